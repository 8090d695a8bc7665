from wickline.sources.archives import register_archives, write_archives
from wickline.sources.raw import read_kline_archives, read_klines, read_raw, unpack_archives
from wickline.sources.tables import (
    newest_date,
    read_metadata,
    read_table,
    register_views,
    symbols,
    table_exists,
)

__all__ = [
    "newest_date",
    "read_kline_archives",
    "read_klines",
    "read_metadata",
    "read_raw",
    "read_table",
    "register_views",
    "symbols",
    "table_exists",
    "register_archives",
    "unpack_archives",
    "write_archives",
]
