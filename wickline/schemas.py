"""Declared schemas of every layer. Nothing in this package infers a schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_LONG, _DOUBLE, _TEXT, _DATE = T.LongType(), T.DoubleType(), T.StringType(), T.DateType()
_PRICES = dict.fromkeys(("open", "high", "low", "close", "volume"), _DOUBLE)

# The column layout of the published kline files and of the layers built from them.
_KLINE = {
    "open_time": _LONG,
    **_PRICES,
    "close_time": _LONG,
    "quote_asset_volume": _DOUBLE,
    "num_trades": _LONG,
    "taker_buy_base": _DOUBLE,
    "taker_buy_quote": _DOUBLE,
    "ignore": _LONG,
}
RAW = _schema(**_KLINE)
BRONZE = _schema(**_KLINE, symbol=_TEXT, ingestion_date=_DATE)
SILVER = _schema(
    **_KLINE,
    symbol=_TEXT,
    date=_DATE,
    ingestion_date=_DATE,
    ingestion_ts=T.TimestampType(),
    coin_name=_TEXT,
)
GOLD = _schema(symbol=_TEXT, timestamp=_LONG, **_PRICES, num_trades=_LONG, date=_DATE)
METADATA = _schema(symbol=_TEXT, name=_TEXT)

BRONZE_PARTITIONS = ["ingestion_date"]
TABLE_PARTITIONS = ["symbol", "date"]
SILVER_KEYS = ["symbol", "open_time"]
GOLD_KEYS = ["symbol", "timestamp"]


def conform(df: DataFrame, schema: T.StructType, **given: Column) -> DataFrame:
    """Project ``df`` to exactly ``schema``: its columns, its order, its types.

    ``given`` adds columns that ``df`` does not have yet. Types may only widen; anything lossy fails.
    """
    return df.withColumns(given).to(schema)
