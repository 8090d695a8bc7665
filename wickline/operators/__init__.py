from wickline.operators.bars import TIMEFRAMES, ohlcv, resample
from wickline.operators.dedup import dedup
from wickline.operators.enrich import to_silver, with_coin_names
from wickline.operators.gaps import infer_interval, interval_gaps, source_interval
from wickline.operators.market import (
    freshness,
    last_24h,
    market_overview,
    newest_timestamp,
    pct_change_24h,
    top_movers,
    volume_24h,
)
from wickline.operators.quality import (
    SILVER_SUITE,
    QualityError,
    quality_counts,
    run_suite,
    validate,
)
from wickline.operators.rollup import (
    BAR_STATES,
    GAP_STATES,
    add_bars,
    coarse_bars,
    replace_bars,
    stored_interval,
    update_gaps,
)
from wickline.operators.selection import (
    CHART_ROWS,
    TABLE_ROWS,
    close_between,
    close_bounds,
    in_time_order,
    latest,
    load_bars,
    range_summary,
    volume_at_least,
    volume_bounds,
)
from wickline.operators.tables import append, cluster, export_csv, replace_partitions, upsert

__all__ = [
    "BAR_STATES",
    "CHART_ROWS",
    "GAP_STATES",
    "SILVER_SUITE",
    "TABLE_ROWS",
    "TIMEFRAMES",
    "QualityError",
    "add_bars",
    "append",
    "close_between",
    "close_bounds",
    "cluster",
    "coarse_bars",
    "dedup",
    "export_csv",
    "freshness",
    "in_time_order",
    "infer_interval",
    "interval_gaps",
    "last_24h",
    "latest",
    "load_bars",
    "market_overview",
    "newest_timestamp",
    "ohlcv",
    "pct_change_24h",
    "quality_counts",
    "range_summary",
    "replace_bars",
    "replace_partitions",
    "resample",
    "run_suite",
    "source_interval",
    "stored_interval",
    "to_silver",
    "top_movers",
    "update_gaps",
    "upsert",
    "validate",
    "volume_24h",
    "volume_at_least",
    "volume_bounds",
    "with_coin_names",
]
