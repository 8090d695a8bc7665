"""Selecting bars: symbol and date range, value filters, newest rows, range summary."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.functions import as_date

MAX_DAYS = 30  # fixed value: the longest range that a page may show; a guard only where it is passed
CHART_ROWS = 5000  # fixed values: how many rows a chart and a table show
TABLE_ROWS = 1000


def load_bars(
    gold: DataFrame,
    symbol: str,
    start: date | str,
    end: date | str,
    max_days: int | None = None,
) -> DataFrame:
    """Bars of one symbol from ``start`` to ``end`` inclusive, plus ``time`` as a timestamp.

    Both filters are on partition columns of the gold table, so only those folders are read.
    """
    first, last = as_date(start), as_date(end)
    if first > last:
        raise ValueError("start date is after end date")
    span = (last - first).days + 1
    if max_days is not None and span > max_days:
        raise ValueError(f"range spans {span} days, at most {max_days} are allowed")
    return (
        gold.filter(F.col("symbol") == symbol)
        .filter(F.col("date").between(F.lit(first), F.lit(last)))
        .withColumn("time", F.timestamp_micros("timestamp"))
    )


def close_bounds(bars: DataFrame) -> DataFrame:
    """Smallest and largest close, the default ends of :func:`close_between`."""
    return bars.agg(F.min("close").alias("min_close"), F.max("close").alias("max_close"))


def close_between(
    bars: DataFrame, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Bars with a close in ``[low, high]``; an open end means the bound of the data itself."""
    kept = bars.filter(F.col("close").isNotNull())
    if low is not None:
        kept = kept.filter(F.col("close") >= low)
    if high is not None:
        kept = kept.filter(F.col("close") <= high)
    return kept


def volume_bounds(bars: DataFrame) -> DataFrame:
    """Smallest and largest volume of what the close filter left."""
    return bars.agg(F.min("volume").alias("min_volume"), F.max("volume").alias("max_volume"))


def volume_at_least(bars: DataFrame, low: float | None = None) -> DataFrame:
    kept = bars.filter(F.col("volume").isNotNull())
    return kept if low is None else kept.filter(F.col("volume") >= low)


def in_time_order(bars: DataFrame) -> DataFrame:
    return bars.orderBy("timestamp", "symbol")


def latest(bars: DataFrame, n: int, newest_first: bool = True) -> DataFrame:
    """The ``n`` newest bars, newest or oldest first. Planned as a top-k, never as a full sort."""
    newest = bars.orderBy(F.col("timestamp").desc(), "symbol").limit(n)
    return newest if newest_first else newest.orderBy("timestamp", F.col("symbol").desc())


def range_summary(bars: DataFrame) -> DataFrame:
    """Per symbol: first and last close, total volume, absolute and percent change of the selection.

    The percent change is 0 when the first close is 0.
    """
    ends = bars.groupBy("symbol").agg(
        F.min_by("close", "timestamp").alias("first_close"),
        F.max_by("close", "timestamp").alias("last_close"),
        F.sum("volume").alias("total_volume"),
    )
    change = F.col("last_close") - F.col("first_close")
    percent = F.when(F.col("first_close") != 0, change / F.col("first_close") * 100)
    return ends.withColumn("change", change).withColumn(
        "pct_change", percent.when(F.col("first_close") == 0, F.lit(0.0))
    )
