"""Market reports over the newest 24 hours of the gold table.

``newest`` is the newest date of the given bars, for a whole table ``sources.newest_date``. With it each scan
of a report is pruned to that date and the one before; without it the date column of all bars is read.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.functions import DAY_US, MINUTE_US, as_micros, utc_date


def newest_timestamp(gold: DataFrame, newest: date | None = None) -> DataFrame:
    """The largest bar timestamp as one row ``max_timestamp``, null for an empty table."""
    day = gold.agg(F.max("date")).scalar() if newest is None else F.lit(newest)
    return gold.filter(F.col("date") == day).agg(F.max("timestamp").alias("max_timestamp"))


def last_24h(gold: DataFrame, newest: date | None = None) -> DataFrame:
    """Bars of the 24 hours that end at the newest bar, both ends included.

    The bound on ``date`` follows from the one on ``timestamp``; it is stated so that older
    partitions are not opened.
    """
    last = newest_timestamp(gold, newest)
    since = F.col("max_timestamp") - DAY_US
    first_day = last.select(utc_date(since)).scalar() if newest is None else F.lit(newest - timedelta(days=1))
    return gold.filter(F.col("date") >= first_day).filter(
        F.col("timestamp") >= last.select(since).scalar()
    )


def _percent_change() -> Column:
    first = F.min_by("close", "timestamp")
    return F.try_divide(F.max_by("close", "timestamp") - first, first) * 100


def pct_change_24h(gold: DataFrame, newest: date | None = None) -> DataFrame:
    """Percent change of the close per symbol; null when the first close is 0."""
    return last_24h(gold, newest).groupBy("symbol").agg(_percent_change().alias("pct_change"))


def top_movers(
    gold: DataFrame, n: int = 1, losers: bool = False, newest: date | None = None
) -> DataFrame:
    """The ``n`` best (or worst) symbols by 24-hour change; ties go to the smaller symbol."""
    change = F.col("pct_change")
    ranked = pct_change_24h(gold, newest).filter(change.isNotNull())
    return ranked.orderBy(change.asc() if losers else change.desc(), "symbol").limit(n)


def volume_24h(gold: DataFrame, newest: date | None = None) -> DataFrame:
    """Total volume of the 24 hours over all symbols, 0 when there is none."""
    return last_24h(gold, newest).agg(F.coalesce(F.sum("volume"), F.lit(0.0)).alias("volume_24h"))


def _minutes_old(newest: Column, as_of: datetime) -> Column:
    return F.greatest((F.lit(as_micros(as_of)) - newest) / MINUTE_US, F.lit(0.0))


def freshness(gold: DataFrame, as_of: datetime, newest: date | None = None) -> DataFrame:
    """Minutes from the newest bar to ``as_of``, never negative."""
    return newest_timestamp(gold, newest).select(
        _minutes_old(F.col("max_timestamp"), as_of).alias("freshness_minutes")
    )


def market_overview(gold: DataFrame, as_of: datetime, newest: date | None = None) -> DataFrame:
    """Top gainer, top loser, 24-hour volume and freshness in one row; no row for an empty table."""
    per_symbol = (
        last_24h(gold, newest)
        .groupBy("symbol")
        .agg(
            _percent_change().alias("pct_change"),
            F.sum("volume").alias("volume"),
            F.max("timestamp").alias("newest"),
        )
    )
    change = F.col("pct_change")
    gain = F.when(change.isNotNull(), F.struct(-change, "symbol"))
    loss = F.when(change.isNotNull(), F.struct(change, "symbol"))
    return (
        per_symbol.agg(
            F.min_by("symbol", gain).alias("top_gainer"),
            F.max("pct_change").alias("top_gainer_pct"),
            F.min_by("symbol", loss).alias("top_loser"),
            F.min("pct_change").alias("top_loser_pct"),
            F.coalesce(F.sum("volume"), F.lit(0.0)).alias("volume_24h"),
            F.max("newest").alias("max_timestamp"),
        )
        .filter("max_timestamp IS NOT NULL")
        .withColumn("freshness_minutes", _minutes_old(F.col("max_timestamp"), as_of))
        .drop("max_timestamp")
    )
