"""Coarse bars and gap histograms that are kept up to date batch by batch.

Both are tables of mergeable states. A coarse bar's state holds the first and the last price with their times,
so that two states of one bar merge into that of all their rows, in any order. A day's histogram holds the
gaps inside the day and the day's first and last time, from which the gap to the next day follows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wickline.functions import utc_date
from wickline.operators.bars import TIMEFRAMES, bar_label
from wickline.operators.gaps import interval_gaps, median_seconds, rounded_seconds
from wickline.operators.tables import replace_partitions, restrict
from wickline.schemas import TABLE_PARTITIONS, conform
from wickline.session import staged
from wickline.sources.tables import read_table, table_exists

_LONG, _DOUBLE, _TEXT = T.LongType(), T.DoubleType(), T.StringType()
BAR_STATES = T.StructType(
    [
        T.StructField("symbol", _TEXT),
        T.StructField("timestamp", _LONG),
        T.StructField("open", _DOUBLE),
        T.StructField("open_time", _LONG),
        T.StructField("high", _DOUBLE),
        T.StructField("low", _DOUBLE),
        T.StructField("close", _DOUBLE),
        T.StructField("close_time", _LONG),
        T.StructField("volume", _DOUBLE),
        T.StructField("month", _TEXT),
    ]
)
GAP_STATES = T.StructType(
    [
        T.StructField("symbol", _TEXT),
        T.StructField("seconds", _LONG),
        T.StructField("n", _LONG),
        T.StructField("first", _LONG),
        T.StructField("last", _LONG),
        T.StructField("date", T.DateType()),
    ]
)
_MONTHS = ["symbol", "month"]


def bar_states(bars: DataFrame, timeframe: str) -> DataFrame:
    """Each bar as the state of the coarse bar it falls into, not yet merged."""
    if timeframe not in TIMEFRAMES[1:]:
        raise ValueError(f"unknown timeframe {timeframe!r}; use one of {TIMEFRAMES[1:]}")

    def time_of(price: str) -> Column:
        return F.when(F.col(price).isNotNull(), F.col("timestamp"))

    label = bar_label(timeframe)
    return bars.select(
        "symbol",
        label.alias("timestamp"),
        "open",
        time_of("open").alias("open_time"),
        "high",
        "low",
        "close",
        time_of("close").alias("close_time"),
        "volume",
        F.date_format(utc_date(label), "yyyy-MM").alias("month"),
    )


def merge_states(states: DataFrame) -> DataFrame:
    """One state for each coarse bar. Partially aggregated before the shuffle, like bars themselves."""
    return states.groupBy("symbol", "timestamp", "month").agg(
        F.min_by("open", "open_time").alias("open"),
        F.min("open_time").alias("open_time"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "close_time").alias("close"),
        F.max("close_time").alias("close_time"),
        F.sum("volume").alias("volume"),
    )


def add_bars(spark: SparkSession, bars: DataFrame, path: str, timeframe: str) -> None:
    """Merge new bars into the coarse bars of the state table at ``path``, which the first call creates.

    Only the months of the symbols that the batch falls into are read and rewritten. ``bars`` must be new:
    a bar that is added twice counts twice in the volume. After a correction of bars already added, use
    :func:`replace_bars` with all bars of the months it touches.
    """
    with staged(conform(merge_states(bar_states(bars, timeframe)), BAR_STATES), "bar-states") as batch:
        merged = batch
        if table_exists(spark, path):
            touched = restrict(read_table(spark, path, BAR_STATES), batch, _MONTHS, _MONTHS)
            merged = merge_states(touched.select(*BAR_STATES.names).unionByName(batch))
        with staged(conform(merged, BAR_STATES), "merged-states") as states:
            replace_partitions(states, path, BAR_STATES, _MONTHS, order=["timestamp"])


def replace_bars(bars: DataFrame, path: str, timeframe: str) -> None:
    """Rebuild the coarse bars of the months that ``bars`` fall into from ``bars`` alone."""
    replace_partitions(merge_states(bar_states(bars, timeframe)), path, BAR_STATES, _MONTHS, order=["timestamp"])


def coarse_bars(states: DataFrame) -> DataFrame:
    """The bars of a state table, as :func:`wickline.operators.resample` gives them."""
    prices = ["open", "high", "low", "close"]
    return states.select("symbol", "timestamp", *prices, F.coalesce("volume", F.lit(0.0)).alias("volume")).dropna(subset=prices)


def gap_states(rows: DataFrame, time: str = "open_time") -> DataFrame:
    """Histogram rows ``seconds, n`` of the gaps inside each ``(symbol, date)``, and one row with its ends."""
    rows = rows.filter(F.col(time).isNotNull()).select("symbol", "date", time)
    # The gaps of a day are found as those of a symbol are, with the day in the place of the symbol.
    by_day = rows.select(F.struct("symbol", "date").alias("symbol"), time)
    gaps = interval_gaps(by_day, time).groupBy("symbol", rounded_seconds().alias("seconds")).agg(F.count("*").alias("n"))
    none = F.lit(None).cast("bigint")
    inside = gaps.select("symbol.symbol", "symbol.date", "seconds", "n", none.alias("first"), none.alias("last"))
    ends = rows.groupBy("symbol", "date").agg(F.min(time).alias("first"), F.max(time).alias("last"))
    return inside.unionByName(ends.withColumns({"seconds": none, "n": none}))


def update_gaps(rows: DataFrame, path: str, time: str = "open_time") -> None:
    """Bring the histogram table up to date: ``rows`` are all rows of the ``(symbol, date)`` partitions they fall into."""
    replace_partitions(gap_states(rows, time), path, GAP_STATES, TABLE_PARTITIONS)


def stored_interval(states: DataFrame) -> DataFrame:
    """:func:`source_interval` of the rows behind a histogram table, as one row ``interval_seconds``.

    Reads histograms and one row a day, not candles. A window over a symbol's days holds 366 rows a year.
    """
    inside = states.filter("seconds IS NOT NULL").select("seconds", "n")
    days = Window.partitionBy("symbol").orderBy("first")
    ends = states.filter("first IS NOT NULL")
    between = ends.select((F.col("first") - F.lag("last").over(days)).alias("interval_us")).filter("interval_us > 0")
    counted = inside.unionByName(between.select(rounded_seconds().alias("seconds"), F.lit(1).cast("bigint").alias("n")))
    return median_seconds(counted.groupBy("seconds").agg(F.sum("n").alias("n")))
