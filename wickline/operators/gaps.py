"""Spacing of candles: gaps between neighbours, and the source interval as their exact median."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.functions import HOUR_US, SECOND_US, bucket_start

FALLBACK_SECONDS = 300  # fixed value: the window used when no gap exists

_BLOCK_BITS = 22  # a gap of epoch microseconds has at most 44 bits of seconds


def _gaps_within(runs: DataFrame, groups: str) -> DataFrame:
    before = f"lag(last) OVER (PARTITION BY {groups} ORDER BY first)"
    return runs.selectExpr("symbol", "first AS open_time", f"first - {before} AS interval_us")


def interval_gaps(
    df: DataFrame, time: str = "open_time", spans: tuple[int, ...] = (HOUR_US,)
) -> DataFrame:
    """Positive gaps to the previous candle of the same symbol, as ``symbol, open_time, interval_us``.

    Expects at most one row per ``(symbol, open_time)``. One window per symbol would put a symbol's
    whole history in one task. Instead rows are windowed inside time slots of ``spans[0]``; each slot
    then stands as one run (first and last time) inside the next longer span, and finally inside the
    symbol. Every gap appears once: inside a slot, or between two neighbouring slots. Candles are
    whole seconds apart, so an hour holds at most 3,600 rows and a symbol 8,784 runs a year; for finer
    data, pass a shorter span first. Each level shuffles once (the runs reuse the slot partitioning).
    """
    runs = df.filter(F.col(time).isNotNull()).selectExpr(
        "symbol", f"`{time}` AS first", f"`{time}` AS last"
    )
    found = []
    for span in spans:
        slots = runs.withColumn("slot", bucket_start("first", span)).repartition("slot", "symbol")
        found.append(_gaps_within(slots, "slot, symbol"))
        ends = F.min("first").alias("first"), F.max("last").alias("last")
        runs = slots.groupBy("slot", "symbol").agg(*ends).drop("slot")
    found.append(_gaps_within(runs, "symbol"))
    return reduce(DataFrame.unionByName, found).filter("interval_us > 0")


def rounded_seconds(gap: str = "interval_us") -> Column:
    """A gap in whole seconds, rounded half-even, at least 1."""
    return F.greatest(F.bround(F.col(gap) / SECOND_US, 0).cast("bigint"), F.lit(1))


def source_interval(df: DataFrame, time: str = "open_time") -> DataFrame:
    """The source interval in whole seconds as one row ``interval_seconds`` (none if there is no gap).

    It is the exact discrete median of all gaps over all symbols, rounded half-even, at least 1.
    Rounding keeps the order, so the median is taken over rounded seconds: a histogram, counted
    before the shuffle.
    """
    return median_seconds(interval_gaps(df, time).groupBy(rounded_seconds().alias("seconds")).agg(F.count("*").alias("n")))


def median_seconds(counts: DataFrame) -> DataFrame:
    """The discrete median of a histogram ``seconds, n``, as one row ``interval_seconds`` (none if it is empty).

    It is located in two steps, first its block of 2^22 seconds, then the second inside that block, so that
    neither running count exceeds 2^22 rows whatever the gaps.
    """
    block_of = f"shiftright(seconds, {_BLOCK_BITS})"

    block = (
        counts.groupBy(F.expr(block_of).alias("block"))
        .agg(F.sum("n").alias("n"))
        .selectExpr(
            "block", "n", "sum(n) OVER (ORDER BY block) AS upto", "(sum(n) OVER () + 1) div 2 AS place"
        )
        .filter("upto >= place")
        .orderBy("block")
        .limit(1)
        .selectExpr("block", "place - (upto - n) AS place")
    )
    return (
        counts.join(F.broadcast(block), F.expr(f"{block_of} = block"))
        .selectExpr("seconds", "place", "sum(n) OVER (ORDER BY seconds) AS upto")
        .filter("upto >= place")
        .orderBy("seconds")
        .limit(1)
        .selectExpr("seconds AS interval_seconds")
    )


def infer_interval(
    df: DataFrame, fallback: int = FALLBACK_SECONDS, time: str = "open_time"
) -> int:
    """The source interval as a number; ``fallback`` when no two candles follow each other.

    Gold bars have their time in another column: ``infer_interval(gold, time="timestamp")``.
    """
    row = source_interval(df, time).first()
    return fallback if row is None else row.interval_seconds
