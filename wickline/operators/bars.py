"""OHLCV bars: time buckets of candles, and coarser bars from finer ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.functions import DAY_US, HOUR_US, bucket_start, utc_date, week_label
from wickline.schemas import GOLD, conform

_OHLCV = ["open", "high", "low", "close", "volume"]

# The timeframes on offer. ``1m`` means the bars as they are.
TIMEFRAMES = ("1m", "1H", "4H", "1D", "1W")
_WIDTHS = {"1H": HOUR_US, "4H": 4 * HOUR_US, "1D": DAY_US}


def ohlcv(df: DataFrame, window_us: int | Column) -> DataFrame:
    """One gold bar per symbol and time bucket.

    First and last are by ``open_time``, not by arrival. All six measures are partially aggregated
    before the shuffle, so a hot symbol or bucket sends one row per map task.
    """
    bars = (
        df.withColumn("timestamp", bucket_start("open_time", window_us))
        .groupBy("symbol", "timestamp")
        .agg(
            F.min_by("open", "open_time").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "open_time").alias("close"),
            F.sum("volume").alias("volume"),
            F.sum("num_trades").alias("num_trades"),
        )
    )
    return conform(bars, GOLD, date=utc_date("timestamp"))


def bar_label(timeframe: str) -> Column:
    """The label of the coarse bar that a bar falls into."""
    return week_label("timestamp") if timeframe == "1W" else bucket_start("timestamp", _WIDTHS[timeframe])


def resample(bars: DataFrame, timeframe: str) -> DataFrame:
    """Bars of a coarser ``timeframe`` as ``symbol, timestamp, open, high, low, close, volume``.

    Nulls are skipped by first and last, and a bar without any price is dropped. Hour, four-hour and
    day bars are labelled by their start, week bars by the Sunday that ends them.
    """
    if timeframe not in TIMEFRAMES:
        raise ValueError(f"unknown timeframe {timeframe!r}; use one of {TIMEFRAMES}")
    if timeframe == "1m":
        return bars.select("symbol", "timestamp", *_OHLCV)
    label = bar_label(timeframe)

    def time_of(price: str) -> Column:
        return F.when(F.col(price).isNotNull(), F.col("timestamp"))

    return (
        bars.groupBy("symbol", label.alias("timestamp"))
        .agg(
            F.min_by("open", time_of("open")).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", time_of("close")).alias("close"),
            F.coalesce(F.sum("volume"), F.lit(0.0)).alias("volume"),
        )
        .dropna(subset=_OHLCV)
    )
