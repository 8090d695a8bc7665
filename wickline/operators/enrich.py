"""Silver projection: derived columns and the coin dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.functions import utc_date
from wickline.schemas import SILVER, conform

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024


def _dimension(meta: DataFrame) -> DataFrame:
    """The dimension ready to join: unique by symbol, broadcast only if it is measured small.

    The measuring is a Spark job over the dimension that runs while the plan is built.
    """
    size = F.octet_length("symbol") + F.coalesce(F.octet_length("name"), F.lit(0))
    named = meta.filter("symbol IS NOT NULL")
    facts = (
        named.groupBy("symbol")
        .agg(F.count("*").alias("copies"), F.sum(size).alias("bytes"))
        .agg(F.count("*").alias("n"), F.max("copies").alias("copies"), F.sum("bytes").alias("bytes"))
        .first()
    )
    if facts.n and facts.copies > 1:
        raise ValueError("the dimension has more than one row for some symbol")
    names = named.select("symbol", F.col("name").alias("coin_name"))
    if facts.n <= BROADCAST_ROWS and (facts.bytes or 0) <= BROADCAST_BYTES:
        return F.broadcast(names)
    return names  # left to the planner: a shuffle join whose skewed symbols are split at run time


def with_coin_names(df: DataFrame, meta: DataFrame) -> DataFrame:
    """Left join to the coin dimension: every row stays, an unknown symbol gets a null name."""
    return df.join(_dimension(meta), "symbol", "left")


def to_silver(bronze: DataFrame, meta: DataFrame) -> DataFrame:
    """The 17 silver columns of deduplicated bronze rows."""
    return conform(
        with_coin_names(bronze, meta),
        SILVER,
        date=utc_date("open_time"),
        ingestion_ts=F.current_timestamp(),
    )
