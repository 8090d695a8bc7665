"""The batch jobs: raw files to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from wickline.functions import DAY_US, SECOND_US, as_date, bucket_start, utc_date
from wickline.operators.bars import ohlcv
from wickline.operators.dedup import dedup
from wickline.operators.enrich import to_silver
from wickline.operators.gaps import FALLBACK_SECONDS, infer_interval
from wickline.operators.quality import validate
from wickline.operators.rollup import GAP_STATES, stored_interval, update_gaps
from wickline.operators.tables import publish, replace_partitions, restrict, upsert
from wickline.schemas import (
    BRONZE,
    BRONZE_PARTITIONS,
    GOLD,
    SILVER,
    SILVER_KEYS,
    TABLE_PARTITIONS,
    conform,
)
from wickline.session import require_utc, staged
from wickline.sources.raw import marked_rows
from wickline.sources.tables import read_metadata, read_table


_HAS_KEY = "open_time IS NOT NULL AND symbol IS NOT NULL AND symbol != ''"


def _of_batch(df: DataFrame, batch_date: date | str | None) -> DataFrame:
    if batch_date is None:
        return df
    return df.filter(F.col("ingestion_date") == F.lit(as_date(batch_date)))


def _reached(
    spark: SparkSession, silver: DataFrame, bronze: str | None, batch_date: date | str | None
) -> DataFrame:
    """The silver partitions that the bronze rows of a batch fall into; all without both arguments."""
    if bronze is None or batch_date is None:
        return silver
    logged = _of_batch(read_table(spark, bronze, BRONZE), batch_date).filter(_HAS_KEY)
    places = logged.select("symbol", utc_date("open_time").alias("date"))
    return restrict(silver, places, TABLE_PARTITIONS, TABLE_PARTITIONS)


def to_bronze(rows: DataFrame, batch_date: date | str | None = None) -> DataFrame:
    """Raw rows stamped with their batch date (default: today); rows without a symbol are dropped."""
    stamp = F.current_date() if batch_date is None else F.lit(as_date(batch_date))
    return conform(rows.filter("symbol != ''"), BRONZE, ingestion_date=stamp)


def fated(rows: DataFrame, batch_date: date | str | None = None) -> DataFrame:
    """Raw rows marked ``damaged``, in bronze form, with the ``fate`` that :func:`publish` goes by.

    ``stray`` rows lie in no symbol folder; a ``damaged`` one stands for an archive that could not be read.
    """
    stamp = F.current_date() if batch_date is None else F.lit(as_date(batch_date))
    fate = F.when(F.col("damaged"), "damaged").when(F.col("symbol") == "", "stray").otherwise("kept")
    schema = StructType([*BRONZE.fields, StructField("fate", StringType(), False)])
    return conform(rows.withColumn("fate", fate), schema, ingestion_date=stamp)


def ingest(
    spark: SparkSession,
    raw: str,
    bronze: str,
    batch_date: date | str | None = None,
    symbols: list[str] | None = None,
    resolution: str | None = None,
    date_pattern: str | None = None,
) -> dict[str, int]:
    """Append the raw CSV and ZIP files below ``raw`` to the bronze log.

    Returns how much was left out, which the footers of the written files tell: ``damaged_archives``, and
    ``rows_without_symbol``, which lie in no symbol folder.
    """
    require_utc(spark)
    rows = marked_rows(spark, raw, symbols, resolution, date_pattern)
    fates = publish(fated(rows, batch_date), bronze, BRONZE_PARTITIONS, uuid.uuid4().hex)
    return {"damaged_archives": fates["damaged"], "rows_without_symbol": fates["stray"]}


def refine(
    spark: SparkSession,
    bronze: str,
    silver: str,
    metadata: str,
    batch_date: date | str | None = None,
    gaps: str | None = None,
) -> int:
    """Upsert a bronze batch (all of bronze without ``batch_date``) into silver.

    Of rows with one key the newest ingestion wins, whatever the order in which batches arrive, so a
    batch may be run again or late.

    Rows without a key cannot be merged. They are left out, and their number is returned, which takes a
    scan of the two key columns of the batch.

    With ``gaps``, the histogram table there is brought up to date for the partitions that the batch reached,
    so that :func:`aggregate` need not read candles for their spacing.
    """
    require_utc(spark)
    batch = _of_batch(read_table(spark, bronze, BRONZE), batch_date)
    rows = to_silver(dedup(batch.filter(_HAS_KEY)), read_metadata(spark, metadata))
    upsert(spark, rows, silver, SILVER_KEYS, SILVER, unique=True, resolve=dedup)
    if gaps is not None:
        places = batch.filter(_HAS_KEY).select("symbol", utc_date("open_time").alias("date"))
        reached = restrict(read_table(spark, silver, SILVER), places, TABLE_PARTITIONS, TABLE_PARTITIONS)
        update_gaps(reached, gaps)
    return batch.filter(~F.coalesce(F.expr(_HAS_KEY), F.lit(False))).count()


def rebuilt_bars(silver: DataFrame, batch: DataFrame, window_us: int) -> DataFrame:
    """All bars of the gold partitions that ``batch`` falls into, each from all of its silver rows.

    A bar belongs to the date it starts on. Whole ``(symbol, date)`` partitions are rebuilt, so that no
    bar of another width or of an earlier state of silver can stay beside the new ones. The dates that
    a partition's bars cover prune the silver scan.
    """
    start = utc_date(bucket_start("open_time", window_us))
    days = batch.select("symbol", start.alias("start_date")).distinct()
    beyond = (window_us - 1) // DAY_US + (DAY_US % window_us > 0)
    covered = F.sequence("start_date", F.date_add("start_date", beyond))
    spread = days.withColumn("date", F.explode(covered))
    rows = restrict(
        silver.withColumn("start_date", start), spread, ["symbol", "start_date"], TABLE_PARTITIONS
    )
    return ohlcv(rows, window_us)


def aggregate(
    spark: SparkSession,
    silver: str,
    gold: str,
    batch_date: date | str | None = None,
    window_seconds: int | None = None,
    skip_validation: bool = False,
    skip_optimize: bool = False,
    fallback_seconds: int = FALLBACK_SECONDS,
    bronze: str | None = None,
    gaps: str | None = None,
) -> int | None:
    """Bring gold up to date with a silver batch; returns the bar width, ``None`` for an empty batch.

    Silver is not laid out by ``ingestion_date``. With ``bronze``, which is, the partitions that the batch
    can have reached are read from there, and only those of silver are opened.

    The bar width follows the spacing of all silver rows in the partitions that the batch touches, unless
    ``window_seconds`` is given. With ``gaps``, the histogram table that :func:`refine` keeps, it is found there.
    Unless ``skip_optimize``, the rewritten partitions are ordered by
    ``timestamp`` in the same write.
    """
    require_utc(spark)
    table = read_table(spark, silver, SILVER)
    rows = _of_batch(_reached(spark, table, bronze, batch_date), batch_date).filter(_HAS_KEY)
    needed = ["symbol", "open_time", "open", "high", "low", "close", "volume"]
    with staged(rows.select(*needed), "batch") as batch:
        if batch.isEmpty():
            return None
        if not skip_validation:
            validate(batch)
        if window_seconds:
            seconds = window_seconds
        else:
            touched = batch.select("symbol", utc_date("open_time").alias("date"))
            if gaps is None:
                whole = restrict(table, touched, TABLE_PARTITIONS, TABLE_PARTITIONS).filter("open_time IS NOT NULL")
                seconds = infer_interval(whole, fallback_seconds)
            else:
                states = read_table(spark, gaps, GAP_STATES)
                known = stored_interval(restrict(states, touched, TABLE_PARTITIONS, TABLE_PARTITIONS)).first()
                seconds = fallback_seconds if known is None else known.interval_seconds
        bars = rebuilt_bars(table, batch, seconds * SECOND_US)
        replace_partitions(bars, gold, GOLD, order=None if skip_optimize else ["timestamp"])
    return seconds


def yesterday() -> date:
    return datetime.now(timezone.utc).date() - timedelta(days=1)


def run_pipeline(
    spark: SparkSession,
    raw: str,
    bronze: str,
    silver: str,
    gold: str,
    metadata: str,
    batch_date: date | str | None = None,
    window_seconds: int | None = None,
    skip_validation: bool = False,
    skip_optimize: bool = False,
    gaps: str | None = None,
    **scope,
) -> date:
    """Ingest, refine and aggregate one batch (default: yesterday, UTC); returns its date.

    ``gaps`` names the histogram table of candle gaps that the last two steps share.

    ``scope`` may narrow the raw files: ``symbols``, ``resolution``, ``date_pattern``.
    """
    day = yesterday() if batch_date is None else as_date(batch_date)
    ingest(spark, raw, bronze, day, **scope)
    refine(spark, bronze, silver, metadata, day, gaps)
    aggregate(spark, silver, gold, day, window_seconds, skip_validation, skip_optimize, bronze=bronze, gaps=gaps)
    return day
