"""Scans of the layer tables and of the coin dimension."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wickline.schemas import GOLD, METADATA, SILVER
from wickline.session import hadoop_path


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A layer table. The declared schema also fixes the types of the partition columns."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def table_exists(spark: SparkSession, path: str) -> bool:
    folder, files = hadoop_path(spark, path)
    return files.exists(folder)


def newest_date(spark: SparkSession, path: str) -> date | None:
    """The newest ``date`` of a layer table, from the names of its folders; no data file is opened."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    day = F.to_date(F.regexp_extract("path", "/date=([0-9-]{10})/", 1))
    return files.agg(F.max(day)).first()[0]


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """The coin dimension: a CSV with the header ``symbol,name``."""
    return spark.read.schema(METADATA).csv(path, header=True)


def symbols(meta: DataFrame) -> DataFrame:
    """Sorted distinct symbols, nulls dropped."""
    return meta.select("symbol").dropna().distinct().orderBy("symbol")


def register_views(
    spark: SparkSession, silver: str | DataFrame | None = None, gold: str | DataFrame | None = None
) -> None:
    """(Re-)register ``silver_klines`` and ``gold_ohlcv`` from table paths or frames."""
    for view, table, schema in (("silver_klines", silver, SILVER), ("gold_ohlcv", gold, GOLD)):
        if isinstance(table, str):
            spark.catalog.refreshByPath(table)
            table = read_table(spark, table, schema)
        if table is not None:
            table.createOrReplaceTempView(view)
