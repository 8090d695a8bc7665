"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: ASCII white space as a class of Java regular expressions.
SPACE = "[\\x20\\x09-\\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    It cuts the lineage: later jobs read files, also after an executor is lost.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_az(text: Column) -> Column:
    """``text`` with A-Z in lower case and everything else as it is."""
    return F.translate(text, _UPPER, _UPPER.lower())


def words(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), f"{SPACE}+")
    return F.filter(parts, lambda word: word != "")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as make it new to ``df``."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where lambdas inside ``body`` refer to it."""
    return F.transform(F.array(value), body)[0]


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))
