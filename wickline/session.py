"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "wickline") -> SparkSession:
    """A session for tests and the bench. On a cluster the caller brings their own."""
    return (
        SparkSession.builder.appName(app)
        .master(f"local[{cores}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # Small local batches still write their partition folders in parallel.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .getOrCreate()
    )


def require_utc(spark: SparkSession) -> None:
    """Readable times and ``current_date`` follow the session zone; the tables are in UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone is {zone!r}; set it to 'UTC'")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder the cluster names in ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="wickline-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/wickline-{label}-{uuid.uuid4().hex}"


@contextmanager
def staged(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """Write ``df`` once to the scratch folder and read it back for the life of the block.

    A batch that feeds several jobs (checks, touched partitions, merge) is thereby computed once
    and frozen: a lost executor re-reads files instead of recomputing clock-dependent columns, and
    each later job reads only the columns it needs. The copy is dropped when the block ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        folder, files = hadoop_path(spark, path)
        files.delete(folder, True)


def hadoop_path(spark: SparkSession, path: str) -> tuple:
    """``path`` and the file system it is on, whatever the store."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
