"""Writing and maintaining partitioned Parquet tables.

Limits: one writer per table. Tasks may fail and rerun at will, but the swap of rewritten partitions
is done by the driver at job commit, partition by partition. A driver that dies inside the commit leaves
some partitions old, some new, and possibly one missing; rebuild it from the layer below by running
the job without a batch date (bronze is only ever appended to).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wickline.schemas import TABLE_PARTITIONS, conform
from wickline.session import hadoop_path, staged
from wickline.sources.tables import read_table, table_exists


def append(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Add rows to a log table. No shuffle: each task writes what it holds."""
    df.write.partitionBy(*partitions).mode("append").parquet(path)


def _matching(spark: SparkSession, pattern: str) -> tuple[list, object]:
    """Paths that match a glob, and their file system."""
    glob, files = hadoop_path(spark, pattern)
    return [status.getPath() for status in files.globStatus(glob) or []], files


def publish(rows: DataFrame, path: str, partitions: list[str], name: str) -> Counter:
    """Add the ``rows`` whose ``fate`` is ``kept`` to the table at ``path`` as the load ``name``.

    What that load has added before is replaced. Returns the number of rows of each fate, which the footers of
    the written files tell. Readers pass over the folder in which they are written, as its name begins with an
    underscore. The driver moves the files one by one, as at any job commit.
    """
    spark, root = rows.sparkSession, path.rstrip("/")
    beside, levels = f"{root}/_load-{name}", "/".join(f"{p}=*" for p in partitions)
    earlier, files = _matching(spark, f"{root}/{levels}/load-{name}-*")
    for file in earlier:
        files.delete(file, False)
    rows.write.partitionBy("fate", *partitions).mode("overwrite").parquet(beside)
    fates = spark.read.schema("fate STRING").parquet(beside).groupBy("fate").count().collect()
    kept, _ = hadoop_path(spark, f"{beside}/fate=kept")
    written, files = _matching(spark, f"{beside}/fate=kept/{levels}/part-*")
    for file in written:
        folder = file.getParent().toUri().getPath().removeprefix(kept.toUri().getPath())
        target, _ = hadoop_path(spark, f"{root}{folder}/load-{name}-{file.getName()}")
        files.mkdirs(target.getParent())
        if not files.rename(file, target):
            raise OSError(f"could not move {file} to {target}")
    files.delete(kept.getParent(), True)
    spark.catalog.refreshByPath(path)
    return Counter({r.fate: r["count"] for r in fates})


def restrict(target: DataFrame, keys: DataFrame, on: list[str], prune: list[str]) -> DataFrame:
    """Rows of ``target`` whose ``on`` values occur in ``keys``.

    The smallest and the largest value of each ``prune`` column, one row, come to the driver and let the
    scan skip the partition folders outside. The semi-join is exact; where its keys are small enough for
    Spark to broadcast, they also prune the folders in between when the query runs.
    """
    ends = keys.agg(*[F.struct(F.min(c), F.max(c)) for c in prune]).first()
    within = [F.col(c).between(F.lit(low), F.lit(high)) for c, (low, high) in zip(prune, ends, strict=True)]
    # The bounds drop no key. Stated on the keys too, they make Spark consider dynamic pruning.
    wanted = reduce(DataFrame.filter, within, keys).select(*on).distinct()
    return reduce(DataFrame.filter, within, target).join(wanted, on, "left_semi")


def _write_partitions(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Replace exactly the partitions that occur in ``df``; all others stay.

    The mode is set on the write itself: with the session default (static) the same call would wipe
    the whole table.
    """
    (
        df.write.option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .partitionBy(*partitions)
        .parquet(path)
    )
    df.sparkSession.catalog.refreshByPath(path)


def _sorted_files(df: DataFrame, partitions: list[str], order: list[str]) -> DataFrame:
    """Few, evenly sized files per table partition, each ordered by ``order``.

    Adaptive execution joins small shuffle blocks and splits a table partition that is too large for
    one task. The partition columns lead the sort, so the writer does not sort again.
    """
    return df.hint("rebalance", *partitions).sortWithinPartitions(*partitions, *order)


def _check_keys(source: DataFrame, keys: list[str]) -> None:
    missing = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    facts = (
        source.groupBy(*keys)
        .agg(F.count("*").alias("copies"))
        .agg(
            F.max("copies").alias("copies"),
            F.sum(F.when(missing, F.col("copies"))).alias("missing"),
        )
        .first()
    )
    if facts.missing:
        raise ValueError(f"{facts.missing} source rows have a null in {keys}")
    if (facts.copies or 0) > 1:
        raise ValueError(f"the source has several rows for one {keys}")


def upsert(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: list[str],
    schema: StructType,
    partitions: list[str] = TABLE_PARTITIONS,
    order: list[str] | None = None,
    unique: bool = False,
    resolve: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Keyed merge: a source row replaces the table row with its key, or is added.

    With ``resolve``, a function that keeps one row of each key, it decides between old and new rows.

    ``partitions`` must be functions of ``keys`` (a key always lives in one partition). Only the
    partitions that occur in the source are read and rewritten, through one shuffle, with the rows
    of each file ordered by ``order``. The first call creates the table.

    A null or repeated source key is an error. ``unique`` skips that check, and its shuffle, for a
    source that has one row per key by construction; its first load is written without being staged.
    """
    if unique and not table_exists(spark, path):
        replace_partitions(source, path, schema, partitions, order)
        return
    with staged(conform(source, schema), "upsert") as batch:
        if not unique:
            _check_keys(batch, keys)
        if table_exists(spark, path):
            table = read_table(spark, path, schema)
            touched = restrict(table, batch, partitions, partitions)
            if resolve is None:
                kept = touched.join(batch.select(*keys), keys, "left_anti")
                batch = kept.select(*schema.names).unionByName(batch)
            else:
                batch = resolve(touched.select(*schema.names).unionByName(batch))
        _write_partitions(_sorted_files(batch, partitions, order or []), path, partitions)


def replace_partitions(
    source: DataFrame,
    path: str,
    schema: StructType,
    partitions: list[str] = TABLE_PARTITIONS,
    order: list[str] | None = None,
) -> None:
    """Write ``source`` in place of the whole partitions that occur in it; it must not read ``path``."""
    _write_partitions(_sorted_files(conform(source, schema), partitions, order or []), path, partitions)


def _count_below(value: Column) -> Callable[[Column, Column], Column]:
    return lambda count, bound: count + (bound < value).cast("bigint")


def interleaved(df: DataFrame, columns: list[str], bits: int = 6) -> Column:
    """A key along which rows close in all of ``columns`` lie close: the columns' ranks, bit by bit in turn.

    A rank is the number of the column's ``2**bits - 1`` quantiles below the value, so that skewed columns are
    divided evenly too; one pass finds the quantiles of all columns. Null ranks first.
    """
    share = [i / (1 << bits) for i in range(1, 1 << bits)]
    quantiles = df.agg(*[F.percentile_approx(c, share).alias(c) for c in columns]).first()
    key = F.lit(0).cast("bigint")
    for place, c in enumerate(columns):
        bounds = sorted(set(quantiles[c] or []))
        rank = F.lit(0).cast("bigint")
        if bounds:
            below = F.aggregate(F.array(*[F.lit(b) for b in bounds]), rank, _count_below(F.col(c)))
            rank = F.when(F.col(c).isNull(), rank).otherwise(below)
        for bit in range(bits):
            one = F.shiftright(rank, bit).bitwiseAND(F.lit(1).cast("bigint"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(columns) + len(columns) - 1 - place))
    return key


def cluster(
    spark: SparkSession,
    path: str,
    schema: StructType,
    dates: DataFrame | None = None,
    by: str | list[str] = "timestamp",
    partitions: list[str] = TABLE_PARTITIONS,
    files: int | None = None,
) -> None:
    """Compact the partitions of ``dates`` (a frame with a ``date`` column; all if ``None``) and order
    them by ``by``.

    The rows are range-partitioned by partition and ``by``: small partitions share a task, and a
    large one is cut into files with disjoint ranges, so min/max statistics skip files and row groups.
    Several columns are interleaved, so that a filter on any of them skips files. ``files`` fixes the number
    of ranges, which otherwise follows from the size of the data.
    """
    table = read_table(spark, path, schema)
    if dates is not None:
        table = restrict(table, dates, ["date"], ["date"])
    rows, columns = table.select(*schema.names), [by] if isinstance(by, str) else by
    if len(columns) > 1:
        rows = rows.withColumn("_place", interleaved(rows, columns))
        columns = ["_place", *columns]
    ranged = [*partitions, *columns]
    dealt = rows.repartitionByRange(*ranged) if files is None else rows.repartitionByRange(files, *ranged)
    ordered = dealt.sortWithinPartitions(*ranged).drop("_place")
    _write_partitions(ordered, path, partitions)


# Fixed order of the exported columns; those that the bars lack are left out.
_EXPORTED = ("symbol", "timestamp", "date", "open", "high", "low", "close", "volume")


def export_csv(bars: DataFrame, path: str) -> None:
    """Bars as CSV with a header, in time order across the part files of folder ``path``.

    ``timestamp`` is written as a date and time in the session zone, ``symbol`` where bars have one.
    """
    readable = F.date_format(F.timestamp_micros("timestamp"), "yyyy-MM-dd HH:mm:ss")
    present = [name for name in _EXPORTED if name in bars.columns]
    rows = bars.orderBy(*[name for name in ("timestamp", "symbol") if name in present])
    rows.withColumn("timestamp", readable).select(*present).write.option("header", True).csv(path)
