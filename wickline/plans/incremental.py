"""Ingestion of new raw files only: each file below a growing tree reaches bronze exactly once.

A file stream remembers in its checkpoint which files it has seen and hands the others over in numbered
batches. A batch may be handed over again after a failure, under the same number. Its rows are therefore
written beside the table first and then moved in under names that carry the number, and whatever an earlier
attempt moved in under them is removed before. The plain layout of bronze stays, so batches of :func:`ingest`
may lie in the same table.
"""

from __future__ import annotations

from collections import Counter
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from wickline.functions import as_date
from wickline.operators.tables import publish
from wickline.plans.jobs import fated
from wickline.schemas import BRONZE_PARTITIONS, RAW
from wickline.session import require_utc
from wickline.sources.raw import _archives, archive_blocks, csv_rows, file_glob, file_stems, in_scope, parsed_lines
from wickline.sources.tables import table_exists

#: Files older than the newest by more than this would be passed over by Spark (a week, by default).
_ANY_AGE = "36500d"
_BINARY = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def _stream(spark: SparkSession, date_pattern: str | None, suffix: str, max_files: int | None) -> DataStreamReader:
    reader = (
        spark.readStream.option("recursiveFileLookup", True)
        .option("pathGlobFilter", file_glob(date_pattern, suffix))
        .option("maxFileAge", _ANY_AGE)
    )
    return reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)


def ingest_new(
    spark: SparkSession,
    raw: str,
    bronze: str,
    checkpoint: str,
    batch_date: date | str | None = None,
    symbols: list[str] | None = None,
    resolution: str | None = None,
    date_pattern: str | None = None,
    max_files: int | None = None,
) -> dict[str, int]:
    """Add the raw CSV and ZIP files below ``raw`` that no earlier call with this ``checkpoint`` has added.

    Ends when all files that lay there at the start are in bronze; ``max_files`` bounds those of one batch.
    Returns ``files`` and ``rows`` added, and as :func:`ingest` ``damaged_archives`` and ``rows_without_symbol``.

    Of an archive and the CSV extracted beside it one counts, that which came first; of both at once the
    CSV. The scope must stay the same for a checkpoint: files outside of it count as seen. A file that is
    replaced under its name later is not read again.
    """
    require_utc(spark)
    day = None if batch_date is None else as_date(batch_date)
    told: Counter = Counter()

    def load(kind: str, of_batch):
        """A handler of batches: rows of files not loaded as the other kind, their stems noted beside."""

        def handle(batch: DataFrame, number: int) -> None:
            place = f"{checkpoint}/loaded/{kind}/batch={number}"
            # What a batch takes is settled once, so that an attempt after a failure takes the same.
            if not table_exists(spark, f"{place}/_SUCCESS"):
                stems = file_stems(batch.select("path").distinct()).select("stem", "path")
                if kind == "zip":
                    beside = file_stems(_archives(spark, raw, date_pattern=date_pattern, suffix=".csv").select("path"))
                    stems = stems.join(beside.select("stem"), "stem", "left_anti")
                other = f"{checkpoint}/loaded/{'zip' if kind == 'csv' else 'csv'}"
                if table_exists(spark, other):
                    loaded = spark.read.schema("stem STRING").parquet(other)
                    stems = stems.join(loaded.select("stem"), "stem", "left_anti")
                stems.write.mode("overwrite").parquet(place)
            wanted = spark.read.schema("stem STRING, path STRING").parquet(place).select("path")
            rows = of_batch(in_scope(batch.join(wanted, "path", "left_semi"), raw, symbols, resolution))
            identity = spark.read.schema("id STRING").json(f"{checkpoint}/{kind}/metadata").first().id
            fates = publish(fated(rows, day), bronze, BRONZE_PARTITIONS, f"{identity}-{number}")
            told.update(files=wanted.count(), rows=fates["kept"], rows_without_symbol=fates["stray"])
            told.update(damaged_archives=fates["damaged"])

        return handle

    def csv_batch(files: DataFrame) -> DataFrame:
        return files.drop("path").withColumn("damaged", F.lit(False))

    def zip_batch(files: DataFrame) -> DataFrame:
        return parsed_lines(archive_blocks(files))

    csv = csv_rows(_stream(spark, date_pattern, ".csv", max_files).schema(RAW).csv(raw))
    archives = _stream(spark, date_pattern, ".zip", max_files).schema(_BINARY).format("binaryFile").load(raw)
    zipped = archives.select("path", "content")
    for kind, files, of_batch in (("csv", csv, csv_batch), ("zip", zipped, zip_batch)):
        started = (
            files.writeStream.foreachBatch(load(kind, of_batch))
            .option("checkpointLocation", f"{checkpoint}/{kind}")
            .trigger(availableNow=True)
            .start()
        )
        started.awaitTermination()
    return {k: told[k] for k in ("files", "rows", "damaged_archives", "rows_without_symbol")}
