"""ZIP archives of candles as a Spark data source: read file by file, written by tasks.

Reading plans from the archives' central directories, which say where each file inside begins. A task gets
some of these files, of one archive or of several, about ``splitBytes`` of compressed data together, and opens
only their ranges. A single file cannot be split.

Writing goes to a folder beside the tree; the names of what a task wrote are its commit message, and the
committing job moves the files into place. No content passes through the driver.

Python tasks reach the store through Arrow's file systems (local and mounted paths, HDFS, S3, GCS). Where
only Spark reaches it, :func:`wickline.sources.unpack_archives` reads whole archives instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.functions import utc_date
from wickline.schemas import RAW

ARCHIVE_FORMAT = "kline_zip"
#: Compressed bytes that a task reads, about.
SPLIT_BYTES = 32 << 20


def _source() -> type:
    """The data source. Its classes are local, so that workers need no copy of this package."""
    import io
    import uuid
    import zipfile
    import zlib
    from concurrent.futures import ThreadPoolExecutor
    from dataclasses import dataclass
    from fnmatch import fnmatchcase

    import pyarrow as pa
    from pyarrow import fs
    from pyspark.sql.datasource import (
        DataSource,
        DataSourceReader,
        DataSourceWriter,
        InputPartition,
        WriterCommitMessage,
    )

    # Arrow refuses a seek beyond the ends of a file that is too short for an archive.
    unreadable = (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError, pa.ArrowInvalid)
    columns, split, block_chars, name = RAW.names, SPLIT_BYTES, 1 << 20, ARCHIVE_FORMAT

    def at(path: str) -> tuple:
        """The file system of ``path`` and the path on it."""
        return fs.FileSystem.from_uri(path)

    @dataclass
    class Members(InputPartition):
        """Files inside archives, as ``(archive, name)``; no name: the archive's directory is unreadable."""

        files: list

    @dataclass
    class Written(WriterCommitMessage):
        moves: list

    class Reader(DataSourceReader):
        def __init__(self, options: dict) -> None:
            self.root, self.pattern = options["path"], options.get("name", "*.zip")
            self.split = int(options.get("splitbytes", options.get("splitBytes", split)))

        def _listed(self) -> list[str]:
            store, root = at(self.root)
            found = store.get_file_info(fs.FileSelector(root, recursive=True))
            below = len(root.rstrip("/")) + 1
            return sorted(
                f.path
                for f in found
                if f.type == fs.FileType.File
                and fnmatchcase(f.base_name, self.pattern)
                and not any(part[0] in "._" for part in f.path[below:].split("/"))
            )

        def partitions(self) -> list:
            store, _ = at(self.root)

            def members(path: str) -> list[tuple[str, str | None, int]]:
                try:
                    with store.open_input_file(path) as data, zipfile.ZipFile(data) as archive:
                        inside = archive.infolist()
                except unreadable:
                    return [(path, None, 0)]
                return [(path, m.filename, m.compress_size) for m in inside if m.filename.lower().endswith(".csv")]

            with ThreadPoolExecutor(16) as pool:
                found = [m for each in pool.map(members, self._listed()) for m in each]
            parts, size = [[]], 0
            for path, member, length in found:
                if parts[-1] and size + length > self.split:
                    parts.append([])
                    size = 0
                parts[-1].append((path, member))
                size += length
            return [Members(p) for p in parts if p]

        def read(self, partition):
            store, _ = at(self.root)

            def batch(path, member, block):
                values = {"path": [path], "member": [member], "block": [block]}
                return pa.RecordBatch.from_pydict({k: pa.array(v, pa.string()) for k, v in values.items()})

            for path, member in partition.files if partition is not None else []:
                if member is None:
                    yield batch(path, None, None)
                    continue
                with store.open_input_file(path) as data:
                    try:
                        with zipfile.ZipFile(data) as archive:
                            # Tested before its first line is handed on, and not held for that.
                            with archive.open(member) as lines:
                                while lines.read(block_chars):
                                    pass
                            with archive.open(member) as lines:
                                text = io.TextIOWrapper(lines, "utf-8", errors="replace")
                                while block := text.readlines(block_chars):
                                    yield batch(path, member, "".join(block))
                    except unreadable:
                        yield batch(path, member, None)

    class Writer(DataSourceWriter):
        def __init__(self, options: dict) -> None:
            self.root, self.resolution = options["path"], options.get("resolution", "1m")
            self.beside = f"{self.root.rstrip('/')}/_archives-{uuid.uuid4().hex}"

        def write(self, iterator):
            from itertools import groupby

            store, beside = at(self.beside)
            _, root = at(self.root)
            # An attempt that runs again or beside another writes to a folder of its own.
            folder, moves = f"{beside}/{uuid.uuid4().hex}", []
            store.create_dir(folder)
            for (symbol, day), rows in groupby(iterator, key=lambda r: (r["symbol"], r["day"])):
                title = f"{symbol}-{self.resolution}-{day}"
                target = io.BytesIO()
                with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive, archive.open(f"{title}.csv", "w") as out:
                    for row in rows:
                        out.write((",".join("" if row[c] is None else str(row[c]) for c in columns) + "\n").encode())
                with store.open_output_stream(f"{folder}/{len(moves)}") as out:
                    out.write(target.getvalue())
                moves.append((f"{folder}/{len(moves)}", f"{root.rstrip('/')}/{symbol}/{self.resolution}/{title}.zip"))
            return Written(moves)

        def commit(self, messages):
            store, beside = at(self.beside)
            for message in messages:
                for source, target in message.moves if message is not None else []:
                    store.create_dir(target.rpartition("/")[0])
                    store.move(source, target)
            self._clear(store, beside)

        def abort(self, messages):
            self._clear(*at(self.beside))

        def _clear(self, store, beside):
            if store.get_file_info(beside).type != fs.FileType.NotFound:
                store.delete_dir(beside)

    class Archives(DataSource):
        @classmethod
        def name(cls):
            return name

        def schema(self):
            return "path STRING, member STRING, block STRING"

        def reader(self, schema):
            return Reader(dict(self.options))

        def writer(self, schema, overwrite):
            return Writer(dict(self.options))

    return Archives


def register_archives(spark: SparkSession) -> None:
    """Make the format ``kline_zip`` known to the session."""
    spark.dataSource.register(_source())


def write_archives(candles: DataFrame, root: str, resolution: str = "1m") -> None:
    """Candles (raw columns and ``symbol``) as ``SYMBOL/RESOLUTION/SYMBOL-RESOLUTION-DATE.zip`` below ``root``.

    One archive holds a symbol's day in time order and is written by one task. All appear when the job commits;
    an archive of that name is replaced. Candles without a symbol or a time have no archive and are an error.
    """
    register_archives(candles.sparkSession)
    checked = F.when(F.col("symbol") != "", F.col("symbol"))
    missing = F.raise_error(F.lit("a candle without a symbol or a time has no archive"))
    rows = candles.select(
        *RAW.names,
        F.coalesce(checked, missing).alias("symbol"),
        F.coalesce(utc_date("open_time").cast("string"), missing).alias("day"),
    )
    dealt = rows.repartition("symbol", "day").sortWithinPartitions("symbol", "day", "open_time")
    dealt.write.format(ARCHIVE_FORMAT).option("resolution", resolution).mode("append").save(root)
