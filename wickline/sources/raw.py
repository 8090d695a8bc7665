"""Raw kline files: ``SYMBOL/RESOLUTION/SYMBOL-RESOLUTION-DATE.csv`` or ``.zip`` below a root folder.

Folders may also be written as ``symbol=SYMBOL/resolution=RESOLUTION``. The root may also be the folder
that holds ``raw``.
"""

from __future__ import annotations

import io
import re
import zipfile
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wickline.schemas import RAW
from wickline.session import hadoop_path
from wickline.sources.archives import ARCHIVE_FORMAT, register_archives

_BLOCK_CHARS = 1 << 20
_SYMBOL = "(?:symbol=)?([^/]+)/"
_RESOLUTION = "[^/]+/(?:resolution=)?([^/]+)/"


def _decoded(path: Column) -> Column:
    """A file path as it is on disk; the scan metadata gives it percent-encoded."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _below(spark: SparkSession, root: str) -> str:
    """A pattern of what precedes the symbol in the full path of a file below ``root``."""
    folder, files = hadoop_path(spark, root)
    full = files.makeQualified(folder).toUri().getPath().rstrip("/")
    return f"^(?:[^:/]+:(?://[^/]*)?)?{re.escape(full)}/(?:raw/)?"


def in_scope(
    df: DataFrame, root: str, symbols: list[str] | None, resolution: str | None
) -> DataFrame:
    """Derive ``symbol`` from ``path`` and keep the wanted symbols and resolution."""
    before = _below(df.sparkSession, root)
    df = df.withColumn("symbol", F.regexp_extract("path", before + _SYMBOL, 1))
    if symbols is not None:
        df = df.filter(F.col("symbol").isin(symbols))
    if resolution is not None:
        df = df.filter(F.regexp_extract("path", before + _RESOLUTION, 1) == resolution)
    return df


def file_glob(date_pattern: str | None, suffix: str) -> str:
    return f"*{date_pattern}*{suffix}" if date_pattern else f"*{suffix}"


def csv_rows(scan: DataFrame) -> DataFrame:
    """A scan or stream of CSV files with the decoded ``path`` of each row's file."""
    return scan.withColumn("path", _decoded(F.col("_metadata.file_path")))


def file_stems(files: DataFrame) -> DataFrame:
    """``files`` with ``stem``: their ``path`` without scheme and extension, equal for an archive and its CSV."""
    bare = F.regexp_replace("path", r"^[^:/]+:(?://[^/]*)?(?=/)", "")
    return files.withColumn("stem", F.regexp_replace(bare, r"\.[^./]+$", ""))


def _folders(
    spark: SparkSession, root: str, symbols: list[str] | None, resolution: str | None
) -> list[str] | str:
    """``root`` narrowed by glob to the wanted folders, so that others are not even listed."""
    if symbols is None and resolution is None:
        return root
    wanted = "{" + ",".join(f"{s},symbol={s}" for s in symbols) + "}" if symbols else "*"
    under = "{" + f"{resolution},resolution={resolution}" + "}" if resolution else "*"
    return f"{root.rstrip('/')}/{wanted}/{under}"


def read_klines(
    spark: SparkSession,
    root: str,
    symbols: list[str] | None = None,
    resolution: str | None = None,
    date_pattern: str | None = None,
) -> DataFrame:
    """All CSV candles below ``root`` with ``symbol`` taken from the path (empty if there is none).

    A malformed field becomes null, surplus fields are dropped.
    """
    rows = csv_rows(
        spark.read.schema(RAW)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", file_glob(date_pattern, ".csv"))
        .csv(_folders(spark, root, symbols, resolution))
    )
    return in_scope(rows, root, symbols, resolution).drop("path")


def unpack_archives(archives: DataFrame, damaged: Observation | None = None) -> DataFrame:
    """Candles inside ``archives`` (columns ``path, content, symbol``); damaged archives give no rows.

    ``damaged`` observes their number as ``n`` when the rows are first computed.
    """
    return _parsed(archive_blocks(archives), damaged)


def archive_blocks(archives: DataFrame) -> DataFrame:
    """``(symbol, block)``: text of the CSV files inside ``archives`` in blocks of lines, a null for a damaged one.

    An archive is tested in a first pass, so that none of its lines is handed on before all of it is known to be sound, and none
    of its text need be held.

    A ZIP cannot be split, so one archive is one record: a task holds one archive at a time and hands
    its text to the JVM in blocks, where lines are split and parsed. An RDD step, because an Arrow
    batch would hold thousands of archives. The functions are local, so that workers need no copy of
    this package.
    """

    def csv_blocks(archive: bytes) -> Iterator[str | None]:
        """Text of all CSV members in blocks of whole lines; one null if the archive is damaged."""
        try:
            with zipfile.ZipFile(io.BytesIO(archive)) as members:
                if members.testzip() is not None:
                    yield None
                    return
                for name in members.namelist():
                    if name.lower().endswith(".csv"):
                        with members.open(name) as member:
                            lines = io.TextIOWrapper(member, "utf-8", errors="replace")
                            while block := lines.readlines(_BLOCK_CHARS):
                                yield "".join(block)
        except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError):
            yield None

    def blocks(part):
        for row in part:
            for block in csv_blocks(row.content):
                yield row.symbol, block

    text = archives.select("symbol", "content").rdd.mapPartitions(blocks)
    return text.toDF("symbol STRING, block STRING")


def _parsed(texts: DataFrame, damaged: Observation | None) -> DataFrame:
    """Candles of blocks of lines; a null block stands for what could not be read."""
    if damaged is not None:
        texts = texts.observe(damaged, F.count_if(F.col("block").isNull()).alias("n"))
    return parsed_lines(texts).filter("NOT damaged").drop("damaged")


def parsed_lines(texts: DataFrame) -> DataFrame:
    """Candles of blocks of lines with their ``symbol``; a null block gives one row, marked ``damaged``."""
    lines = texts.select(
        "symbol", F.col("block").isNull().alias("damaged"), F.explode_outer(F.split("block", "\\r?\\n")).alias("line")
    )
    parsed = lines.filter("damaged OR line != ''").select(F.from_csv("line", RAW.toDDL()).alias("k"), "symbol", "damaged")
    return parsed.select("k.*", "symbol", "damaged")


def _archives(
    spark: SparkSession,
    root: str,
    symbols: list[str] | None = None,
    resolution: str | None = None,
    date_pattern: str | None = None,
    suffix: str = ".zip",
    only: list[str] | None = None,
) -> DataFrame:
    """Files ending in ``suffix`` with ``symbol`` and the path ``stem``; content is read on demand.

    ``only`` names the files to take instead of all below ``root``.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", file_glob(date_pattern, suffix))
        .load(_folders(spark, root, symbols, resolution) if only is None else only)
    )
    stem = F.regexp_replace("path", r"\.[^./]+$", "")
    return in_scope(files, root, symbols, resolution).withColumn("stem", stem)


def _literal(path: str) -> str:
    """``path`` with the characters escaped that a scan would take as a glob."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def read_kline_archives(
    spark: SparkSession,
    root: str,
    symbols: list[str] | None = None,
    resolution: str | None = None,
    date_pattern: str | None = None,
    damaged: Observation | None = None,
    by_member: bool = False,
) -> DataFrame:
    """All candles inside the ZIP archives below ``root``, as :func:`read_klines` gives them.

    With ``by_member`` the files inside an archive are read by several tasks (see :mod:`wickline.sources.archives`):
    a damaged one gives no rows and counts as such, and the others of its archive are read.
    """
    if by_member:
        register_archives(spark)
        scan = spark.read.format(ARCHIVE_FORMAT).option("name", file_glob(date_pattern, ".zip"))
        blocks = in_scope(scan.load(root), root, symbols, resolution).select("symbol", "block")
        return _parsed(blocks, damaged)
    return unpack_archives(_archives(spark, root, symbols, resolution, date_pattern), damaged)


def marked_rows(
    spark: SparkSession,
    root: str,
    symbols: list[str] | None = None,
    resolution: str | None = None,
    date_pattern: str | None = None,
) -> DataFrame:
    """The rows of :func:`read_raw` with ``damaged``, which marks the one row, all null, of a damaged archive.

    Which archives lie extracted beside themselves is settled on paths alone, before any is opened, so that
    contents pass through no shuffle. The paths left come to the driver, which lists them for the scan in any case.
    """
    scope = (spark, root, symbols, resolution, date_pattern)
    extracted = _archives(*scope, suffix=".csv").select("stem")
    packed = _archives(*scope).select("stem", "path").join(extracted, "stem", "left_anti")
    only = [_literal(row.path) for row in packed.select("path").collect()]
    rows = read_klines(*scope).withColumn("damaged", F.lit(False))
    if not only:
        return rows
    return rows.unionByName(parsed_lines(archive_blocks(_archives(*scope, only=only))))


def read_raw(
    spark: SparkSession,
    root: str,
    symbols: list[str] | None = None,
    resolution: str | None = None,
    date_pattern: str | None = None,
    damaged: Observation | None = None,
) -> DataFrame:
    """CSV files and ZIP archives together; an archive that lies extracted beside itself counts once."""
    rows = marked_rows(spark, root, symbols, resolution, date_pattern)
    if damaged is not None:
        rows = rows.observe(damaged, F.count_if("damaged").alias("n"))
    return rows.filter("NOT damaged").drop("damaged")
