"""WARC archives with a shared Zstandard dictionary: a writer, and a reader that checks digests.

An archive is one file: a skippable frame with the dictionary, then one frame for each record. Spark's
text writer commits the files wherever the path leads; its line separator is an empty skippable frame,
which decoders pass over.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.llm.common import stage

# The magic number of a dictionary frame and an empty skippable frame as text.
_DICTIONARY_MAGIC = 0x184D2A5D
_EMPTY_FRAME = "P*M\x18\0\0\0\0"
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The dictionary is built from so many records, of each so many characters, and has so many bytes.
SAMPLE_RECORDS, SAMPLE_CHARS, DICTIONARY_BYTES = 2000, 8192, 65536
#: Payload bytes of one archive, about.
ARCHIVE_BYTES = 32 << 20

READ_SCHEMA = "page_id BIGINT, payload_bytes BIGINT, payload_digest STRING, record_type STRING, refers_to BIGINT, payload BINARY"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id) -> str:
    return f"<urn:page:{'none' if page_id is None or pd.isna(page_id) else int(page_id)}>"


def _page(urn: str) -> int | None:
    name = urn.rpartition(":")[2].rstrip(">")
    return None if name == "none" else int(name)


def record(page_id, url: str | None, html: str | None, refers_to, revisit: bool, date: str) -> bytes:
    """One WARC record. A revisit keeps the HTTP head, which states the payload's length, and no payload."""
    payload = (html or "").encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    target = "".join(c if 32 < ord(c) != 127 else f"%{ord(c):02X}" for c in url or "")
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {_REVISIT_PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A trained dictionary; with too few records to train on, their bytes themselves."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _with_kinds(pages: DataFrame, at_least: int) -> DataFrame:
    """Adds ``revisit`` and ``refers_to``: equal payloads refer to the largest page id among them."""
    digest = F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256)
    size = F.octet_length(F.coalesce("html", F.lit("")))
    rows = pages.select("page_id", "url", "html", digest.alias("digest"), size.alias("bytes"))
    groups = rows.filter(F.col("bytes") >= at_least).groupBy("digest").agg(F.max("page_id").alias("last"), F.count("*").alias("n"))
    several = stage(groups.filter("n > 1 AND last IS NOT NULL").select("digest", "last"), "warc-equal")
    joined = rows.join(several, "digest", "left")
    revisit = F.col("last").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("last"))
    return joined.select("page_id", "url", "html", revisit.alias("revisit"), F.when(revisit, F.col("last")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, at_least: int = 0, date: str = "1970-01-01T00:00:00Z", level: int = 3) -> None:
    """Write a record for each row of ``pages`` (``page_id``, ``url``, ``html``) to archives below ``path``.

    Of rows with equal payloads of at least ``at_least`` bytes, that with the largest page id is a response
    (so is a repeated row with that id), the others are revisits of it; if none has an id, all are
    responses. Null html is the empty payload. Other columns are not read.
    """
    import zstandard

    spark = pages.sparkSession
    total, n = pages.agg(F.coalesce(F.sum(F.octet_length("html")), F.lit(0)), F.count("*")).first()
    # About SAMPLE_RECORDS rows by hash, so that what reaches the driver is bounded whatever the table's size.
    share = min(1.0, SAMPLE_RECORDS / max(n, 1))
    chosen = F.pmod(F.xxhash64("page_id", "url", "html"), F.lit(1 << 30)) < int(share * (1 << 30))
    picked = pages.filter(chosen).select("page_id", "url", F.substring("html", 1, SAMPLE_CHARS).alias("html"))
    picked = sorted(picked.limit(2 * SAMPLE_RECORDS).collect(), key=lambda r: (r.page_id is None, r.page_id or 0, r.html or ""))
    trained = build_dictionary([record(r.page_id, r.url, r.html, None, False, date) for r in picked])

    def frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept = zstandard.ZstdCompressionDict(trained)
        writer = zstandard.ZstdCompressor(level=level, dict_data=kept)
        lead = [struct.pack("<II", _DICTIONARY_MAGIC, len(trained)) + trained]
        for batch in batches:
            out = [
                writer.compress(record(i, u, h, r, bool(again), date))
                for i, u, h, again, r in zip(*[batch[c] for c in ("page_id", "url", "html", "revisit", "refers_to")], strict=True)
            ]
            if out:
                yield pd.DataFrame({"frame": lead + out})
                lead = []

    rows = _with_kinds(pages, at_least).repartition(max(1, -(-total // ARCHIVE_BYTES)))
    written = rows.mapInPandas(frames, "frame BINARY").select(F.col("frame").cast("string").alias("value"))
    written.write.option("lineSep", _EMPTY_FRAME).option("compression", "none").text(path)


def read_archive(data: bytes) -> Iterator[tuple]:
    """``(page_id, payload_bytes, payload_digest, record_type, refers_to, payload)`` of each record, checked."""
    import zstandard

    if not data:
        return
    magic, size = struct.unpack("<II", data[:8])
    if magic != _DICTIONARY_MAGIC:
        raise ValueError("the archive does not begin with a dictionary frame")
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
    source = io.BufferedReader(reader.stream_reader(memoryview(data)[8 + size :], read_across_frames=True), 1 << 20)
    while source.readline():
        head = {}
        while (line := source.readline().strip()):
            name, _, value = line.decode().partition(": ")
            head[name] = value
        block = source.read(int(head["Content-Length"]))
        source.read(4)
        http, _, payload = block.partition(b"\r\n\r\n")
        stated = int(http.rpartition(b"Content-Length: ")[2])
        digest, kind = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"]
        if kind == "response" and (len(payload) != stated or payload_digest(payload) != digest):
            raise ValueError(f"damaged record {head['WARC-Record-ID']}")
        refers = _page(head["WARC-Refers-To"]) if kind == "revisit" else None
        yield _page(head["WARC-Record-ID"]), stated, digest, kind, refers, payload


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records below ``path``; a response whose payload does not match its digest is an error."""

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in READ_SCHEMA.split(", ")]
        for batch in batches:
            for data in batch["content"]:
                rows, size = [], 0
                for row in read_archive(bytes(data)):
                    rows.append(row)
                    size += len(row[-1])
                    if size > 8 << 20:
                        yield _frame(rows, names)
                        rows, size = [], 0
                if rows:
                    yield _frame(rows, names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(records, READ_SCHEMA)


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})
