"""Benchmark decontamination: a prefix-filtered join of item windows with documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.llm.common import fresh, stage

#: Words of a window and of a shingle.
WINDOW, SHINGLE = 10, 5
#: Words of benchmark text in one broadcast block (about 100 bytes each in a worker, all indexes included).
BLOCK_WORDS = 500_000

# A-Z to lower case; bytes that are neither ASCII letters or digits nor part of a longer code point to a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)
_FACTOR = 0x9E3779B97F4A7C15


def fold_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


def _shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hashes of all runs of ``n`` words."""
    count = max(0, len(hashes) - n + 1)
    out = np.zeros(count, dtype=np.uint64)
    for i in range(n):
        out = out * np.uint64(_FACTOR) + hashes[i : i + count]
    return out


def _hashes(words: list[bytes], vocabulary: dict[bytes, int]) -> np.ndarray:
    """Hashes of words; a word that no item has is 0."""
    return np.fromiter(map(vocabulary.get, words, repeat(0)), np.uint64, len(words))


@dataclass
class Block:
    """Windows of some items, with the shingles they consist of.

    Broadcast values are pickled without their classes, so workers get the fields alone (``vars``).
    """

    vocabulary: dict[bytes, int]
    windows: list[tuple[bytes, ...]]
    #: Items of each window.
    owners: list[list[str]]
    #: For each window its shingle length and shingle hashes by offset.
    parts: list[tuple[int, np.ndarray]]
    #: Sorted shingle hashes by shingle length.
    known: dict[int, np.ndarray]

    @classmethod
    def of(cls, items: list[tuple[str, str | None]], window: int, shingle: int) -> Block:
        import xxhash

        owners: dict[tuple[bytes, ...], set[str]] = {}
        vocabulary: dict[bytes, int] = {}
        for item, text in items:
            words = fold_words(text)
            for word in words:
                vocabulary[word] = xxhash.xxh64_intdigest(word, 7) | 1
            for i in range(max(1, len(words) - window + 1) if words else 0):
                owners.setdefault(tuple(words[i : i + window]), set()).add(item)
        windows, parts = sorted(owners), []
        for words in windows:
            n = min(shingle, len(words))
            parts.append((n, _shingles(_hashes(list(words), vocabulary), n)))
        known = {n: np.unique(np.concatenate([h for m, h in parts if m == n])) for n in {m for m, _ in parts}}
        return cls(vocabulary, windows, [sorted(owners[w]) for w in windows], parts, known)

    def prefixes(self, frequency: dict[tuple[int, int], int]) -> dict[int, dict[int, list[tuple[int, int]]]]:
        """For each shingle length: rarest shingle of a window -> (window, offset).

        All of a window's shingles must occur in a document that contains it, so one is a sufficient
        prefix, and the rarest is the cheapest. A window whose rarest shingle no document has is left out.
        """
        out: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for w, (n, hashes) in enumerate(self.parts):
            count, h, at = min((frequency.get((n, int(h)), 0), int(h), i) for i, h in enumerate(hashes))
            if count:
                out.setdefault(n, {}).setdefault(h, []).append((w, at))
        return out


def _members(sorted_keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Indexes of ``hashes`` that are among the keys."""
    at = np.minimum(np.searchsorted(sorted_keys, hashes), len(sorted_keys) - 1)
    return np.flatnonzero(sorted_keys[at] == hashes)


def _frequencies(docs: DataFrame, text: str, shared) -> dict[tuple[int, int], int]:
    """How often each shingle of a block occurs in all documents."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block = Block(**shared.value)
        totals = {n: np.zeros(len(keys), dtype=np.int64) for n, keys in block.known.items()}
        for batch in batches:
            for value in batch["text"]:
                hashes = _hashes(fold_words(value), block.vocabulary)
                if not hashes.any():
                    continue
                for n, keys in block.known.items():
                    own = _shingles(hashes, n)
                    if len(own):
                        hit = own[_members(keys, own)]
                        np.add.at(totals[n], np.searchsorted(keys, hit), 1)
        for n, total in totals.items():
            some = np.flatnonzero(total)
            yield pd.DataFrame({"n": n, "h": block.known[n][some].view(np.int64), "c": total[some]})

    counts = docs.select(F.col(text).alias("text")).mapInPandas(count, "n BIGINT, h BIGINT, c BIGINT")
    rows = counts.groupBy("n", "h").agg(F.sum("c").alias("c")).collect()
    return {(r.n, r.h % (1 << 64)): r.c for r in rows}


def _matcher(shared, prefixes):
    """UDF: text and what earlier blocks found, to words, hit words, hit runs and items."""

    def find(words: list[bytes], block: Block, tables) -> tuple[list[tuple[int, int]], set[str]]:
        runs, items = [], set()
        hashes = _hashes(words, block.vocabulary)
        if not hashes.any():
            return runs, items
        for n, (keys, postings) in tables.items():
            own = _shingles(hashes, n)
            if not len(own):
                continue
            for p in _members(keys, own):
                for w, at in postings[int(own[p])]:
                    window, start = block.windows[w], int(p) - at
                    # Positional and length bounds before the words are compared.
                    if start < 0 or start + len(window) > len(words):
                        continue
                    if tuple(words[start : start + len(window)]) == window:
                        runs.append((start, start + len(window)))
                        items.update(block.owners[w])
        return runs, items

    def match(texts: pd.Series, spans: pd.Series, found: pd.Series) -> pd.DataFrame:
        block = Block(**shared.value)
        tables = {n: (np.array(sorted(t), dtype=np.uint64), t) for n, t in prefixes.value.items()}
        out = []
        for text, old, items in zip(texts, spans, found, strict=True):
            words = fold_words(text)
            runs, more = find(words, block, tables)
            runs += list(zip(old[::2], old[1::2], strict=True))
            merged: list[int] = []
            for start, end in sorted(runs):
                if merged and start <= merged[-1]:
                    merged[-1] = max(merged[-1], int(end))
                else:
                    merged += [int(start), int(end)]
            hit = sum(merged[1::2]) - sum(merged[::2])
            out.append((len(words), hit, merged, sorted({*items, *more})))
        return pd.DataFrame(out, columns=["n_words", "n_hit", "spans", "items"])

    return F.pandas_udf(match, "n_words BIGINT, n_hit BIGINT, spans ARRAY<BIGINT>, items ARRAY<STRING>")


def _blocks(benchmark: DataFrame, item_id: str, text: str, block_words: int) -> tuple[DataFrame, int]:
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), F.col(text).alias("text")).distinct()
    size = rows.agg(F.sum(F.size(F.split(F.coalesce("text", F.lit("")), "[^A-Za-z0-9\\x80-\\x{10FFFF}]+")))).first()[0]
    n = max(1, -(-(size or 0) // block_words))
    return rows.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n))), n


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_words: int = BLOCK_WORDS,
) -> tuple[DataFrame, str]:
    """``docs`` with one more column, and that column's name: a struct of

    n_words, n_hit (words inside an occurrence of a window), spans (start and end of the runs of such
    words, flat), items (ids with an occurring window, sorted as text). Null and empty texts have no
    words; an item without words has no window; rows of one ``item_id`` are one item, a null id is
    the empty text. Repeated documents are marked each; an empty benchmark marks none. The column is
    called ``hits``, with underscores before it if ``docs`` has such a column.

    The benchmark goes to the workers in blocks of about ``block_words`` words, one after another, so
    a broadcast never grows with its size; documents are read once more for each block.
    """
    spark, name = docs.sparkSession, fresh(docs, "hits")
    items, n = _blocks(benchmark, item_id, item_text, block_words)
    nothing = (F.array().cast("array<bigint>"), F.array().cast("array<string>"))
    for number in range(n):
        chosen = [(r.item, r.text) for r in items.filter(F.col("block") == number).select("item", "text").collect()]
        block = Block.of(chosen, window, shingle)
        shared = spark.sparkContext.broadcast(vars(block))
        frequency = _frequencies(docs, text, shared) if block.windows else {}
        prefixes = spark.sparkContext.broadcast(block.prefixes(frequency))
        before = nothing if number == 0 else (F.col(f"{name}.spans"), F.col(f"{name}.items"))
        docs = docs.withColumn(name, _matcher(shared, prefixes)(F.col(text), *before))
        if number < n - 1:
            docs = stage(docs, "benchmark-block")
    return docs, name


def digest(hits: Column) -> dict[str, Column]:
    items = hits["items"]
    return {
        "n_words": hits["n_words"],
        "n_hit": hits["n_hit"],
        "n_items": F.size(items).cast("bigint"),
        "items_sha256": F.sha2(F.concat_ws(",", items).cast("binary"), 256),
        "contaminated": hits["n_hit"] > 0,
    }
