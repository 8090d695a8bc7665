"""SimHash near-dedup with pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wickline.llm.common import fresh, stage
from wickline.llm.components import components

#: Differing bits up to which two fingerprints are linked.
MAX_BITS = 4
#: Ten segments on a ring. Chain budgets are l * 4 / 10, so a chain that starts right begins with two
#: equal segments and then at most one differing bit in the next two.
SEGMENTS = (7, 7, 7, 7, 6, 6, 6, 6, 6, 6)
#: Members of a bucket that one comparison block holds.
BLOCK = 1024


def _fingerprint(text: str, n: int, seed: int) -> int:
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    ones, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(grams), 65536):
        h = np.array([digest(g, seed) for g in grams[at : at + 65536]], dtype=np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(grams)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(text: Column, n: int = 4, seed: int = 42) -> Column:
    """64-bit SimHash of word n-grams, as a signed long; no words: 0."""

    def sketch(texts: pd.Series) -> pd.Series:
        return pd.Series([_fingerprint(t or "", n, seed) for t in texts], dtype="int64")

    return F.pandas_udf(sketch, "bigint")(text)


def _starts() -> list[int]:
    return [sum(SEGMENTS[:i]) for i in range(len(SEGMENTS))]


def _mask(segment: int) -> int:
    return ((1 << SEGMENTS[segment]) - 1) << _starts()[segment]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def chain_masks() -> list[tuple[int, int]]:
    """For each ring start and each bit that may differ: (key number, mask of the bits that must agree).

    Two fingerprints whose chain of four segments from a start keeps its budget agree under at least
    one mask of that start: the first two segments are equal, the next two differ in one bit at most.
    """
    out, ring = [], len(SEGMENTS)
    for i in range(ring):
        first, second, third, fourth = ((i + j) % ring for j in range(4))
        whole = _mask(first) | _mask(second) | _mask(third) | _mask(fourth)
        for segment in (third, fourth):
            for bit in range(SEGMENTS[segment]):
                out.append((len(out), _signed(whole & ~(1 << (_starts()[segment] + bit)))))
    return out


def _popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.view(np.uint64)).astype(np.int64)


def chain_passes(x: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Whether some start of the ring keeps every chain's cumulative difference within its budget."""
    boxes = np.stack([_popcount(x & np.int64(_signed(_mask(i)))) for i in range(len(SEGMENTS))])
    budgets = [length * max_bits // len(SEGMENTS) for length in range(1, len(SEGMENTS) + 1)]
    passed = np.zeros(x.shape, dtype=bool)
    for start in range(len(SEGMENTS)):
        total, good = np.zeros(x.shape, dtype=np.int64), np.ones(x.shape, dtype=bool)
        for length, budget in enumerate(budgets):
            total = total + boxes[(start + length) % len(SEGMENTS)]
            good &= total <= budget
        passed |= good
    return passed


def _linked(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Indexes of pairs that pass the ring filter and then the full Hamming check."""
    x = a ^ b
    hit = np.flatnonzero(chain_passes(x))
    return hit[_popcount(x[hit]) <= MAX_BITS]


def _forest(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links between two blocks (or inside one, if they are the same)."""
    parent = {int(v): int(v) for v in np.concatenate([left, right])}

    def root(v: int) -> int:
        while parent[v] != v:
            parent[v] = parent[parent[v]]
            v = parent[v]
        return v

    out = []
    for v in left:
        for k in _linked(np.full(len(right), v), right):
            a, b = root(int(v)), root(int(right[k]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((int(v), int(right[k])))
    return out


def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links inside runs of equal ``(key, lo, hi)``; rows arrive sorted, a run may cross batches."""

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        key = frame[["key", "mask", "lo", "hi"]].to_numpy()
        fp, block = frame["fp"].to_numpy(), frame["block"].to_numpy()
        edge = np.flatnonzero(np.any(key[1:] != key[:-1], axis=1)) + 1
        first = np.concatenate([[0], edge]).astype(np.int64)
        size = np.diff(np.concatenate([first, [len(fp)]]))
        left, right, more = [], [], []
        for n in np.unique(size):
            runs = first[size == n]
            if n <= 8:
                for i in range(int(n)):
                    for j in range(i + 1, int(n)):
                        a, b = fp[runs + i], fp[runs + j]
                        hit = _linked(a, b)
                        left.append(a[hit])
                        right.append(b[hit])
                continue
            for at in runs:
                lo, hi = key[at, 2], key[at, 3]
                rows, blocks = fp[at : at + n], block[at : at + n]
                more += _forest(rows[blocks == lo], rows[blocks == hi])
        if more:
            left.append(np.array([a for a, _ in more], dtype=np.int64))
            right.append(np.array([b for _, b in more], dtype=np.int64))
        a = np.concatenate([*left, np.zeros(0, np.int64)])
        b = np.concatenate([*right, np.zeros(0, np.int64)])
        return pd.DataFrame({"u": np.minimum(a, b), "v": np.maximum(a, b)}).drop_duplicates()

    rest = None
    for batch in batches:
        frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        last = frame[["key", "mask", "lo", "hi"]].iloc[-1].to_numpy()
        same = (frame[["key", "mask", "lo", "hi"]].to_numpy() == last).all(axis=1)
        rest = frame[same]
        if not same.all():
            yield solve(frame[~same])
    if rest is not None and len(rest):
        yield solve(rest)


def link_fingerprints(distinct: DataFrame) -> DataFrame:
    """Links ``(u, v)`` that connect all of ``fp`` within four bits of each other.

    Each fingerprint goes to one bucket per chain mask. Buckets of one are dropped; the others are
    compared inside. A bucket above ``BLOCK`` members is compared block against block in separate
    tasks, each of which returns a spanning forest, so that no group emits all its pairs and no link
    is lost.
    """
    masks = F.array(*[F.struct(F.lit(i).alias("mask"), F.lit(m).alias("bits")) for i, m in chain_masks()])
    keyed = distinct.select("fp", F.explode(masks).alias("m")).select(
        "fp", F.col("m.mask").alias("mask"), F.col("fp").bitwiseAND(F.col("m.bits")).alias("key")
    )
    bucket = Window.partitionBy("mask", "key")
    shared = stage(keyed.select("*", F.count("*").over(bucket).alias("n")).filter("n > 1"), "buckets")
    big = shared.filter(F.col("n") > BLOCK).select("*", F.row_number().over(bucket.orderBy("fp")).alias("r"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("bigint")
    own = F.floor((F.col("r") - 1) / BLOCK)
    big = big.select("fp", "mask", "key", own.alias("block"), F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("o"))
    split = big.select(
        "fp", "mask", "key", "block", F.least("block", "o").alias("lo"), F.greatest("block", "o").alias("hi")
    )
    zero = F.lit(0).cast("bigint")
    small = shared.filter(F.col("n") <= BLOCK).select(
        "fp", "mask", "key", zero.alias("block"), zero.alias("lo"), zero.alias("hi")
    )
    keys = ["mask", "key", "lo", "hi"]
    dealt = small.unionByName(split).repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(_links, "u BIGINT, v BIGINT").distinct()


def _grouped(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(doc_id, fp, k1, k2, component_id)`` for each row; k1 and k2 hash the row's id and text."""
    key, value = F.col(doc_id).cast("string"), F.col(text)
    marked = stage(
        docs.select(
            F.col(doc_id).alias("doc_id"),
            fingerprints(value).alias("fp"),
            F.xxhash64(key, value).alias("k1"),
            F.xxhash64(value, key).alias("k2"),
        ),
        "fingerprints",
    )
    distinct = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(stage(link_fingerprints(distinct.select("fp")), "links"), "links")
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    return marked.join(named.join(smallest, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fp, component_id)`` for each row of ``docs``.

    ``component_id`` is the smallest id reachable over links. Null and empty texts have fingerprint 0
    and are linked like any other; rows with a null id are grouped too, and their component has the
    smallest id that is not null. Repeated rows come out as often as they come in. Other columns are
    not read. No row gives no row.
    """
    return _grouped(docs, doc_id, text).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, all columns: the smallest id (null last), then any of equal rows."""
    found = _grouped(docs, doc_id, text)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "k1", "k2")).alias("r")
    chosen = found.groupBy("root").agg(least).select(F.col("r.k1").alias("k1"), F.col("r.k2").alias("k2"))
    k1, k2, rank = (fresh(docs, c) for c in ("k1", "k2", "rank"))
    key, value = F.col(doc_id).cast("string"), F.col(text)
    rows = docs.withColumns({k1: F.xxhash64(key, value), k2: F.xxhash64(value, key)})
    kept = rows.join(chosen.select(F.col("k1").alias(k1), F.col("k2").alias(k2)), [k1, k2], "left_semi")
    first = F.row_number().over(Window.partitionBy(k1, k2).orderBy(k1, k2))
    return kept.withColumn(rank, first).filter(F.col(rank) == 1).select(*docs.columns)
