"""MinHash near-dedup: one-permutation hashing with optimal densification, banded buckets, star edges.

One hash of each shingle picks its bin and its rank there. An empty bin takes the value of a bin that its own
fixed random order of bins reaches first, so that equal bins of two texts stay equal with the probability of
their Jaccard similarity. Bands of ``ROWS`` bins are bucket keys. A bucket is compared as a star: each member
with the smallest one, so a bucket of n members costs n - 1 pairs. Links are confirmed on the full sets. What
a star may miss, two members alike to each other but not to the centre, is left only in buckets whose members
then still lie in several components; these are compared inside, across components. Before texts are moved,
one byte of each bin tells which members can be alike at all.

Joins that move texts or bands are merge joins at every size, as no side of theirs has a bound. Only texts whose
rows are marked in broadcast bitmaps of a checked size are moved.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.llm.common import stage
from wickline.llm.compact_windows import shingles
from wickline.llm.components import components
from wickline.llm.packing import mixed

#: 24 bands of 4 bins: a pair of similarity 0.8 shares no bucket with probability (1 - 0.8^4)^24 = 3e-6.
BANDS, ROWS = 24, 4
#: Bins whose bytes must agree before two texts are compared. Of 96, a pair of similarity 0.8 has 77 on average,
#: with a standard deviation of 3.9; fewer than 48 has a probability below 1e-11.
AGREE = BANDS * ROWS // 2
#: Words of a shingle, and the similarity in percent from which two sets are linked.
SHINGLE, SIMILAR = 4, 80
#: Members of a star, or of a block of a bucket, whose texts one task compares at once.
BLOCK = 256
#: Members of a block of a bucket whose signatures (about 130 bytes each) one task compares at once.
SIGNATURES = 2048

_BINS = BANDS * ROWS
_EDGES = np.array([-(-(i << 64) // _BINS) for i in range(_BINS)], dtype=np.uint64)
_PROBES = np.argsort(mixed(np.arange(_BINS * _BINS, dtype=np.uint64), 7).reshape(_BINS, _BINS), axis=1, kind="stable")
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of marks of texts that one broadcast may hold: 4 KB for 32,768 rows, so about half a billion rows.
MARKS = 64 << 20


def shingle_sets(texts: Iterable[str | None], n: int = SHINGLE) -> list[np.ndarray]:
    """Of each text the sorted distinct 64-bit hashes of its word n-grams; of fewer words, of all of them."""
    import xxhash

    data = [(text or "").encode() for text in texts]
    runs, counts = shingles(data, n)
    out = []
    for text, values, count in zip(data, runs, counts.tolist(), strict=True):
        if count >= n:
            values = np.sort(values)
            new = np.ones(len(values), dtype=bool)
            np.not_equal(values[1:], values[:-1], out=new[1:])
            values = values[new]
        elif count:
            values = np.array([xxhash.xxh64_intdigest(b" ".join(text.lower().split()), 2)], dtype=np.uint64)
        else:
            values = np.zeros(0, dtype=np.uint64)
        out.append(values)
    return out


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least hash of each bin; an empty bin has that of the first bin in its order that is not."""
    at = np.append(np.searchsorted(hashes, _EDGES), len(hashes))
    filled = at[:-1] < at[1:]
    donor = np.arange(_BINS)
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = _PROBES[empty]
        donor[empty] = order[np.arange(len(empty)), np.argmax(filled[order], axis=1)]
    return hashes[at[donor]]


def band_keys(bins: np.ndarray) -> np.ndarray:
    rows = bins.reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        key = key * _STEP + rows[:, i]
    return mixed(key, 5).view(np.int64)


def sketches(text: Column, n: int = SHINGLE) -> Column:
    """A struct of the set's size ``n``, 128 bits ``s1, s2`` that stand for the set, its ``bands``, and a byte of each bin."""

    def sketch(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import xxhash

        for texts in batches:
            rows = []
            for found in shingle_sets(texts, n):
                if len(found):
                    s1, s2 = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64)
                    bins = signature(found)
                    rows.append((len(found), int(s1), int(s2), band_keys(bins), bins.astype(np.uint8).tobytes()))
                else:
                    rows.append((0, 0, 0, None, None))
            yield pd.DataFrame(rows, columns=["n", "s1", "s2", "bands", "bytes"])

    return F.pandas_udf(sketch, "n BIGINT, s1 BIGINT, s2 BIGINT, bands ARRAY<BIGINT>, bytes BINARY")(text)


def _bytes(values: pd.Series | np.ndarray) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.uint8).reshape(len(values), -1)


def may_be_alike(a: Column, b: Column) -> Column:
    """Whether two signatures agree in ``AGREE`` bytes or more."""

    def agree(left: pd.Series, right: pd.Series) -> pd.Series:
        if not len(left):
            return pd.Series([], dtype=bool)
        return pd.Series((_bytes(left) == _bytes(right)).sum(1) >= AGREE)

    return F.pandas_udf(agree, "boolean")(a, b)


def alike(common: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return 100 * common >= SIMILAR * (a + b - common)


def _in_runs(solve: Callable[..., list[np.ndarray]], keys: list[str], out: list[str], n: int | None = None):
    """``solve`` on each run of rows with equal keys; it returns columns ``out``. Rows arrive sorted; a run may cross batches.

    With ``n``, the shingle sets of the rows are its second argument, taken of many rows at once.
    """

    def all_runs(frame: pd.DataFrame) -> pd.DataFrame:
        values = frame[keys].to_numpy()
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        columns = {name: frame[name].to_numpy() for name in frame.columns}
        sets = shingle_sets(columns.pop("text"), n) if n else None
        found = []
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(frame)], strict=True):
            run = {name: column[low:high] for name, column in columns.items()}
            found.append(solve(run, sets[low:high]) if n else solve(run))
        return pd.DataFrame({name: np.concatenate([f[i] for f in found]) for i, name in enumerate(out)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            if not len(batch):
                continue
            frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            same = (frame[keys].to_numpy() == frame[keys].iloc[-1].to_numpy()).all(axis=1)
            rest = frame[same]
            if not same.all():
                yield all_runs(frame[~same])
        if rest is not None:
            yield all_runs(rest)

    return run


def _star(rows: dict[str, np.ndarray], sets: list[np.ndarray]) -> list[np.ndarray]:
    """Links between the first row and the others."""
    centre = sets[0]
    sizes = np.array([len(s) for s in sets[1:]], dtype=np.int64)
    common = np.array([_common(centre, s) for s in sets[1:]], dtype=np.int64)
    linked = rows["cid"][1:][alike(common, len(centre), sizes)]
    return [np.full(len(linked), rows["cid"][0]), linked]


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Values that two sorted arrays without repeats have in common."""
    both = np.sort(np.concatenate([a, b]))
    return int((both[1:] == both[:-1]).sum())


def marked_rows(texts: DataFrame, needed: DataFrame, limit: int = MARKS) -> DataFrame:
    """The rows of ``texts`` whose ``cid`` is in ``needed``, so that no other text is shuffled for a join.

    The ids are marked as bits, 32,768 to a bitmap, and the bitmaps are broadcast; above ``limit`` bytes of
    them all rows are returned, which the join that follows sorts out.
    """
    bits = needed.groupBy(F.bitmap_bucket_number("cid").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("cid")).alias("bits")
    )
    bits = stage(bits, "marks")
    if bits.count() * 4096 > limit:
        return texts
    place = "cast(bitmap_bit_position(cid) AS INT)"
    byte = f"cast(conv(hex(substring(bits, {place} div 8 + 1, 1)), 16, 10) AS INT)"
    marked = F.expr(f"(shiftright({byte}, {place} % 8) & 1) = 1")
    named = texts.withColumn("bucket", F.bitmap_bucket_number("cid")).join(F.broadcast(bits), "bucket")
    return named.filter(marked).select(*texts.columns)


def star_links(texts: DataFrame, stars: DataFrame, n: int = SHINGLE) -> DataFrame:
    """The pairs ``(center, cid)`` of ``stars`` that are alike, as ``(u, v)``; ``texts`` has ``cid, text``.

    A star is dealt to tasks in parts of about ``BLOCK`` members, each with a copy of the centre.
    """
    sizes = stars.groupBy("center").agg(F.ceil(F.count("*") / BLOCK).alias("slots"))
    members = stars.join(sizes, "center").select(
        "center", F.pmod(F.xxhash64("cid"), F.col("slots")).alias("slot"), F.lit(1).alias("role"), "cid"
    )
    centres = sizes.select(
        "center", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slots") - 1)).alias("slot"), F.lit(0).alias("role"), F.col("center").alias("cid")
    )
    keys = ["center", "slot"]
    both = members.unionByName(centres)
    needed = marked_rows(texts, both.select("cid").distinct())
    dealt = both.join(needed.hint("merge"), "cid").repartition(*keys).sortWithinPartitions(*keys, "role", "cid")
    return dealt.select(*keys, "cid", "text").mapInPandas(_in_runs(_star, keys, ["u", "v"], n), "u BIGINT, v BIGINT")


def _across(rows: dict[str, np.ndarray], sets: list[np.ndarray]) -> list[np.ndarray]:
    """A forest of the links between components, from the left to the right block."""
    sizes = np.array([len(s) for s in sets])
    own, low, high = rows["block"], rows["lo"][0], rows["hi"][0]
    left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
    found: list[tuple[int, int]] = []
    labels, cids = rows["label"].copy(), rows["cid"]
    if len(left) and len(right) and (labels != labels[0]).any():
        universe, place = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        for i in left:
            fits = 100 * np.minimum(sizes[right], sizes[i]) >= SIMILAR * np.maximum(sizes[right], sizes[i])
            other = right[fits & (labels[right] != labels[i])]
            if not len(other):
                continue
            marked = np.zeros(len(universe), dtype=np.int64)
            marked[place[starts[i] : ends[i]]] = 1
            common = np.array([marked[place[starts[j] : ends[j]]].sum() for j in other])
            for j in other[alike(common, sizes[other], sizes[i])]:
                if labels[i] != labels[j]:
                    found.append((cids[i], cids[j]))
                    labels[labels == labels[j]] = labels[i]
    return list(np.array(found, dtype=np.int64).reshape(-1, 2).T)


def _partners(rows: dict[str, np.ndarray]) -> list[np.ndarray]:
    """Members of two blocks of a bucket that may be alike to one of another component."""
    sketches, labels, sizes = _bytes(rows["bytes"]), rows["label"], rows["n"]
    own, low, high = rows["block"], rows["lo"][0], rows["hi"][0]
    left, right = np.flatnonzero(own == low), np.flatnonzero(own == high)
    found = np.zeros(len(own), dtype=bool)
    for i in left:
        other = right[labels[right] != labels[i]]
        other = other[100 * np.minimum(sizes[other], sizes[i]) >= SIMILAR * np.maximum(sizes[other], sizes[i])]
        other = other[(sketches[other] == sketches[i]).sum(1) >= AGREE]
        found[other] = True
        found[i] |= len(other) > 0
    return [rows[name][found] for name in ("key", "cid", "label")]


def _in_blocks(members: DataFrame, size: int) -> tuple[DataFrame, list[str]]:
    """Rows of each bucket of two or more components, once for each pair of blocks that they take part in.

    Members of a bucket's largest component are dealt to blocks of ``size`` of their own, which meet the blocks
    of the other members only: links inside a component are not sought. So a bucket with one large component
    and few others is copied as often as the others have blocks, not as often as it has blocks itself.
    """
    parts = members.groupBy("key", "label").agg(F.count("*").alias("m"))
    several = parts.groupBy("key").agg(
        F.max(F.struct("m", "label")).alias("largest"), F.sum("m").alias("all"), F.count("*").alias("labels")
    )
    several = several.filter("labels > 1").select(
        "key",
        F.col("largest.label").alias("main"),
        F.ceil(F.col("largest.m") / size).alias("a"),
        F.ceil((F.col("all") - F.col("largest.m")) / size).alias("b"),
    )
    rows = members.join(several, "key")
    in_main = F.col("label") == F.col("main")
    dealt = F.xxhash64("cid")
    block = F.when(in_main, F.pmod(dealt, F.col("a"))).otherwise(F.col("a") + F.pmod(dealt, F.col("b")))
    met = F.sequence(F.when(in_main, F.col("a")).otherwise(F.lit(0).cast("bigint")), F.col("a") + F.col("b") - 1)
    rows = rows.select(*members.columns, block.alias("block"), F.explode(met).alias("o"))
    return rows.select(
        *members.columns, "block", F.least("block", "o").alias("lo"), F.greatest("block", "o").alias("hi")
    ), ["key", "lo", "hi"]


def bucket_links(texts: DataFrame, members: DataFrame, sketched: DataFrame, roots: DataFrame, n: int = SHINGLE) -> DataFrame:
    """Links ``(u, v)`` between members ``(key, cid)`` of a bucket that ``roots`` has in different components.

    The signatures ``(cid, n, bytes)`` of ``sketched`` first leave only members that may have a link to another
    component. Their texts are compared; each pair of blocks gives a forest of links.
    """
    labelled = members.join(roots.withColumnRenamed("node", "cid"), "cid", "left").select(
        "key", "cid", F.coalesce("root", "cid").alias("label")
    )
    dealt, keys = _in_blocks(labelled, SIGNATURES)
    dealt = dealt.join(sketched, "cid").repartition(*keys).sortWithinPartitions(*keys, "block", "cid")
    found = dealt.mapInPandas(_in_runs(_partners, keys, ["key", "cid", "label"]), "key BIGINT, cid BIGINT, label BIGINT").distinct()
    dealt, keys = _in_blocks(stage(found, "possible-links"), BLOCK)
    needed = marked_rows(texts, dealt.select("cid").distinct())
    dealt = dealt.join(needed.hint("merge"), "cid").repartition(*keys).sortWithinPartitions(*keys, "block", "cid")
    return dealt.mapInPandas(_in_runs(_across, keys, ["u", "v"], n), "u BIGINT, v BIGINT").distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = SHINGLE) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` for each row of ``docs``; ``component_id`` is the smallest id reachable.

    Texts with the same set are one node, named by one of their rows, so copies meet in no bucket. Null texts
    and texts without words have no shingles and are linked with nothing; each is its own component, also where
    an id repeats. A null id is reached like any other, and its component has the smallest id that is not null,
    null if there is none. Repeated rows come out as often as they come in. Other columns are not read. No row
    gives no row.
    """
    marked = stage(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), sketches(F.col(text), n).alias("s")).select(
            "doc_id", "text", "s.*", F.monotonically_increasing_id().alias("row")
        ),
        "sketches",
    )
    texts = marked.filter("n > 0").select(F.col("row").alias("cid"), "text")
    classes = stage(
        marked.filter("n > 0")
        .groupBy("s1", "s2", "n", "bands", "bytes")
        .agg(F.min("doc_id").alias("first"), F.min("row").alias("cid")),
        "set-classes",
    )
    sketched = classes.select("cid", "n", "bytes")
    keyed = classes.select("cid", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("cid").alias("center"), F.count("*").alias("m"), F.bit_xor(F.xxhash64("cid")).alias("all"))
    # Buckets with the same members are taken once.
    chosen = buckets.filter("m > 1").groupBy("center", "m", "all").agg(F.min("key").alias("key")).select("key", "center")
    members = stage(keyed.hint("merge").join(chosen, "key"), "bucket-members")
    pairs = members.filter("cid <> center").select("center", "cid").distinct()
    of_center = sketched.select(F.col("cid").alias("center"), F.col("n").alias("center_n"), F.col("bytes").alias("center_bytes"))
    fits = 100 * F.least("n", "center_n") >= SIMILAR * F.greatest("n", "center_n")
    pairs = pairs.join(sketched, "cid").join(of_center, "center").filter(fits).filter(may_be_alike(F.col("bytes"), F.col("center_bytes")))
    stars = stage(pairs.select("center", "cid"), "stars")
    links = stage(star_links(texts, stars, n), "star-links")
    roots = components(links, "minhash-stars")
    more = stage(bucket_links(texts, members.select("key", "cid"), sketched, roots, n), "bucket-links")
    if not more.isEmpty():
        roots = components(links.unionByName(more), "minhash")
    named = classes.join(roots.withColumnRenamed("node", "cid"), "cid", "left").select(
        "s1", "s2", "first", F.coalesce("root", "cid").alias("root")
    )
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    answers = named.join(smallest, "root").select("s1", "s2", "component_id")
    rows = marked.select("doc_id", F.col("n").alias("n_shingles"), "s1", "s2")
    found = rows.filter("n_shingles > 0").join(answers, ["s1", "s2"]).select("doc_id", "n_shingles", "component_id")
    alone = rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.unionByName(alone)
