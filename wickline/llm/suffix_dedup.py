"""Exact substring dedup: suffixes at shared anchors, sorted by hash-compared mergesort."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.llm.packing import mixed
from wickline.llm.shared_keys import HOT, OPEN, TWIN, Found, Texts, chunked, judge, texts_of

#: Length of a removed string, and of the anchor that it is found by.
LENGTH, ANCHOR = 50, 20
#: Bytes of a chunk and keys of a part.
CHUNK_BYTES, PART_KEYS = 4 << 20, 1_500_000
_BUFFER = 1 << 16
_BASE = 0x5851F42D4C957F2D
_POSITION = np.uint64((1 << 20) - 1)


class Hashes:
    """Prefix polynomial hashes of a buffer: the hash of any substring in constant time, mod 2 ** 64."""

    _powers: dict[str, np.ndarray] = {}
    _codes = mixed(np.arange(256, dtype=np.uint64), 3)

    def __init__(self, data: np.ndarray):
        n = len(data)
        power, inverse = self._tables(n + 1)
        codes = data if data.dtype == np.uint64 else self._codes[data]
        self.prefix = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(codes * power[:n], out=self.prefix[1:])
        self.inverse = inverse

    @classmethod
    def _tables(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls._powers.get("up", ())) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                cls._powers[name] = np.cumprod(steps, dtype=np.uint64)
        return cls._powers["up"], cls._powers["down"]

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.inverse[start]

    def each(self, length: int) -> np.ndarray:
        """Hashes of all substrings of ``length``."""
        n = len(self.prefix) - length
        return (self.prefix[length:] - self.prefix[:n]) * self.inverse[:n]

    def extension(self, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """Length of the common extension of the suffixes at ``a`` and ``b``, by binary search."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), most, np.int64)
        while True:
            some = low < high
            if not some.any():
                return low
            middle = (low + high + 1) >> 1
            same = self.of(a, middle) == self.of(b, middle)
            low, high = np.where(some & same, middle, low), np.where(some & ~same, middle - 1, high)


def _buffers(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts end to end in buffers: (bytes, segment starts, document of each segment, offset in it).

    A text above the buffer's size is cut into segments that share LENGTH - 1 bytes, so that each of its
    strings lies in exactly one segment.
    """
    held, docs, offsets, size = [], [], [], 0

    def out():
        lengths = np.array([len(h) for h in held], dtype=np.int64)
        data = np.frombuffer(b"".join(held), dtype=np.uint8)
        return data, np.cumsum(lengths) - lengths, np.array(docs, np.int64), np.array(offsets, np.int64)

    for d, text in enumerate(texts):
        for at in range(0, max(1, len(text) - LENGTH + 1), _BUFFER):
            piece = text[at : at + _BUFFER + LENGTH - 1]
            if len(piece) < LENGTH:
                continue
            if held and size + len(piece) > 2 * _BUFFER:
                yield out()
                held, docs, offsets, size = [], [], [], 0
            held.append(piece)
            docs.append(d)
            offsets.append(at)
            size += len(piece)
    if held:
        yield out()


def find_anchors(texts: list[bytes], rank: np.ndarray) -> Found:
    """Anchors: of each string of LENGTH bytes the ANCHOR-byte part with the least hash.

    Equal strings have equal anchors at equal offsets, so each string is only compared with others of
    its anchor. The context is the span of all strings that share the anchor at this place; ``doc``,
    ``lo`` (its first string), ``n`` (strings) and ``at`` (the anchor) are kept besides.
    """
    parts = []
    for data, starts, docs, offsets in _buffers(texts):
        hashes, n = Hashes(data), len(data)
        grams = hashes.each(ANCHOR)
        best = (mixed(grams, 5) & ~_POSITION) | np.arange(n - ANCHOR + 1, dtype=np.uint64)
        width, wanted = 1, LENGTH - ANCHOR + 1
        while 2 * width <= wanted:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        best = np.minimum(best[: len(best) - (wanted - width)], best[wanted - width :])
        anchor = (best & _POSITION).astype(np.int64)
        ends = np.append(starts[1:], n)
        segment = np.repeat(np.arange(len(starts)), ends - starts)[: n - LENGTH + 1]
        first = np.arange(n - LENGTH + 1)
        whole = np.flatnonzero(ends[segment] - first >= LENGTH)
        chosen = anchor[whole]
        new = np.ones(len(whole), dtype=bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (np.diff(whole) != 1)
        head = np.flatnonzero(new)
        count = np.diff(np.append(head, len(whole)))
        lo, at = whole[head], chosen[head]
        seg = segment[lo]
        shape = (((at - lo) << 8) | count).astype(np.uint64)
        parts.append(
            (
                mixed(grams[at], 11),
                mixed(mixed(hashes.of(lo, count - 1 + LENGTH), 13) + mixed(shape, 17), 19),
                docs[seg],
                lo - starts[seg] + offsets[seg],
                count,
                at - starts[seg] + offsets[seg],
            )
        )
    key, context, doc, lo, count, at = (
        np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.uint64 if i < 2 else np.int64)
        for i in range(6)
    )
    return Found(key, context, rank[doc], {"doc": doc, "lo": lo, "n": count, "at": at})


def sort_suffixes(data: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
    """Order of the suffixes at ``starts`` by their first ``length`` bytes, within each group.

    ``group`` is ascending. A bottom-up mergesort over all groups at once: in each round every suffix
    looks up its place in the sibling run by binary search, and two suffixes are compared by the byte
    after their common extension.
    """
    hashes, n = Hashes(data), len(starts)
    head = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.append(head, n))
    base, size = np.repeat(head, sizes), np.repeat(sizes, sizes)
    order, local, width = np.arange(n), np.arange(n) - base, 1
    padded = np.append(data, np.uint8(0))
    while True:
        # Groups that are one run already rest.
        live = np.flatnonzero(size > width)
        if not len(live):
            return order
        mine, run = starts[order[live]], local[live] // width
        right = run & 1 == 1
        low = np.minimum((run ^ 1) * width, size[live])
        high = np.minimum(low + width, size[live])
        origin = low.copy()
        while True:
            some = np.flatnonzero(low < high)
            if not len(some):
                break
            middle = (low[some] + high[some]) >> 1
            a, b = mine[some], starts[order[base[live[some]] + middle]]
            common = hashes.extension(a, b, length)
            x = padded[np.minimum(a + common, len(data))]
            y = padded[np.minimum(b + common, len(data))]
            # Of equal suffixes those of the left run come first.
            after = np.where(common < length, y < x, right[some])
            low[some] = np.where(after, middle + 1, low[some])
            high[some] = np.where(after, high[some], middle)
        place = (run & ~1) * width + (local[live] - run * width) + (low - origin)
        moved = order.copy()
        moved[base[live] + place] = order[live]
        order = moved
        width *= 2


def repeated_strings(spans: list[bytes], at: np.ndarray, key: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each span a bit mask of its strings that a smaller document has too.

    ``at`` is the anchor's place in the span; rows come sorted by ``key``.
    """
    lengths = np.array([len(s) for s in spans], dtype=np.int64)
    data = np.frombuffer(b"".join(spans), dtype=np.uint8)
    begin = np.cumsum(lengths) - lengths
    count = lengths - LENGTH + 1
    span = np.repeat(np.arange(len(spans)), count)
    shift = np.arange(len(span)) - np.repeat(np.cumsum(count) - count, count)
    starts, lead = begin[span] + shift, at[span] - shift
    by_group = np.lexsort((span, lead, key[span]))
    k, d = key[span][by_group], lead[by_group]
    new = np.ones(len(k), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (d[1:] != d[:-1])
    group = np.cumsum(new) - 1
    several = np.bincount(group)[group] > 1
    by_group, group = by_group[several], group[several]
    order = by_group[sort_suffixes(data, starts[by_group], group, LENGTH)]
    sorted_group = group  # groups keep their places
    hashes = Hashes(data)
    s = starts[order]
    same = np.zeros(len(order), dtype=bool)
    if len(order) > 1:
        same[1:] = (sorted_group[1:] == sorted_group[:-1]) & (hashes.of(s[1:], LENGTH) == hashes.of(s[:-1], LENGTH))
    hit = np.flatnonzero(same)
    # Equal hashes are verified byte by byte.
    for block in np.array_split(hit, max(1, len(hit) // 100_000)):
        window = np.arange(LENGTH)
        equal = (data[s[block][:, None] + window] == data[s[block - 1][:, None] + window]).all(axis=1)
        same[block[~equal]] = False
    if not len(order):
        return np.zeros(len(spans), dtype=np.int64)
    heads = np.flatnonzero(~same)
    least = np.minimum.reduceat(rank[span[order]], heads)[np.cumsum(~same) - 1]
    bad = order[rank[span[order]] > least]
    out = np.zeros(len(spans), dtype=np.int64)
    np.bitwise_or.at(out, span[bad], np.int64(1) << shift[bad])
    return out


_OPEN = "key BIGINT, rank BIGINT, span BINARY, at BIGINT, chunk BIGINT, ref BIGINT, hot BOOLEAN"
_MASKS = "chunk BIGINT, ref BIGINT, mask BIGINT"


def _solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Masks of runs of equal keys; rows arrive sorted by key, span and rank, and a run may cross batches.

    Rows of hot keys are single strings with a key of their own and the smallest rank first, so they
    are compared with their run's first row as they pass and never held.
    """

    def solve(rows: pd.DataFrame) -> pd.DataFrame:
        spans = [bytes(s) for s in rows["span"]]
        mask = repeated_strings(spans, *(rows[c].to_numpy() for c in ("at", "key", "rank")))
        return pd.DataFrame({"chunk": rows["chunk"], "ref": rows["ref"], "mask": mask})[mask != 0]

    rest, first = None, (None, None)
    for batch in batches:
        hot, out = batch[batch["hot"]], []
        for row in hot.itertuples(index=False):
            if row.span != first[0]:
                first = (row.span, row.rank)
            elif row.rank > first[1]:
                out.append((row.chunk, row.ref, 1 << row.at))
        if out:
            yield pd.DataFrame(out, columns=["chunk", "ref", "mask"])
        cool = batch[~batch["hot"]]
        rows = cool if rest is None else pd.concat([rest, cool], ignore_index=True)
        if not len(rows):
            continue
        last = rows["key"].to_numpy() == rows["key"].iloc[-1]
        rest = rows[last]
        if not last.all():
            yield solve(rows[~last])
    if rest is not None and len(rest):
        yield solve(rest)


def _hot_strings(texts: Texts, found: Found, verdict: np.ndarray) -> tuple[list[tuple], list[tuple[int, int]]]:
    """Strings of hot keys: those with the smallest rank in the chunk, and (occurrence, bit) of the others."""
    m, rows, least = found.more, [], {}
    own = np.arange(len(verdict)) == found.leader
    for x in np.flatnonzero(own & (verdict == HOT)):
        text, lo, rank = texts.data[m["doc"][x]], int(m["lo"][x]), int(found.rank[x])
        for bit in range(int(m["n"][x])):
            string = text[lo + bit : lo + bit + LENGTH]
            rows.append((string, rank, bit, int(x)))
            least[string] = min(rank, least.get(string, rank))
    return [r for r in rows if r[1] == least[r[0]]], [(x, bit) for s, r, bit, x in rows if r > least[s]]


def _open_rows(parts: int):
    """Spans whose key has other contexts; of a hot key the strings one by one, by a key of their own."""

    def rows(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        import xxhash

        texts = texts_of(left)
        found = find_anchors(texts.data, texts.rank)
        verdict, _ = found.verdicts(right, parts)
        m, chunk = found.more, int(left["chunk"].iloc[0])
        own = np.arange(len(verdict)) == found.leader
        out = []
        for x in np.flatnonzero(own & (verdict == OPEN)):
            lo, n = int(m["lo"][x]), int(m["n"][x])
            span = texts.data[m["doc"][x]][lo : lo + n - 1 + LENGTH]
            out.append((int(found.key[x]), int(found.rank[x]), span, int(m["at"][x]) - lo, chunk, int(x), False))
        for string, rank, bit, x in _hot_strings(texts, found, verdict)[0]:
            out.append((-1 - (xxhash.xxh64_intdigest(string) >> 1), rank, string, bit, chunk, x, True))
        return pd.DataFrame(out, columns=["key", "rank", "span", "at", "chunk", "ref", "hot"])

    return rows


def _cut(parts: int):
    """The kept bytes of every text and the removed spans."""

    def rows(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        texts = texts_of(left)
        found = find_anchors(texts.data, texts.rank)
        verdict, _ = found.verdicts(right[right["verdict"].notna()], parts)
        masks = right[right["verdict"].isna()]
        mask = np.zeros(len(verdict), dtype=np.int64)
        np.bitwise_or.at(mask, masks["part"].to_numpy(np.int64), masks["mask"].to_numpy(np.int64))
        for x, bit in _hot_strings(texts, found, verdict)[1]:
            mask[x] |= 1 << bit
        mask = mask[found.leader]
        lengths = np.array([len(t) for t in texts.data], dtype=np.int64)
        begin = np.cumsum(lengths) - lengths
        change = np.zeros(int(lengths.sum()) + 1, dtype=np.int64)
        m = found.more
        lo = begin[m["doc"]] + m["lo"] if len(verdict) else np.zeros(0, np.int64)
        twin = verdict == TWIN
        np.add.at(change, lo[twin], 1)
        np.add.at(change, lo[twin] + m["n"][twin] - 1 + LENGTH, -1)
        some = np.flatnonzero(~twin & (mask != 0))
        for bit in range(LENGTH - ANCHOR + 1):
            hit = lo[some[(mask[some] >> bit) & 1 == 1]] + bit
            np.add.at(change, hit, 1)
            np.add.at(change, hit + LENGTH, -1)
        gone = np.cumsum(change)[:-1] > 0
        kept, spans = {}, {}
        for i, k in enumerate(texts.k):
            own = gone[begin[i] : begin[i] + lengths[i]]
            edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
            pieces, last = [], 0
            for start, end in zip(edges[::2], edges[1::2], strict=True):
                pieces.append(texts.data[i][last:start])
                last = int(end)
            kept[k] = b"".join([*pieces, texts.data[i][last:]])
            spans[k] = edges.tolist()
        sizes = dict(zip(texts.k, lengths, strict=True))
        return pd.DataFrame(
            {
                "doc_id": left["doc_id"].array,
                "n_bytes": [sizes[k] for k in left["k"]],
                "kept": [kept[k] for k in left["k"]],
                "removed": [spans[k] for k in left["k"]],
            }
        )

    return rows


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, kept, removed)`` for each row of ``docs``.

    Every byte that is part of a string of LENGTH bytes which also starts in a document with a smaller
    id is removed; ``kept`` is what remains, ``removed`` the flat list of starts and ends. Null and
    empty texts have no bytes. A null id comes after all others, rows of one id never remove each
    other's bytes, and rows equal in id and text come out alike. Other columns are not read.
    """
    chunks, total = chunked(docs, doc_id, text, CHUNK_BYTES)
    parts = max(1, -(-total // (16 * PART_KEYS)))
    verdicts = judge(chunks, find_anchors, parts)
    opened = chunks.groupBy("chunk").cogroup(verdicts.groupBy("chunk")).applyInPandas(_open_rows(parts), _OPEN)
    dealt = opened.repartition("key").sortWithinPartitions("key", "span", "rank")
    masks = dealt.mapInPandas(_solve, _MASKS)
    nothing = F.lit(None).cast("binary")
    back = verdicts.select("chunk", "part", "verdict", "twin", F.lit(0).cast("bigint").alias("mask")).unionByName(
        masks.select(
            "chunk", F.col("ref").alias("part"), nothing.alias("verdict"), nothing.alias("twin"), "mask"
        )
    )
    return chunks.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInPandas(
        _cut(parts), "doc_id BIGINT, n_bytes BIGINT, kept BINARY, removed ARRAY<BIGINT>"
    )
