"""Near-duplicate passages by compact windows over min-hashes of word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wickline.llm.common import stage
from wickline.llm.components import components
from wickline.llm.packing import mixed
from wickline.llm.shared_keys import LAST, OPEN, TWIN, Found, chunked, judge, texts_of
from wickline.llm.suffix_dedup import Hashes

#: Words of a shingle, shingles of a passage (50 words), similarity from which passages are near-duplicates.
SHINGLE, PASSAGE, SIMILARITY = 5, 46, 0.8
#: Shingles that two passages without repeats must have in common.
NEEDED = int(np.ceil(2 * PASSAGE * SIMILARITY / (1 + SIMILARITY)))
#: Hash functions whose windows are joined.
HASHES = 4
CHUNK_BYTES, PART_KEYS = 4 << 20, 1_500_000
#: Contexts of a key that one comparison block holds; rows up to which pairs are verified together, and all pairs.
BLOCK, FEW, TINY = 2000, 32, 3
_BUFFER, _TEXT_BUFFER = 1 << 16, 1 << 17
_POSITION = np.uint64((1 << 20) - 1)
_REACH = PASSAGE - 1
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
#: Values of a block whose minima are kept; a passage holds a whole block wherever it starts.
_STEP = 16


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words between ASCII white space in a buffer."""
    word = np.zeros(len(data) + 2, dtype=np.int8)
    word[1:-1] = ~_SPACE[data]
    edges = np.flatnonzero(np.diff(word))
    start, length = edges[::2], edges[1::2] - edges[::2]
    return start, mixed(Hashes(data).of(start, length) + length.astype(np.uint64), 7)


def shingles(texts: list[bytes], width: int = SHINGLE) -> tuple[list[np.ndarray], np.ndarray]:
    """Of each text the hashes of all runs of ``width`` words (A-Z in lower case), and the number of words."""
    out: list[np.ndarray] = []
    counts: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= _TEXT_BUFFER):
            size += len(texts[end]) + 1
            end += 1
        lengths = np.array([len(t) + 1 for t in texts[at:end]], dtype=np.int64)
        data = np.frombuffer((b" ".join(texts[at:end]) + b" ").lower(), dtype=np.uint8)
        start, hashes = _word_hashes(data)
        words = np.diff(np.searchsorted(start, np.concatenate([[0], np.cumsum(lengths)])))
        n = max(0, len(hashes) - width + 1)
        runs = np.zeros(n, dtype=np.uint64)
        for i in range(width):
            runs = runs * _FACTOR + hashes[i : i + n]
        runs = mixed(runs, 9)
        first = np.cumsum(words) - words
        out += [runs[f : f + max(0, w - width + 1)] for f, w in zip(first.tolist(), words.tolist(), strict=True)]
        counts.append(words)
        at = end
    return out, np.concatenate([*counts, np.zeros(0, np.int64)])


def compact_windows(values: np.ndarray, lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, ...]:
    """``(l, c, r)`` of all compact windows of PASSAGE values or more in the given ranges.

    The Cartesian tree of a range has its minimum at the root; every subsequence of ``[l, r]`` that
    contains ``c`` has its minimum there. Ranges below PASSAGE are not followed. The trees of all ranges
    are walked level by level; minima come from those up to and from each place of a block of _STEP values,
    and for the blocks between, of which such ranges have one or more, from a table of powers of two.
    """
    n, longest = -(-len(values) // _STEP), int((highs - lows + 1).max(initial=1))
    upto = np.full(n * _STEP, ~np.uint64(0))
    upto[: len(values)] = (values & ~_POSITION) | np.arange(len(values), dtype=np.uint64)
    upto = np.ascontiguousarray(upto.reshape(n, _STEP).T)
    onward = upto.copy()
    for k in range(1, _STEP):
        np.minimum(upto[k], upto[k - 1], out=upto[k])
        np.minimum(onward[-k - 1], onward[-k], out=onward[-k - 1])
    table = np.empty((max(1, (longest // _STEP).bit_length()), n), dtype=np.uint64)
    table[0] = upto[-1]
    for level in range(1, len(table)):
        half = 1 << (level - 1)
        table[level] = table[level - 1]
        np.minimum(table[level - 1, : n - half], table[level - 1, half:], out=table[level, : n - half])
    found: list[tuple[np.ndarray, ...]] = []
    while len(lows):
        good = highs - lows + 1 >= PASSAGE
        lows, highs = lows[good], highs[good]
        if not len(lows):
            break
        first, last = lows // _STEP + 1, highs // _STEP
        level = np.frexp((last - first).astype(np.float64))[1] - 1
        best = np.minimum(table[level, first], table[level, last - (1 << level)])
        best = np.minimum(best, np.minimum(onward[lows % _STEP, first - 1], upto[highs % _STEP, last]))
        c = (best & _POSITION).astype(np.int64)
        found.append((lows, c, highs))
        lows, highs = np.concatenate([lows, c + 1]), np.concatenate([c - 1, highs])
    return tuple(np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))


def find_windows(texts: list[bytes], rank: np.ndarray) -> Found:
    """Compact windows of all hash functions. Key: hash function and shingle at the centre.

    The context is the window's part within reach of a passage around the centre: ``lo`` to ``hi``. Besides,
    ``doc``, the centre ``at`` and each document's shingles are kept.
    """
    own, words = shingles(texts)
    parts: list[tuple[np.ndarray, ...]] = []
    held: list[tuple[int, int, np.ndarray]] = []

    def out():
        sizes = np.array([len(s) for _, _, s in held], dtype=np.int64)
        data = np.concatenate([s for _, _, s in held])
        begin = np.cumsum(sizes) - sizes
        docs, offsets = (np.array([h[i] for h in held], dtype=np.int64) for i in (0, 1))
        hashes = Hashes(data)
        # The trees of all hash functions are walked together.
        values = np.concatenate([mixed(data, 1000 + j) for j in range(HASHES)])
        lows = (np.arange(HASHES)[:, None] * len(data) + begin).ravel()
        windows = compact_windows(values, lows, lows + np.tile(sizes, HASHES) - 1)
        function = windows[1] // len(data)
        for j in range(HASHES):
            low, c, high = (w[function == j] - j * len(data) for w in windows)
            lo, hi = np.maximum(low, c - _REACH), np.minimum(high, c + _REACH)
            content = hashes.of(lo, hi - lo + 1)
            shape = (((c - lo) << 8) | (hi - lo)).astype(np.uint64)
            piece = np.searchsorted(begin, c, side="right") - 1
            shift = offsets[piece] - begin[piece]
            parts.append(
                (
                    mixed(data[c], 31 + j),
                    mixed(mixed(content, 13) + mixed(shape, 17), 19 + j),
                    docs[piece],
                    lo + shift,
                    hi + shift,
                    c + shift,
                )
            )

    size = 0
    for d, values in enumerate(own):
        for at in range(0, max(1, len(values) - PASSAGE + 1), _BUFFER):
            piece = values[at : at + _BUFFER + PASSAGE - 1]
            if len(piece) < PASSAGE:
                continue
            if held and size + len(piece) > _BUFFER:
                out()
                held, size = [], 0
            held.append((d, at, piece))
            size += len(piece)
    if held:
        out()
    key, context, doc, lo, hi, at = (
        np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.uint64 if i < 2 else np.int64)
        for i in range(6)
    )
    found = Found(key, context, rank[doc], {"doc": doc, "lo": lo, "hi": hi, "at": at})
    found.shingles, found.words = own, words
    return found


def _around(content: list[bytes], at: np.ndarray) -> np.ndarray:
    """Shingles as a matrix with the centre in the middle column; 0 where there is none."""
    out = np.zeros((len(content), 2 * _REACH + 1), dtype=np.uint32)
    for i, data in enumerate(content):
        values = np.frombuffer(data, dtype=np.uint32)
        out[i, _REACH - at[i] : _REACH - at[i] + len(values)] = values
    return out


def _repeats(rows: np.ndarray) -> np.ndarray:
    """Which rows hold a shingle more than once."""
    by_value = np.sort(rows, axis=1)
    return ((by_value[:, 1:] == by_value[:, :-1]) & (by_value[:, 1:] != 0)).any(axis=1)


def _inside(marked: np.ndarray) -> np.ndarray:
    """For each first column the number of marked columns in a passage that starts there."""
    total = np.zeros((len(marked), marked.shape[1] + 1), dtype=np.int8)
    np.cumsum(marked, axis=1, dtype=np.int8, out=total[:, 1:])
    return total[:, PASSAGE : PASSAGE + _REACH + 1] - total[:, : _REACH + 1]


def _whole(x: np.ndarray) -> np.ndarray:
    """For each first column whether a passage that starts there has all its shingles."""
    return _inside(x == 0) == 0


def _bits(starts: np.ndarray) -> np.ndarray:
    """First columns as bits of an integer."""
    return (starts.astype(np.uint64) << np.arange(PASSAGE, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def verify(rows: np.ndarray, i: np.ndarray, j: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For pairs of rows, as bits: all first columns of passages with a near-duplicate in the other row.

    Every passage around the centre of one row is compared with every one of the other by its exact
    Jaccard similarity. ``odd`` says which rows hold a shingle more than once.
    """
    out = np.zeros(len(i), dtype=np.uint64), np.zeros(len(i), dtype=np.uint64)
    repeats = odd[i] | odd[j]
    for which, compare, size in ((np.flatnonzero(~repeats), _plain, 512), (np.flatnonzero(repeats), _sets, 4096)):
        for at in range(0, len(which), size):
            block = which[at : at + size]
            for to, bits in zip(out, compare(rows, i[block], j[block]), strict=True):
                to[block] = bits
    return out


def _plain(rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``verify`` for rows without repeats: shingles common to both rows are counted for all pairs of passages."""
    x, y = rows[i], rows[j]
    n, width, columns = len(x), x.shape[1], np.arange(x.shape[1], dtype=np.uint64)
    tagged = np.concatenate([x, y], axis=1).astype(np.uint64) << np.uint64(8)
    tagged[:, :width] |= columns
    tagged[:, width:] |= columns | np.uint64(128)
    tagged.sort(axis=1)
    value = tagged >> np.uint64(8)
    equal = (value[:, 1:] == value[:, :-1]) & (value[:, 1:] != 0)
    bits = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=np.uint64)
    some = np.flatnonzero(equal.sum(axis=1) >= NEEDED)
    if not len(some):
        return bits
    row, at = np.nonzero(equal[some])
    i = (tagged[some[row], at] & np.uint64(127)).astype(np.int64)
    j = (tagged[some[row], at + 1] & np.uint64(127)).astype(np.int64)
    # Passages at the same place in both rows are counted first: often they are all that can be near-duplicates.
    marked = np.zeros((3, len(some), width), dtype=bool)
    marked[0, row, i], marked[1, row, j], marked[2, row[i == j], i[i == j]] = True, True, True
    whole = _whole(x[some]), _whole(y[some])
    may = [w & (_inside(m) >= NEEDED) for w, m in zip(whole, marked, strict=False)]
    sure = whole[0] & whole[1] & (_inside(marked[2]) >= NEEDED)
    bits[0][some] = bits[1][some] = _bits(sure)
    left = ((may[0] != sure) | (may[1] != sure)).any(axis=1)
    left &= may[0].any(axis=1) & may[1].any(axis=1)
    if not left.any():
        return bits
    own = left[row]
    row, i, j = (np.cumsum(left) - 1)[row[own]], i[own], j[own]
    some, whole = some[left], [w[left] for w in whole]
    # A shingle at (i, j) is in the passages that start in a rectangle.
    side = PASSAGE + 1
    edge = np.zeros(len(some) * side * side, dtype=np.int64)
    for f, sign in ((np.maximum(i - _REACH, 0), 1), (np.minimum(i, _REACH) + 1, -1)):
        for g, other in ((np.maximum(j - _REACH, 0), 1), (np.minimum(j, _REACH) + 1, -1)):
            edge += sign * other * np.bincount((row * side + f) * side + g, minlength=len(edge))
    common = edge.reshape(-1, side, side).astype(np.int8).cumsum(axis=1, dtype=np.int8).cumsum(axis=2, dtype=np.int8)
    good = (common[:, :-1, :-1] >= NEEDED) & whole[0][:, :, None] & whole[1][:, None, :]
    bits[0][some], bits[1][some] = _bits(good.any(axis=2)), _bits(good.any(axis=1))
    return bits


def _firsts(rows: np.ndarray) -> np.ndarray:
    """For each column the first start whose passage holds no earlier occurrence of its shingle.

    A passage that starts from there up to the column holds the shingle with this as its first occurrence,
    so that each shingle of a passage is counted once.
    """
    n, width = rows.shape
    tagged = np.sort((rows.astype(np.uint64) << np.uint64(8)) | np.arange(width, dtype=np.uint64), axis=1)
    value, column = tagged >> np.uint64(8), (tagged & np.uint64(255)).astype(np.int64)
    before = np.full((n, width), -1, dtype=np.int64)
    before[:, 1:] = np.where(value[:, 1:] == value[:, :-1], column[:, :-1], -1)
    out = np.empty((n, width), dtype=np.int64)
    np.put_along_axis(out, column, np.maximum(before + 1, column - _REACH), axis=1)
    return out


def _distinct(rows: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Number of distinct shingles of the passage at each start."""
    row, at = np.nonzero((rows != 0) & (firsts <= _REACH))
    low, side = firsts[row, at], PASSAGE + 1
    edge = np.bincount(row * side + low, minlength=len(rows) * side)
    edge -= np.bincount(row * side + np.minimum(at, _REACH) + 1, minlength=len(rows) * side)
    return edge.reshape(-1, side).cumsum(axis=1)[:, :-1]


def _sets(rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``verify`` for rows that may hold a shingle more than once.

    Rows with fewer distinct shingles in common than any near-duplicate passages of theirs are left out;
    for the others the shingles common to all pairs of passages are counted by rectangles of starts.
    """
    bits = np.zeros(len(a), dtype=np.uint64), np.zeros(len(a), dtype=np.uint64)
    own, where = np.unique(np.concatenate([a, b]), return_inverse=True)
    rows, a, b = rows[own], where[: len(a)], where[len(a) :]
    low, whole = _firsts(rows), _whole(rows)
    distinct = _distinct(rows, low).astype(np.int16)
    least = np.where(whole, distinct, 2 * PASSAGE).min(axis=1)
    once = np.sort(rows, axis=1)
    once[:, 1:][once[:, 1:] == once[:, :-1]] = 0
    both = np.sort(np.concatenate([once[a], once[b]], axis=1), axis=1)
    shared = ((both[:, 1:] == both[:, :-1]) & (both[:, 1:] != 0)).sum(axis=1)
    some = np.flatnonzero(5 * shared >= 4 * np.maximum(least[a], least[b]))
    side = PASSAGE + 1
    for at in range(0, len(some), 128):
        part = some[at : at + 128]
        x, y = a[part], b[part]
        pair, i, j = np.nonzero((rows[x][:, :, None] == rows[y][:, None, :]) & (rows[x] != 0)[:, :, None])
        f, g = low[x[pair], i], low[y[pair], j]
        inside = (f <= _REACH) & (g <= _REACH)
        pair, i, j, f, g = (v[inside] for v in (pair, i, j, f, g))
        edge = np.zeros(len(part) * side * side, dtype=np.int64)
        for left, sign in ((f, 1), (np.minimum(i, _REACH) + 1, -1)):
            for right, other in ((g, 1), (np.minimum(j, _REACH) + 1, -1)):
                edge += sign * other * np.bincount((pair * side + left) * side + right, minlength=len(edge))
        # Sums of edges may pass 127 on the way.
        common = edge.astype(np.int16).reshape(-1, side, side).cumsum(axis=1, dtype=np.int16).cumsum(axis=2, dtype=np.int16)
        total = distinct[x][:, :, None] + distinct[y][:, None, :]
        good = (9 * common[:, :-1, :-1] >= 4 * total) & whole[x][:, :, None] & whole[y][:, None, :]
        bits[0][part], bits[1][part] = _bits(good.any(axis=2)), _bits(good.any(axis=1))
    return bits


def _possible(rows: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As bits: starts that may have a near-duplicate in another row without repeats, and in any; kinds of rows.

    So many of a passage's shingles as a near-duplicate shares must occur in some other row. Rows
    with repeats are not judged. Rows of one kind differ only in shingles that no other row has, so
    that they are alike to every other row.
    """
    value, where, n = np.unique(rows, return_inverse=True, return_counts=True)
    where = where.reshape(rows.shape)
    several = ((n > 1) & (value != 0))[where]
    shared = np.zeros((len(rows), rows.shape[1] + 1), dtype=np.int16)
    np.cumsum(several, axis=1, out=shared[:, 1:])
    shared = shared[:, PASSAGE : PASSAGE + _REACH + 1] - shared[:, : _REACH + 1]
    whole = _whole(rows)
    plain, any_row = (_bits(whole & ((shared >= least) | odd[:, None])) for least in (NEEDED, SIMILARITY * PASSAGE))
    content = np.where(several, where + 2, rows != 0)
    kinds: dict[bytes, int] = {}
    return plain, any_row, np.array([kinds.setdefault(c.tobytes(), len(kinds)) for c in content])


def _rare_shingles(rows: np.ndarray, order: np.ndarray, odd: np.ndarray, head: np.ndarray) -> np.ndarray:
    """Which columns are among the rarest shingles of a passage, so many that near-duplicates must meet there.

    Passages of ``a`` and ``b`` distinct shingles with a Jaccard similarity of 4 / 5 share 4 (a + b) / 9, of which
    the rarest is among the ``a`` - 4 (a + b) / 9 + 1 rarest of the one and likewise of the other. ``order`` counts
    the shingles of a group from the rarest on; ``b`` is the least in the group, which begins at ``head``. For each
    passage's start there is a counter of the shingles still to take, held as bits across four integers.
    """
    n, width = rows.shape
    low = np.broadcast_to(np.maximum(np.arange(width) - _REACH, 0), rows.shape).copy()
    distinct, whole = np.full((n, PASSAGE), PASSAGE), _whole(rows)
    if odd.any():
        low[odd] = _firsts(rows[odd])
        distinct[odd] = _distinct(rows[odd], low[odd])
    size = np.diff(np.append(head, n))
    least = np.minimum.reduceat(np.where(whole, distinct, 2 * PASSAGE).min(axis=1), head)
    other = np.maximum(-(-4 * distinct // 5), np.repeat(least, size)[:, None])
    take = np.where(whole, np.maximum(distinct + 1 - -(-4 * (distinct + other) // 9), 0), 0)
    left = [_bits((take >> k) & 1) for k in range(4)]
    upto = np.array([(1 << k) - 1 for k in range(PASSAGE + 1)], dtype=np.uint64)
    inside = upto[np.minimum(np.arange(width), _REACH) + 1] & ~upto[np.minimum(low, PASSAGE)]
    inside[rows == 0] = 0
    column = np.argsort(order, axis=1)
    inside = np.ascontiguousarray(np.take_along_axis(inside, column, axis=1).T)
    rare = np.zeros((width, n), dtype=bool)
    for k in range(width):
        less = inside[k] & (left[0] | left[1] | left[2] | left[3])
        rare[k] = less != 0
        for bit in range(4):
            left[bit], less = left[bit] ^ less, less & ~left[bit]
    out = np.zeros((n, width), dtype=bool)
    np.put_along_axis(out, column, rare.T, axis=1)
    return out


def _meetings(rows: np.ndarray, odd: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(shingle, row)`` sorted, for shingles that are among the rarest of passages of several rows of a group.

    Rows of a group begin at ``head``. Rows that meet at no shingle hold no near-duplicate passages.
    """
    n, width = rows.shape
    group = np.repeat(np.arange(len(head), dtype=np.uint64), np.diff(np.append(head, n)))
    code = ((group[:, None] << np.uint64(32)) | rows).ravel()
    at = np.argsort(code, kind="stable")
    code, row = code[at], at // width
    new = np.concatenate([[True], code[1:] != code[:-1]])
    shingle = np.cumsum(new) - 1
    other = new | np.concatenate([[True], row[1:] != row[:-1]])
    holders = np.bincount(shingle, other).astype(np.int64)
    place = np.empty(len(holders), dtype=np.int32)
    place[np.argsort(holders, kind="stable")] = np.arange(len(holders), dtype=np.int32)
    index = np.empty(len(at), dtype=np.int32)
    index[at] = shingle
    index = index.reshape(n, width)
    rare = _rare_shingles(rows, place[index], odd, head) & (holders[index] > 1)
    row, column = np.nonzero(rare)
    met = np.unique(index[row, column].astype(np.int64) * n + row)
    shingle, row = met // n, met % n
    several = np.bincount(shingle, minlength=len(holders))[shingle] > 1
    return shingle[several], row[several]


def _pairs(shingle: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows that meet at a shingle, each once, the smaller row first."""
    after = np.searchsorted(shingle, shingle, side="right") - np.arange(len(shingle)) - 1
    i = np.repeat(np.arange(len(shingle)), after)
    j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(after) - after, after)
    both = np.unique(row[i] * n + row[j])
    return both // max(n, 1), both % max(n, 1)


class _Group:
    """Rows of one key that meet in a task: the starts found of each row, and links that connect them."""

    def __init__(self, rank: np.ndarray):
        self.rank, self.root = rank, np.arange(len(rank))
        self.found = np.zeros(len(rank), dtype=np.uint64)
        self.links: list[tuple[int, int]] = []

    def add(self, early: int, late: np.ndarray, bits: np.ndarray) -> None:
        """Near-duplicates ``late`` of a row; rows must come in the order of their ranks."""
        first = self.found[late] == 0
        self.found[late] |= bits
        for k, new in zip(late.tolist(), first.tolist(), strict=True):
            if new or self.root[k] != self.root[early]:
                self.links.append((k, early))
                if self.root[k] != self.root[early]:
                    self.root[self.root == self.root[k]] = self.root[early]


def _meet(
    rank: np.ndarray, rows: np.ndarray, odd: np.ndarray, side: np.ndarray | None, shingle: np.ndarray, met: np.ndarray
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Starts found of each row, as bits, and links ``(late, early)``; with ``side`` only across sides.

    ``met`` are the rows that meet at each ``shingle``. No pair is left out but by bounds: rows that meet nowhere,
    a row without a possible start, rows of one document, and a pair that is connected already while the
    later row has all its possible starts.
    """
    plain, any_row, kind = _possible(rows, odd)
    _, shingle, sizes = np.unique(shingle, return_inverse=True, return_counts=True)
    ends, at_row = np.cumsum(sizes), np.argsort(met, kind="stable")
    of_row = np.searchsorted(met[at_row], np.arange(len(rows) + 1))
    group, kinds = _Group(rank), int(kind.max()) + 1
    several, known = np.bincount(kind) > 1, {}
    order = np.argsort(rank, kind="stable")
    order = order[(any_row if odd.any() else plain)[order] != 0]
    place = np.full(len(rows), -1)
    place[order] = np.arange(len(order))
    for k, y in enumerate(order.tolist()):
        own = shingle[at_row[of_row[y] : of_row[y + 1]]].tolist()
        near = np.zeros(len(order) + 1, dtype=bool)
        for s in own:
            near[place[met[ends[s] - sizes[s] : ends[s]]]] = True
        x = order[k + 1 + np.flatnonzero(near[k + 1 : -1])]
        if not len(x):
            continue
        possible = any_row[x] if odd[y] else np.where(odd[x], any_row[x], plain[x])
        # A pair without possible starts is out; a later row that has all of its own is only to be connected.
        open_ = (possible & ~group.found[x] != 0) | ((possible != 0) & (group.root[x] != group.root[y]))
        x = x[(rank[x] > rank[y]) & open_]
        if side is not None:
            x = x[side[x] != side[y]]
        if not len(x):
            continue
        bits, done = known.get(kind[y]) or (np.zeros(kinds, dtype=np.uint64), np.zeros(kinds, dtype=bool))
        if several[kind[y]]:
            known[kind[y]] = bits, done
        new, at = np.unique(kind[x], return_index=True)
        some = x[at[~done[new]]]
        done[new] = True
        for part in np.array_split(some, max(1, len(some) // 4096)):
            bits[kind[part]], _ = verify(rows, part, np.full(len(part), y), odd)
        hit = x[bits[kind[x]] != 0]
        group.add(y, hit, bits[kind[hit]])
    return group.found, group.links


_OPEN_ROWS = "key BIGINT, rank BIGINT, content BINARY, at BIGINT, chunk BIGINT, ref BIGINT, block BIGINT, blocks BIGINT"
_LINKS = "chunk BIGINT, ref BIGINT, other BIGINT, starts BIGINT"
_GROUP = ["key", "lo", "hi"]


def _solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Verified links of runs of equal keys; rows arrive sorted, a run may cross batches."""

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        key, rank, block = frame[_GROUP].to_numpy(), frame["rank"].to_numpy(), frame["block"].to_numpy()
        rows = _around(list(frame["content"]), frame["at"].to_numpy())
        head = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)]))
        size = np.diff(np.append(head, len(key)))
        found, links = np.zeros(len(key), dtype=np.uint64), []
        # Pairs of small groups are verified together, all of them in the smallest.
        odd, large = _repeats(rows), np.repeat(size > TINY, size)
        shingle, met = np.zeros((2, 0), dtype=np.int64)
        if large.any():
            shingle, met = _meetings(rows[large], odd[large], np.searchsorted(np.flatnonzero(large), head[size > TINY]))
            met = np.flatnonzero(large)[met]
        few = np.repeat(size <= FEW, size)[met]
        i, j = _pairs(shingle[few], met[few], len(key))
        tiny = np.flatnonzero(~large)
        first, second = _pairs(np.repeat(np.arange(len(head)), size)[tiny], tiny, len(key))
        i, j = np.concatenate([i, first]), np.concatenate([j, second])
        apart = (rank[i] != rank[j]) & ((key[i, 1] == key[i, 2]) | (block[i] != block[j]))
        i, j = i[apart], j[apart]
        late, early = np.where(rank[i] > rank[j], i, j), np.where(rank[i] > rank[j], j, i)
        for at in range(0, len(late), 4096):
            x, y = late[at : at + 4096], early[at : at + 4096]
            bits, _ = verify(rows, x, y, odd)
            np.bitwise_or.at(found, x, bits)
            links += zip(x[bits != 0].tolist(), y[bits != 0].tolist(), strict=True)
        # Shingles are numbered group by group, so that those of a group lie together.
        group = np.searchsorted(head, met, side="right") - 1
        for g in np.flatnonzero(size > FEW).tolist():
            lo, (first, last) = head[g], np.searchsorted(group, [g, g + 1])
            some, local = np.unique(met[first:last], return_inverse=True)
            if not len(some):
                continue
            side = block[some] if key[lo, 1] != key[lo, 2] else None
            found[some], own = _meet(rank[some], rows[some], odd[some], side, shingle[first:last], local)
            links += [(some[k], some[e]) for k, e in own]
        x, y = np.array(links, dtype=np.int64).reshape(-1, 2).T
        # The link is noted at the later of the two documents.
        out = frame[["chunk", "ref"]].iloc[x].reset_index(drop=True)
        return out.assign(other=rank[y], starts=found[x].view(np.int64))

    rest = None
    for batch in batches:
        frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        last = (frame[_GROUP].to_numpy() == frame[_GROUP].iloc[-1].to_numpy()).all(axis=1)
        rest = frame[last]
        if not last.all():
            yield solve(frame[~last])
    if rest is not None and len(rest):
        yield solve(rest)


def _open_rows(parts: int, block_rows: int):
    """Windows whose key has other contexts. A hot key's rows are dealt to blocks."""

    def rows(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        texts = texts_of(left)
        found = find_windows(texts.data, texts.rank)
        verdict, contexts = found.verdicts(right, parts)
        m, own = found.more, np.arange(len(verdict)) == found.leader
        x = np.flatnonzero(own & (verdict >= OPEN))
        sizes = np.array([len(s) for s in found.shingles], dtype=np.int64)
        flat = np.concatenate([np.zeros(0, np.uint64), *found.shingles]).astype(np.uint32)
        flat[flat == 0] = 1
        begin = (np.cumsum(sizes) - sizes)[m["doc"][x]]
        lo, hi = begin + m["lo"][x], begin + m["hi"][x] + 1
        blocks = np.maximum(1, -(-contexts[x] // block_rows))
        return pd.DataFrame(
            {
                "key": found.key[x].astype(np.int64),
                "rank": found.rank[x],
                "content": [flat[i:j].tobytes() for i, j in zip(lo.tolist(), hi.tolist(), strict=True)],
                "at": m["at"][x] - m["lo"][x],
                "chunk": left["chunk"].iloc[0],
                "ref": x,
                "block": (mixed(found.context[x], 91) % blocks.astype(np.uint64)).astype(np.int64),
                "blocks": blocks,
            }
        )

    return rows


def _runs(starts: int) -> list[tuple[int, int]]:
    """First and last of each run of bits that are set."""
    bit = np.zeros(PASSAGE + 2, dtype=np.int8)
    bit[1:-1] = [starts >> f & 1 for f in range(PASSAGE)]
    edges = np.flatnonzero(np.diff(bit))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


def _passages(parts: int):
    """Of each row its passages with a near-duplicate in an earlier document, and those documents."""

    def rows(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        texts = texts_of(left)
        found = find_windows(texts.data, texts.rank)
        verdict, twin = found.verdicts(right[right["verdict"].notna()], parts)
        m = found.more
        runs: list[list[tuple[int, int]]] = [[] for _ in texts.data]
        others: list[set[int]] = [set() for _ in texts.data]
        for x in np.flatnonzero(verdict == TWIN):
            d = m["doc"][x]
            runs[d].append((int(m["lo"][x]), int(m["hi"][x]) + SHINGLE))
            others[d].add(int(twin[x]))
        links = right[right["verdict"].isna()]
        by_leader: dict[int, list[tuple[int, int]]] = {}
        for ref, other, starts in zip(links["part"], links["other"], links["starts"], strict=True):
            by_leader.setdefault(int(ref), []).append((int(other), int(starts)))
        if by_leader:
            for x in np.flatnonzero(np.isin(found.leader, list(by_leader))):
                d, c = m["doc"][x], int(m["at"][x])
                own = by_leader[int(found.leader[x])]
                others[d].update(other for other, _ in own)
                for starts in {starts for _, starts in own}:
                    for first, last in _runs(starts):
                        runs[d].append((c - _REACH + first, c - _REACH + last + PASSAGE - 1 + SHINGLE))
        flat = []
        for spans in runs:
            merged: list[int] = []
            for start, end in sorted(spans):
                if merged and start <= merged[-1]:
                    merged[-1] = max(merged[-1], end)
                else:
                    merged += [start, end]
            flat.append(merged)
        place = {k: i for i, k in enumerate(texts.k)}
        at = [place[k] for k in left["k"]]
        return pd.DataFrame(
            {
                "doc_id": left["doc_id"].array,
                "rank": texts.rank[at],
                "n_words": found.words[at],
                "passages": [flat[i] for i in at],
                "others": [sorted(others[i]) for i in at],
            }
        )

    return rows


def near_duplicate_passages(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_rows: int = BLOCK
) -> DataFrame:
    """``(doc_id, n_words, passages, others, n_links, class_id)`` for each row of ``docs``.

    ``passages`` is a flat list of word ranges (start and end) that are near-duplicates of a passage in a
    document with a smaller id: 50 words or more with a Jaccard similarity of 0.8 or more over five-word
    shingles. All contexts of a key are compared, above ``block_rows`` of them block against block in tasks
    of their own. ``others`` are such documents: links enough to connect a class, at least one for each document
    with passages; ``class_id`` is the smallest document that a chain of links reaches, itself if there is
    none, and ``n_links`` the number of ids before the document's in its class, 0 without passages. Texts below 50 words, null and
    empty ones have no passages. A null id counts as larger than all others and has its class's smallest id,
    or none; rows of one id are never linked to each other. Other columns are not read.
    """
    chunks, total = chunked(docs, doc_id, text, CHUNK_BYTES)
    parts = max(1, -(-total // (32 * PART_KEYS)))
    verdicts = judge(chunks, find_windows, parts)
    opened = chunks.groupBy("chunk").cogroup(verdicts.groupBy("chunk")).applyInPandas(_open_rows(parts, block_rows), _OPEN_ROWS)
    # Each row meets each block of its key once.
    with_block = opened.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("o"))
    dealt = with_block.withColumns({"lo": F.least("block", "o"), "hi": F.greatest("block", "o")}).drop("o", "blocks")
    links = dealt.repartition(*_GROUP).sortWithinPartitions(*_GROUP).mapInPandas(_solve, _LINKS)
    nothing, zero = F.lit(None).cast("binary"), F.lit(0).cast("bigint")
    back = verdicts.select(
        "chunk", "part", "verdict", "twin", zero.alias("other"), zero.alias("starts")
    ).unionByName(
        links.distinct().select(
            "chunk", F.col("ref").alias("part"), nothing.alias("verdict"), nothing.alias("twin"), "other", "starts"
        )
    )
    marked = chunks.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInPandas(
        _passages(parts),
        "doc_id BIGINT, rank BIGINT, n_words BIGINT, passages ARRAY<BIGINT>, others ARRAY<BIGINT>",
    )
    marked = stage(marked, "passages")
    edges = marked.select(F.col("rank").alias("u"), F.explode("others").alias("v")).distinct()
    roots = components(stage(edges, "passage-links"), "passage-classes")
    before = F.row_number().over(Window.partitionBy("root").orderBy("node")) - 1
    placed = roots.select(F.col("node").alias("rank"), "root", before.cast("bigint").alias("before"))
    named = marked.join(placed, "rank", "left")
    root = F.coalesce("root", "rank")
    return named.select(
        "doc_id",
        "n_words",
        "passages",
        "others",
        F.when(F.size("others") > 0, F.col("before")).otherwise(F.lit(0).cast("bigint")).alias("n_links"),
        F.when(root != LAST, root).alias("class_id"),
    )
