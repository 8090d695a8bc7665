"""Which passages of a corpus occur in several documents: keys are shuffled packed, verdicts come back.

Documents are dealt into chunks of bounded size. A task takes one chunk at a time, finds its
occurrences - each with a key, a hash of its surroundings (the context) and the rank of its document -
and ships one leader for each key and context it holds. Occurrences of the same key meet by key;
each chunk gets back one verdict for each leader, in the order it sent them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.llm.packing import mixed, pack, unpack

#: Rank of a document without an id: after all others.
LAST = (1 << 63) - 1
#: Verdicts. ALONE: no other document has the key. TWIN: a smaller document has key and context.
#: OPEN: other contexts of the key exist. HOT: OPEN, with more than ``HOT_CONTEXTS`` of them.
ALONE, TWIN, OPEN, HOT = range(4)
HOT_CONTEXTS = 2000
_48 = np.uint64((1 << 48) - 1)
VERDICTS = "chunk BIGINT, part BIGINT, verdict BINARY, twin BINARY"


@dataclass
class Found:
    """Occurrences in a chunk, in an order that depends on its documents alone."""

    key: np.ndarray
    context: np.ndarray
    rank: np.ndarray
    more: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self):
        self.key, self.context = self.key & _48, self.context & _48
        pair = mixed(self.key, 41) + self.context
        order = np.lexsort((self.rank, pair))  # stable: of equal ranks the first occurrence leads
        pair = pair[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = pair[1:] != pair[:-1]
        first = order[np.flatnonzero(new)]
        self.leader = np.empty(len(order), dtype=np.int64)
        if len(order):
            self.leader[order] = first[np.cumsum(new) - 1]
        self.leaders = np.sort(first)

    def by_part(self, parts: int) -> list[tuple[int, np.ndarray]]:
        """Leaders of each part, in the order in which they are sent."""
        part = mixed(self.key[self.leaders], 77) % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        cuts = np.flatnonzero(np.diff(part[order])) + 1
        return [(int(part[at[0]]), self.leaders[at]) for at in np.split(order, cuts) if len(at)]

    def verdicts(self, rows: pd.DataFrame, parts: int) -> tuple[np.ndarray, np.ndarray]:
        """Verdict and twin's rank of every occurrence; a follower of a leader shares its verdict.

        Where the verdict is OPEN or HOT, the number of the key's contexts stands in place of the rank.
        """
        verdict, twin = np.zeros(len(self.key), dtype=np.uint8), np.zeros(len(self.key), dtype=np.int64)
        sent = dict(self.by_part(parts))
        for part, v, t in zip(rows["part"], rows["verdict"], rows["twin"], strict=True):
            at = sent[int(part)]
            verdict[at] = np.frombuffer(zstandard.ZstdDecompressor().decompress(v), dtype=np.uint8)
            twin[at] = unpack(t).view(np.int64)
        verdict, twin = verdict[self.leader], twin[self.leader]
        local = self.rank > self.rank[self.leader]
        twin[local & (verdict != TWIN)] = self.rank[self.leader][local & (verdict != TWIN)]
        verdict[local] = TWIN
        return verdict, twin


Extract = Callable[[list[bytes], np.ndarray], Found]


@dataclass
class Texts:
    """The distinct rows of a chunk."""

    k: np.ndarray
    doc_id: list
    rank: np.ndarray
    data: list[bytes]


def texts_of(frame: pd.DataFrame) -> Texts:
    rows = frame.sort_values("k").drop_duplicates("k")
    ids = [None if pd.isna(i) else int(i) for i in rows["doc_id"]]
    rank = np.array([LAST if i is None else i for i in ids], dtype=np.int64)
    data = [t.encode() if isinstance(t, str) else b"" for t in rows["text"]]
    return Texts(rows["k"].to_numpy(), ids, rank, data)


def chunked(docs: DataFrame, doc_id: str, text: str, chunk_bytes: int) -> tuple[DataFrame, int]:
    """``(chunk, k, doc_id, text)`` with chunks of about ``chunk_bytes``, and the bytes of all texts.

    ``k`` hashes id and text; rows equal in both are one document with several rows.
    """
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    k = F.xxhash64(F.col(doc_id).cast("string"), F.col(text))
    chunks = max(1, -(-total // chunk_bytes))
    rows = docs.select(k.alias("k"), F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.select(F.pmod("k", F.lit(chunks)).alias("chunk"), "k", "doc_id", "text"), total


def judge(chunks: DataFrame, extract: Extract, parts: int) -> DataFrame:
    """Verdicts on the leaders of every chunk, packed by chunk and part."""

    def ship(frame: pd.DataFrame) -> pd.DataFrame:
        texts = texts_of(frame)
        found = extract(texts.data, texts.rank)
        rows = [
            (part, pack(found.key[at]), pack(found.context[at]), pack(found.rank[at].view(np.uint64)))
            for part, at in found.by_part(parts)
        ]
        out = pd.DataFrame(rows, columns=["part", "keys", "contexts", "ranks"])
        out.insert(0, "chunk", frame["chunk"].iloc[0])
        return out

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        key = np.concatenate([unpack(b) for b in frame["keys"]])
        context = np.concatenate([unpack(b) for b in frame["contexts"]])
        ranks = [unpack(b).view(np.int64) for b in frame["ranks"]]
        sizes, rank = [len(r) for r in ranks], np.concatenate(ranks)
        verdict, twin = np.zeros(len(key), dtype=np.uint8), np.zeros(len(key), dtype=np.int64)
        order = np.lexsort((rank, context, key))
        k, c, r = key[order], context[order], rank[order]
        new_key = np.concatenate([[True], k[1:] != k[:-1]])
        new_pair = new_key | np.concatenate([[True], c[1:] != c[:-1]])
        in_key, in_pair = np.cumsum(new_key) - 1, np.cumsum(new_pair) - 1
        starts = np.flatnonzero(new_key)
        several = (np.minimum.reduceat(r, starts) != np.maximum.reduceat(r, starts))[in_key]
        least = r[np.flatnonzero(new_pair)][in_pair]
        contexts = np.bincount(in_key, new_pair)[in_key]
        state = np.where(several & (r > least), TWIN, ALONE)
        state = np.where(several & (r == least) & (contexts > 1), np.where(contexts > HOT_CONTEXTS, HOT, OPEN), state)
        verdict[order] = state
        twin[order] = np.where(state == TWIN, least, np.where(state >= OPEN, contexts.astype(np.int64), 0))
        ends = np.cumsum(sizes)
        squeeze = zstandard.ZstdCompressor(level=1).compress
        rows = [
            (squeeze(verdict[end - n : end].tobytes()), pack(twin[end - n : end].view(np.uint64)))
            for n, end in zip(sizes, ends, strict=True)
        ]
        out = pd.DataFrame(rows, columns=["verdict", "twin"])
        return pd.DataFrame({"chunk": frame["chunk"].to_numpy(), "part": frame["part"].to_numpy()}).join(out)

    sent = chunks.groupBy("chunk").applyInPandas(
        ship, "chunk BIGINT, part BIGINT, keys BINARY, contexts BINARY, ranks BINARY"
    )
    return sent.groupBy("part").applyInPandas(meet, VERDICTS)
