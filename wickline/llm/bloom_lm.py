"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b
from itertools import chain, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.llm.common import stage
from wickline.llm.packing import mixed, pack, pack_sorted, unpack, unpack_sorted

#: A word is in the broadcast dictionary from this share of all training tokens on, so the dictionary
#: has at most 2 ** WORD_BITS words. Words above WORD_BYTES bytes are known by a 160-bit digest.
WORD_BITS, WORD_BYTES = 21, 64
#: The filter holds every bigram, and every word outside the dictionary, so it grows with the corpus. It is broadcast in blocks of
#: about this many events (84 MB) one after another; each adds to the scores what its bigrams say.
BLOCK_EVENTS = 1 << 26
#: Bits set for each event, parts of a block that are built in separate tasks, and runs of parts in which a block
#: passes the driver, one after another.
PROBES, SHARDS, RUNS = 7, 64, 8
#: Weight of the unigram model, in tokens, where a history is known.
SMOOTHING = 8.0
#: The end of a text, no word as it is white space; also the history of a text's first word.
END = b"\n"
_FACTOR, _UPPER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFFFFFFFF00000000)
_FLUSH_WORDS, _FLUSH_GRAMS = 400_000, 4_000_000


def tokens(text: str | None) -> list[bytes]:
    """Words between ASCII white space with A-Z in lower case, then one end; long words by their digest."""
    words = (text or "").encode().lower().split()
    if words and max(map(len, words)) > WORD_BYTES:
        words = [w if len(w) <= WORD_BYTES else END + blake2b(w, digest_size=20).digest() for w in words]
    return [*words, END]


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 11)


def gram_keys(history: np.ndarray, word: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """Keys of bigrams by the hashes of both words.

    The upper half says where a key is dealt. That of a rare word's bigrams is the word's own, so that they lie
    with its count; a frequent word's bigrams are spread.
    """
    key = mixed(history * _FACTOR + word, 5)
    return np.where(rare, (mixed(word, 6) & _UPPER) | (key & ~_UPPER), key)


def word_keys(word: np.ndarray) -> np.ndarray:
    """Keys of single rare words."""
    return mixed(word, 6)


@dataclass
class Dictionary:
    """Frequent words with exact counts, and the totals of the training tokens.

    Broadcast values are pickled without their classes, so workers get the fields alone (``vars``).
    """

    ids: dict[bytes, int]
    counts: np.ndarray
    hashes: np.ndarray
    n_tokens: int
    n_distinct: int

    def log_unigram(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1.0) / (self.n_tokens + self.n_distinct + 1.0))


@dataclass
class Filter:
    """Events ``(key, 1) ... (key, q)`` of a block's bigrams and rare words, ``q`` growing with the logarithm of the count."""

    #: The bits of all shards, one shard after another, in one array or in a list of equal runs; the bits of a shard.
    shards: np.ndarray | list[np.ndarray]
    bits: int

    def quantised(self, keys: np.ndarray) -> np.ndarray:
        """``q`` of each key: the number of events found before the first that is missing."""
        q = np.zeros(len(keys), dtype=np.int64)
        if not self.bits:
            return q
        runs = self.shards if isinstance(self.shards, list) else [self.shards]
        shard, each = shard_of(keys), np.uint64(SHARDS // len(runs))
        for number, run in enumerate(runs):
            own = np.flatnonzero(shard // each == np.uint64(number))
            q[own] = self._quantised(run, keys[own], shard[own] % each)
        return q

    def _quantised(self, joined: np.ndarray, keys: np.ndarray, shard: np.ndarray) -> np.ndarray:
        q, left, j = np.zeros(len(keys), dtype=np.int64), np.arange(len(keys)), 1
        base, size = shard * np.uint64(self.bits), np.uint64(self.bits)
        while len(left):
            at, step = mixed(keys[left], 2 * j), mixed(keys[left], 2 * j + 1) | np.uint64(1)
            start, found = base[left], np.ones(len(left), dtype=bool)
            for t in range(PROBES):
                bit = start + (at - at // size * size)
                found &= (joined[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
                if t < PROBES - 1 and 4 * np.count_nonzero(found) < 3 * len(found):
                    left, at, step, start = left[found], at[found], step[found], start[found]
                    found = np.ones(len(left), dtype=bool)
                at = at + step
            left = left[found]
            q[left] = j
            j += 1
        return q

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts rounded down to the quantisation, so that a history's bigrams never exceed it."""
        q = self.quantised(keys)
        return np.where(q > 0, 2.0 ** (q - 1), 0.0)


def shard_of(keys: np.ndarray) -> np.ndarray:
    return mixed(keys >> np.uint64(32), 101) % np.uint64(SHARDS)


@dataclass
class Blocks:
    """Quantised bigrams ``(part, shard, grams, q, events)``; ``parts`` are dealt to ``n`` blocks in runs."""

    grams: DataFrame
    parts: int
    runs: int
    n: int
    bits: int

    def load(self, number: int) -> Iterator[np.ndarray]:
        """The filter of one block in ``RUNS`` runs, each shard built in a task of its own.

        The shards are written first, so that the driver holds one run at a time.
        """
        bits = self.bits

        def build(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
            keys = np.concatenate([unpack_sorted(b) for b in frame["grams"]])
            q = np.concatenate([unpack(b) for b in frame["q"]]).astype(np.int64)
            return pd.DataFrame([(int(key[0]), build_shard(keys, q, bits).tobytes())], columns=["shard", "bits"])

        if not bits:
            return
        own = self.grams.filter(_block(F.col("part"), self.runs) == number)
        built = stage(own.groupBy("shard").applyInPandas(build, "shard BIGINT, bits BINARY"), "filter")
        each = SHARDS // RUNS
        for first in range(0, SHARDS, each):
            shards = np.zeros((each, bits // 8), dtype=np.uint8)
            for row in built.filter(F.col("shard").between(first, first + each - 1)).collect():
                shards[row.shard - first] = np.frombuffer(row.bits, dtype=np.uint8)
            yield shards.reshape(-1)


def _block(part: Column, runs: int) -> Column:
    return F.floor(part / (SHARDS * runs))


def block_of(keys: np.ndarray, parts: int, runs: int) -> np.ndarray:
    """The block of each key; the key's part also says its shard, as ``parts`` is a multiple of ``SHARDS``."""
    return (mixed(keys >> np.uint64(32), 101) % np.uint64(parts) // np.uint64(SHARDS * runs)).astype(np.int64)


def events_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log2(counts)).astype(np.int64)


def build_shard(keys: np.ndarray, q: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(bits, dtype=np.uint8)
    for j in range(1, int(q.max(initial=0)) + 1):
        some = keys[q >= j]
        first, second = mixed(some, 2 * j), mixed(some, 2 * j + 1) | np.uint64(1)
        for t in range(PROBES):
            out[(first + np.uint64(t) * second) % np.uint64(bits)] = 1
    return np.packbits(out, bitorder="little")


def _slices(batches: Iterator[pd.DataFrame], chars: int = 1 << 21) -> Iterator[pd.DataFrame]:
    """Batches cut to about ``chars`` characters, so that a task holds the tokens of few texts at once."""
    for batch in batches:
        if len(batch):
            group = batch["text"].str.len().fillna(0).cumsum() // chars
            for _, part in batch.groupby(group.to_numpy(), sort=True):
                yield part


def count_words(train: DataFrame) -> DataFrame:
    """``(word, c)`` of all training tokens; each task counts before the shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()

        def flush() -> pd.DataFrame:
            out = pd.DataFrame({"word": list(seen), "c": np.fromiter(seen.values(), np.int64, len(seen))})
            seen.clear()
            return out

        for batch in batches:
            for text in batch["text"]:
                seen.update(tokens(text))
                if len(seen) > _FLUSH_WORDS:
                    yield flush()
        yield flush()

    counted = train.select("text").mapInPandas(count, "word BINARY, c BIGINT")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


def dictionary(words: DataFrame) -> Dictionary:
    n, v = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    frequent = words.filter(F.col("c") * (1 << WORD_BITS) >= n).toPandas()
    frequent = frequent.sort_values("word", ignore_index=True)
    ids = dict(zip(map(bytes, frequent["word"]), range(len(frequent)), strict=True))
    hashes = np.fromiter(map(word_hash, ids), np.uint64, len(ids))
    return Dictionary(ids, frequent["c"].to_numpy(np.int64), hashes, int(n), int(v))


def _batch_ids(texts, known: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
    """Ids of all texts' tokens end to end, the number of tokens of each text, and the tokens."""
    parts = [tokens(t) for t in texts]
    lengths = np.array([len(p) for p in parts], dtype=np.int64)
    ids = np.concatenate([np.fromiter(map(known.get, p, repeat(-1)), np.int64, len(p)) for p in parts])
    return ids, lengths, parts


def _heads(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


@dataclass
class _Grams:
    """Tokens of some texts end to end: ids and hashes of words and of their histories, and keys of the bigrams."""

    ids: np.ndarray
    codes: np.ndarray
    before: np.ndarray
    history: np.ndarray
    keys: np.ndarray


def _grams(ids: np.ndarray, lengths: np.ndarray, parts: list[list[bytes]], words: Dictionary) -> _Grams:
    """The first word of each text follows the end."""
    rare, codes = ids < 0, np.zeros(len(ids), dtype=np.uint64)
    codes[~rare] = words.hashes[ids[~rare]]
    flat = list(chain.from_iterable(parts))
    codes[rare] = np.fromiter((word_hash(flat[i]) for i in np.flatnonzero(rare)), np.uint64, int(rare.sum()))
    heads = _heads(lengths)
    before, history = np.roll(ids, 1), np.roll(codes, 1)
    before[heads], history[heads] = words.ids.get(END, -1), np.uint64(word_hash(END))
    return _Grams(ids, codes, before, history, gram_keys(history, codes, rare))


def count_grams(train: DataFrame, shared, block_events: int) -> Blocks:
    """Count and quantise bigrams and words outside the dictionary in groups, and deal the groups to blocks.

    Events are at most twice as many as tokens, so half of ``block_events`` tokens fit a block with ``SHARDS`` groups;
    as many of such runs as their events allow go to one block.
    """
    runs_in_all = max(1, -(-2 * shared.value["n_tokens"] // block_events))
    parts = SHARDS * runs_in_all

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Dictionary(**shared.value)
        held, size = [], 0

        def flush() -> pd.DataFrame:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            part = mixed(keys >> np.uint64(32), 101) % np.uint64(parts)
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order])) + 1
            rows = [(int(part[at[0]]), pack_sorted(keys[at]), pack(counts[at])) for at in np.split(order, cuts) if len(at)]
            return pd.DataFrame(rows, columns=["part", "grams", "counts"])

        for batch in _slices(batches):
            grams = _grams(*_batch_ids(batch["text"], words.ids), words)
            held += [grams.keys, word_keys(grams.codes[grams.ids < 0])]
            size += len(held[-1]) + len(held[-2])
            if size >= _FLUSH_GRAMS:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def total(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        grams = np.concatenate([unpack_sorted(b) for b in frame["grams"]])
        counts = np.concatenate([unpack(b) for b in frame["counts"]]).astype(np.int64)
        keys, where = np.unique(grams, return_inverse=True)
        counts = np.bincount(where, counts, minlength=len(keys))
        q = events_of(counts)
        row = (int(key[0]), int(key[0]) % SHARDS, pack_sorted(keys), pack(q), int(q.sum()))
        return pd.DataFrame([row], columns=["part", "shard", "grams", "q", "events"])

    gathered = train.select("text").mapInPandas(gather, "part BIGINT, grams BINARY, counts BINARY")
    counted = gathered.groupBy("part").applyInPandas(total, "part BIGINT, shard BIGINT, grams BINARY, q BINARY, events BIGINT")
    grams = stage(counted, "bigrams")
    events = grams.agg(F.coalesce(F.sum("events"), F.lit(0))).first()[0]
    runs = max(1, runs_in_all * block_events // max(1, events))
    sizes = grams.groupBy("shard", _block(F.col("part"), runs)).agg(F.sum("events").alias("e"))
    most = sizes.agg(F.max("e")).first()[0] or 0
    bits = -(-int(most * PROBES / np.log(2)) // 8) * 8
    return Blocks(grams, parts, runs, -(-runs_in_all // runs), bits)


def _gain(ids, lengths, parts, words: Dictionary, blocks: tuple[int, int, int], bloom: Filter) -> np.ndarray:
    """What one block says of each text's log10 probability beyond its words' own.

    Words of the dictionary have exact counts, others those of the filter, rounded up where a bigram's is
    rounded down, so that no bigram exceeds its words.
    """
    number, n_parts, runs = blocks
    grams = _grams(ids, lengths, parts, words)
    text_of, gain = np.repeat(np.arange(len(parts)), lengths), np.zeros(len(ids))
    rare = np.flatnonzero(grams.before < 0)
    singles = word_keys(grams.history[rare])
    own = block_of(singles, n_parts, runs) == number
    gain[rare[own]] = np.log10(SMOOTHING / (2.0 ** bloom.quantised(singles[own]) - 1 + SMOOTHING))
    if number == 0:
        known = grams.before >= 0
        gain[known] = np.log10(SMOOTHING / (words.counts[grams.before[known]] + SMOOTHING))
    at = np.flatnonzero(block_of(grams.keys, n_parts, runs) == number)
    joint = bloom.counts(grams.keys[at])
    at, joint = at[joint > 0], joint[joint > 0]
    known = grams.before[at] >= 0
    most = np.full(len(at), words.n_tokens / (1 << WORD_BITS))
    most[known] = words.counts[grams.before[at[known]]]
    joint = np.minimum(joint, most)
    count, rare = np.empty(len(at)), grams.ids[at] < 0
    count[~rare] = words.counts[grams.ids[at[~rare]]]
    count[rare] = 2.0 ** bloom.quantised(word_keys(grams.codes[at[rare]])) - 1
    gain[at] += np.log10(1.0 + joint / (SMOOTHING * 10.0 ** words.log_unigram(count)))
    return np.bincount(text_of, gain, minlength=len(parts))


def _score_first(rows: DataFrame, shared, grams: list, bits: int, blocks: tuple[int, int, int], columns: list[str]) -> DataFrame:
    """``columns`` of the rows, what dictionary and first block say of each text, and the other words."""

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, bloom = Dictionary(**shared.value), Filter([run.value for run in grams], bits)
        unigram = words.log_unigram(words.counts)
        for batch in _slices(batches):
            ids, lengths, parts = _batch_ids(batch["text"], words.ids)
            n = len(parts)
            text_of = np.repeat(np.arange(n), lengths)
            known = ids >= 0
            # A word outside the dictionary gets its own part later.
            single = np.where(known, unigram[ids] if len(unigram) else 0.0, 0.0)
            others: list[Counter] = [Counter() for _ in range(n)]
            rare = np.flatnonzero(~known)
            flat = list(chain.from_iterable(parts))
            words_of = np.searchsorted(text_of[rare], np.arange(n + 1)).tolist()
            rare = [flat[i] for i in rare.tolist()]
            for k in range(n):
                if words_of[k] < words_of[k + 1]:
                    others[k] = Counter(rare[words_of[k] : words_of[k + 1]])
            yield pd.DataFrame(
                {
                    **{c: batch[c].array for c in columns},
                    "n_tokens": lengths,
                    "n_known": np.bincount(text_of, known, minlength=n).astype(np.int64),
                    "base_score": np.bincount(text_of, single, minlength=n),
                    "gain": _gain(ids, lengths, parts, words, blocks, bloom),
                    "others": [list(c) for c in others],
                    "other_counts": [list(c.values()) for c in others],
                }
            )

    own = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns)
    schema = (
        f"{own}, n_tokens BIGINT, n_known BIGINT, base_score DOUBLE, gain DOUBLE,"
        " others ARRAY<BINARY>, other_counts ARRAY<BIGINT>"
    )
    return rows.mapInPandas(score, schema)


def _score_next(scored: DataFrame, shared, grams: list, bits: int, blocks: tuple[int, int, int]) -> DataFrame:
    """``scored`` with what a later block says added to ``gain``."""

    def add(texts: pd.Series, gain: pd.Series) -> pd.Series:
        frame = pd.DataFrame({"text": texts, "gain": gain})
        words, bloom = Dictionary(**shared.value), Filter([run.value for run in grams], bits)
        out = []
        for part in _slices(iter([frame])):
            ids, lengths, parts = _batch_ids(part["text"], words.ids)
            out.append(part["gain"].to_numpy() + _gain(ids, lengths, parts, words, blocks, bloom))
        return pd.Series(np.concatenate([*out, np.zeros(0)]))

    return scored.withColumn("gain", F.pandas_udf(add, "double")("text", "gain"))


def scores(
    docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", block_events: int = BLOCK_EVENTS
) -> DataFrame:
    """``(doc_id, n_tokens, n_known, train_tokens, base_score, score)`` for each row of ``docs``.

    ``train`` is a condition over ``docs`` that marks rows to learn from. ``base_score`` is the exact
    add-one unigram score. ``score`` is log10 of ``(c(h w) + s * p(w)) / (c(h) + s)`` summed over the tokens,
    with ``p`` the unigram probability, ``c(h w)`` the filter's quantised count and ``s`` the smoothing; ``c(h)``
    and the count in ``p(w)`` beside ``c(h w)`` are the filter's too for words outside the dictionary. Null and empty texts have their end as only token;
    repeated rows are learnt from and scored each; with nothing to learn from every word is unknown.
    The texts are read once more for each further block of the filter.
    """
    spark = docs.sparkSession
    learn = docs.filter(train).select(F.col(text).alias("text"))
    words = stage(count_words(learn), "words")
    lexicon = dictionary(words)
    shared = spark.sparkContext.broadcast(vars(lexicon))
    blocks = count_grams(learn, shared, block_events)
    # Row numbers are only used within tables written from this one.
    known = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")
    )
    for number in range(blocks.n):
        grams = [spark.sparkContext.broadcast(run) for run in blocks.load(number)]
        which, more = (number, blocks.parts, blocks.runs), number < blocks.n - 1
        if number == 0:
            known = _score_first(known, shared, grams, blocks.bits, which, ["row", "doc_id", *(["text"] if more else [])])
        else:
            known = _score_next(known, shared, grams, blocks.bits, which)
        known = stage(known if more else known.drop("text"), "lm-scores")
        # The scores are in files now; the driver need not keep its copy either.
        for run in grams:
            run.destroy()
    other = known.select("row", F.explode(F.arrays_zip("others", "other_counts")).alias("o")).select(
        "row", F.col("o.others").alias("word"), F.col("o.other_counts").alias("n")
    )
    rare = words.filter(F.col("c") * (1 << WORD_BITS) < lexicon.n_tokens)
    count = F.coalesce("c", F.lit(0))
    scale = float(lexicon.n_tokens + lexicon.n_distinct + 1)
    found = (
        other.join(rare, "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.when(count > 0, F.col("n")).otherwise(0)).alias("more_known"),
            F.sum(F.col("n") * F.log10((count + 1) / F.lit(scale))).alias("more_base"),
        )
    )
    base = F.col("base_score") + F.coalesce("more_base", F.lit(0.0))
    return known.drop("others", "other_counts").join(found, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(lexicon.n_tokens).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        (base + F.col("gain")).alias("score"),
    )
