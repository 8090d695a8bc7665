"""Source divergence audit over a vocabulary kept as minimal acyclic transducers.

Two passes over the texts. The first counts in how many documents of a language each term occurs; the terms
kept are sorted across the cluster and numbered in that order. Each run of ``SHARD_TERMS`` of them becomes one
minimal transducer from term to ordinal. The second pass streams the texts through the transducers and counts
by ordinal. From there on terms are numbers: shares are compared block by block of the vocabulary, and equal
values rank by ordinal, which is the order of the terms' UTF-8 bytes.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wickline.llm import transducer
from wickline.llm.common import stage

#: Terms of one transducer, built in one task.
SHARD_TERMS = 65536
#: Bytes of transducers broadcast together. A larger vocabulary takes one pass over the texts for each such share.
BROADCAST_BYTES = 64 << 20
#: Terms and sources compared in one task.
BLOCK_TERMS, BLOCK_SOURCES = 1024, 256
#: Distinct terms that a task counts before it hands the counts on.
HELD_TERMS = 500_000
#: Above this count the arithmetic of shares needs more than 64 bits.
_WIDE = 9_000_000_000

# Letters in lower case, bytes of other scripts as they are, a blank for everything else.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and non-ASCII characters, only A-Z lower-cased."""
    return (text or "").encode().translate(_LETTERS).split()


def _document_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, Counter] = defaultdict(Counter)

    def rows() -> pd.DataFrame:
        found = [(lang, term.decode(), n) for lang, counts in held.items() for term, n in counts.items()]
        held.clear()
        return pd.DataFrame(found, columns=["lang", "term", "n"])

    for batch in batches:
        for lang, text in zip(batch["lang"], batch["text"], strict=True):
            held[lang].update(set(terms_of(text)))
            if len(held[lang]) > HELD_TERMS:
                yield rows()
        if sum(map(len, held.values())) > HELD_TERMS:
            yield rows()
    if held:
        yield rows()


def vocabulary(texts: DataFrame, min_docs: int) -> DataFrame:
    """``(lang, term, ordinal)`` of the terms in at least ``min_docs`` documents of their language.

    Ordinals number each language's terms from 0 in UTF-8 order. The sort is a range partitioning; each
    partition numbers its own terms and adds the count of those before it.
    """
    counts = texts.select("lang", "text").mapInPandas(_document_counts, "lang STRING, term STRING, n BIGINT")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_docs)
    ranged = stage(
        kept.repartitionByRange("lang", "term").select("lang", "term", F.spark_partition_id().alias("part")), "kept-terms"
    )
    sizes = ranged.groupBy("lang", "part").agg(F.count("*").alias("n"))
    before = sizes.select(
        "lang", "part", (F.sum("n").over(Window.partitionBy("lang").orderBy("part")) - F.col("n")).alias("before")
    )
    place = F.row_number().over(Window.partitionBy("lang", "part").orderBy("term")) - 1
    numbered = ranged.withColumn("place", place).join(before, ["lang", "part"])
    return stage(numbered.select("lang", "term", (F.col("before") + F.col("place")).alias("ordinal")), "vocabulary")


def transducers(vocab: DataFrame) -> DataFrame:
    """``(lang, shard, first, data)``: a transducer for each run of ``SHARD_TERMS`` terms of a language."""

    def build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        terms = [t.encode() for t in rows.sort_values("ordinal")["term"]]
        data = transducer.dump(transducer.build(terms))
        return pd.DataFrame([(key[0], key[1], terms[0], data)], columns=["lang", "shard", "first", "data"])

    sharded = vocab.withColumn("shard", F.floor(F.col("ordinal") / SHARD_TERMS))
    built = sharded.groupBy("lang", "shard").applyInPandas(build, "lang STRING, shard BIGINT, first BINARY, data BINARY")
    return stage(built, "transducers")


def _shares(shards: DataFrame) -> Iterator[dict[str, list[tuple]]]:
    """The transducers by language, in shares of about ``BROADCAST_BYTES``."""
    listed = shards.select("lang", "shard", F.octet_length("data").alias("size")).orderBy("lang", "shard").collect()
    share, size = [], 0
    for i, row in enumerate(listed):
        share.append(row)
        size += row["size"]
        if size >= BROADCAST_BYTES or i + 1 == len(listed):
            first, last = share[0], share[-1]
            key, low, high = F.struct("lang", "shard"), *(
                F.struct(F.lit(r.lang).alias("lang"), F.lit(r.shard).cast("bigint").alias("shard")) for r in (first, last)
            )
            out: dict[str, list[tuple]] = {}
            for r in shards.filter((key >= low) & (key <= high)).orderBy("lang", "shard").collect():
                out.setdefault(r.lang, []).append((bytes(r["first"]), r.shard * SHARD_TERMS, bytes(r.data)))
            yield out
            share, size = [], 0


def recount(texts: DataFrame, shards: DataFrame) -> DataFrame:
    """``(lang, source, ordinal, n)``: occurrences of each term of the vocabulary, counted by the transducers."""
    counted = []
    for share in _shares(shards):
        sent = texts.sparkSession.sparkContext.broadcast(share)

        def stream(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            table = {
                lang: ([r[0] for r in rows], [r[1] for r in rows], [transducer.load(r[2]) for r in rows])
                for lang, rows in sent.value.items()
            }
            held: dict[tuple[str, str], Counter] = defaultdict(Counter)

            def rows() -> Iterator[pd.DataFrame]:
                for (lang, source), counts in held.items():
                    firsts, bases, machines = table[lang]
                    dealt = defaultdict(list)
                    for term in counts:
                        shard = bisect_right(firsts, term) - 1
                        if shard >= 0:
                            dealt[shard].append(term)
                    for shard, tokens in dealt.items():
                        found = transducer.ordinals(machines[shard], tokens)
                        n = np.fromiter((counts[t] for t in tokens), np.int64, len(tokens))[found >= 0]
                        found = found[found >= 0] + bases[shard]
                        yield pd.DataFrame({"lang": lang, "source": source, "ordinal": found, "n": n})
                held.clear()

            for batch in batches:
                for lang, source, text in zip(batch["lang"], batch["source"], batch["text"], strict=True):
                    if lang in table:
                        counts = held[lang, source]
                        counts.update(terms_of(text))
                        if len(counts) > HELD_TERMS:
                            yield from rows()
                if sum(map(len, held.values())) > HELD_TERMS:
                    yield from rows()
            yield from rows()

        part = texts.mapInPandas(stream, "lang STRING, source STRING, ordinal BIGINT, n BIGINT")
        counted.append(stage(part.groupBy("lang", "source", "ordinal").agg(F.sum("n").alias("n")), "term-counts"))
    if not counted:
        return texts.sparkSession.createDataFrame([], "lang STRING, source STRING, ordinal BIGINT, n BIGINT")
    whole = counted[0]
    for more in counted[1:]:
        whole = whole.unionByName(more)
    return whole


def _comparison(top: int, scale: int, add: int):
    """The task that compares some sources with all sources of a language over one block of its terms."""

    def compare(key: tuple, counts: pd.DataFrame, sources: pd.DataFrame) -> pd.DataFrame:
        lang, block, part = key
        sources = sources.sort_values("idx").reset_index(drop=True)
        size = int(sources["n_terms"].iloc[0])
        width = min(BLOCK_TERMS, size - block * BLOCK_TERMS)
        all_words = int(sources["lang_words"].iloc[0])
        kind = object if all_words > _WIDE else np.int64
        n = np.zeros((len(sources), width), dtype=np.int64)
        n[counts["at"].to_numpy(np.int64), counts["ordinal"].to_numpy(np.int64) - block * BLOCK_TERMS] = counts["n"]

        def share(count: np.ndarray, words: np.ndarray) -> np.ndarray:
            exact = (scale * (count.astype(kind) + add)) // (words.astype(kind) + add * size)
            return (1 + exact).astype(np.int64)

        p = share(n, sources["words"].to_numpy(np.int64)[:, None])
        q = share(n.sum(0), np.array([all_words]))
        names = sources["source"].to_numpy()
        frames = []
        for a in np.flatnonzero(sources["idx"].to_numpy() // BLOCK_SOURCES == part):
            apart = p - p[a]
            value = (apart * apart // (p + p[a])).sum(1)
            other = np.arange(len(names)) != a
            frames.append(pd.DataFrame({"source": names[a], "other": names[other], "ordinal": -1, "value": value[other]}))
            above = np.flatnonzero((n[a] > 0) & (p[a] > q))
            value = (p[a] - q)[above] ** 2 // (p[a] + q)[above]
            best = np.lexsort((above, -value))[:top]
            frames.append(
                pd.DataFrame({"source": names[a], "other": None, "ordinal": above[best] + block * BLOCK_TERMS, "value": value[best]})
            )
        return pd.concat(frames, ignore_index=True).assign(lang=lang)[["lang", "source", "other", "ordinal", "value"]]

    return compare


def source_divergence(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_docs: int = 10,
    top: int = 10,
    scale: int = 1_000_000_000,
    add: int = 2,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how each source's words differ from others' of its language.

    A term kept in a language has the share ``1 + floor(scale * (count + add) / (N + add * V))`` in a group; two
    shares p and q differ by ``floor((p - q)^2 / (p + q))``. ``pair`` rows hold that, summed over the vocabulary,
    for each other source; ``term`` rows the ``top`` terms more frequent in the source than in its language.
    Values rank downwards, equal ones by the bytes of the item.

    Null text, lang and source count as empty. A group without terms has its rows of ``pair``; a language
    without kept terms has value 0 there. Repeated rows count each. Other columns are not read. No row gives
    no row.
    """
    texts = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((text, "text"), (lang, "lang"), (source, "source"))])
    vocab = vocabulary(texts, min_docs)
    counts = recount(texts, transducers(vocab))
    words = counts.groupBy("lang", "source").agg(F.sum("n").alias("words"))
    sizes = vocab.groupBy("lang").agg(F.count("*").alias("n_terms"))
    by_lang = Window.partitionBy("lang")
    groups = texts.groupBy("lang", "source").agg(F.count("*").alias("docs"))
    sources = stage(
        groups.join(words, ["lang", "source"], "left")
        .join(sizes, "lang", "left")
        .select(
            "lang",
            "source",
            F.coalesce("words", F.lit(0)).cast("bigint").alias("words"),
            F.coalesce("n_terms", F.lit(0)).cast("bigint").alias("n_terms"),
        )
        .withColumn("idx", (F.row_number().over(by_lang.orderBy("source")) - 1).cast("bigint"))
        .withColumn("lang_words", F.sum("words").over(by_lang))
        .withColumn("slices", F.floor((F.count("*").over(by_lang) - 1) / BLOCK_SOURCES)),
        "sources",
    )
    zero = F.lit(0).cast("bigint")
    slices = F.explode(F.sequence(zero, "slices")).alias("slice")
    blocks = F.explode(F.sequence(zero, F.floor((F.col("n_terms") - 1) / BLOCK_TERMS))).alias("block")
    left = counts.join(sources.select("lang", "source", "idx", "slices"), ["lang", "source"]).select(
        "lang", F.floor(F.col("ordinal") / BLOCK_TERMS).alias("block"), slices, F.col("idx").alias("at"), "ordinal", "n"
    )
    facts = ["source", "idx", "words", "n_terms", "lang_words"]
    right = sources.filter("n_terms > 0").select("*", slices).select("lang", blocks, "slice", *facts)
    keys = ["lang", "block", "slice"]
    compared = stage(
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInPandas(_comparison(top, scale, add), "lang STRING, source STRING, other STRING, ordinal BIGINT, value BIGINT"),
        "divergences",
    )
    pairs = compared.filter("other IS NOT NULL").select("lang", "source", F.col("other").alias("item"), "value")
    silent = sources.filter("n_terms = 0").select("lang", "source")
    nothing = silent.join(silent.withColumnRenamed("source", "item"), "lang").filter("source <> item")
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.unionByName(nothing.withColumn("value", zero))
    of_group = Window.partitionBy("lang", "source")
    ranked = pairs.withColumn("rank", F.row_number().over(of_group.orderBy(F.desc("value"), "item")))
    terms = compared.filter("other IS NULL")
    terms = terms.withColumn("rank", F.row_number().over(of_group.orderBy(F.desc("value"), "ordinal"))).filter(F.col("rank") <= top)
    named = terms.join(vocab.withColumnRenamed("term", "item"), ["lang", "ordinal"])
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return ranked.withColumn("part", F.lit("pair")).select(*columns).unionByName(
        named.withColumn("part", F.lit("term")).select(*columns)
    )
