"""The operators' queries over the given tables, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.llm import (
    bloom_lm,
    compact_windows,
    decontamination,
    divergence,
    minhash,
    mixing,
    quality,
    secret_scan,
    simhash,
    suffix_dedup,
    toxicity,
    warc,
    whitening,
)
from wickline.llm.common import Query, held_out, read_table
from wickline.session import scratch_path

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _query(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _checked(sql: str):
    """Register a query together with its DuckDB equivalent."""

    def register(query: Query) -> Query:
        ORACLE[query.__name__] = sql
        return _query(query)

    return register


@_query
def op1_toxicity(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held = held_out(F.col("doc_id"), 5, 0)
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"), ~held)
    found = toxicity.locate(docs, model)
    return found.select(
        "doc_id",
        held.alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
        F.col("toxicity.offending").alias("n_offending"),
        F.col("toxicity.start").alias("worst_start"),
        F.col("toxicity.end").alias("worst_end"),
    )


@_query
def op2_bloom_lm(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held = held_out(F.col("doc_id"), 7, 2)
    scored = bloom_lm.scores(docs, ~held)
    return scored.select(
        "doc_id", held.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@_query
def op3_decontamination(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    marked, name = decontamination.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    columns = decontamination.digest(F.col(name))
    return marked.select("doc_id", *[c.alias(n) for n, c in columns.items()])


@_query
def op4_secrets(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    marked, name = secret_scan.find_secrets(docs)
    found = F.col(name)
    count = lambda kind: F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("bigint")
    return marked.select(
        "doc_id",
        *[count(i).alias(f"n_{rule.kind}") for i, rule in enumerate(secret_scan.BASE)],
        F.sha2(secret_scan.listed(found, kinds=len(secret_scan.BASE)).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listed(found).alias("spans"),
    )


@_query
def op5_quality(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    judged, name = quality.judge(docs)
    return judged.select(
        "doc_id",
        *[f"{name}.{m}" for m in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        F.col(f"{name}.failed_base").alias("base_failed"),
        F.col(f"{name}.failed").isNull().alias("kept"),
    )


@_query
def op6_simhash(spark, sf_dir) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query
def op7_warc(spark, sf_dir) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(read_table(spark, sf_dir, "pages"), path)
    found = warc.read_archives(spark, path)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query
def op8_mixing(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed, name = mixing.mix(docs)
    return mixed.select("doc_id", *[f"{name}.{c}" for c in ("size", "source_size", "target", "taken")])


@_query
def op9_suffix_dedup(spark, sf_dir) -> DataFrame:
    found = suffix_dedup.remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        (F.size("removed") / 2).cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@_query
def op10_compact_windows(spark, sf_dir) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = compact_windows.near_duplicate_passages(docs)
    lengths = F.transform(F.col("passages"), lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate(lengths, F.lit(0).cast("bigint"), lambda total, x: total + x).alias("n_dup_words"),
        (F.size("passages") / 2).cast("bigint").alias("n_passages"),
        "n_links",
        "class_id",
        "others",
        "passages",
    )


_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_FAR = "(p - q) * (p - q) // (p + q)"


@_checked(
    f"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
tokens AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term FROM tokens GROUP BY ALL HAVING count(DISTINCT row) >= 10),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
counts AS (SELECT lang, source, term, count(*) AS n FROM tokens SEMI JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0)::hugeint AS n
          FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
group_p AS (SELECT lang, source, term, n, 1 + 1000000000 * (n + 2) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p
            FROM cells JOIN sizes USING (lang)),
lang_p AS (SELECT lang, term, 1 + 1000000000 * (n + 2) // (sum(n) OVER (PARTITION BY lang) + 2 * v) AS q
           FROM (SELECT lang, term, sum(n) AS n FROM cells GROUP BY ALL) JOIN sizes USING (lang)),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT lang, x.source, y.source AS other, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
                     FROM group_p x JOIN group_p y USING (lang, term) GROUP BY ALL) f
            ON f.lang = a.lang AND f.source = a.source AND f.other = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, {_FAR} AS value
          FROM group_p JOIN lang_p USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::bigint AS value, rank::int AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
      FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
WHERE part = 'pair' OR rank <= 10"""
)
def op11_divergence(spark, sf_dir) -> DataFrame:
    return divergence.source_divergence(read_table(spark, sf_dir, "documents"))


@_checked(
    f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS row, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), {_AZ}), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents),
sets AS (SELECT row, doc_id, CASE WHEN len(words) = 0 THEN [] ELSE list_distinct(list_transform(
           range(1, greatest(1, len(words) - 3) + 1), lambda i: array_to_string(words[i:i + 3], ' '))) END AS s FROM d),
grams AS (SELECT row, len(s) AS size, unnest(s) AS gram FROM sets),
links AS (SELECT a.row AS u, b.row AS v FROM grams a JOIN grams b USING (gram) GROUP BY a.row, b.row, a.size, b.size
          HAVING 100 * count(*) >= 80 * (a.size + b.size - count(*))),
reach AS (SELECT row AS u, row AS v FROM d UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v),
least AS (SELECT u AS row, min(doc_id) AS component_id FROM reach r JOIN (SELECT row AS v, doc_id FROM d) USING (v) GROUP BY u)
SELECT doc_id, len(s)::bigint AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM sets JOIN least USING (row)"""
)
def op12_minhash(spark, sf_dir) -> DataFrame:
    found = minhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


@_query
def op13_whitening(spark, sf_dir) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def _pipeline(spark, sf_dir) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = _pipeline
