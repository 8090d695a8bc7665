"""A corpus cleaning pipeline: each stage applies one operator to all documents the one before kept.

The stages take ``(spark, docs, sf_dir)`` and return a DataFrame; ``run`` writes each result as Parquet
to the shared folder and reads it back as the next stage's documents. All but the last return the
columns of ``documents``; the last adds the copies that the mix takes. Null and empty texts pass the
filters as clean documents; repeated rows are judged each, and an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.llm import decontamination, mixing, secret_scan, simhash, toxicity
from wickline.llm.common import fresh, held_out, read_table, stage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose noisy-or score is below 0.5, by a model of those labelled outside the held-out fold."""
    labels = read_table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, ~held_out(F.col("doc_id"), 5, 0))
    name = fresh(docs, "toxicity")
    return toxicity.locate(docs, model).filter(F.col(f"{name}.score") < 0.5).drop(name)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: that with the smallest id, and of equal ids one row."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    marked, name = decontamination.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return marked.filter(F.col(f"{name}.n_hit") == 0).drop(name)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with ``[SECRET]`` in place of each secret, and ``n_chars`` to match."""
    marked, name = secret_scan.find_secrets(docs)
    clean = marked.withColumn("text", secret_scan.redact(F.col("text"), F.col(name)))
    changed = F.when(F.size(name) > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars"))
    return clean.withColumn("n_chars", changed).drop(name)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes, with ``copies``, ``size``, ``source_size``, ``target`` and ``taken``."""
    mixed, name = mixing.mix(docs)
    new = {c: fresh(docs, c) for c in ("copies", "size", "source_size", "target", "taken")}
    return mixed.filter(F.col(f"{name}.copies") > 0).select(*docs.columns, *[F.col(f"{name}.{c}").alias(n) for c, n in new.items()])


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: SQL has no trained noisy-or model and no XXH64 fingerprints, so stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
