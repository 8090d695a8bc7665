"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wickline.llm.common import stage


def components(links: DataFrame, label: str) -> DataFrame:
    """``(node, root)`` for each node of the links ``(u, v)``; root is the component's smallest node.

    Alternates large-star and small-star steps until the links are stars around their roots. Each
    round is two shuffled aggregations and joins over the links and is written to the shared folder,
    so that a lost executor costs one round at most.
    """
    edges = links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        small = small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v"))
        )
        edges = stage(small.distinct(), f"{label}-round")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
