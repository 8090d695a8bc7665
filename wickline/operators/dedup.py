"""Deduplication with a total order, so that the surviving row never depends on row order."""

from __future__ import annotations

from pyspark.sql import DataFrame

from wickline.schemas import SILVER_KEYS


def dedup(
    df: DataFrame, keys: list[str] = SILVER_KEYS, newest_first: tuple[str, ...] = ("ingestion_date",)
) -> DataFrame:
    """One row per key: the newest by ``newest_first``, ties broken by every other column.

    Spark keeps one candidate per key in each map task before the shuffle (``WindowGroupLimit``), so
    a key with very many copies sends only one row per task. Text keys come last in the sort: rows
    are mostly told apart by the leading time, without comparing strings.
    """
    kinds = dict(df.dtypes)
    rest = [c for c in df.columns if c not in keys and c not in newest_first]
    parts = ", ".join(f"`{c}`" for c in sorted(keys, key=lambda c: kinds[c] == "string"))
    order = ", ".join(f"`{c}` DESC NULLS LAST" for c in (*newest_first, *rest))
    ranked = df.selectExpr("*", f"row_number() OVER (PARTITION BY {parts} ORDER BY {order}) AS _rank")
    return ranked.filter("_rank = 1").drop("_rank")
