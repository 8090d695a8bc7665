"""Candles derived from the given test tables, in Spark and as DuckDB SQL."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wickline.operators import dedup, ohlcv, to_silver
from wickline.schemas import BRONZE, RAW

_DIMENSION = [("CLICK", "Click"), ("ERROR", "Error"), ("VIEW", "View"), ("PURCHASE", "Purchase")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _candles(rows: DataFrame, **base: str) -> DataFrame:
    """All bronze columns from SQL for the base ones, in one projection."""
    derived = {
        "high": "greatest({open}, {close})",
        "low": "greatest(least({open}, {close}), 0D)",
        "close_time": "{open_time} + 59999999",
        "quote_asset_volume": "{volume} * 4",
        "taker_buy_base": "{volume} / 2",
        "taker_buy_quote": "{volume} * 2",
        "ignore": "0L",
    }
    sql = base | {name: text.format(**base) for name, text in derived.items()}
    return rows.selectExpr(*[f"{sql[name]} AS {name}" for name in BRONZE.names])


def klines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows from ``events``: symbol = event type, minute candles, some repeated keys."""
    return _candles(
        _table(spark, sf_dir, "events"),
        open_time="(unix_micros(cast(ts AS timestamp)) div 60000000 * 60000000)",
        open="value",
        close="(value + (user_id % 7 - 3) * 0.25D)",
        volume="cast(1 + event_id % 50 AS double)",
        num_trades="(1 + event_id % 9)",
        symbol="upper(event_type)",
        ingestion_date="cast(ts AS date)",
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows from ``lineitem``: symbol = supplier, one-second candles, many symbols."""
    return _candles(
        _table(spark, sf_dir, "lineitem"),
        open_time="(unix_micros(cast(l_shipdate AS timestamp))"
        " + (l_orderkey * 8 + l_linenumber) % 86400 * 1000000)",
        open="l_extendedprice",
        close="(l_extendedprice * (1 - l_discount))",
        volume="l_quantity",
        num_trades="cast(l_linenumber AS bigint)",
        symbol="concat('S', l_suppkey)",
        ingestion_date="cast(l_shipdate AS date)",
    )


def dimension(spark: SparkSession) -> DataFrame:
    """Names for all symbols of ``klines`` but SIGNUP."""
    rows = ", ".join(f"({symbol!r}, {name!r})" for symbol, name in _DIMENSION)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS d(symbol, name)")


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_silver(dedup(klines(spark, sf_dir)), dimension(spark))


def gold(spark: SparkSession, sf_dir: str, window_us: int = 300_000_000) -> DataFrame:
    return ohlcv(dedup(klines(spark, sf_dir)), window_us)


def sound_klines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``klines`` without negative prices, so that they pass the quality gate."""
    return klines(spark, sf_dir).withColumn("close", F.abs("close"))


def write_raw_tree(df: DataFrame, root: str, resolution: str = "1m") -> str:
    """Candles as headerless CSV files below ``root/raw``; returns that folder."""
    folder = f"{root}/raw"
    (
        df.withColumn("resolution", F.lit(resolution))
        .select(*RAW.names, "symbol", "resolution")
        .write.partitionBy("symbol", "resolution")
        .mode("append")
        .csv(folder)
    )
    return folder


def zipped(df: DataFrame) -> DataFrame:
    """Candles packed into ZIP archives (``symbol, content``), each from one batch of one task."""
    columns = RAW.names

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            packed = []
            for symbol, rows in batch.groupby("symbol"):
                target = io.BytesIO()
                with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr(f"{symbol}-1m.csv", rows[columns].to_csv(header=False, index=False))
                packed.append((symbol, target.getvalue()))
            yield pd.DataFrame(packed, columns=["symbol", "content"])

    return df.mapInPandas(pack, "symbol STRING, content BINARY")


# The same inputs for DuckDB.
_CANDLES = """
SELECT open_time, open, greatest(open, close) AS high,
       greatest(least(open, close), 0::double) AS low, close, volume,
       open_time + 59999999 AS close_time, volume * 4 AS quote_asset_volume,
       cast(num_trades AS bigint) AS num_trades, volume / 2 AS taker_buy_base,
       volume * 2 AS taker_buy_quote, 0::bigint AS ignore, symbol, ingestion_date
FROM ({rows})"""

KLINES = _CANDLES.format(
    rows="""
  SELECT epoch_us(ts) // 60000000 * 60000000 AS open_time, value AS open,
         value + (user_id % 7 - 3) * 0.25::double AS close,
         cast(1 + event_id % 50 AS double) AS volume, 1 + event_id % 9 AS num_trades,
         upper(event_type) AS symbol, cast(ts AS date) AS ingestion_date
  FROM events"""
)

TRADES = _CANDLES.format(
    rows="""
  SELECT epoch_us(l_shipdate) + (l_orderkey * 8 + l_linenumber) % 86400 * 1000000 AS open_time,
         l_extendedprice AS open, l_extendedprice * (1 - l_discount) AS close,
         l_quantity AS volume, l_linenumber AS num_trades,
         'S' || l_suppkey AS symbol, cast(l_shipdate AS date) AS ingestion_date
  FROM lineitem"""
)


def deduped_sql(rows: str) -> str:
    return f"""
SELECT * EXCLUDE (_rank) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, open_time
    ORDER BY ingestion_date DESC, open DESC, high DESC, low DESC, close DESC, volume DESC,
      close_time DESC, quote_asset_volume DESC, num_trades DESC, taker_buy_base DESC,
      taker_buy_quote DESC, ignore DESC) AS _rank
  FROM ({rows})) WHERE _rank = 1"""


def bars_sql(rows: str, width: str | int) -> str:
    return f"""
SELECT symbol, open_time // {width} * {width} AS timestamp,
       arg_min(open, open_time) AS open, max(high) AS high, min(low) AS low,
       arg_max(close, open_time) AS close, sum(volume) AS volume,
       cast(sum(num_trades) AS bigint) AS num_trades,
       cast(make_timestamp(open_time // {width} * {width}) AS date) AS date
FROM ({rows}) GROUP BY ALL"""


def silver_sql(rows: str) -> str:
    return f"""
SELECT k.*, cast(make_timestamp(open_time) AS date) AS date, d.name AS coin_name
FROM ({deduped_sql(rows)}) k
LEFT JOIN (VALUES {", ".join(map(str, _DIMENSION))}) d(symbol, name) USING (symbol)"""


SILVER = silver_sql(KLINES)
GOLD = bars_sql(deduped_sql(KLINES), 300_000_000)
