"""The checked queries: each operator on whole test tables, with the DuckDB SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import inputs as I
from wickline import functions as fn
from wickline import operators as op
from wickline import plans, sources
from wickline.plans.jobs import rebuilt_bars, to_bronze
from wickline.schemas import (
    BRONZE,
    BRONZE_PARTITIONS,
    GOLD,
    GOLD_KEYS,
    RAW,
    SILVER,
    SILVER_KEYS,
)
from wickline.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

HOUR = fn.HOUR_US
DAY = fn.DAY_US
AS_OF = datetime(2024, 2, 1)
AS_OF_US = fn.as_micros(AS_OF)
_BAR = "symbol, timestamp, open, high, low, close, volume, num_trades, cast(date AS varchar) AS date"
_FINE = "symbol, timestamp, open, high, low, close, volume"


def checked(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name together with its DuckDB equivalent."""

    def register(query: Query) -> Query:
        QUERIES[query.__name__] = query
        ORACLE[query.__name__] = sql
        return query

    return register


def _plain(df: DataFrame) -> DataFrame:
    """Dates as text, so that both engines return the same type."""
    dates = [c for c, t in df.dtypes if t == "date"]
    return df.withColumns({c: F.col(c).cast("string") for c in dates})


def _all_bars(width: int) -> str:
    return f"SELECT {_BAR} FROM ({I.bars_sql(I.deduped_sql(I.KLINES), width)})"


# Deduplication and enrichment


@checked(
    "SELECT * REPLACE (cast(ingestion_date AS varchar) AS ingestion_date) "
    f"FROM ({I.deduped_sql(I.KLINES)})"
)
def dedup_klines(spark, sf):
    return _plain(op.dedup(I.klines(spark, sf)))


@checked(
    "SELECT * REPLACE (cast(ingestion_date AS varchar) AS ingestion_date) "
    f"FROM ({I.deduped_sql(I.TRADES)})"
)
def dedup_trades(spark, sf):
    return _plain(op.dedup(I.trades(spark, sf)))


@checked(
    "SELECT * REPLACE (cast(ingestion_date AS varchar) AS ingestion_date, "
    f"cast(date AS varchar) AS date) FROM ({I.SILVER})"
)
def silver_enriched(spark, sf):
    return _plain(I.silver(spark, sf).drop("ingestion_ts"))


@checked(f"SELECT DISTINCT symbol FROM ({I.KLINES}) ORDER BY symbol")
def symbol_list(spark, sf):
    return sources.symbols(I.klines(spark, sf))


# Bars


@checked(_all_bars(300_000_000))
def bars_5m(spark, sf):
    return _plain(I.gold(spark, sf))


@checked(_all_bars(HOUR))
def bars_1h(spark, sf):
    return _plain(I.gold(spark, sf, HOUR))


@checked(f"SELECT {_BAR} FROM ({I.bars_sql(I.deduped_sql(I.TRADES), DAY)})")
def trade_bars_1d(spark, sf):
    return _plain(op.ohlcv(op.dedup(I.trades(spark, sf)), DAY))


_GAPS = """
SELECT * FROM (
  SELECT symbol, open_time,
         open_time - lag(open_time) OVER (PARTITION BY symbol ORDER BY open_time) AS interval_us
  FROM ({rows})) WHERE interval_us > 0"""
_INTERVAL = """
SELECT greatest(1, cast(round_even(quantile_disc(interval_us, 0.5) / 1000000, 0) AS bigint))
  AS interval_seconds FROM ({gaps})"""
_KLINE_GAPS = _GAPS.format(rows=I.deduped_sql(I.KLINES))
_TRADE_GAPS = _GAPS.format(rows=I.deduped_sql(I.TRADES))


@checked(_KLINE_GAPS)
def interval_gaps(spark, sf):
    return op.interval_gaps(op.dedup(I.klines(spark, sf)))


@checked(_TRADE_GAPS)
def trade_interval_gaps(spark, sf):
    return op.interval_gaps(op.dedup(I.trades(spark, sf)))


@checked(_INTERVAL.format(gaps=_KLINE_GAPS))
def inferred_interval(spark, sf):
    return op.source_interval(op.dedup(I.klines(spark, sf)))


@checked(_INTERVAL.format(gaps=_TRADE_GAPS))
def trade_inferred_interval(spark, sf):
    return op.source_interval(op.dedup(I.trades(spark, sf)))


@checked(
    f"WITH w AS ({_INTERVAL.format(gaps=_KLINE_GAPS)}), "
    f"k AS ({I.deduped_sql(I.KLINES)}) "
    f"SELECT {_BAR} FROM ("
    + I.bars_sql("SELECT k.*, interval_seconds * 1000000 AS w FROM k, w", "w")
    + ")"
)
def bars_inferred(spark, sf):
    rows = op.dedup(I.klines(spark, sf))
    seconds = F.coalesce(op.source_interval(rows).scalar(), F.lit(300))
    return _plain(op.ohlcv(rows, seconds * fn.SECOND_US))


def _resampled(label: str, bars: str = I.GOLD) -> str:
    return f"""
SELECT symbol, {label} AS timestamp, arg_min(open, timestamp) AS open, max(high) AS high,
       min(low) AS low, arg_max(close, timestamp) AS close, sum(volume) AS volume
FROM ({bars}) GROUP BY ALL"""


_WEEK = "epoch_us(date_trunc('week', make_timestamp(timestamp)) + INTERVAL 6 DAYS)"


@checked(_resampled(f"timestamp // {HOUR} * {HOUR}"))
def resample_1h(spark, sf):
    return op.resample(I.gold(spark, sf), "1H")


@checked(_resampled(f"timestamp // {4 * HOUR} * {4 * HOUR}"))
def resample_4h(spark, sf):
    return op.resample(I.gold(spark, sf), "4H")


@checked(_resampled(f"timestamp // {DAY} * {DAY}"))
def resample_1d(spark, sf):
    return op.resample(I.gold(spark, sf), "1D")


@checked(_resampled(_WEEK))
def resample_1w(spark, sf):
    return op.resample(I.gold(spark, sf), "1W")


@checked(f"SELECT {_FINE} FROM ({I.GOLD})")
def resample_1m(spark, sf):
    return op.resample(I.gold(spark, sf), "1m")


@checked(_resampled(_WEEK, I.bars_sql(I.deduped_sql(I.TRADES), DAY)))
def trade_resample_1w(spark, sf):
    return op.resample(op.ohlcv(op.dedup(I.trades(spark, sf)), DAY), "1W")


# Market reports


_LAST_24H = f"SELECT * FROM ({I.GOLD}) WHERE timestamp >= (SELECT max(timestamp) - {DAY} FROM ({I.GOLD}))"
_CHANGE = """
SELECT symbol, CASE WHEN arg_min(close, timestamp) <> 0 THEN
  (arg_max(close, timestamp) - arg_min(close, timestamp)) / arg_min(close, timestamp) * 100 END
  AS pct_change FROM ({bars}) GROUP BY symbol"""
_CHANGE_24H = _CHANGE.format(bars=_LAST_24H)
_TRADE_GOLD = I.bars_sql(I.deduped_sql(I.TRADES), DAY)


_stored: dict[tuple[str, str], str] = {}


def _stored_gold(spark: SparkSession, sf: str) -> tuple[DataFrame, date | None]:
    """Gold as a table, which prunes by its folders, and its newest date. Written once in a session."""
    key = spark.sparkContext.applicationId, sf
    if key not in _stored:
        path = scratch_path(spark, "market")
        op.replace_partitions(I.gold(spark, sf), path, GOLD)
        _stored[key] = path
    return sources.read_table(spark, _stored[key], GOLD), sources.newest_date(spark, _stored[key])


@checked(f"SELECT {_BAR} FROM ({_LAST_24H})")
def last_24h(spark, sf):
    return _plain(op.last_24h(*_stored_gold(spark, sf)))


@checked(_CHANGE_24H)
def pct_change_24h(spark, sf):
    return op.pct_change_24h(*_stored_gold(spark, sf))


@checked(
    _CHANGE.format(
        bars=f"SELECT * FROM ({_TRADE_GOLD}) WHERE timestamp >= "
        f"(SELECT max(timestamp) - {DAY} FROM ({_TRADE_GOLD}))"
    )
)
def trade_pct_change_24h(spark, sf):
    return op.pct_change_24h(op.ohlcv(op.dedup(I.trades(spark, sf)), DAY))


@checked(
    f"SELECT * FROM ({_CHANGE_24H}) WHERE pct_change IS NOT NULL "
    "ORDER BY pct_change DESC, symbol LIMIT 2"
)
def top_gainers(spark, sf):
    bars, newest = _stored_gold(spark, sf)
    return op.top_movers(bars, 2, newest=newest)


@checked(
    f"SELECT * FROM ({_CHANGE_24H}) WHERE pct_change IS NOT NULL "
    "ORDER BY pct_change, symbol LIMIT 2"
)
def top_losers(spark, sf):
    bars, newest = _stored_gold(spark, sf)
    return op.top_movers(bars, 2, losers=True, newest=newest)


@checked(f"SELECT coalesce(sum(volume), 0) AS volume_24h FROM ({_LAST_24H})")
def volume_24h(spark, sf):
    return op.volume_24h(*_stored_gold(spark, sf))


_FRESHNESS = f"greatest(0, ({AS_OF_US} - max(timestamp)) / 60000000)"


@checked(f"SELECT {_FRESHNESS} AS freshness_minutes FROM ({I.GOLD})")
def freshness(spark, sf):
    bars, newest = _stored_gold(spark, sf)
    return op.freshness(bars, AS_OF, newest)


@checked(
    f"""
WITH c AS (SELECT * FROM ({_CHANGE_24H}) WHERE pct_change IS NOT NULL),
     g AS (SELECT * FROM c ORDER BY pct_change DESC, symbol LIMIT 1),
     l AS (SELECT * FROM c ORDER BY pct_change, symbol LIMIT 1)
SELECT g.symbol AS top_gainer, g.pct_change AS top_gainer_pct,
       l.symbol AS top_loser, l.pct_change AS top_loser_pct,
       (SELECT coalesce(sum(volume), 0) FROM ({_LAST_24H})) AS volume_24h,
       (SELECT {_FRESHNESS} FROM ({I.GOLD})) AS freshness_minutes
FROM g, l"""
)
def market_overview(spark, sf):
    bars, newest = _stored_gold(spark, sf)
    return op.market_overview(bars, AS_OF, newest)


# Selections


_SUMMARY = """
SELECT symbol, first_close, last_close, total_volume, last_close - first_close AS change,
       CASE WHEN first_close = 0 THEN 0 ELSE (last_close - first_close) / first_close * 100 END
         AS pct_change
FROM (SELECT symbol, arg_min(close, timestamp) AS first_close, arg_max(close, timestamp) AS last_close,
             sum(volume) AS total_volume FROM ({bars}) GROUP BY symbol)"""


@checked(_SUMMARY.format(bars=f"SELECT * FROM ({I.GOLD}) WHERE close BETWEEN 5 AND 300 AND volume >= 20"))
def range_summary(spark, sf):
    bars = op.close_between(I.gold(spark, sf), 5.0, 300.0)
    return op.range_summary(op.volume_at_least(bars, 20.0))


@checked(_SUMMARY.format(bars=_TRADE_GOLD))
def trade_range_summary(spark, sf):
    return op.range_summary(op.ohlcv(op.dedup(I.trades(spark, sf)), DAY))


@checked(
    f"SELECT {_BAR}, make_timestamp(timestamp)::varchar AS time FROM ({I.GOLD}) "
    "WHERE symbol = 'CLICK' AND date BETWEEN '2024-01-03' AND '2024-01-20' ORDER BY timestamp"
)
def selected_bars(spark, sf):
    bars = op.load_bars(I.gold(spark, sf), "CLICK", "2024-01-03", "2024-01-20")
    return op.in_time_order(_plain(bars.withColumn("time", fn.readable_time("timestamp"))))


@checked(f"SELECT {_BAR} FROM ({I.GOLD}) WHERE date BETWEEN '2024-01-18' AND '2024-01-24'")
def last_7_days(spark, sf):
    first, last = fn.date_range("last 7 days", "2024-01-25")
    return _plain(I.gold(spark, sf).filter(F.col("date").between(F.lit(first), F.lit(last))))


@checked(f"SELECT min(close) AS min_close, max(close) AS max_close FROM ({I.GOLD})")
def close_bounds(spark, sf):
    return op.close_bounds(I.gold(spark, sf))


@checked(
    "SELECT min(volume) AS min_volume, max(volume) AS max_volume "
    f"FROM ({I.GOLD}) WHERE close BETWEEN 5 AND 300"
)
def volume_bounds(spark, sf):
    return op.volume_bounds(op.close_between(I.gold(spark, sf), 5.0, 300.0))


@checked(f"SELECT {_BAR} FROM ({I.GOLD}) ORDER BY timestamp DESC, symbol LIMIT {op.TABLE_ROWS}")
def latest_bars(spark, sf):
    return op.latest(_plain(I.gold(spark, sf)), op.TABLE_ROWS)


@checked(
    f"SELECT * FROM ({_resampled(f'timestamp // {HOUR} * {HOUR}')}) "
    f"ORDER BY timestamp DESC, symbol LIMIT {op.CHART_ROWS}"
)
def latest_chart(spark, sf):
    hourly = op.resample(I.gold(spark, sf), "1H")
    return op.latest(hourly, op.CHART_ROWS, newest_first=False)


# Quality


def _quality(rows: str) -> str:
    prices = ", ".join(
        f"count(*) FILTER ({c} < 0 OR {c} > 1e12) AS invalid_{c}"
        for c in ("open", "high", "low", "close")
    )
    return f"""
SELECT count(*) FILTER (open_time IS NULL) AS null_open_time,
       count(*) FILTER (symbol IS NULL OR symbol = '') AS null_symbol, {prices},
       count(*) FILTER (volume < 0 OR isnan(volume)) AS invalid_volume FROM ({rows})"""


@checked(_quality(I.SILVER))
def quality_counts(spark, sf):
    return op.quality_counts(I.silver(spark, sf))


@checked(_quality(I.TRADES))
def trade_quality_counts(spark, sf):
    return op.quality_counts(I.trades(spark, sf))


_SUITE = " UNION ALL ".join(
    [
        f"SELECT 'expect_column_values_to_not_be_null' AS expectation, '{c}' AS \"column\", "
        f"count(*) FILTER ({c} IS NULL) AS failed FROM s"
        for c in ("open_time", "symbol")
    ]
    + [
        f"SELECT 'expect_column_values_to_be_between', '{c}', "
        f"count(*) FILTER ({c} < 0 OR {c} > {top}) FROM s"
        for c, top in [(p, "1e12") for p in ("open", "high", "low", "close")] + [("volume", "1e20")]
    ]
)


@checked(f"WITH s AS ({I.SILVER}) SELECT *, failed = 0 AS success FROM ({_SUITE})")
def suite_report(spark, sf):
    return op.run_suite(I.silver(spark, sf))


# Labels


_SCALE = "CASE num_trades % 5 WHEN 0 THEN 1 WHEN 1 THEN 1e3 WHEN 2 THEN 1e6 WHEN 3 THEN 1e9 ELSE 1e12 END"
_VOLUME_LABEL = """
CASE WHEN v >= 1e12 THEN format('{:.2f}T', v / 1e12) WHEN v >= 1e9 THEN format('{:.2f}B', v / 1e9)
     WHEN v >= 1e6 THEN format('{:.2f}M', v / 1e6) WHEN v >= 1e3 THEN format('{:.2f}K', v / 1e3)
     ELSE format('{:,.0f}', v) END"""
_PRICE_LABEL = """
'$' || CASE WHEN {0} >= 1000 THEN format('{{:,.2f}}', {0}) WHEN {0} >= 1 THEN format('{{:.2f}}', {0})
            ELSE format('{{:.4f}}', {0}) END"""


@checked(
    f"""
SELECT symbol, timestamp, volume_label, '$' || volume_label AS currency_label, price_label,
       CASE WHEN d >= 0 THEN '+' ELSE '' END || {_PRICE_LABEL.format("d")} AS change_label,
       CASE WHEN d >= 0 THEN '+' ELSE '' END || format('{{:.2f}}%', d) AS percent_label
FROM (SELECT symbol, timestamp, {_VOLUME_LABEL} AS volume_label,
             {_PRICE_LABEL.format("p")} AS price_label, d
      FROM (SELECT symbol, timestamp, close * volume * {_SCALE} AS v, close * num_trades AS p,
                   close - open AS d FROM ({I.GOLD})))"""
)
def display_labels(spark, sf):
    v = F.expr(f"close * volume * {_SCALE}")
    change = F.col("close") - F.col("open")
    return I.gold(spark, sf).select(
        "symbol",
        "timestamp",
        fn.volume_label(v).alias("volume_label"),
        fn.currency_label(v).alias("currency_label"),
        fn.price_label(F.col("close") * F.col("num_trades")).alias("price_label"),
        fn.signed_price_label(change).alias("change_label"),
        fn.signed_percent_label(change).alias("percent_label"),
    )


@checked(
    f"""
WITH g AS ({I.GOLD})
SELECT symbol, timestamp,
       CASE WHEN m < 1 THEN 'Just now'
            WHEN m < 60 THEN cast(round_even(m, 0) AS bigint) || ' minutes ago'
            WHEN m / 60 < 24 THEN format('{{:.1f}} hours ago', m / 60)
            ELSE format('{{:.1f}} days ago', m / 60 / 24) END AS age_label,
       strftime(make_timestamp(timestamp), '%Y-%m-%d %H:%M:%S') AS readable_time
FROM (SELECT symbol, timestamp, ((SELECT max(timestamp) FROM g) - timestamp) / 60000000 AS m FROM g)"""
)
def age_labels(spark, sf):
    bars = I.gold(spark, sf)
    newest = bars.agg(F.max("timestamp")).scalar()
    minutes = (newest - F.col("timestamp")) / fn.MINUTE_US
    return bars.select(
        "symbol",
        "timestamp",
        fn.age_label(minutes).alias("age_label"),
        fn.readable_time("timestamp").alias("readable_time"),
    )


@checked(
    f"""
SELECT symbol, open_time,
       CASE WHEN s < 60 THEN s || 's' WHEN s < 3600 THEN s // 60 || 'm'
            WHEN s < 86400 THEN s // 3600 || 'h' ELSE s // 86400 || 'd' END AS window_label
FROM (SELECT symbol, open_time, interval_us // 1000000 AS s FROM ({_TRADE_GAPS}))"""
)
def window_labels(spark, sf):
    gaps = op.interval_gaps(op.dedup(I.trades(spark, sf)))
    seconds = F.expr("interval_us div 1000000")
    return gaps.select("symbol", "open_time", fn.window_label(seconds).alias("window_label"))


# Ad-hoc SQL: the published example questions. Aggregates answer for every symbol and day at once.


def _ask(spark: SparkSession, sf: str, sql: str, **more) -> DataFrame:
    from_silver = "silver_klines" in sql
    sources.register_views(
        spark,
        silver=I.silver(spark, sf) if from_silver else None,
        gold=None if from_silver else I.gold(spark, sf),
    )
    return plans.ask_sql(spark, sql, **more)


def _views(sql: str) -> str:
    return f"WITH silver_klines AS ({I.SILVER}), gold_ohlcv AS ({I.GOLD}) {sql}"


_HIGH_LOW = """
SELECT symbol, cast(date AS {text}) AS date, max(high) AS highest, min(low) AS lowest
FROM gold_ohlcv GROUP BY symbol, date"""


@checked(_views(_HIGH_LOW.format(text="varchar")))
def sql_day_high_low(spark, sf):
    return _ask(spark, sf, _HIGH_LOW.format(text="string"), cap=None)


_DAY_VOLUME = """
SELECT symbol, cast(date AS {text}) AS date, sum(volume) AS total_volume
FROM gold_ohlcv GROUP BY symbol, date"""


@checked(_views(_DAY_VOLUME.format(text="varchar")))
def sql_day_volume(spark, sf):
    return _ask(spark, sf, _DAY_VOLUME.format(text="string"), cap=None)


_RECENT = """
SELECT timestamp, open, high, low, close FROM gold_ohlcv
WHERE symbol = 'PURCHASE' AND date = DATE '2024-01-18' ORDER BY timestamp DESC LIMIT 10"""


@checked(_views(_RECENT))
def sql_recent(spark, sf):
    bound = _RECENT.replace("'PURCHASE'", ":symbol").replace("DATE '2024-01-18'", "cast(:day AS date)")
    return _ask(spark, sf, bound, args={"symbol": "PURCHASE", "day": "2024-01-18"})


_BEST_HOUR = """
SELECT symbol, cast(date AS {text}) AS date, hour, avg_close FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY avg_close DESC, hour) AS place
  FROM (SELECT symbol, date, cast(hour({time}) AS int) AS hour, round(avg(close), 6) AS avg_close
        FROM gold_ohlcv GROUP BY 1, 2, 3)) WHERE place = 1"""


@checked(_views(_BEST_HOUR.format(text="varchar", time="make_timestamp(timestamp)")))
def sql_best_hour(spark, sf):
    sql = _BEST_HOUR.format(text="string", time="timestamp_micros(timestamp)")
    return _ask(spark, sf, sql, cap=None)


_QUOTE = """
SELECT symbol, cast(date AS {text}) AS date, sum(quote_asset_volume) AS total_quote_volume
FROM silver_klines GROUP BY symbol, date"""


@checked(_views(_QUOTE.format(text="varchar")))
def sql_quote_volume(spark, sf):
    return _ask(spark, sf, _QUOTE.format(text="string"), cap=None)


_TAKER = """
SELECT open_time, taker_buy_base, taker_buy_quote FROM silver_klines
WHERE symbol = 'ERROR' AND date = DATE '2024-01-20' ORDER BY open_time"""


@checked(_views(_TAKER))
def sql_taker(spark, sf):
    return _ask(spark, sf, _TAKER)


@checked(_views(f"{_TAKER} LIMIT 40"))
def sql_capped(spark, sf):
    """The feature is the cap; the order is on a key, so the rows are the same in both engines."""
    return _ask(spark, sf, _TAKER, cap=40)


_NAMES = """
WITH named AS (SELECT DISTINCT symbol, coin_name, cast(date AS {text}) AS date FROM silver_klines)
SELECT * FROM named"""


@checked(
    f"WITH silver_klines AS ({I.SILVER}) "
    "SELECT DISTINCT symbol, coin_name, cast(date AS varchar) AS date FROM silver_klines"
)
def sql_coin_names(spark, sf):
    return _ask(spark, sf, _NAMES.format(text="string"), cap=None)


# Tables, files and jobs: each writes to the shared scratch folder and reads back.


@checked(
    "SELECT * REPLACE (cast(ingestion_date AS varchar) AS ingestion_date) "
    f"FROM ({I.KLINES} UNION ALL {I.KLINES})"
)
def bronze_append(spark, sf):
    path = scratch_path(spark, "bronze")
    for _ in range(2):
        op.append(I.klines(spark, sf), path, BRONZE_PARTITIONS)
    return _plain(sources.read_table(spark, path, BRONZE))


@checked(
    f"""
SELECT * REPLACE (cast(ingestion_date AS varchar) AS ingestion_date, cast(date AS varchar) AS date)
FROM (SELECT * REPLACE (CASE WHEN date >= '2024-01-15' THEN volume + 1 ELSE volume END AS volume)
      FROM ({I.SILVER}))"""
)
def silver_upsert(spark, sf):
    path = scratch_path(spark, "silver")
    rows = I.silver(spark, sf)
    first = rows.filter("date < '2024-01-20'")
    second = rows.filter("date >= '2024-01-15'").withColumn("volume", F.col("volume") + 1)
    for batch in (first, second):
        op.upsert(spark, batch, path, SILVER_KEYS, SILVER)
    return _plain(sources.read_table(spark, path, SILVER).drop("ingestion_ts"))


_HOURLY = I.bars_sql(I.deduped_sql(I.KLINES), HOUR)


@checked(
    f"""
WITH first AS (SELECT * FROM ({_HOURLY}) WHERE date < '2024-01-20'),
     second AS (SELECT * REPLACE (volume + 1 AS volume) FROM ({_HOURLY})
                WHERE timestamp >= epoch_us(TIMESTAMP '2024-01-15 07:00:00'))
SELECT {_BAR} FROM (SELECT * FROM second UNION ALL
                    SELECT * FROM first ANTI JOIN second USING (symbol, timestamp))"""
)
def gold_upsert(spark, sf):
    path = scratch_path(spark, "gold")
    bars = I.gold(spark, sf, HOUR)
    since = fn.as_micros(datetime(2024, 1, 15, 7))
    first = bars.filter("date < '2024-01-20'")
    second = bars.filter(F.col("timestamp") >= since).withColumn("volume", F.col("volume") + 1)
    for batch in (first, second):
        op.upsert(spark, batch, path, GOLD_KEYS, GOLD, order=["timestamp"])
    return _plain(sources.read_table(spark, path, GOLD))


@checked(_all_bars(300_000_000))
def cluster_rewrite(spark, sf):
    path = scratch_path(spark, "cluster")
    bars = I.gold(spark, sf)
    op.upsert(spark, bars, path, GOLD_KEYS, GOLD, unique=True)
    op.cluster(spark, path, GOLD)
    return _plain(sources.read_table(spark, path, GOLD))


_SEVEN_HOURS = 7 * HOUR


@checked(
    f"""
WITH s AS ({I.SILVER}), g AS ({I.bars_sql("SELECT * FROM s", _SEVEN_HOURS)}),
b AS (SELECT DISTINCT symbol,
        cast(make_timestamp(open_time // {_SEVEN_HOURS} * {_SEVEN_HOURS}) AS date) AS date
      FROM s WHERE ingestion_date >= '2024-01-15')
SELECT {_BAR} FROM g SEMI JOIN b ON g.symbol = b.symbol AND g.date = b.date"""
)
def bars_recomputed(spark, sf):
    rows = I.silver(spark, sf)
    batch = rows.filter("ingestion_date >= '2024-01-15'")
    return _plain(rebuilt_bars(rows, batch, _SEVEN_HOURS))


@checked(
    "SELECT symbol, strftime(make_timestamp(timestamp), '%Y-%m-%d %H:%M:%S') AS timestamp, "
    "cast(date AS varchar) AS date, open, high, low, close, volume "
    f"FROM ({_HOURLY})"
)
def csv_export(spark, sf):
    path = scratch_path(spark, "export")
    op.export_csv(I.gold(spark, sf, HOUR), path)
    columns = "symbol STRING, timestamp STRING, date STRING, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE"
    return spark.read.schema(columns).csv(path, header=True)


_RAW_ROWS = f"SELECT * EXCLUDE (ingestion_date), '2024-02-01' AS ingestion_date FROM ({I.KLINES})"


@checked(_RAW_ROWS)
def csv_scan(spark, sf):
    raw = I.write_raw_tree(I.klines(spark, sf), scratch_path(spark, "csv"))
    return _plain(to_bronze(sources.read_klines(spark, raw), "2024-02-01"))


@checked(f"SELECT * REPLACE (volume + 1 AS volume) FROM ({_RAW_ROWS})")
def csv_scope(spark, sf):
    home = scratch_path(spark, "scope")
    rows = I.klines(spark, sf)
    I.write_raw_tree(rows, home, "1m")
    raw = I.write_raw_tree(rows.withColumn("volume", F.col("volume") + 1), home, "5m")
    return _plain(to_bronze(sources.read_klines(spark, raw, resolution="5m"), "2024-02-01"))


@checked(_RAW_ROWS)
def archive_scan(spark, sf):
    rows = sources.unpack_archives(I.zipped(I.klines(spark, sf)))
    return _plain(to_bronze(rows, "2024-02-01"))


_SOUND = f"SELECT * REPLACE (abs(close) AS close) FROM ({I.KLINES})"
_SOUND_GAPS = _GAPS.format(rows=I.deduped_sql(_SOUND))


@checked(
    f"WITH w AS ({_INTERVAL.format(gaps=_SOUND_GAPS)}), "
    f"k AS ({I.deduped_sql(_SOUND)}) "
    f"SELECT {_BAR} FROM ("
    + I.bars_sql("SELECT k.*, interval_seconds * 1000000 AS w FROM k, w", "w")
    + ")"
)
def medallion_run(spark, sf):
    home = scratch_path(spark, "medallion")
    raw = I.write_raw_tree(I.sound_klines(spark, sf), home)
    metadata = f"{home}/metadata"
    I.dimension(spark).write.option("header", True).csv(metadata)
    bronze, silver, gold = (f"{home}/{layer}" for layer in ("bronze", "silver", "gold"))
    plans.run_pipeline(spark, raw, bronze, silver, gold, metadata, "2024-02-01")
    return _plain(sources.read_table(spark, gold, GOLD))


_CORRECTED = (
    f"SELECT * REPLACE (close + 1 AS close, DATE '2024-02-02' AS ingestion_date) FROM ({_SOUND}) "
    "WHERE open_time % 3600000000 = 0"
)
_BOTH = f"SELECT * REPLACE (DATE '2024-02-01' AS ingestion_date) FROM ({_SOUND}) UNION ALL {_CORRECTED}"


@checked(f"SELECT {_BAR} FROM ({I.bars_sql(I.deduped_sql(_BOTH), 300_000_000)})")
def medallion_two_batches(spark, sf):
    """A second batch corrects the candle of each full hour; the first is then run again."""
    home = scratch_path(spark, "two-batches")
    first = I.sound_klines(spark, sf)
    second = first.filter("open_time % 3600000000 = 0").withColumn("close", F.col("close") + 1)
    metadata = f"{home}/metadata"
    I.dimension(spark).write.option("header", True).csv(metadata)
    bronze, silver, gold = (f"{home}/{layer}" for layer in ("bronze", "silver", "gold"))
    for rows, day in ((first, "2024-02-01"), (second, "2024-02-02")):
        raw = I.write_raw_tree(rows, f"{home}/{day}")
        plans.run_pipeline(spark, raw, bronze, silver, gold, metadata, day, window_seconds=300)
    plans.refine(spark, bronze, silver, metadata, "2024-02-01")
    plans.aggregate(spark, silver, gold, "2024-02-01", window_seconds=300)
    return _plain(sources.read_table(spark, gold, GOLD))


_LATE = f"SELECT * REPLACE (close + 1 AS close, DATE '2024-03-01' AS ingestion_date) FROM ({I.KLINES}) WHERE num_trades > 5"
_EVERY = f"SELECT * FROM ({I.KLINES}) UNION ALL SELECT * FROM ({_LATE})"


@checked(
    "SELECT * REPLACE (cast(ingestion_date AS varchar) AS ingestion_date, cast(date AS varchar) AS date) "
    f"FROM ({I.silver_sql(_EVERY)})"
)
def silver_out_of_order(spark, sf):
    """The newest batch arrives first; what was ingested before it must not undo it."""
    home = scratch_path(spark, "out-of-order")
    old = I.klines(spark, sf)
    new = old.filter("num_trades > 5").withColumn("close", F.col("close") + 1)
    new = new.withColumn("ingestion_date", F.lit(date(2024, 3, 1)))
    bronze, silver, metadata = (f"{home}/{layer}" for layer in ("bronze", "silver", "metadata"))
    I.dimension(spark).write.option("header", True).csv(metadata)
    op.append(new, bronze, BRONZE_PARTITIONS)
    plans.refine(spark, bronze, silver, metadata, "2024-03-01")
    op.append(old, bronze, BRONZE_PARTITIONS)
    plans.refine(spark, bronze, silver, metadata)
    plans.refine(spark, bronze, silver, metadata, "2024-01-10")
    return _plain(sources.read_table(spark, silver, SILVER).drop("ingestion_ts"))


@checked(
    "SELECT symbol, cast(date AS varchar) AS date, open_time, close, coin_name FROM "
    f"({I.silver_sql(I.KLINES)})"
)
def silver_from_csv_meta(spark, sf):
    """Names read from a CSV dimension."""
    home = scratch_path(spark, "meta")
    I.dimension(spark).write.option("header", True).csv(home)
    rows = op.to_silver(op.dedup(I.klines(spark, sf)), sources.read_metadata(spark, home))
    return _plain(rows.select("symbol", "date", "open_time", "close", "coin_name"))


@checked(f"SELECT * FROM ({_RAW_ROWS}) WHERE symbol IN ('CLICK', 'VIEW')")
def csv_scope_symbols(spark, sf):
    """Two symbols and the files of a name pattern; the others hold the same rows and must not count."""
    home = scratch_path(spark, "scope-symbols")
    raw = I.write_raw_tree(I.klines(spark, sf), home)
    rows = sources.read_klines(spark, raw, symbols=["CLICK", "VIEW"], date_pattern="part-")
    none = sources.read_klines(spark, raw, symbols=["CLICK", "VIEW"], date_pattern="2031-01-01")
    return _plain(to_bronze(rows.unionByName(none), "2024-02-01"))


@checked(
    f"SELECT count(*) AS kept, count(*) AS stray, (SELECT count(*) FROM ({I.KLINES}) WHERE num_trades = 3) AS without_key, "
    f"(SELECT count(*) FROM ({I.deduped_sql(f'SELECT * FROM ({I.KLINES}) WHERE num_trades <> 3')})) AS in_silver "
    f"FROM ({I.KLINES})"
)
def bronze_dirty(spark, sf):
    """Files outside a symbol folder and rows without a time; what is left out is reported."""
    home = scratch_path(spark, "dirty")
    rows = I.klines(spark, sf)
    no_time = F.when(F.col("num_trades") != 3, F.col("open_time"))
    raw = I.write_raw_tree(rows.withColumn("open_time", no_time), home)
    rows.select(*RAW.names).write.mode("append").csv(raw)
    bronze, silver, metadata = (f"{home}/{layer}" for layer in ("bronze", "silver", "metadata"))
    I.dimension(spark).write.option("header", True).csv(metadata)
    left_out = plans.ingest(spark, raw, bronze, "2024-02-01")
    without_key = plans.refine(spark, bronze, silver, metadata, "2024-02-01")
    in_silver = sources.read_table(spark, silver, SILVER).agg(F.count("*")).scalar()
    return sources.read_table(spark, bronze, BRONZE).agg(F.count("*").alias("kept")).select(
        "kept",
        F.lit(left_out["rows_without_symbol"]).cast("bigint").alias("stray"),
        F.lit(without_key).cast("bigint").alias("without_key"),
        in_silver.alias("in_silver"),
    )


def _silver_table(spark: SparkSession, rows: DataFrame, home: str) -> str:
    """Deduplicated ``rows`` as a silver table below ``home``."""
    path = f"{home}/silver"
    op.upsert(spark, op.to_silver(op.dedup(rows), I.dimension(spark)), path, SILVER_KEYS, SILVER, unique=True)
    return path


@checked(f"SELECT {_BAR} FROM ({_HOURLY})")
def gold_empty_batch(spark, sf):
    """A batch without rows leaves gold as it was."""
    home = scratch_path(spark, "empty-batch")
    gold = f"{home}/gold"
    silver = _silver_table(spark, I.sound_klines(spark, sf), home)
    op.replace_partitions(I.gold(spark, sf, HOUR), gold, GOLD)
    if plans.aggregate(spark, silver, gold, "2031-01-01") is not None:
        raise AssertionError("the batch should be empty")
    return _plain(sources.read_table(spark, gold, GOLD))


@checked(f"SELECT {_BAR} FROM ({_HOURLY})")
def gold_skip_validation(spark, sf):
    """Negative prices stop the job unless the gate is skipped."""
    home = scratch_path(spark, "skip-validation")
    gold = f"{home}/gold"
    silver = _silver_table(spark, I.klines(spark, sf), home)
    plans.aggregate(spark, silver, gold, window_seconds=3600, skip_validation=True)
    return _plain(sources.read_table(spark, gold, GOLD))


@checked(_INTERVAL.format(gaps=_GAPS.format(rows=f"SELECT timestamp AS open_time, symbol FROM ({I.GOLD})")))
def gold_interval(spark, sf):
    """The spacing of gold bars."""
    return op.source_interval(I.gold(spark, sf), time="timestamp")


@checked(_all_bars(HOUR))
def cluster_dates(spark, sf):
    """Only the dates from 2024-01-15 on are rewritten; no row may change anywhere."""
    path = scratch_path(spark, "cluster-dates")
    op.replace_partitions(I.gold(spark, sf, HOUR), path, GOLD)
    bars = sources.read_table(spark, path, GOLD)
    op.cluster(spark, path, GOLD, dates=bars.filter("date >= '2024-01-15'").select("date").distinct())
    return _plain(sources.read_table(spark, path, GOLD))


_BOUND = """
SELECT symbol, timestamp, high FROM gold_ohlcv
WHERE symbol IN ('CLICK', 'VIEW') AND date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'"""


@checked(_views(_BOUND))
def sql_required(spark, sf):
    """A question to the stored table that must be bounded on both partition columns."""
    path = scratch_path(spark, "required")
    op.replace_partitions(I.gold(spark, sf), path, GOLD)
    sources.register_views(spark, gold=path)
    return plans.ask_sql(spark, _BOUND, require=("symbol", "date"))


@checked(_RAW_ROWS)
def zip_tree_ingest(spark, sf):
    """A tree of CSV files of some symbols and ZIP files of others to bronze."""
    home = scratch_path(spark, "zip-tree")
    rows = I.klines(spark, sf)
    zipped = rows.filter("symbol IN ('CLICK', 'ERROR')")
    raw = I.write_raw_tree(rows.filter("symbol NOT IN ('CLICK', 'ERROR')"), home)
    sources.write_archives(zipped, raw)
    bronze = f"{home}/bronze"
    plans.ingest(spark, raw, bronze, "2024-02-01")
    return _plain(sources.read_table(spark, bronze, BRONZE))


@checked(_RAW_ROWS)
def incremental_ingest(spark, sf):
    """A tree of CSV and ZIP files that grows twice; every file reaches bronze once, however often the job runs."""
    home = scratch_path(spark, "incremental")
    rows, raw = I.klines(spark, sf), f"{home}/raw"
    bronze, checkpoint = f"{home}/bronze", f"{home}/checkpoint"
    for days in ("date < '2024-01-08'", "date BETWEEN '2024-01-08' AND '2024-01-20'", "date > '2024-01-20'"):
        some = rows.withColumn("date", fn.utc_date("open_time")).filter(days).drop("date")
        I.write_raw_tree(some.filter("symbol NOT IN ('CLICK', 'ERROR')"), home)
        sources.write_archives(some.filter("symbol IN ('CLICK', 'ERROR')"), raw)
        plans.ingest_new(spark, raw, bronze, checkpoint, "2024-02-01", max_files=40)
    if plans.ingest_new(spark, raw, bronze, checkpoint, "2024-02-01")["files"]:
        raise AssertionError("all files should have been seen")
    return _plain(sources.read_table(spark, bronze, BRONZE))


@checked(_RAW_ROWS)
def archive_members(spark, sf):
    """Archives written by tasks, one a symbol and day, and read file by file."""
    raw = scratch_path(spark, "archives")
    sources.write_archives(I.klines(spark, sf), raw)
    return _plain(to_bronze(sources.read_kline_archives(spark, raw, by_member=True), "2024-02-01"))


@checked(
    f"SELECT * FROM ({_RAW_ROWS}) WHERE symbol IN ('CLICK', 'VIEW') "
    "AND cast(make_timestamp(open_time) AS date) BETWEEN '2024-01-10' AND '2024-01-19'"
)
def archive_dates(spark, sf):
    """Of the archives of two symbols those whose names hold a pattern."""
    raw = scratch_path(spark, "archive-dates")
    sources.write_archives(I.klines(spark, sf), raw)
    scope = {"symbols": ["CLICK", "VIEW"], "resolution": "1m", "date_pattern": "2024-01-1"}
    return _plain(to_bronze(sources.read_kline_archives(spark, raw, **scope), "2024-02-01"))


def _rolled(spark: SparkSession, sf: str, timeframe: str) -> DataFrame:
    """Coarse bars from two batches that share most of them."""
    path, bars = scratch_path(spark, "rolled"), I.gold(spark, sf)
    late = "date > '2024-01-20' OR num_trades % 2 = 1"
    op.add_bars(spark, bars.filter(f"NOT ({late})"), path, timeframe)
    op.add_bars(spark, bars.filter(late), path, timeframe)
    return op.coarse_bars(sources.read_table(spark, path, op.BAR_STATES))


@checked(_resampled(f"timestamp // {4 * HOUR} * {4 * HOUR}"))
def rolled_4h(spark, sf):
    return _rolled(spark, sf, "4H")


@checked(_resampled(_WEEK))
def rolled_1w(spark, sf):
    return _rolled(spark, sf, "1W")


@checked(_INTERVAL.format(gaps=_KLINE_GAPS))
def stored_interval(spark, sf):
    """The interval from a table of gap histograms, after a day that came in two batches."""
    path = scratch_path(spark, "gaps")
    rows = op.dedup(I.klines(spark, sf)).withColumn("date", fn.utc_date("open_time"))
    op.update_gaps(rows.filter("date < '2024-01-15' OR date = '2024-01-15' AND num_trades < 5"), path)
    op.update_gaps(rows.filter("date >= '2024-01-15'"), path)
    return op.stored_interval(sources.read_table(spark, path, op.GAP_STATES))


@checked(
    f"WITH w AS ({_INTERVAL.format(gaps=_SOUND_GAPS)}), "
    f"k AS ({I.deduped_sql(_SOUND)}) "
    f"SELECT {_BAR} FROM ("
    + I.bars_sql("SELECT k.*, interval_seconds * 1000000 AS w FROM k, w", "w")
    + ")"
)
def medallion_gaps(spark, sf):
    """New files only to bronze, and the bar width from the stored gaps."""
    home = scratch_path(spark, "medallion-gaps")
    raw = I.write_raw_tree(I.sound_klines(spark, sf), home)
    metadata = f"{home}/metadata"
    I.dimension(spark).write.option("header", True).csv(metadata)
    bronze, silver, gold, gaps = (f"{home}/{layer}" for layer in ("bronze", "silver", "gold", "gaps"))
    plans.ingest_new(spark, raw, bronze, f"{home}/checkpoint", "2024-02-01")
    plans.refine(spark, bronze, silver, metadata, "2024-02-01", gaps)
    plans.aggregate(spark, silver, gold, "2024-02-01", bronze=bronze, gaps=gaps)
    return _plain(sources.read_table(spark, gold, GOLD))


@checked(_all_bars(300_000_000))
def cluster_interleaved(spark, sf):
    """Ordered by time and price together; no row may change."""
    path = scratch_path(spark, "interleaved")
    op.replace_partitions(I.gold(spark, sf), path, GOLD, ["symbol"])
    op.cluster(spark, path, GOLD, by=["timestamp", "close"], partitions=["symbol"], files=32)
    return _plain(sources.read_table(spark, path, GOLD))


_TWO_TABLES = """
SELECT g.symbol, g.timestamp, g.high - d.low AS over_low
FROM (SELECT symbol, date AS day, timestamp, high FROM gold_ohlcv) g
JOIN (SELECT symbol, date AS day, min(low) AS low FROM gold_ohlcv
      WHERE date >= DATE '2024-01-10' AND date <= DATE '2024-01-12' GROUP BY symbol, date) d
  ON g.symbol = d.symbol AND g.day = d.day
WHERE g.symbol = 'CLICK' OR g.symbol = 'VIEW'
UNION ALL
SELECT symbol, timestamp, high - (SELECT min(low) FROM gold_ohlcv WHERE symbol = 'ERROR' AND date = DATE '2024-01-11')
FROM gold_ohlcv WHERE symbol IN ('ERROR') AND date = DATE '2024-01-11'"""


@checked(_views(_TWO_TABLES))
def sql_required_tables(spark, sf):
    """Each of four scans must be bounded: through aliases, a join, a union and a subquery."""
    path = scratch_path(spark, "required-tables")
    op.replace_partitions(I.gold(spark, sf), path, GOLD)
    sources.register_views(spark, gold=path)
    return plans.ask_sql(spark, _TWO_TABLES, require=("symbol", "date"))
