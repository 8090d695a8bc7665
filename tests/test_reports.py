import datetime as dt

import pytest
from pyspark.sql import functions as F

from wickline import functions as fn
from wickline.functions import DAY_US, HOUR_US, utc_date
from wickline.operators import (
    CHART_ROWS,
    QualityError,
    close_between,
    close_bounds,
    freshness,
    in_time_order,
    last_24h,
    latest,
    load_bars,
    market_overview,
    pct_change_24h,
    quality_counts,
    range_summary,
    run_suite,
    top_movers,
    upsert,
    validate,
    volume_24h,
    volume_at_least,
    volume_bounds,
)
from wickline.schemas import GOLD, GOLD_KEYS
from wickline.sources import newest_date, read_table

NAN = float("nan")


def _gold(spark, rows):
    """rows: (symbol, timestamp, close, volume)"""
    frame = spark.createDataFrame(rows, "symbol string, timestamp long, close double, volume double")
    return frame.withColumn("date", utc_date("timestamp")).repartition(4)


# Market


def test_24h_slice_is_anchored_on_the_data_and_closed_at_both_ends(spark):
    t = 5 * DAY_US + 7
    gold = _gold(spark, [("A", t, 1.0, 1.0), ("A", t - DAY_US, 1.0, 1.0), ("A", t - DAY_US - 1, 1.0, 1.0)])
    assert sorted(r.timestamp for r in last_24h(gold).collect()) == [t - DAY_US, t]


def test_24h_slice_opens_only_the_newest_partitions(spark, tmp_path):
    path = str(tmp_path / "g")
    rows = [("A", d * DAY_US, 1.0, 1.0) for d in range(6)]
    full = _gold(spark, rows)
    for c in ("open", "high", "low"):
        full = full.withColumn(c, F.col("close"))
    upsert(spark, full.withColumn("num_trades", F.lit(1)), path, GOLD_KEYS, GOLD)
    bars = read_table(spark, path, GOLD)
    assert last_24h(bars).count() == 2
    newest = newest_date(spark, path)
    assert newest == dt.date(1970, 1, 6)
    assert last_24h(bars, newest).count() == 2
    for report in (last_24h(bars, newest), freshness(bars, dt.datetime(1970, 1, 7), newest),
                   market_overview(bars, dt.datetime(1970, 1, 7), newest), volume_24h(bars, newest),
                   top_movers(bars, 2, newest=newest), pct_change_24h(bars, newest)):
        steps = report._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )
        scans = [s for s in steps.split("\n\n") if s.strip().split("\n")[0].find(") Scan parquet") > 0]
        assert scans and all("PartitionFilters: [isnotnull(date" in s for s in scans)
    (tmp_path / "none").mkdir()
    assert newest_date(spark, str(tmp_path / "none")) is None


def test_overview_ties_zero_first_close_and_volume(spark):
    gold = _gold(
        spark,
        [("B", 0, 1.0, 1.0), ("B", HOUR_US, 2.0, 1.0), ("A", 0, 2.0, 1.0), ("A", HOUR_US, 4.0, 1.0),
         ("Z", 0, 0.0, 1.0), ("Z", HOUR_US, 9.0, 1.0), ("D", 0, 4.0, None), ("D", HOUR_US, 2.0, 1.0),
         ("C", 0, 2.0, 1.0), ("C", HOUR_US, 1.0, 1.0)],
    )
    row = market_overview(gold, dt.datetime(1970, 1, 1, 2)).first()
    assert tuple(row) == ("A", 100.0, "C", -50.0, 9.0, 60.0)
    assert pct_change_24h(gold).filter("symbol = 'Z'").first().pct_change is None
    assert [r.symbol for r in top_movers(gold, 2).collect()] == ["A", "B"]
    assert [r.symbol for r in top_movers(gold, 3, losers=True).collect()] == ["C", "D", "A"]
    assert volume_24h(gold).first()[0] == 9.0


def test_overview_of_an_empty_table_has_no_row(spark):
    empty = _gold(spark, [("A", 0, 1.0, 1.0)]).filter("symbol = 'none'")
    assert market_overview(empty, dt.datetime(2024, 1, 1)).count() == 0
    assert volume_24h(empty).first()[0] == 0.0


def test_freshness_is_never_negative(spark):
    gold = _gold(spark, [("A", HOUR_US, 1.0, 1.0)])
    aware = dt.datetime(1970, 1, 1, 3, 30, tzinfo=dt.timezone(dt.timedelta(hours=1)))
    assert freshness(gold, aware).first()[0] == 90.0
    assert freshness(gold, dt.datetime(1970, 1, 1)).first()[0] == 0.0


# Selections


def test_load_bars_prunes_guards_and_adds_a_time(spark):
    gold = _gold(spark, [("A", d * DAY_US, 1.0, 1.0) for d in range(5)] + [("B", DAY_US, 1.0, 1.0)])
    rows = load_bars(gold, "A", "1970-01-02", dt.date(1970, 1, 3))
    assert [r.date.day for r in in_time_order(rows).collect()] == [2, 3]
    assert dict(rows.dtypes)["time"] == "timestamp"
    with pytest.raises(ValueError, match="after"):
        load_bars(gold, "A", "1970-01-03", "1970-01-02")
    with pytest.raises(ValueError, match="31 days"):
        load_bars(gold, "A", "1970-01-01", "1970-01-31", max_days=30)
    assert load_bars(gold, "A", "1970-01-01", "1970-01-31").count() == 5


def test_value_filters_are_inclusive_and_drop_nulls(spark):
    gold = _gold(spark, [("A", i, c, v) for i, (c, v) in enumerate(
        [(1.0, 5.0), (2.0, 1.0), (3.0, None), (None, 9.0)])])
    assert tuple(close_bounds(gold).first()) == (1.0, 3.0)
    assert close_between(gold).count() == 3
    assert close_between(gold, 2.0, 3.0).count() == 2
    assert tuple(volume_bounds(close_between(gold, 2.0)).first()) == (1.0, 1.0)
    assert volume_at_least(gold).count() == 3 and volume_at_least(gold, 5.0).count() == 2


def test_latest_rows_in_either_direction(spark):
    gold = _gold(spark, [("A", i, 1.0, 1.0) for i in range(20)])
    assert [r.timestamp for r in latest(gold, 3).collect()] == [19, 18, 17]
    assert [r.timestamp for r in latest(gold, 3, newest_first=False).collect()] == [17, 18, 19]
    assert latest(gold, CHART_ROWS).count() == 20


def test_summary_of_a_range(spark):
    gold = _gold(spark, [("A", 2, 3.0, 1.0), ("A", 1, 2.0, 1.0), ("Z", 1, 0.0, 1.0), ("Z", 2, 5.0, 2.0)])
    rows = {r.symbol: tuple(r)[1:] for r in range_summary(gold).collect()}
    assert rows == {"A": (2.0, 3.0, 2.0, 1.0, 50.0), "Z": (0.0, 5.0, 3.0, 5.0, 0.0)}


# Quality


BAD = [
    {"open_time": None}, {"symbol": None}, {"symbol": ""}, {"open": -0.5}, {"high": 1e13},
    {"low": NAN}, {"close": None}, {"volume": -1.0}, {"volume": NAN}, {"open": 0.0},
]


def test_counts_by_rule_come_from_one_pass(candles):
    counts = quality_counts(candles([{"open_time": i, "symbol": "A", "open": 1.0, "high": 1.0,
                                      "low": 1.0, "close": 1.0, "volume": 1.0} | b
                                     for i, b in enumerate(BAD)]))
    assert counts.first().asDict() == {
        "null_open_time": 1, "null_symbol": 2, "invalid_open": 1, "invalid_high": 1,
        "invalid_low": 1, "invalid_close": 0, "invalid_volume": 2,
    }
    assert counts._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") <= 2


def test_validation_reports_missing_keys_first(candles):
    both = candles([{"open_time": None, "open": -1.0}])
    with pytest.raises(QualityError) as failure:
        validate(both)
    assert failure.value.failed == {"null_open_time": 1, "null_symbol": 0}
    with pytest.raises(QualityError, match="invalid_close=1"):
        validate(candles([{"close": -1.0}]))
    assert validate(candles([{"close": None, "open": 0.0, "high": 1e12}]))


def test_suite_is_data_not_code(candles):
    rows = candles([{"open": 1.0}, {"open": 5.0}, {"open": None}])
    suite = {"expectations": [
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "open", "min_value": 2}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "open"}},
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "close"}},
    ]}
    assert [(r.column, r.failed, r.success) for r in run_suite(rows, suite).collect()] == [
        ("open", 1, False), ("open", 1, False), ("close", 0, True)
    ]
    suite["expectations"].append({"expectation_type": "expect_magic", "kwargs": {"column": "open"}})
    with pytest.raises(ValueError, match="expect_magic"):
        run_suite(rows, suite)
    extra = {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "volume", "mostly": 0.9}}
    with pytest.raises(ValueError, match="mostly"):
        run_suite(rows, {"expectations": [extra]})


# Labels and dates


def _texts(spark, label, values):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    return [r[0] for r in frame.orderBy("i").select(label(F.col("v"))).collect()]


@pytest.mark.parametrize("label,cases", [
    (fn.volume_label, {1.5e12: "1.50T", 1234.5e12: "1234.50T", 2.345e9: "2.35B", 1e6: "1.00M", 1234.0: "1.23K",
                       999.5: "1,000", 998.5: "998", 0.0: "0", -5000.0: "-5,000", None: None}),
    (fn.currency_label, {1e9: "$1.00B", 12.0: "$12", None: None}),
    (fn.price_label, {43127.8: "$43,127.80", 1000.0: "$1,000.00", 999.999: "$1000.00", 1.0: "$1.00",
                      0.125: "$0.1250", -5.0: "$-5.0000", -12345.5: "$-12345.5000", None: None}),
    (fn.signed_price_label, {0.0: "+$0.0000", 2.0: "+$2.00", -2.0: "$-2.0000"}),
    (fn.signed_percent_label, {1.005: "+1.00%", -3.456: "-3.46%", 0.0: "+0.00%"}),
    (fn.age_label, {0.99: "Just now", 1.0: "1 minutes ago", 2.5: "2 minutes ago", 59.7: "60 minutes ago",
                    60.0: "1.0 hours ago", 1439.0: "24.0 hours ago", 1440.0: "1.0 days ago",
                    2e6: "1388.9 days ago", None: None}),
    (fn.window_label, {1.0: "1s", 59.0: "59s", 60.0: "1m", 3599.0: "59m", 7200.0: "2h", 200000.0: "2d"}),
])
def test_labels(spark, label, cases):
    assert _texts(spark, label, list(cases)) == list(cases.values())


def test_relative_dates():
    assert fn.date_range("today", "2024-03-01") == (dt.date(2024, 3, 1),) * 2
    assert fn.date_range("yesterday", dt.date(2024, 3, 1)) == (dt.date(2024, 2, 29),) * 2
    assert fn.date_range("last 7 days", "2024-03-01") == (dt.date(2024, 2, 23), dt.date(2024, 2, 29))
    with pytest.raises(ValueError):
        fn.date_range("last month", "2024-03-01")


@pytest.mark.parametrize("micros", [0, -1, DAY_US - 1, -DAY_US, 9_223_000_000_000_000_000 // 1000])
def test_utc_date_matches_python(spark, micros):
    got = spark.range(1).select(utc_date(F.lit(micros))).first()[0]
    assert got == (dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=micros)).date()
