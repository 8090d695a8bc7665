import datetime as dt

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wickline.functions import DAY_US, HOUR_US
from wickline.operators import TIMEFRAMES, ohlcv, resample
from wickline.schemas import GOLD

QUICK = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def test_a_bar_takes_each_price_from_its_own_candle(candles):
    prices = [(7.0, 9.5, 6.5, 8.0), (8.0, 8.25, 2.0, 3.0), (3.0, 14.0, 3.0, 12.0), (12.0, 12.5, 4.0, 5.5)]
    rows = [
        {"open": o, "high": h, "low": low, "close": c, "volume": 0.5 * i, "num_trades": i, "open_time": i * 37_000_000}
        for i, (o, h, low, c) in enumerate(prices)
    ]
    bar, = ohlcv(candles(rows, symbol="XRPUSDT"), 120_000_000).collect()
    assert tuple(bar) == ("XRPUSDT", 0, 7.0, 14.0, 2.0, 5.5, 3.0, 6, dt.date(1970, 1, 1))


def test_bars_have_the_declared_schema(candles):
    bars = ohlcv(candles([{}]), HOUR_US)
    assert [(f.name, f.dataType) for f in bars.schema] == [(f.name, f.dataType) for f in GOLD]


def test_buckets_before_the_epoch_floor(candles):
    bars = ohlcv(candles([{"open_time": -1}]), HOUR_US).first()
    assert (bars.timestamp, bars.date) == (-HOUR_US, dt.date(1969, 12, 31))


def test_dates_do_not_depend_on_the_session_zone(spark, candles):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        bar = ohlcv(candles([{"open_time": 3 * DAY_US + 5}]), DAY_US).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert bar.date == dt.date(1970, 1, 4)


def test_bar_aggregation_is_partial_and_hashed(candles):
    plan = ohlcv(candles([{}]), HOUR_US)._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "SortAggregate" not in plan


def _gold(spark, rows):
    """rows: (timestamp, open, close, volume)"""
    return spark.createDataFrame(
        [("A", t, o, max(o or 0, c or 0), 0.0, c, v) for t, o, c, v in rows],
        "symbol string, timestamp long, open double, high double, low double, close double, volume double",
    ).repartition(4)


def test_resample_skips_nulls_and_drops_priceless_bars(spark):
    bars = _gold(
        spark,
        [(0, None, 2.0, 1.0), (1, 5.0, None, None), (HOUR_US, None, 3.0, 1.0)],
    )
    assert [tuple(r) for r in resample(bars, "1H").collect()] == [("A", 0, 5.0, 5.0, 0.0, 2.0, 1.0)]


@pytest.mark.parametrize("timeframe,rule", [("1H", "1h"), ("4H", "4h"), ("1D", "1D"), ("1W", "1W")])
def test_resample_labels_agree_with_pandas(spark, timeframe, rule):
    start = 1_704_400_000_000_000
    rows = [(start + i * 5_000_000_000, 1.0 + i, 2.0 + i, float(i)) for i in range(300)]
    got = resample(_gold(spark, rows), timeframe).orderBy("timestamp").collect()
    frame = pd.DataFrame(rows, columns=["t", "open", "close", "volume"])
    frame.index = pd.to_datetime(frame.t, unit="us")
    want = frame.resample(rule).agg({"open": "first", "close": "last", "volume": "sum"}).dropna()
    labels = (want.index - pd.Timestamp(0)) // pd.Timedelta(microseconds=1)
    assert [(r.timestamp, r.open, r.close, r.volume) for r in got] == list(
        zip(labels, want.open, want.close, want.volume)
    )


def test_resample_rejects_other_timeframes(spark):
    with pytest.raises(ValueError):
        resample(_gold(spark, [(0, 1.0, 1.0, 1.0)]), "2H")
    assert "1m" in TIMEFRAMES


@QUICK
@given(
    st.lists(
        st.tuples(st.integers(0, 40 * DAY_US), st.integers(1, 99), st.integers(0, 9)),
        min_size=1,
        max_size=30,
        unique_by=lambda t: t[0],
    )
)
def test_resampling_in_steps_is_resampling_at_once(spark, rows):
    bars = _gold(spark, [(t, float(p), float(p + 1), float(v)) for t, p, v in rows])
    by_hour = resample(bars, "1H")
    once = sorted(tuple(r) for r in resample(bars, "1D").collect())
    assert once == sorted(tuple(r) for r in resample(by_hour, "1D").collect())
    assert sum(r[-1] for r in once) == sum(v for _, _, v in rows)
