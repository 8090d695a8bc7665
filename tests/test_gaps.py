import math
import random

import pandas as pd
import pytest

from wickline.operators import infer_interval, interval_gaps, source_interval

SCHEMA = "symbol string, open_time long"


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


def _random_rows(seed, n, spread):
    rng = random.Random(seed)
    rows = {(rng.choice("AAAAB"), rng.randrange(-spread, spread)) for _ in range(n)}
    return sorted(rows)


@pytest.mark.parametrize(
    "n,spread", [(300, 10**6), (300, 10**8), (300, 10**11), (300, 10**14), (50, 4 * 10**18)]
)
@pytest.mark.parametrize("spans", [(3_600_000_000,), (60_000_000, 86_400_000_000)])
def test_gaps_equal_one_window_per_symbol(spark, n, spread, spans):
    rows = _random_rows(n, n, spread)
    want = []
    for (s, t), (s0, t0) in zip(rows[1:], rows):
        if s == s0:
            want.append((s, t, t - t0))
    got = interval_gaps(_frame(spark, rows), spans=spans).collect()
    assert sorted(tuple(r) for r in got) == sorted(want)


@pytest.mark.parametrize("seed,spread", [(1, 10**7), (2, 10**10), (3, 10**15), (4, 2 * 10**18)])
def test_interval_is_the_exact_discrete_median(spark, seed, spread):
    rows = _random_rows(seed, 101 + seed, spread)
    gaps = sorted(t - t0 for (s, t), (s0, t0) in zip(rows[1:], rows) if s == s0)
    middle = gaps[math.ceil(len(gaps) / 2) - 1]
    assert infer_interval(_frame(spark, rows)) == max(1, round(middle / 1e6))


@pytest.mark.parametrize("gap_us,seconds", [(100, 1), (1_500_000, 2), (2_500_000, 2), (60_000_000, 60)])
def test_interval_rounds_half_even_and_is_at_least_a_second(spark, gap_us, seconds):
    assert infer_interval(_frame(spark, [("A", i * gap_us) for i in range(4)])) == seconds


def test_interval_falls_back_without_gaps(spark):
    lonely = _frame(spark, [("A", 1), ("B", 2), ("C", None), ("C", None)])
    assert infer_interval(lonely) == 300
    assert infer_interval(lonely, 60) == 60
    bars = _frame(spark, [("A", 0), ("A", 90_000_000)]).withColumnRenamed("open_time", "timestamp")
    assert infer_interval(bars, time="timestamp") == 90
    assert source_interval(lonely).count() == 0


def test_no_window_spans_a_whole_symbol_of_rows(spark):
    plan = interval_gaps(_frame(spark, [("A", i) for i in range(10)]))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    first = text.index("RepartitionByExpression [")
    assert "slot#" in text[first : text.index("\n", first)]


def test_median_agrees_with_pandas_on_many_symbols(spark):
    rng = random.Random(9)
    rows, clock = [], 0
    for s in range(40):
        for _ in range(50):
            clock += rng.choice([1, 1, 1, 60, 3600]) * 1_000_000
            rows.append((f"S{s}", clock))
    frame = pd.DataFrame(rows, columns=["s", "t"])
    gaps = frame.t.sub(frame.groupby("s").t.shift(1)).dropna().sort_values().to_list()
    assert infer_interval(_frame(spark, rows)) == gaps[math.ceil(len(gaps) / 2) - 1] // 1_000_000
