import datetime as dt
import random

import pytest

from wickline.operators import dedup, to_silver, with_coin_names
from wickline.operators import enrich
from wickline.schemas import METADATA, SILVER

DAY1, DAY2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def test_newest_ingestion_wins_then_the_larger_values(candles):
    rows = candles(
        [
            {"open_time": 0, "close": 9.0, "ingestion_date": DAY1},
            {"open_time": 0, "close": 1.0, "ingestion_date": DAY2},
            {"open_time": 0, "close": 3.0, "ingestion_date": DAY2},
            {"open_time": 1, "close": 7.0, "ingestion_date": DAY1},
        ]
    )
    kept = dedup(rows).orderBy("open_time").collect()
    assert [(r.open_time, r.close) for r in kept] == [(0, 3.0), (1, 7.0)]


def test_survivor_does_not_depend_on_row_order(candles, rows_of):
    rng = random.Random(1)
    rows = [
        {"open_time": rng.randrange(20), "close": float(rng.randrange(5)),
         "volume": float(rng.randrange(5)), "ingestion_date": DAY1}
        for _ in range(400)
    ]
    a = rows_of(dedup(candles(rows, partitions=7)))
    assert a == rows_of(dedup(candles(rows[::-1], partitions=3)))
    assert len(a) == len({r["open_time"] for r in rows})


def test_copies_are_cut_down_before_the_shuffle(candles):
    hot = candles([{"open_time": 0, "ingestion_date": DAY1}] * 300)
    plan = dedup(hot)._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[before_shuffle:]
    assert dedup(hot).count() == 1


def _meta(spark, *rows):
    return spark.createDataFrame(rows, METADATA)


def test_silver_has_the_declared_columns_and_null_names_for_unknown_symbols(spark, candles):
    bronze = candles([{"symbol": s, "ingestion_date": DAY1} for s in ("A", "B")])
    silver = to_silver(bronze, _meta(spark, ("A", "Alpha"), (None, "Nobody")))
    assert silver.columns == SILVER.names
    assert {(r.symbol, r.coin_name) for r in silver.collect()} == {("A", "Alpha"), ("B", None)}


def test_dimension_is_broadcast_only_while_it_is_small(spark, candles, monkeypatch):
    rows = candles([{"symbol": "A"}])
    meta = _meta(spark, ("A", "Alpha"), ("B", "Beta"))

    def hinted():
        return "ResolvedHint" in with_coin_names(rows, meta)._jdf.queryExecution().analyzed().toString()

    assert hinted()
    monkeypatch.setattr(enrich, "BROADCAST_ROWS", 1)
    assert not hinted()
    assert with_coin_names(rows, meta).first().coin_name == "Alpha"


def test_repeated_dimension_symbol_is_an_error(spark, candles):
    with pytest.raises(ValueError, match="more than one row"):
        with_coin_names(candles([{}]), _meta(spark, ("A", "x"), ("A", "y")))
