import datetime as dt
import shutil

import pytest

from wickline.functions import DAY_US, HOUR_US
from wickline.operators import QualityError, ohlcv
from wickline.operators import tables
from wickline.plans import aggregate, ingest, refine, run_pipeline
from wickline.plans.jobs import rebuilt_bars, yesterday
from wickline.schemas import BRONZE, GOLD, SILVER
from wickline.sources import read_table

DAY0 = 1_704_067_200_000_000  # 2024-01-01
MINUTE = 60_000_000


class Home:
    """One raw tree with its tables."""

    def __init__(self, folder):
        self.folder = folder
        self.raw = str(folder / "raw")
        self.bronze, self.silver, self.gold = (str(folder / n) for n in ("b", "s", "g"))
        meta = folder / "coin_metadata.csv"
        meta.write_text("symbol,name\nBTCUSDT,Bitcoin\n")
        self.metadata = str(meta)

    def put(self, symbol, day, rows):
        """rows: (open_time, price)"""
        folder = self.folder / "raw" / symbol / "1m"
        folder.mkdir(parents=True, exist_ok=True)
        lines = [f"{t},{p},{p},{p},{p},1,{t},1,1,1,1,0" for t, p in rows]
        (folder / f"{symbol}-1m-{day}.csv").write_text("\n".join(lines) + "\n")

    def run(self, spark, day, **more):
        return run_pipeline(
            spark, self.raw, self.bronze, self.silver, self.gold, self.metadata, day, **more
        )

    def bars(self, spark):
        rows = read_table(spark, self.gold, GOLD).orderBy("symbol", "timestamp").collect()
        return [(r.symbol, r.timestamp - DAY0, r.open, r.close, r.volume) for r in rows]


@pytest.fixture
def home(tmp_path):
    return Home(tmp_path)


def test_full_run_twice_gives_the_same_gold(spark, home):
    home.put("BTCUSDT", "2024-01-01", [(DAY0 + i * MINUTE, 10.0 + i) for i in range(5)])
    home.put("ETHUSDT", "2024-01-01", [(DAY0 + i * MINUTE, 20.0 + i) for i in range(3)])
    assert home.run(spark, "2024-01-01") == dt.date(2024, 1, 1)
    first = home.bars(spark)
    assert len(first) == 8 and first[0] == ("BTCUSDT", 0, 10.0, 10.0, 1.0)
    home.run(spark, "2024-01-01", skip_optimize=True)
    assert home.bars(spark) == first
    assert read_table(spark, home.bronze, BRONZE).count() == 16
    silver = read_table(spark, home.silver, SILVER)
    assert silver.count() == 8
    assert {(r.symbol, r.coin_name) for r in silver.collect()} == {
        ("BTCUSDT", "Bitcoin"), ("ETHUSDT", None)
    }
    assert silver.filter("ingestion_ts IS NULL OR date <> DATE '2024-01-01'").count() == 0


def test_a_batch_is_read_by_its_ingestion_date(spark, home):
    home.put("BTCUSDT", "2024-01-01", [(DAY0, 1.0), (DAY0 + MINUTE, 1.0)])
    ingest(spark, home.raw, home.bronze, "2024-01-01")
    refine(spark, home.bronze, home.silver, home.metadata, "2024-01-02")
    assert read_table(spark, home.silver, SILVER).count() == 0
    assert aggregate(spark, home.silver, home.gold, "2024-01-02") is None
    refine(spark, home.bronze, home.silver, home.metadata)
    assert aggregate(spark, home.silver, home.gold, dt.date(2024, 1, 1)) == 60


def test_scope_narrows_the_ingest(spark, home):
    home.put("BTCUSDT", "2024-01-01", [(DAY0, 1.0)])
    home.put("ETHUSDT", "2024-01-01", [(DAY0, 1.0)])
    ingest(spark, home.raw, home.bronze, "2024-01-01", symbols=["ETHUSDT"], resolution="1m")
    assert [r.symbol for r in read_table(spark, home.bronze, BRONZE).collect()] == ["ETHUSDT"]


def test_files_outside_a_symbol_folder_are_dropped(spark, home):
    home.put("BTCUSDT", "2024-01-01", [(DAY0, 1.0)])
    (home.folder / "raw" / "stray.csv").write_text(f"{DAY0},1,1,1,1,1,1,1,1,1,1,0\n")
    ingest(spark, home.raw, home.bronze, "2024-01-01")
    assert [r.symbol for r in read_table(spark, home.bronze, BRONZE).collect()] == ["BTCUSDT"]


def test_a_lost_partition_is_rebuilt_from_the_layer_below(spark, home):
    rows = [(DAY0 + d * DAY_US + i * MINUTE, 1.0 + i) for d in range(2) for i in range(3)]
    home.put("BTCUSDT", "d", rows)
    home.run(spark, "2024-01-01")
    before = home.bars(spark)
    for layer in (home.silver, home.gold):
        shutil.rmtree(f"{layer}/symbol=BTCUSDT/date=2024-01-02")
    refine(spark, home.bronze, home.silver, home.metadata)
    aggregate(spark, home.silver, home.gold)
    assert home.bars(spark) == before and len(before) == 6


def test_ingest_stamps_today_by_default_and_rejects_bad_dates(spark, home):
    home.put("BTCUSDT", "2024-01-01", [(DAY0, 1.0)])
    ingest(spark, home.raw, home.bronze)
    stamp = read_table(spark, home.bronze, BRONZE).first().ingestion_date
    assert abs(stamp - yesterday()) <= dt.timedelta(days=2)
    with pytest.raises(ValueError):
        ingest(spark, home.raw, home.bronze, "2024-13-01")


def test_rows_without_a_key_are_counted_and_left_out(spark, home):
    home.put("BTCUSDT", "2024-01-01", [("", 1.0), ("x", 1.0), (DAY0, 1.0)])
    ingest(spark, home.raw, home.bronze, "2024-01-01")
    assert refine(spark, home.bronze, home.silver, home.metadata, "2024-01-01") == 2
    assert refine(spark, home.bronze, home.silver, home.metadata, "2024-01-01") == 2
    assert read_table(spark, home.silver, SILVER).count() == 1


def test_newer_batch_replaces_older_rows(spark, home):
    home.put("BTCUSDT", "2024-01-01", [(DAY0, 1.0), (DAY0 + MINUTE, 1.0)])
    home.run(spark, "2024-01-01")
    home.put("BTCUSDT", "2024-01-01", [(DAY0, 5.0)])
    home.run(spark, "2024-01-02", window_seconds=60)
    assert [b[2] for b in home.bars(spark)] == [5.0, 1.0]
    stamps = read_table(spark, home.silver, SILVER).orderBy("open_time").collect()
    assert [r.ingestion_date.day for r in stamps] == [2, 1]


def test_a_bucket_shared_by_two_batches_is_recomputed_whole(spark, home):
    home.put("BTCUSDT", "d1", [(DAY0 + i * MINUTE, 1.0 + i) for i in range(3)])
    ingest(spark, home.raw, home.bronze, "2024-01-01")
    refine(spark, home.bronze, home.silver, home.metadata, "2024-01-01")
    aggregate(spark, home.silver, home.gold, "2024-01-01", window_seconds=3600)
    assert home.bars(spark) == [("BTCUSDT", 0, 1.0, 3.0, 3.0)]
    home.put("BTCUSDT", "d1", [(DAY0 + 30 * MINUTE, 9.0)])
    ingest(spark, home.raw, home.bronze, "2024-01-02")
    refine(spark, home.bronze, home.silver, home.metadata, "2024-01-02")
    aggregate(spark, home.silver, home.gold, "2024-01-02", window_seconds=3600)
    assert home.bars(spark) == [("BTCUSDT", 0, 1.0, 9.0, 4.0)]


@pytest.mark.parametrize("window", [7 * HOUR_US, 3 * DAY_US + 5])
def test_rebuilt_bars_equal_a_full_rebuild(spark, candles, window):
    from wickline.functions import utc_date
    from pyspark.sql import functions as F

    rows = [{"open_time": DAY0 + i * HOUR_US, "open": float(i), "close": float(i),
             "symbol": "AB"[i % 3 == 0]} for i in range(200)]
    silver = candles(rows).withColumn("date", utc_date("open_time"))
    batch = silver.filter((F.col("open_time") >= DAY0 + 50 * HOUR_US) & (F.col("open_time") < DAY0 + 60 * HOUR_US))
    day = lambda us: us // DAY_US
    days = {(r.symbol, day(r.open_time // window * window)) for r in batch.collect()}
    full = [r for r in ohlcv(silver, window).collect() if (r.symbol, day(r.timestamp)) in days]
    assert sorted(rebuilt_bars(silver, batch, window).collect()) == sorted(full)


def test_invalid_prices_stop_the_gold_job(spark, home):
    home.put("BTCUSDT", "2024-01-01", [(DAY0, -1.0), (DAY0 + MINUTE, 2.0)])
    with pytest.raises(QualityError, match="invalid_open=1"):
        home.run(spark, "2024-01-01")
    assert aggregate(spark, home.silver, home.gold, "2024-01-01", skip_validation=True) == 60
    assert len(home.bars(spark)) == 2


def test_jobs_insist_on_utc(spark, home):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError, match="UTC"):
            ingest(spark, home.raw, home.bronze)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_small_batch_does_not_count_twice(spark, home):
    """A batch without gaps of its own takes the width of the partitions it touches."""
    home.put("BTCUSDT", "d1", [(DAY0 + i * MINUTE, 1.0) for i in range(5)])
    home.run(spark, "2024-01-01")
    home.put("BTCUSDT", "d1", [(DAY0 + 2 * MINUTE, 3.0)])
    home.run(spark, "2024-01-02")
    silver = read_table(spark, home.silver, SILVER)
    assert sum(b[4] for b in home.bars(spark)) == silver.agg({"volume": "sum"}).first()[0] == 5.0
    aggregate(spark, home.silver, home.gold, "2024-01-02", window_seconds=300)
    assert [b[4] for b in home.bars(spark)] == [5.0]


def test_batches_in_any_order_give_the_same_silver(spark, home):
    for number, close in ((1, 1.0), (2, 9.0), (3, 4.0)):
        home.put("BTCUSDT", "d1", [(DAY0, close), (DAY0 + number * MINUTE, close)])
        ingest(spark, home.raw, home.bronze, f"2024-01-0{number}")
    for number in (3, 1, 2, 1):
        refine(spark, home.bronze, home.silver, home.metadata, f"2024-01-0{number}")

    def rows():
        table = read_table(spark, home.silver, SILVER)
        stable = [c for c, kind in table.dtypes if not kind.startswith("timestamp")]
        return sorted(map(tuple, table.select(*stable).collect()))

    stepwise = rows()
    refine(spark, home.bronze, home.silver, home.metadata)
    assert stepwise == rows()


def test_the_batch_is_read_from_the_silver_partitions_it_reached(spark, home):
    from wickline.plans.jobs import _of_batch, _reached

    for number in range(1, 5):
        home.put("BTCUSDT", f"d{number}", [(DAY0 + number * DAY_US, float(number))])
        ingest(spark, home.raw, home.bronze, f"2024-01-0{number}", date_pattern=f"d{number}")
    refine(spark, home.bronze, home.silver, home.metadata)
    batch = _of_batch(_reached(spark, read_table(spark, home.silver, SILVER), home.bronze, "2024-01-03"), "2024-01-03")
    assert [r.close for r in batch.collect()] == [3.0]
    plan = batch._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("]")[0]
    assert "symbol#" in filters and "date#" in filters


def test_ingest_counts_what_it_leaves_out(spark, home):
    from pathlib import Path

    home.put("BTCUSDT", "d1", [(DAY0, 1.0)])
    stray = Path(home.raw) / "stray.csv"
    stray.write_text("1,1,1,1,1,1,1,1,1,1,1,1\n")
    assert ingest(spark, home.raw, home.bronze, "2024-01-01") == {"damaged_archives": 0, "rows_without_symbol": 1}
    (Path(home.raw) / "BTCUSDT" / "junk.zip").write_bytes(b"junk")
    assert ingest(spark, home.raw, home.bronze, "2024-01-01") == {"damaged_archives": 1, "rows_without_symbol": 1}
