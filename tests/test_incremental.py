"""New files only, archives as a data source, states that merge, and interleaved files."""

import os
import shutil
import zipfile
from datetime import date

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from wickline import operators as op
from wickline import plans, sources
from wickline.functions import DAY_US, HOUR_US, utc_date
from wickline.operators import rollup, tables
from wickline.plans import incremental
from wickline.schemas import BRONZE, BRONZE_PARTITIONS, GOLD, RAW, conform

LINE = "{},1,2,0.5,1.5,10,{},4,3,5,2,0\n"


def _csv(raw, symbol, name, times):
    folder = raw / symbol / "1m"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{symbol}-1m-{name}.csv").write_text("".join(LINE.format(t, t + 59) for t in times))


def _zip(raw, symbol, name, members):
    folder = raw / symbol / "1m"
    folder.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / f"{symbol}-1m-{name}.zip", "w", zipfile.ZIP_DEFLATED) as archive:
        for member, times in members.items():
            archive.writestr(member, "".join(LINE.format(t, t + 59) for t in times))


def _times(spark, bronze):
    rows = sources.read_table(spark, str(bronze), BRONZE)
    return sorted((r.symbol, r.open_time) for r in rows.collect())


@pytest.fixture
def tree(spark, tmp_path):
    raw, bronze, checkpoint = tmp_path / "raw", tmp_path / "bronze", str(tmp_path / "checkpoint")
    raw.mkdir()

    def run(**more):
        return plans.ingest_new(spark, str(raw), str(bronze), checkpoint, "2024-01-01", **more)

    return raw, bronze, run


def test_each_file_is_ingested_once(spark, tree):
    raw, bronze, run = tree
    _csv(raw, "A", "1", [1, 2])
    _zip(raw, "B", "1", {"x.csv": [3]})
    assert run() == {"files": 2, "rows": 3, "damaged_archives": 0, "rows_without_symbol": 0}
    assert run()["files"] == 0
    _csv(raw, "A", "2", [4])
    _zip(raw, "B", "2", {"x.csv": [5], "y.csv": [6]})
    (raw / "loose.csv").write_text(LINE.format(7, 8))
    (raw / "B" / "1m" / "bad.zip").write_bytes(b"no archive")
    assert run(max_files=1) == {"files": 4, "rows": 3, "damaged_archives": 1, "rows_without_symbol": 1}
    assert _times(spark, bronze) == [("A", 1), ("A", 2), ("A", 4), ("B", 3), ("B", 5), ("B", 6)]


def test_an_archive_and_its_csv_count_once_whichever_comes_first(spark, tree):
    raw, bronze, run = tree
    _zip(raw, "A", "first", {"x.csv": [1]})
    _zip(raw, "A", "both", {"x.csv": [2]})
    _csv(raw, "A", "both", [2])
    _csv(raw, "A", "second", [3])
    assert run()["rows"] == 3
    _csv(raw, "A", "first", [1])
    _zip(raw, "A", "second", {"x.csv": [3]})
    assert run()["rows"] == 0
    assert _times(spark, bronze) == [("A", 1), ("A", 2), ("A", 3)]


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_batch_that_fails_is_not_added_twice(spark, tree, monkeypatch, when):
    raw, bronze, run = tree
    _csv(raw, "A", "1", [1])
    run()
    _csv(raw, "A", "2", [2, 3])
    real = incremental.publish

    def failing(*args):
        if when == "after":
            real(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(incremental, "publish", failing)
    with pytest.raises(Exception, match="lost"):
        run()
    monkeypatch.setattr(incremental, "publish", real)
    _zip(raw, "A", "2", {"x.csv": [2, 3]})  # what the batch takes is settled, so this stays out
    assert run()["rows"] == 2
    assert run()["rows"] == 0
    assert _times(spark, bronze) == [("A", 1), ("A", 2), ("A", 3)]
    assert not [f for f in os.listdir(bronze) if f.startswith("_load")]


def test_old_files_are_not_passed_over(spark, tree):
    raw, bronze, run = tree
    _csv(raw, "A", "new", [1])
    run()
    _csv(raw, "A", "old", [2])
    os.utime(raw / "A" / "1m" / "A-1m-old.csv", (1_000_000_000, 1_000_000_000))
    assert run()["rows"] == 1


def test_both_ways_of_ingestion_share_a_table(spark, tree):
    raw, bronze, run = tree
    _csv(raw, "A", "1", [1])
    run()
    plans.ingest(spark, str(raw), str(bronze), "2024-01-02")
    rows = sources.read_table(spark, str(bronze), BRONZE)
    assert sorted((r.open_time, r.ingestion_date) for r in rows.collect()) == [(1, date(2024, 1, 1)), (1, date(2024, 1, 2))]


def test_a_load_replaces_its_own_rows_only(spark, candles, tmp_path):
    path = str(tmp_path / "bronze")
    rows = conform(candles([{}, {}]), BRONZE, ingestion_date=F.lit(date(2024, 1, 1)))
    rows = rows.withColumn("fate", F.when(F.col("open_time") > 0, "stray").otherwise("kept"))
    for name in ("a-1", "a-11", "a-1"):
        assert tables.publish(rows, path, BRONZE_PARTITIONS, name) == {"kept": 1, "stray": 1}
    assert sources.read_table(spark, path, BRONZE).count() == 2


def test_members_of_one_archive_are_read_by_several_tasks(spark, tmp_path):
    members = {f"part{i}.csv": range(100 * i, 100 * i + 50) for i in range(6)}
    _zip(tmp_path, "A", "1", members)
    sources.register_archives(spark)
    scan = spark.read.format("kline_zip").option("splitBytes", 1).load(str(tmp_path))
    assert scan.rdd.getNumPartitions() == 6
    assert scan.filter("member = 'part3.csv'").count() == 1
    rows = sources.read_kline_archives(spark, str(tmp_path), by_member=True)
    assert sorted(r.open_time for r in rows.collect()) == sorted(t for m in members.values() for t in m)
    assert rows.select("symbol").distinct().first().symbol == "A"


def test_a_damaged_member_leaves_the_others(spark, tmp_path):
    from pyspark.sql import Observation

    _zip(tmp_path, "A", "1", {"a.csv": range(50), "b.csv": range(100, 150)})
    file = tmp_path / "A" / "1m" / "A-1m-1.zip"
    data = bytearray(file.read_bytes())
    data[60] ^= 0xFF  # inside the first member
    file.write_bytes(data)
    (tmp_path / "A" / "1m" / "A-1m-2.zip").write_bytes(b"")
    (tmp_path / "A" / "1m" / "_hidden.zip").write_bytes(b"")
    damaged = Observation()
    rows = sources.read_kline_archives(spark, str(tmp_path), by_member=True, damaged=damaged)
    assert sorted(r.open_time for r in rows.collect()) == list(range(100, 150))
    assert damaged.get["n"] == 2


def test_archives_are_written_by_tasks_and_appear_at_commit(spark, candles, tmp_path):
    day = candles([{"open_time": t * HOUR_US, "symbol": s} for s in ("A", "B") for t in range(0, 60, 5)])
    sources.write_archives(day, str(tmp_path))
    found = sorted(str(f.relative_to(tmp_path)) for f in tmp_path.rglob("*") if f.is_file())
    assert found == sorted(f"{s}/1m/{s}-1m-1970-01-0{d}.zip" for s in "AB" for d in (1, 2, 3))
    back = sources.read_kline_archives(spark, str(tmp_path))
    assert back.select(*RAW.names, "symbol").exceptAll(day.select(*RAW.names, "symbol")).isEmpty() and back.count() == 24
    with pytest.raises(Exception, match="without a symbol"):
        sources.write_archives(day.withColumn("symbol", F.lit("")), str(tmp_path / "none"))
    assert not [f for f in (tmp_path / "none").rglob("*") if f.is_file()]


def _bars(spark, rows):
    schema = "symbol STRING, timestamp BIGINT, open DOUBLE, high DOUBLE, low DOUBLE, close DOUBLE, volume DOUBLE"
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("timeframe", ["1H", "4H", "1D", "1W"])
def test_batches_of_bars_give_what_resampling_gives(spark, tmp_path, rows_of, timeframe):
    rows = []
    for i in range(400):
        empty = i % 7 == 0
        price = None if empty else float(i % 13)
        rows.append((f"S{i % 3}", (i * 37 % 400) * HOUR_US, price, price and price + 1, price, price, None if i % 5 == 0 else float(i)))
    rows.append(("none", 0, None, None, None, None, 3.0))
    path = str(tmp_path / "bars")
    for part in range(3):
        op.add_bars(spark, _bars(spark, rows[part::3]), path, timeframe)
    got = op.coarse_bars(sources.read_table(spark, path, op.BAR_STATES))
    assert rows_of(got) == rows_of(op.resample(_bars(spark, rows), timeframe))


def test_only_touched_months_are_read_and_written(spark, tmp_path):
    path = tmp_path / "bars"
    every = [(s, d * 10 * DAY_US, 1.0, 2.0, 0.5, 1.5, 1.0) for s in ("A", "B") for d in range(12)]
    op.add_bars(spark, _bars(spark, every), str(path), "1D")
    before = {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    op.add_bars(spark, _bars(spark, [("A", 45 * DAY_US, 1.0, 2.0, 0.5, 1.5, 1.0)]), str(path), "1D")
    kept = [f for f, t in before.items() if f.exists() and f.stat().st_mtime_ns == t]
    assert len(before) - len(kept) == 1
    table = sources.read_table(spark, str(path), op.BAR_STATES)
    batch = table.filter("symbol = 'A' AND month = '1970-02'")
    plan = tables.restrict(table, batch, ["symbol", "month"], ["symbol", "month"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(symbol" in plan and "(month" in plan.split("PartitionFilters")[1].split("]")[0]
    op.replace_bars(_bars(spark, [("A", 45 * DAY_US, 7.0, 7.0, 7.0, 7.0, 7.0)]), str(path), "1D")
    again = sources.read_table(spark, str(path), op.BAR_STATES).filter("symbol = 'A' AND month = '1970-02'")
    assert [r.open for r in op.coarse_bars(again).collect()] == [7.0]


def test_stored_gaps_give_the_source_interval(spark, candles, tmp_path):
    times = [0, 60, 120, 86_400 * 3, 86_400 * 3 + 61, 86_400 * 9 + 5]
    rows = candles([{"open_time": t * 1_000_000, "symbol": s} for s, k in (("A", 6), ("B", 2), ("C", 1)) for t in times[:k]])
    rows = rows.withColumn("date", utc_date("open_time"))
    path = str(tmp_path / "gaps")
    for part in ("open_time < 100000000", "date < '1970-01-02'", "date >= '1970-01-02'"):
        op.update_gaps(rows.filter(part), path)
        seen = rows.filter("date < '1970-01-02'") if "date >=" not in part else rows
        seen = rows.filter(part) if "open_time" in part else seen
        got = op.stored_interval(sources.read_table(spark, path, op.GAP_STATES)).collect()
        assert got == op.source_interval(seen).collect()
    assert op.stored_interval(sources.read_table(spark, path, op.GAP_STATES).filter("symbol = 'C'")).collect() == []


def test_the_jobs_share_the_gap_table(spark, tree, tmp_path):
    raw, bronze, run = tree
    (tmp_path / "meta.csv").write_text("symbol,name\nA,a\n")
    silver, gold, gaps = (str(tmp_path / layer) for layer in ("silver", "gold", "gaps"))
    for name, times in (("1", range(0, 600, 120)), ("2", range(600, 3000, 30))):
        _csv(raw, "A", name, [t * 1_000_000 for t in times])
        run()
        plans.refine(spark, str(bronze), silver, str(tmp_path / "meta.csv"), "2024-01-01", gaps)
        width = plans.aggregate(spark, silver, gold, "2024-01-01", bronze=str(bronze), gaps=gaps)
        assert width == plans.aggregate(spark, silver, gold, "2024-01-01", bronze=str(bronze))
    assert width == 30


def test_interleaved_files_are_hit_by_fewer_boxes(spark, tmp_path):
    rows = spark.range(20_000).select(
        F.lit("A").alias("symbol"),
        ((F.col("id") * 7919) % 20_000).alias("timestamp"),
        *[F.exp(F.col("id") % 997 / 100).alias(c) for c in ("open", "high", "low", "close")],
        F.lit(1.0).alias("volume"),
        F.lit(1).cast("bigint").alias("num_trades"),
        F.lit(date(2024, 1, 1)).alias("date"),
    )
    rows = rows.withColumn("close", F.when(F.col("timestamp") % 50 == 0, None).otherwise(F.col("close")))

    def hit(by):
        path = tmp_path / "-".join([by] if isinstance(by, str) else by)
        op.replace_partitions(rows, str(path), GOLD, ["symbol"])
        op.cluster(spark, str(path), GOLD, by=by, partitions=["symbol"], files=32)
        table = sources.read_table(spark, str(path), GOLD)
        assert table.exceptAll(rows.select(*GOLD.names)).isEmpty() and table.count() == 20_000
        files = 0
        for file in path.rglob("*.parquet"):
            groups = pq.ParquetFile(file).metadata
            ends = {}
            for g in range(groups.num_row_groups):
                for c in range(groups.num_columns):
                    column = groups.row_group(g).column(c)
                    if column.statistics and column.statistics.has_min_max:
                        ends.setdefault(column.path_in_schema, []).append((column.statistics.min, column.statistics.max))
            inside = min(a for a, _ in ends["close"]) <= 2.0 and max(b for _, b in ends["close"]) >= 1.0
            files += inside
        return files

    assert 2 * hit(["timestamp", "close"]) <= hit("timestamp")
    shutil.rmtree(tmp_path / "timestamp")


def test_states_reject_the_bars_as_they_are(spark):
    with pytest.raises(ValueError, match="timeframe"):
        rollup.bar_states(_bars(spark, []), "1m")


BOUND = "date = DATE '2024-01-10'"
MANY = " AND ".join(f"close <> {i}.5" for i in range(40))


@pytest.mark.parametrize(
    "sql, bounded",
    [
        (f"SELECT * FROM gold_ohlcv WHERE {MANY} AND symbol = 'A' AND {BOUND}", True),
        (f"SELECT * FROM gold_ohlcv WHERE {MANY} AND {BOUND}", False),
        (f"SELECT s FROM (SELECT symbol AS s, date AS d FROM gold_ohlcv) WHERE 'A' = s AND d BETWEEN '2024-01-01' AND '2024-01-02'", True),
        (f"SELECT high FROM gold_ohlcv WHERE symbol = 'A' AND {BOUND} UNION ALL SELECT low FROM gold_ohlcv WHERE {BOUND}", False),
        (f"SELECT (SELECT max(high) FROM gold_ohlcv) FROM gold_ohlcv WHERE symbol = 'A' AND {BOUND}", False),
        (f"SELECT (SELECT max(high) FROM gold_ohlcv WHERE symbol = 'A' AND {BOUND}) FROM gold_ohlcv WHERE symbol = 'A' AND {BOUND}", True),
        (f"SELECT a.high FROM gold_ohlcv a JOIN gold_ohlcv b USING (symbol, date) WHERE a.symbol = 'A' AND a.{BOUND}", True),
        (f"SELECT * FROM gold_ohlcv WHERE (symbol = 'A' OR symbol = 'B' AND high > 1) AND {BOUND}", True),
        (f"SELECT * FROM gold_ohlcv WHERE (symbol = 'A' OR high > 1) AND {BOUND}", False),
        (f"SELECT * FROM gold_ohlcv WHERE symbol >= 'A' AND {BOUND}", False),
        (f"SELECT max(high) FROM gold_ohlcv GROUP BY symbol, date HAVING symbol = 'A' AND {BOUND}", True),
    ],
)
def test_bounds_are_read_off_the_plan(spark, tmp_path, sql, bounded):
    path = str(tmp_path / "gold")
    row = [("A", 0, 1.0, 1.0, 1.0, 1.0, 1.0, 1, date(2024, 1, 10))]
    op.replace_partitions(spark.createDataFrame(row, GOLD), path, GOLD)
    sources.register_views(spark, gold=path)
    if bounded:
        plans.ask_sql(spark, sql, require=("symbol", "date"))
    else:
        with pytest.raises(ValueError, match="must bound"):
            plans.ask_sql(spark, sql, require=("symbol", "date"))
