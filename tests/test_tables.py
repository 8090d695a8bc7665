import os
import random

import pyarrow.parquet as pq
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from wickline.functions import DAY_US, utc_date
from wickline.operators import append, cluster, export_csv, tables, upsert
from wickline.schemas import GOLD, GOLD_KEYS
from wickline.sources import read_table, table_exists

PARTS = ["symbol", "date"]


def _bars(spark, rows):
    """rows: (symbol, timestamp, close)"""
    frame = spark.createDataFrame(rows, "symbol string, timestamp long, close double")
    return frame.selectExpr(
        "symbol", "timestamp", "close AS open", "close AS high", "close AS low", "close",
        "1.0D AS volume", "1L AS num_trades",
    ).withColumn("date", utc_date("timestamp"))


def _closes(spark, path):
    return {(r.symbol, r.timestamp): r.close for r in read_table(spark, path, GOLD).collect()}


def _files(path):
    return {
        os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
        for d, _, names in os.walk(path)
        for f in names
        if f.endswith(".parquet")
    }


def test_upsert_updates_inserts_and_leaves_other_partitions_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not table_exists(spark, path)
    upsert(spark, _bars(spark, [("A", 0, 1.0), ("A", 5, 2.0), ("A", DAY_US, 3.0), ("B", 0, 4.0)]),
           path, GOLD_KEYS, GOLD)
    untouched = {f: t for f, t in _files(path).items() if "symbol=B" in f or "1970-01-02" in f}
    assert len(untouched) == 2
    upsert(spark, _bars(spark, [("A", 5, 20.0), ("A", 6, 6.0), ("C", 0, 7.0)]), path, GOLD_KEYS, GOLD)
    assert _closes(spark, path) == {
        ("A", 0): 1.0, ("A", 5): 20.0, ("A", 6): 6.0, ("A", DAY_US): 3.0, ("B", 0): 4.0, ("C", 0): 7.0
    }
    assert untouched.items() <= _files(path).items()


def test_upsert_never_wipes_the_table_in_a_static_session(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    for rows in ([("A", 0, 1.0), ("B", 0, 2.0)], [("A", 0, 9.0)], []):
        upsert(spark, _bars(spark, rows), path, GOLD_KEYS, GOLD)
    cluster(spark, path, GOLD, dates=read_table(spark, path, GOLD).filter("symbol = 'A'"))
    assert _closes(spark, path) == {("A", 0): 9.0, ("B", 0): 2.0}


def test_symbols_that_look_like_numbers_stay_text(spark, tmp_path):
    path = str(tmp_path / "t")
    for close in (1.0, 2.0):
        upsert(spark, _bars(spark, [("007", 0, close), ("a b/c=d", 0, close)]), path, GOLD_KEYS, GOLD)
    assert _closes(spark, path) == {("007", 0): 2.0, ("a b/c=d", 0): 2.0}


@pytest.mark.parametrize("rows,message", [
    ([("A", 0, 1.0), ("A", 0, 2.0)], "several rows"),
    ([("A", None, 1.0)], "null"),
    ([(None, 0, 1.0)], "null"),
])
def test_upsert_rejects_bad_source_keys(spark, tmp_path, rows, message):
    with pytest.raises(ValueError, match=message):
        upsert(spark, _bars(spark, rows), str(tmp_path / "t"), GOLD_KEYS, GOLD)
    assert not table_exists(spark, str(tmp_path / "t"))


def test_partitions_between_the_touched_ones_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    old = [(s, d * DAY_US, 1.0) for s in "ABCDE" for d in range(5)]
    new = [(s, d * DAY_US + 1, 2.0) for s in "ACE" for d in (0, 2, 4)]
    upsert(spark, _bars(spark, old), path, GOLD_KEYS, GOLD)
    upsert(spark, _bars(spark, new), path, GOLD_KEYS, GOLD)
    assert _closes(spark, path) == {(s, t): c for s, t, c in old + new}


def test_upsert_reads_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, _bars(spark, [("A", 0, 1.0), ("B", DAY_US, 1.0)]), path, GOLD_KEYS, GOLD)
    batch = _bars(spark, [("A", 1, 1.0)])
    touched = tables.restrict(read_table(spark, path, GOLD), batch, PARTS, PARTS)
    plan = touched._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :]
    assert "symbol#" in filters and "date#" in filters
    # Small key sets also prune the folders between the smallest and the largest key.
    keys = str(tmp_path / "keys")
    batch.write.parquet(keys)
    touched = tables.restrict(read_table(spark, path, GOLD), spark.read.parquet(keys), PARTS, PARTS)
    assert "dynamicpruning" in touched._jdf.queryExecution().executedPlan().toString()


def test_first_load_of_unique_keys_is_written_once(spark, tmp_path, monkeypatch):
    def refuse(*_):
        raise AssertionError("staged")

    monkeypatch.setattr(tables, "staged", refuse)
    path = str(tmp_path / "t")
    upsert(spark, _bars(spark, [("A", 0, 1.0)]), path, GOLD_KEYS, GOLD, unique=True)
    assert _closes(spark, path) == {("A", 0): 1.0}


SMALL = settings(
    max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
ROWS = st.dictionaries(
    st.tuples(st.sampled_from("AB"), st.integers(0, 3), st.integers(0, 2)),
    st.integers(0, 99),
    min_size=1,
    max_size=12,
)


@SMALL
@given(first=ROWS, second=ROWS)
def test_upsert_is_a_keyed_merge_and_idempotent(spark, tmp_path_factory, first, second):
    path = str(tmp_path_factory.mktemp("upsert") / "t")

    def rows(batch):
        return [(s, day * DAY_US + t, float(c)) for (s, t, day), c in batch.items()]

    upsert(spark, _bars(spark, rows(first)), path, GOLD_KEYS, GOLD)
    for _ in range(2):
        upsert(spark, _bars(spark, rows(second)), path, GOLD_KEYS, GOLD, unique=True)
        want = {(s, t): c for s, t, c in rows(first) + rows(second)}
        assert _closes(spark, path) == want
    assert read_table(spark, path, GOLD).count() == len(want)


def _time_ranges(path):
    """Per table partition, the timestamps of each of its files in file order."""
    found = {}
    for f in _files(path):
        times = pq.ParquetFile(f).read(["timestamp"])["timestamp"].to_pylist()
        found.setdefault(os.path.dirname(f), []).append(times)
    return found


def test_cluster_compacts_and_orders_only_the_given_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    rng = random.Random(4)
    rows = [(s, d * DAY_US + t, 1.0) for s in "AB" for d in range(2) for t in range(50)]
    rng.shuffle(rows)
    for i in range(4):
        append(_bars(spark, rows[i::4]).select(*GOLD.names).repartition(3), path, PARTS)
    before = _files(path)
    first_day = _bars(spark, [("A", 0, 1.0)]).select("date")
    cluster(spark, path, GOLD, dates=first_day)
    after = _files(path)
    assert all(f in after for f in before if "1970-01-02" in f)
    assert not any(f in after for f in before if "1970-01-01" in f)
    for folder, files in _time_ranges(path).items():
        if "1970-01-01" in folder:
            assert len(files) == 1 and files[0] == sorted(files[0])
    assert set(_closes(spark, path)) == {(s, t) for s, t, _ in rows}


def test_cluster_cuts_a_hot_partition_into_disjoint_files(spark, tmp_path):
    path = str(tmp_path / "t")
    hot = [("HOT", t, 1.0) for t in range(4000)] + [("COLD", 0, 1.0)]
    append(_bars(spark, hot).select(*GOLD.names), path, PARTS)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cluster(spark, path, GOLD)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = next(v for k, v in _time_ranges(path).items() if "symbol=HOT" in k)
    ordered = sorted(files)
    assert len(files) > 3
    assert [t for f in ordered for t in f] == list(range(4000))


def test_upsert_with_order_writes_sorted_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [("A", t, 1.0) for t in range(200)]
    random.Random(5).shuffle(rows)
    upsert(spark, _bars(spark, rows[:120]), path, GOLD_KEYS, GOLD, order=["timestamp"])
    upsert(spark, _bars(spark, rows[120:]), path, GOLD_KEYS, GOLD, order=["timestamp"])
    ((files,)) = _time_ranges(path).values()
    assert [sorted(f) for f in files] == files and sum(map(len, files)) == 200


def test_staging_copies_are_dropped(spark, tmp_path):
    from wickline.session import scratch_path, staged

    with staged(_bars(spark, [("A", 0, 1.0)]), "probe") as batch:
        (file,) = {f.rsplit("/", 1)[0] for f in batch.inputFiles()}
        assert table_exists(spark, file) and batch.count() == 1
    assert not table_exists(spark, file)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_csv_export_is_in_time_order_with_a_header(spark, tmp_path):
    path = str(tmp_path / "csv")
    export_csv(_bars(spark, [("A", 2_000_000, 2.5), ("A", 1_000_000, 1.5)]), path)
    lines = []
    for part in sorted(p for p in os.listdir(path) if p.endswith(".csv")):
        with open(os.path.join(path, part)) as f:
            lines += [line for line in f.read().splitlines()]
    assert lines[0] == "symbol,timestamp,date,open,high,low,close,volume"
    assert [x for x in lines if not x.startswith("symbol")] == [
        "A,1970-01-01 00:00:01,1970-01-01,1.5,1.5,1.5,1.5,1.0",
        "A,1970-01-01 00:00:02,1970-01-01,2.5,2.5,2.5,2.5,1.0",
    ]
