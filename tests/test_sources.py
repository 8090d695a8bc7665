import os
import zipfile

import pytest

from wickline.schemas import METADATA
from wickline.sources import (
    read_kline_archives,
    read_klines,
    read_metadata,
    read_raw,
    register_views,
    symbols,
)

LINE = "{t},1.5,2.5,0.5,2.0,10,{t},20,3,5,10,0"


def _lines(*times):
    return "\n".join(LINE.format(t=t) for t in times) + "\n"


def _write(root, symbol, resolution, day, text, zipped=False, name=None):
    folder = root / "raw" / symbol / resolution
    folder.mkdir(parents=True, exist_ok=True)
    stem = name or f"{symbol}-{resolution}-{day}"
    if zipped:
        with zipfile.ZipFile(folder / f"{stem}.zip", "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr(f"{stem}.csv", text)
    else:
        (folder / f"{stem}.csv").write_text(text)
    return folder


def _times(df):
    return sorted(((r.symbol, r.open_time) for r in df.collect()), key=repr)


@pytest.fixture
def raw(tmp_path):
    _write(tmp_path, "BTCUSDT", "1m", "2024-01-01", _lines(1, 2))
    _write(tmp_path, "BTCUSDT", "1m", "2024-01-02", _lines(3))
    _write(tmp_path, "BTCUSDT", "1s", "2024-01-01", _lines(4))
    _write(tmp_path, "ETHUSDT", "1m", "2024-01-01", _lines(5))
    _write(tmp_path, "ETHUSDT", "1m", "2024-01-03", _lines(6, 7), zipped=True)
    return str(tmp_path / "raw")


def test_csv_scan_takes_symbols_from_the_path(spark, raw):
    rows = read_klines(spark, raw)
    assert rows.columns[0] == "open_time" and rows.columns[-1] == "symbol"
    assert _times(rows) == [
        ("BTCUSDT", 1), ("BTCUSDT", 2), ("BTCUSDT", 3), ("BTCUSDT", 4), ("ETHUSDT", 5)
    ]


@pytest.mark.parametrize("scope,times", [
    ({"symbols": ["ETHUSDT"]}, [5]),
    ({"symbols": ["ETHUSDT", "NONE"], "resolution": "1m"}, [5]),
    ({"resolution": "1s"}, [4]),
    ({"date_pattern": "2024-01-01"}, [1, 2, 4, 5]),
    ({"symbols": ["BTCUSDT"], "resolution": "1m", "date_pattern": "2024-01-0[12]"}, [1, 2, 3]),
])
def test_scope_is_a_filter_on_paths(spark, raw, scope, times):
    rows = read_klines(spark, raw, **scope)
    assert [t for _, t in _times(rows)] == times
    assert len(rows.inputFiles()) == len({t for t in times if t != 2})


def test_archives_give_the_same_rows_as_files(spark, raw):
    assert _times(read_kline_archives(spark, raw)) == [("ETHUSDT", 6), ("ETHUSDT", 7)]
    row = read_kline_archives(spark, raw).filter("open_time = 6").first()
    assert (row.open, row.close, row.num_trades, row.ignore) == (1.5, 2.0, 3, 0)
    assert [t for _, t in _times(read_raw(spark, raw))] == [1, 2, 3, 4, 5, 6, 7]


def test_an_extracted_archive_counts_once(spark, tmp_path):
    folder = _write(tmp_path, "A", "1m", "d1", _lines(1, 2), zipped=True)
    _write(tmp_path, "A", "1m", "d1", _lines(1, 2))
    (folder / "A-1m-d2.zip").write_bytes(b"this is no archive")
    _write(tmp_path, "A", "1m", "d2", _lines(3))
    assert [t for _, t in _times(read_raw(spark, str(tmp_path / "raw")))] == [1, 2, 3]


def test_damaged_archives_give_no_rows(spark, tmp_path):
    folder = _write(tmp_path, "A", "1m", "good", _lines(1), zipped=True)
    (folder / "junk.zip").write_bytes(b"junk")
    (folder / "empty.zip").write_bytes(b"")
    whole = (folder / "A-1m-good.zip").read_bytes()
    (folder / "cut.zip").write_bytes(whole[: len(whole) // 2])
    flipped = bytearray(whole)
    flipped[45] ^= 0xFF
    (folder / "flipped.zip").write_bytes(bytes(flipped))
    rows = read_kline_archives(spark, str(tmp_path / "raw"))
    assert _times(rows) == [("A", 1)]
    assert _times(read_raw(spark, str(tmp_path / "raw"))) == [("A", 1)]


def test_large_archives_stream_in_blocks_without_losing_lines(spark, tmp_path):
    _write(tmp_path, "A", "1s", "d", _lines(*range(60_000)).replace("\n", "\r\n"), zipped=True)
    rows = read_kline_archives(spark, str(tmp_path / "raw"))
    stats = rows.selectExpr("count(*) AS n", "count(DISTINCT open_time) AS d", "sum(ignore) AS s").first()
    assert tuple(stats) == (60_000, 60_000, 0)


@pytest.mark.parametrize("zipped", [False, True])
def test_malformed_lines_become_partial_nulls(spark, tmp_path, zipped):
    text = (
        "open_time,open,high,low,close,volume,a,b,c,d,e,f\n"
        + _lines(1)
        + "2,1.5,2.5\n"
        + LINE.format(t=3) + ",surplus\n"
        + LINE.format(t=4).replace("2.0", "price")
        + "\n" + LINE.format(t="") + "\n\n"
    )
    _write(tmp_path, "A", "1m", "d", text, zipped)
    rows = read_raw(spark, str(tmp_path / "raw")).collect()
    got = sorted(((r.open_time, r.open, r.close) for r in rows), key=repr)
    assert got == [(1, 1.5, 2.0), (2, 1.5, None), (3, 1.5, 2.0), (4, 1.5, None),
                   (None, 1.5, 2.0), (None, None, None)]


def test_symbol_folders_are_decoded(spark, tmp_path):
    _write(tmp_path, "BAD SYM+%", "1m", "d", _lines(1))
    _write(tmp_path, "BAD SYM+%", "1m", "e", _lines(2), zipped=True)
    assert _times(read_raw(spark, str(tmp_path / "raw"))) == [("BAD SYM+%", 1), ("BAD SYM+%", 2)]


def test_key_value_folders_are_read_too(spark, tmp_path):
    _write(tmp_path, "symbol=A", "resolution=1m", "d", _lines(1))
    _write(tmp_path, "symbol=B", "resolution=1s", "d", _lines(2))
    root = str(tmp_path / "raw")
    assert _times(read_klines(spark, root)) == [("A", 1), ("B", 2)]
    assert _times(read_klines(spark, root, symbols=["B"], resolution="1s")) == [("B", 2)]


def test_archive_listing_does_not_read_contents(spark, raw):
    from wickline.sources.raw import _archives

    plan = _archives(spark, raw, None, None, None, ".csv").select("stem")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "content" not in text.split("ReadSchema")[1]


def test_metadata_and_symbols(spark, tmp_path):
    path = tmp_path / "meta.csv"
    path.write_text("symbol,name\nB,Beta\nA,\n,Nobody\nB,Again\n")
    meta = read_metadata(spark, str(path))
    assert meta.columns == METADATA.names and meta.count() == 4
    assert [r.symbol for r in symbols(meta).collect()] == ["A", "B"]


def test_views_follow_the_tables(spark, tmp_path):
    from wickline.operators import ohlcv
    from wickline.plans import ask_sql
    from wickline.schemas import GOLD, GOLD_KEYS
    from wickline.operators import upsert

    path = str(tmp_path / "gold")
    bars = spark.createDataFrame(
        [("A", 0, 1.0, 1.0, 1.0, 1.0, 1.0, 1)],
        "symbol string, open_time long, open double, high double, low double, close double, "
        "volume double, num_trades long",
    )
    for n, moved in ((1, 0), (2, 60_000_000)):
        upsert(spark, ohlcv(bars.selectExpr("*").withColumn("open_time", bars.open_time + moved), 1),
               path, GOLD_KEYS, GOLD)
        register_views(spark, gold=path)
        assert ask_sql(spark, "SELECT count(*) AS n FROM gold_ohlcv").first().n == n
    assert os.path.isdir(path)


@pytest.mark.parametrize("base", ["raw/x", "plain"])
def test_symbols_are_taken_below_the_root_wherever_it_lies(spark, tmp_path, base):
    folder = tmp_path / base / "BTCUSDT" / "1m"
    folder.mkdir(parents=True)
    (folder / "BTCUSDT-1m-d.csv").write_text(_lines(1))
    with zipfile.ZipFile(folder / "e[1].zip", "w") as z:
        z.writestr("e.csv", _lines(2))
    for root in (str(tmp_path / base), f"file://{tmp_path / base}/"):
        assert _times(read_raw(spark, root)) == [("BTCUSDT", 1), ("BTCUSDT", 2)]


def test_archive_contents_pass_no_shuffle(spark, raw):
    from pyspark.sql import Observation

    from wickline.sources.raw import _archives

    plan = read_raw(spark, raw)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    damaged = Observation()
    assert read_raw(spark, raw, damaged=damaged).count() == 7
    assert damaged.get == {"n": 0}
    only = _archives(spark, raw, None, None, None, only=[r.path for r in _archives(spark, raw, None, None, None).collect()])
    assert only.count() == 1
