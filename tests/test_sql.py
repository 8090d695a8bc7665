import pytest

from wickline.functions import utc_date
from wickline.operators import upsert
from wickline.plans import ask_sql
from wickline.plans.adhoc import ROW_CAP
from wickline.schemas import GOLD, GOLD_KEYS
from wickline.sources import register_views


@pytest.fixture(scope="module")
def gold(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("sql") / "gold")
    bars = spark.range(300).selectExpr(
        "concat('S', id % 3) AS symbol", "id * 3600000000 AS timestamp", "1.0D AS open",
        "1.0D AS high", "1.0D AS low", "cast(id AS double) AS close", "1.0D AS volume",
        "1L AS num_trades",
    )
    upsert(spark, bars.withColumn("date", utc_date("timestamp")), path, GOLD_KEYS, GOLD)
    register_views(spark, gold=path)
    return path


@pytest.mark.parametrize("sql,rows", [
    ("SELECT * FROM gold_ohlcv", 100),
    ("SELECT * FROM gold_ohlcv;", 100),
    ("SELECT * FROM gold_ohlcv LIMIT 7", 7),
    ("SELECT * FROM gold_ohlcv LIMIT 5000", 100),
    ("SELECT * FROM (SELECT * FROM gold_ohlcv LIMIT 3) UNION ALL SELECT * FROM gold_ohlcv", 100),
    ("WITH x AS (SELECT * FROM gold_ohlcv) SELECT count(*) FROM x", 1),
    ("SELECT 'DROP' AS `update` -- CREATE", 1),
    ("VALUES 1, 2", 2),
    ("SELECT 'reflect', 'it''s from csv.x' -- java_method(", 1),
    ("TABLE gold_ohlcv", 100),
])
def test_queries_run_under_the_cap(spark, gold, sql, rows):
    assert ask_sql(spark, sql, cap=ROW_CAP).count() == rows


def test_cap_can_be_changed_or_lifted(spark, gold):
    assert ask_sql(spark, "SELECT * FROM gold_ohlcv", cap=3).count() == 3
    assert ask_sql(spark, "SELECT * FROM gold_ohlcv", cap=None).count() == 300


def test_order_survives_the_cap(spark, gold):
    rows = ask_sql(spark, "SELECT close FROM gold_ohlcv ORDER BY close DESC", cap=3)
    assert [r.close for r in rows.collect()] == [299.0, 298.0, 297.0]
    assert "TakeOrderedAndProject" in rows._jdf.queryExecution().executedPlan().toString()


def test_named_parameters_are_bound_not_pasted(spark, gold):
    rows = ask_sql(
        spark, "SELECT count(*) AS n FROM gold_ohlcv WHERE symbol = :s", args={"s": "S1' OR '1'='1"}
    )
    assert rows.first().n == 0


@pytest.mark.parametrize("sql", [
    "", " ; ", "DROP VIEW gold_ohlcv", "DELETE FROM gold_ohlcv", "UPDATE gold_ohlcv SET close = 1",
    "INSERT INTO gold_ohlcv VALUES (1)", "FROM gold_ohlcv INSERT INTO x SELECT *",
    "CREATE TABLE x AS SELECT 1", "ALTER VIEW gold_ohlcv AS SELECT 1", "TRUNCATE TABLE gold_ohlcv",
    "MERGE INTO a USING b ON 1 = 1 WHEN MATCHED THEN DELETE", "SET spark.sql.ansi.enabled = false",
    "SELECT 1; SELECT 2", "SELECT 1); DROP VIEW gold_ohlcv; (SELECT 1", "EXPLAIN SELECT 1",
    "SELECT reflect('java.lang.System', 'getenv')", "SELECT `java_method`('java.lang.System', 'exit', 0)",
    "SELECT try_reflect('java.lang.System', 'getenv')",
])
def test_everything_but_a_query_is_refused(spark, gold, sql):
    with pytest.raises(Exception) as refused:
        ask_sql(spark, sql)
    assert refused.typename in ("ValueError", "ParseException")
    assert spark.table("gold_ohlcv").count() == 300


def test_files_are_not_readable_as_tables(spark, gold):
    for path in (f"parquet.`{gold}`", f"PARQUET . `{gold}`", f"`parquet`.`{gold}`", "gold_ohlcv, parquet.x",
                 f"IDENTIFIER('parquet.`{gold}`')", f"`org.apache.x.ParquetFileFormat`.`{gold}`"):
        with pytest.raises(ValueError, match="parquet|identifier"):
            ask_sql(spark, f"SELECT * FROM {path}")
    assert spark.sql(f"SELECT * FROM parquet.`{gold}`").count() == 300


def test_required_partition_filters(spark, gold):
    need = ("symbol", "date")
    good = "SELECT max(high) FROM gold_ohlcv WHERE symbol = 'S1' AND date = DATE '1970-01-02'"
    assert ask_sql(spark, good, require=need).count() == 1
    for also in ("symbol IN ('S1', 'S2') AND date BETWEEN DATE '1970-01-02' AND DATE '1970-01-03'",
                 "symbol = 'S1' AND date > DATE '1970-01-02' AND date <= DATE '1970-01-03'"):
        assert ask_sql(spark, f"SELECT max(high) FROM gold_ohlcv WHERE {also}", require=need).count() == 1
    for bad in ("SELECT 1 FROM gold_ohlcv WHERE symbol IS NOT NULL AND date IS NOT NULL",
                "SELECT 1 FROM gold_ohlcv WHERE symbol = 'S1' AND date >= DATE '1970-01-02'",
                "SELECT 1 FROM gold_ohlcv WHERE symbol != 'S1' AND date = DATE '1970-01-02'",
                "SELECT 1 FROM gold_ohlcv WHERE (symbol = 'S1' OR high > 0) AND date = DATE '1970-01-02'",
                "SELECT 1 FROM gold_ohlcv", "SELECT 1 FROM gold_ohlcv WHERE symbol = 'S1'",
                f"{good} UNION ALL SELECT max(high) FROM gold_ohlcv WHERE date = DATE '1970-01-02'"):
        with pytest.raises(ValueError, match="symbol, date"):
            ask_sql(spark, bad, require=need)
