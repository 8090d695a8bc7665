"""Every registered query against DuckDB on the smallest test tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from catalog.queries import ORACLE, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("events", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _normal(rows):
    def value(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        return repr(float(v)) if isinstance(v, float) else str(v)

    return sorted(tuple(value(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_oracle(spark, duck, name):
    got = entry_point.queries()[name](spark, SF_DIR)
    want = duck.sql(entry_point.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    rows = _normal(got.select(*columns).collect())
    assert rows == _normal(want.select(*[f'"{c}"' for c in columns]).fetchall())
    assert rows


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) <= set(entry_point.oracle_sql())


def test_entry_runs(spark):
    assert entry_point.entry(spark).count() > 0
