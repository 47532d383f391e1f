"""Every query with SQL against DuckDB on the smallest tables; every other one runs."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("set timezone = 'UTC'")
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    r = duck.execute(SQL[name])
    columns = [x[0] for x in r.description]
    assert sorted(columns) == sorted(df.columns)
    order = sorted(columns)
    got = Counter(tuple(plain(row[c]) for c in order) for row in df.collect())
    want = Counter(tuple(plain(row[columns.index(c)]) for c in order) for row in r.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns and df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
