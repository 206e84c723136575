"""Every query with SQL gives what DuckDB gives on the smallest tables; the others run."""

import glob
import math
import os

import duckdb
import pytest

from boutlens.plans import ORACLE, QUERIES

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return ""
    return f"{value:.6g}" if isinstance(value, float) else str(int(value)) if isinstance(value, bool) else str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([[plain(r[i]) for i in order] for r in data])


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    result = duck.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows(df.columns, df.collect()) == rows(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0
