"""Every query with SQL gives the same rows as that SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from feedmill.plans.queries import ORACLE, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for f in os.listdir(SF):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return "null"
    if isinstance(x, (list, tuple)) or hasattr(x, "tolist") and getattr(x, "ndim", 0):
        return str([plain(v) for v in x])
    return str(round(float(x), 9)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, duck, name):
    got = QUERIES[name](spark, SF)
    want = duck.sql(ORACLE[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    a = sorted(tuple(plain(r[c]) for c in names) for r in got.collect())
    b = sorted(tuple(plain(v) for v in r) for r in want.project(", ".join(names)).fetchall())
    assert a == b


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_queries_without_sql_run(spark, name):
    assert QUERIES[name](spark, SF).count() >= 0
