"""Every registered query that has a SQL twin returns the same rows as DuckDB, on the smallest tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__
from cartolex.plans.registry import ORACLES, QUERIES

TABLES = os.environ.get("CARTOLEX_TEST_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in os.listdir(TABLES):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{TABLES}/{name}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, list | tuple):
        return str([plain(v) for v in value])
    return str(value)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, TABLES)
    columns = sorted(df.columns)
    got = sorted("|".join(plain(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted("|".join(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_other_queries_return_rows(spark, name):
    assert QUERIES[name](spark, TABLES).count() > 0


def test_entry(spark):
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    if os.path.isdir("/root/testdata/sf0.001"):
        assert __spark_entry__.entry(spark).count() == 7
