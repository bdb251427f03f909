"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest
from conftest import TESTDATA

import __spark_entry__ as registered

SF_DIR = f"{TESTDATA}/sf0.001"
QUERIES, SQL = registered.own_queries(), registered.own_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        view = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{SF_DIR}/{file}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("query", QUERIES)
def test_query(spark, duck, query):
    df = QUERIES[query](spark, SF_DIR)
    shown = df._jdf.queryExecution().toString()
    assert not any(node in shown for node in ("CartesianProduct", "NestedLoop", "Python"))
    columns = sorted(df.columns)
    got = sorted(tuple(map(plain, row)) for row in df.select(*[f"`{c}`" for c in columns]).collect())
    result = duck.execute(f"SELECT * FROM ({SQL[query]})")
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = sorted(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    assert got == expected


def test_entry(spark):
    assert registered.entry(spark).count() > 0
