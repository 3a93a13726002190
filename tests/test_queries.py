"""Every registered query against the same SQL in DuckDB."""

import os
import sys
from collections import Counter

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_module  # noqa: E402
from queries import QUERIES  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.sql(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def comparable(found):
    return Counter(tuple("~" if v is None else repr(v) for v in row) for row in found)


@pytest.mark.parametrize("name", entry_module.oracle_sql())
def test_query(spark, duck, name):
    df = entry_module.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    want = duck.sql(entry_module.oracle_sql()[name])
    assert sorted(want.columns) == columns
    want = want.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall()
    assert comparable(df.select(*columns).collect()) == comparable(want)
    assert want


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
    assert entry_module.queries().keys() >= entry_module.oracle_sql().keys() >= QUERIES.keys()
