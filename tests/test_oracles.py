"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = [name[: -len(".parquet")] for name in sorted(os.listdir(SF_DIR))] if os.path.isdir(SF_DIR) else []


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def _comparable(rows, columns, names):
    order = [columns.index(name) for name in names]
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, SF_DIR)
    rows = df.collect()
    assert rows
    if name in oracle_sql():
        found = duck.sql(oracle_sql()[name])
        names = sorted(df.columns)
        assert sorted(found.columns) == names
        assert _comparable(rows, df.columns, names) == _comparable(found.fetchall(), found.columns, names)


def _plain(value):
    return float(value) if isinstance(value, (int, bool)) else value


def test_entry(spark):
    assert entry(spark).columns == ["RIGSTATE", "n"]
