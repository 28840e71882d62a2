"""Every query against its SQL in DuckDB, on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from checks.compare import rows_of
from checks.oracle import ORACLE
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    found = entry_point.queries()[name](spark, sf_dir)
    wanted = duck.sql(entry_point.oracle_sql()[name])
    assert sorted(found.columns) == sorted(wanted.columns)
    assert rows_of(found.columns, found.collect()) == rows_of(wanted.columns, wanted.fetchall())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
