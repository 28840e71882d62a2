"""The queries over the smallest given tables: against SQL where there is any, else that they run over all rows."""

import glob
import os

import duckdb
import pytest

from checks.compare import rows_of
from clickmart.llm.oracle import ORACLE
from clickmart.llm.queries import QUERIES


# What the rows of a query stand for, where it is not documents.
ROWS = {
    "op4_warc_archives": ("pages", "page_id"),
    "op11_conversation_repair": ("conversations", "conv_id"),
    "op13_source_divergence": ("documents", "lang", "source"),
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    found = QUERIES[name](spark, sf_dir)
    rows = found.collect()
    source, *keys = ROWS.get(name, ("documents", "doc_id"))
    wanted = duck.sql(f"SELECT {', '.join(keys)} FROM {source}").fetchall()
    assert {tuple(row[key] for key in keys) for row in rows} == set(wanted)
    if name in ORACLE:
        wanted = duck.sql(ORACLE[name])
        assert sorted(found.columns) == sorted(wanted.columns)
        assert rows_of(found.columns, rows) == rows_of(wanted.columns, wanted.fetchall())
