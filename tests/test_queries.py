"""Every registered query against its SQL text, on the smallest test tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from chatprep.plans.oracle import ORACLE
from chatprep.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    con = duckdb.connect()
    for name in sorted(os.listdir(FOLDER)):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(oracle_sql()) <= set(queries()) and set(QUERIES) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 1


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_as_sql(spark, database, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(repr([r[c] for c in columns]) for r in df.collect())
    result = database.execute(ORACLE[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = sorted(repr([r[names.index(c)] for c in columns]) for r in result.fetchall())
    assert got == want
    assert got
