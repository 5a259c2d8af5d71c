"""Every registered query against its SQL, on the smallest of the given data sets."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from rungworks.catalog.oracle import ORACLE
from rungworks.catalog.queries import QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    return connection


def _comparable(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    shown = [tuple(round(row[i], 6) if isinstance(row[i], float) else row[i] for i in order) for row in values]
    return sorted(names), sorted(shown, key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    ours = _comparable(got.columns, [tuple(r) for r in got.collect()])
    answer = duck.execute(ORACLE[name])
    theirs = _comparable([d[0] for d in answer.description], answer.fetchall())
    assert ours == theirs
    assert ours[1]


def test_every_query_has_sql_and_the_flagship_runs(spark):
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert not contract.entry(spark).isEmpty()
