"""Every registered query against its SQL in DuckDB, on whole tables."""

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    corpus = set(contract.corpus_queries.queries()) if contract.corpus_queries else set()
    assert set(contract.queries()) - corpus == set(contract.oracle_sql()) - corpus


def test_entry(spark):
    assert contract.entry(spark).count() == 10


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    result = contract.queries()[name](spark, SF)
    columns = sorted(result.columns)
    expected = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == columns
    where = [names.index(c) for c in columns]
    want = sorted((tuple(row[i] for i in where) for row in expected.fetchall()), key=repr)
    assert sorted((tuple(row[c] for c in columns) for row in result.collect()), key=repr) == want
    assert want
