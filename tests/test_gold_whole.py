"""Every column of the gold tables of whole and incremental runs, and the details of the quality summary."""

import json

import duckdb
import pytest

import __spark_entry__ as contract
from test_queries import SF, TABLES
from trendlake.operators import quality

ROWS = {
    "trending_analytics": contract._TRENDING,
    "channel_analytics": f"SELECT *, {contract._RANK} FROM channels",
    "category_analytics": contract._CATEGORY,
}
LEFT_OUT = {"view_share_pct", "categories", "avg_engagement_rate", "avg_like_ratio", "avg_views_per_video"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def _plain(row):
    tidy = lambda v: round(v, 6) if isinstance(v, float) else "|".join(sorted(v)) if isinstance(v, list) else v
    return tuple(map(tidy, row))


@pytest.mark.parametrize("query", ["pipeline_end_to_end", "pipeline_incremental"])
def test_gold_tables_in_full(spark, duck, monkeypatch, query):
    monkeypatch.setattr(contract, "_gold_rows", lambda spark, root: root)
    root = getattr(contract, query)(spark, SF)
    tables = contract._GOLD_SQL.split("SELECT 'trending_analytics'")[0]
    compared = set()
    for name, rows in ROWS.items():
        result = duck.execute(tables + rows)
        columns = [d[0] for d in result.description]
        compared.update(columns)
        want = sorted(map(_plain, result.fetchall()), key=repr)
        table = contract.read_table(spark, f"{root}/gold/{name}")
        assert len(set(table.columns) - set(columns)) <= 1, (name, table.columns)  # the stamp
        assert sorted((_plain(r) for r in table.select(*columns).collect()), key=repr) == want, name
    assert LEFT_OUT < compared


def test_details_of_the_summary(spark):
    records = contract._records(spark, SF)
    details = json.loads(quality.summary(records).first()["details"])
    want = [{k: v for k, v in json.loads(x).items() if v is not None} for x in records.toJSON().collect()]
    order = lambda r: json.dumps(r, sort_keys=True)
    assert sorted(details, key=order) == sorted(want, key=order)
