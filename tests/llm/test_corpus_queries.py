"""The registered corpus queries and the pipeline on the small tables."""

import collections

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from trendlake.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n in queries.queries() if n not in ("pipeline", "op12_collocations")])
def test_one_row_per_input_row(spark, name):
    table = "pages" if "html" in name else "documents"
    assert contract.queries()[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_exact_dedup_matches_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = duck.execute(queries.oracle_sql()["op10_exact_dedup"]).df()
    found = contract.queries()["op10_exact_dedup"](spark, SF).toPandas()[list(want.columns)]
    order = ["doc_id", "kept"]
    assert found.sort_values(order).values.tolist() == want.sort_values(order).values.tolist()


def test_stages(spark):
    """Each stage against what its operator says about that stage's own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    quality, exact, near, mixed, tokens = [f for _, f in corpus_pipeline.STAGES]
    good = quality(spark, docs, SF)
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    left = {r["doc_id"] for r in good.collect()}
    clean = [i for i, q in labels.items() if q == 1]
    assert good.columns == docs.columns and sum(i in left for i in clean) >= 0.98 * len(clean)
    one = exact(spark, good, SF)
    last = {}
    for r in good.collect():
        last[r["text"]] = max(r["doc_id"], last.get(r["text"], -1))
    assert {r["doc_id"] for r in one.collect()} == set(last.values())
    apart = near(spark, one, SF)
    assert apart.columns == docs.columns and 0 < apart.count() <= one.count()
    mix = mixed(spark, apart, SF)
    copies = collections.Counter(r["doc_id"] for r in mix.collect())
    assert mix.columns == docs.columns and max(copies.values()) <= 2
    out = tokens(spark, mix, SF)
    assert out.count() == sum(copies.values())


def test_run_is_registered(spark):
    assert contract.queries()["pipeline"](spark, SF).count() > 0 and corpus_pipeline.ORACLE_SQL is None
