"""Fields of objects found in one job, and what becomes of their names."""

import json

import pytest
from pyspark.sql import functions as F

from trendlake.operators import fields
from trendlake.operators.fields import discover_fields, example, paths_of
from trendlake.operators.reference import explode_items, flatten, parse_documents, silver_reference


def objects(spark, *values):
    rows = [(v if isinstance(v, str) else json.dumps(v),) for v in values]
    return spark.createDataFrame(rows, "text string").select(F.try_parse_json("text").alias("item"))


def test_type_texts_are_read():
    kind = "OBJECT<AVOID: STRING, `a.b`: OBJECT<`content-type`: VOID, x: ARRAY<OBJECT<k: BIGINT>>>, e: OBJECT<>, `we``ird <k>: y`: DECIMAL(2,1), z: ARRAY<BIGINT>>"
    assert list(paths_of(kind)) == [
        (("AVOID",), "STRING"), (("a.b",), None), (("a.b", "content-type"), "VOID"), (("a.b", "x"), "ARRAY<OBJECT<k: BIGINT>>"),
        (("e",), None), (("we`ird <k>: y",), "DECIMAL(2,1)"), (("z",), "ARRAY<BIGINT>"),
    ]


@pytest.mark.parametrize("kind", ["BIGINT", "DECIMAL(2,1)", "DECIMAL(3,3)", "DECIMAL(30,0)", "STRING", "ARRAY<BIGINT>", "ARRAY<VOID>", "DOUBLE"])
def test_examples_have_their_type(spark, kind):
    assert spark.range(1).select(F.schema_of_variant(F.parse_json(F.lit(example(kind))))).first()[0] == kind


VALUES = [
    {"id": 1, "a.b": {"content-type": None, "x": [1, {"k": 2}]}, "AVOID": "s", "n": 1.5, "deep": {"er": {"est": [1]}}},
    {"id": "2", "a.b": 5, "AVOID": {"z": True}, "n": 2, "e": {}, "list": [], "deep": {"er": {"est": [2.5]}}},
    '{"id": 3, "n": 123456789012345678901234567890, "list": null}',
]
WANT = {
    ("AVOID",): "STRING", ("AVOID", "z"): "BOOLEAN", ("a.b",): "BIGINT", ("a.b", "content-type"): "VOID", ("a.b", "x"): "ARRAY<VARIANT>",
    ("deep", "er", "est"): "ARRAY<DECIMAL(2,1)>", ("id",): "VARIANT", ("list",): "ARRAY<VOID>", ("n",): "DECIMAL(31,1)",
}


@pytest.mark.parametrize("shapes", [10_000, 0])
def test_mixed_fields(spark, monkeypatch, shapes):
    """By the driver, and where there are very many shapes by the tasks."""
    monkeypatch.setattr(fields, "MAX_KINDS", shapes)
    found = discover_fields(objects(spark, *VALUES))
    assert {p: k for p, k in found.items() if p != ("deep", "er", "est")} == {p: k for p, k in WANT.items() if p != ("deep", "er", "est")}
    assert found["deep", "er", "est"].startswith("ARRAY<DECIMAL")


def test_one_job_at_any_depth(spark):
    deep = {"v": 1}
    for _ in range(30):
        deep = {"in": deep}
    items = objects(spark, deep, *VALUES)
    spark.sparkContext.setJobGroup("fields", "fields")
    try:
        found = discover_fields(items)
        spark.sparkContext.setJobGroup("one", "one")
        fields._kinds_of(items, "item").limit(10).collect()
    finally:
        spark.sparkContext.setJobGroup("other", "other")
    assert ("in",) * 30 + ("v",) in found
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    assert len(jobs("fields")) <= len(jobs("one"))  # those of one collect


def test_objects_with_very_many_names_are_text(spark):
    items = objects(spark, *({"id": n, "by_id": {f"k{n}_{i}": {"x": i} for i in range(20)}} for n in range(10)))
    assert discover_fields(items, most=30) == {("by_id",): "VARIANT", ("id",): "BIGINT"}


def test_names_of_the_table_are_kept_apart(spark):
    value = {"items": [{"id": "1", "_source_file": "mine", "_ingestion_timestamp": "then", "region": "here", "snippet": {"title": "t"}}]}
    docs = spark.createDataFrame([("raw/region=ca/d.json", json.dumps(value))], "path string, value string")
    parsed = parse_documents(docs.withColumn("modified", F.current_timestamp()), False)
    row = silver_reference(parsed).first()
    assert (row["item__source_file"], row["item__ingestion_timestamp"], row["item_region"], row.region) == ("mine", "then", "here", "ca")
    assert row["_source_file"] == "raw/region=ca/d.json"
    assert "items" not in flatten(explode_items(parsed)).columns
