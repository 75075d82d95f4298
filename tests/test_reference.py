import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from trendlake.operators.reference import (
    EMPTY,
    dedupe_last,
    explode_items,
    flatten,
    ingest_report,
    newest_per_region,
    parse_documents,
    silver_reference,
)
from trendlake.schemas import REFERENCE_ITEM, INGEST_REPORT
from trendlake.sources import read_reference_docs

T0 = dt.datetime(2024, 1, 1)


def item(id, title, **more):
    return {"kind": "k", "etag": "e", "id": id, "snippet": {"channelId": "U", "title": title, "assignable": True}, **more}


def docs(spark, *values, region="ca"):
    rows = [
        (f"raw/region={region}/d{i}.json", T0 + dt.timedelta(minutes=i), v if isinstance(v, str) else json.dumps(v))
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, "path string, modified timestamp, value string")


def report(spark, *values):
    return [(r.rows, r.error) for r in ingest_report(parse_documents(docs(spark, *values), False)).orderBy("key").collect()]


def test_report_schema(spark):
    assert ingest_report(parse_documents(docs(spark, {"id": "1"}), False)).schema == INGEST_REPORT


def test_document_shapes(spark):
    found = report(
        spark,
        {"kind": "list", "items": [item("1", "a"), item("2", "b")]},
        {"id": "1"},
        {"id": "1", "items": "not a list"},
        [{"id": "1"}, {"id": "2"}, {"id": "1"}],
    )
    assert found == [(2, None), (1, None), (1, None), (2, None)]


@pytest.mark.parametrize(
    "value, error",
    [
        ('{"items": [', "Not a JSON document"),
        ("", "Not a JSON document"),
        ("5", "Neither an object nor a list"),
        ("null", "Neither an object nor a list"),
        ('"items"', "Neither an object nor a list"),
        ('{"items": []}', EMPTY),
        ("{}", EMPTY),
        ("[]", EMPTY),
        ('{"items": [{}, {}]}', EMPTY),
        ('{"items": [1, {"id": "2"}]}', "Items are not all objects"),
        ('{"items": [null]}', "Items are not all objects"),
    ],
)
def test_bad_documents_are_reported_and_others_go_on(spark, value, error):
    assert report(spark, value, {"items": [item("1", "a")]}) == [(None, error), (1, None)]


def test_items_without_ids_are_kept_whole(spark):
    value = {"items": [{"snippet": {"title": "a"}}, {"snippet": {"title": "a"}}]}
    assert report(spark, value) == [(2, None)]
    parsed = parse_documents(docs(spark, value), False)
    assert dedupe_last(flatten(explode_items(parsed))).count() == 2
    assert parsed.first().missing_columns == ["id"]


def test_items_partly_without_ids_count_as_one_id(spark):
    value = {"items": [item("1", "a"), {"snippet": {"title": "b"}}, {"id": None, "snippet": {"title": "c"}}]}
    assert report(spark, value) == [(2, None)]
    rows = dedupe_last(flatten(explode_items(parse_documents(docs(spark, value), False))))
    assert rows_of(rows, "id", "snippet_title") == [("1", "a"), (None, "c")]


def test_dedupe_last_is_per_document(spark):
    value = {"items": [item("1", "old"), item("2", "x"), item("1", "new")]}
    rows = dedupe_last(flatten(explode_items(parse_documents(docs(spark, value, value), False))))
    assert rows_of(rows, "key", "id", "snippet_title") == [
        (f"raw/region=ca/d{i}.json", id, title) for i in (0, 1) for id, title in (("1", "new"), ("2", "x"))
    ]


def test_flatten_fixed_schema_ignores_unknown_fields(spark):
    items = explode_items(parse_documents(docs(spark, {"items": [item(7, "a", extra=1)]}), False))
    row = flatten(items, REFERENCE_ITEM).drop("key", "region", "pos", "has_id").first()
    assert row.asDict() == {
        "kind": "k", "etag": "e", "id": "7", "snippet_channelId": "U", "snippet_title": "a", "snippet_assignable": True,
    }


def test_flatten_discovers_fields(spark):
    value = {"items": [item("1", "a", extra={"deep": {"n": 1}}), item("2", "b", tags=["x"], none=None)]}
    rows = flatten(explode_items(parse_documents(docs(spark, value), False)), schema=None, separator=".")
    names = set(rows.columns) - {"key", "region", "pos", "has_id"}
    assert names == {
        "kind", "etag", "id", "snippet.channelId", "snippet.title", "snippet.assignable", "extra.deep.n", "tags", "none",
    }
    assert rows_of(rows, "id", "`extra.deep.n`", "tags") == [("1", 1, None), ("2", None, ["x"])]


def test_newest_usable_document_of_a_region_wins(spark):
    parsed = parse_documents(docs(spark, {"items": [item("1", "old")]}, {"items": [item("1", "new")]}, "{bad"), False)
    assert rows_of(newest_per_region(parsed), "key") == [("raw/region=ca/d1.json",)]
    row = silver_reference(parsed, dt.datetime(2024, 1, 2)).first()
    assert (row.id, row.snippet_title, row.region, row._source_file) == ("1", "new", "ca", "raw/region=ca/d1.json")
    assert row._ingestion_timestamp == dt.datetime(2024, 1, 2)


def test_region_defaults_to_unknown(spark):
    df = docs(spark, {"id": "1"}).withColumn("path", F.lit("raw/x.json"))
    assert silver_reference(parse_documents(df, False)).first().region == "unknown"


def test_read_files(spark, tmp_path):
    (tmp_path / "region=ca").mkdir()
    (tmp_path / "region=us").mkdir()
    pretty = json.dumps({"items": [item("1", "Film & Animation")]}, indent=1)
    (tmp_path / "region=ca" / "a b+c.json").write_text(pretty)
    (tmp_path / "region=us" / "u.json").write_text("{")
    found = {r.region: r for r in ingest_report(parse_documents(read_reference_docs(spark, str(tmp_path)))).collect()}
    assert found["ca"].rows == 1 and found["ca"].key.endswith("/region=ca/a b+c.json")
    assert found[None].error == "Not a JSON document"


def test_region_is_normalised_like_the_statistics(spark):
    parsed = parse_documents(docs(spark, {"items": [item("1", "a")]}, region="CA"), False)
    assert rows_of(silver_reference(parsed), "region") == [("ca",)]
