import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from trendlake.operators.clean import (
    cleanse,
    dedupe_latest,
    detect_layout,
    from_api_layout,
    from_csv_layout,
    null_to_zero,
    silver_statistics,
    to_canonical,
)
from trendlake.schemas import CANONICAL, STATS_CSV

AS_OF = dt.datetime(2024, 1, 31)


def csv_rows(spark, *rows):
    names = STATS_CSV.fieldNames()
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], STATS_CSV)


def test_csv_layout_types_and_malformed_values(spark):
    raw = csv_rows(
        spark,
        {"video_id": "v", "views": "10", "likes": "x", "category_id": "12.0", "comments_disabled": "True", "region": "ca"},
    )
    out = from_csv_layout(raw)
    assert {f.name: f.dataType.simpleString() for f in out.schema} == CANONICAL
    row = out.first()
    assert (row.views, row.likes, row.category_id, row.comments_disabled) == (10, None, 12, True)


DOTTED = {
    "id": "v1", "region": "ca", "snippet.title": "t", "snippet.channelTitle": "c", "snippet.categoryId": "10",
    "snippet.publishedAt": "p", "snippet.description": "d", "statistics.viewCount": "5", "statistics.likeCount": "1",
    "statistics.commentCount": "2",
}


@pytest.mark.parametrize("separator", [".", "__"])
def test_api_layout_flat_names_with_defaults(spark, separator):
    names = [n.replace(".", separator) for n in DOTTED]
    raw = spark.createDataFrame([tuple(DOTTED.values())], ", ".join(f"`{n}` string" for n in names))
    assert detect_layout(raw) == "api"
    out = to_canonical(raw, dt.date(2024, 3, 5))
    assert {f.name: f.dataType.simpleString() for f in out.schema} == CANONICAL
    row = out.first()
    assert (row.video_id, row.title, row.channel_title, row.category_id) == ("v1", "t", "c", 10)
    assert (row.views, row.likes, row.dislikes, row.comment_count) == (5, 1, 0, 2)
    assert (row.tags, row.thumbnail_link, row.comments_disabled, row.trending_date) == (None, None, False, "24.05.03")


def test_api_layout_structs(spark):
    raw = spark.createDataFrame(
        [("v", "us", (("t", "c", "1", "p", ["a", "b"], "d", (("u",),))), ("9", "3", "4", None))],
        "id string, region string, snippet struct<title string, channelTitle string, categoryId string, "
        "publishedAt string, tags array<string>, description string, thumbnails struct<default struct<url string>>>, "
        "statistics struct<viewCount string, likeCount string, dislikeCount string, commentCount string>",
    )
    row = to_canonical(raw).first()
    assert (row.tags, row.thumbnail_link, row.dislikes, row.comment_count) == ("a|b", "u", 4, None)
    assert len(row.trending_date) == 8  # today, short form


def test_api_layout_missing_field_is_an_error(spark):
    raw = spark.createDataFrame([("v", "t", "ca")], "id string, `snippet.title` string, region string")
    with pytest.raises(ValueError, match="snippet.channelTitle"):
        from_api_layout(raw)


def test_layout_detection(spark):
    assert detect_layout(csv_rows(spark, {"video_id": "v"})) == "csv"
    assert detect_layout(spark.createDataFrame([("t",)], "`snippet__title` string")) == "api"


def test_cleanse(spark):
    raw = csv_rows(
        spark,
        {"video_id": None, "region": "ca"},
        {"video_id": "v", "region": " CA ", "trending_date": "17.14.11", "views": "n/a", "likes": "3"},
    )
    (row,) = cleanse(from_csv_layout(raw)).collect()
    assert (row.region, row.trending_date_parsed, row.views, row.likes, row.dislikes) == (
        "ca", dt.date(2017, 11, 14), 0, 3, 0,
    )


def test_null_to_zero_takes_columns(spark):
    df = spark.createDataFrame([(None, None)], "a long, b long")
    assert null_to_zero(df, ["a"]).first() == (0, None)


def test_dedupe_keeps_null_keys_and_newest(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 2), ("a", "x", 5), ("b", None, 3)], "k string, r string, n int")
    out = dedupe_latest(df, ["k", "r"], [F.col("n").desc()])
    assert rows_of(out) == [("a", "x", 5), ("a", None, 2), ("b", None, 3)]


def test_dedupe_limits_every_key_before_the_shuffle(spark):
    plan = plan_of(dedupe_latest(spark.range(100).selectExpr("id % 3 k", "id n"), ["k"], [F.col("n").desc()]))
    assert plan.count("WindowGroupLimit") == 2
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(st.sampled_from("ab"), st.sampled_from(["ca", "us"]), st.integers(0, 2), st.integers(0, 3)),
        min_size=1,
        max_size=30,
    )
)
def test_silver_is_unique_and_independent_of_partitioning(spark, rows):
    raw = csv_rows(
        spark,
        *(
            {"video_id": v, "region": r, "trending_date": f"2024-01-0{d + 1}", "views": str(n), "title": f"t{n}"}
            for v, r, d, n in rows
        ),
    )
    keys = ["video_id", "region", "trending_date_parsed"]
    once = silver_statistics(raw, "job", AS_OF)
    again = silver_statistics(raw.repartition(3, "views"), "job", AS_OF)
    found = rows_of(once)
    assert found == rows_of(again)
    assert once.select(*keys).distinct().count() == len(found) == len({r[:3] for r in rows})
    best = {}
    for v, r, d, n in rows:
        best[v, r, d] = max(n, best.get((v, r, d), -1))
    assert {(r.video_id, r.region, r.trending_date_parsed.day - 1): r.views for r in once.collect()} == best


def test_silver_schema(spark):
    raw = csv_rows(spark, {"video_id": "v", "region": "ca", "trending_date": "17.14.11", "views": "10", "likes": "1"})
    out = silver_statistics(raw, "job", AS_OF)
    assert out.columns == [
        *CANONICAL, "trending_date_parsed", "like_ratio", "engagement_rate", "_processed_at", "_job_name",
    ]
    row = out.first()
    assert (row.like_ratio, row.engagement_rate, row._job_name, row._processed_at) == (10.0, 10.0, "job", AS_OF)
