import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from trendlake.operators import gold
from trendlake.operators.enrich import attach_category, build_lookup
from trendlake.operators.ranking import rank_within, share_within

DAY = dt.date(2024, 1, 1)
SCHEMA = (
    "video_id string, channel_title string, category_id long, region string, trending_date_parsed date, views long, "
    "likes long, dislikes long, comment_count long, like_ratio double, engagement_rate double"
)


def silver(spark):
    return spark.createDataFrame(
        [
            ("v1", "c1", 23, "ca", DAY, 100, 10, 1, 2, 10.0, 13.0),
            ("v1", "c1", 23, "ca", dt.date(2024, 1, 2), 300, 30, 1, 2, 10.0, 11.0),
            ("v1", "c1", 34, "ca", dt.date(2024, 1, 3), 50, 5, 0, 0, 10.0, 10.0),
            ("v2", "c1", 99, "ca", DAY, 50, 0, 0, 0, 0.0, 0.0),
            ("v3", "c2", 23, "ca", DAY, 450, 9, 0, 0, 2.0, 2.0),
            ("v4", None, None, "us", None, 0, 0, 0, 0, 0.0, 0.0),
        ],
        SCHEMA,
    )


def lookup(spark):
    return spark.createDataFrame([(23, "Comedy"), (34, "Comedy")], "category_id long, category_name string")


def test_build_lookup_variants(spark):
    flat = spark.createDataFrame([("1", "b", "us"), ("1", "a", "ca"), ("x", "n", "ca"), ("2", None, "ca"), ("2", "z", "us")],
                                 "id string, snippet_title string, region string")
    assert rows_of(build_lookup(flat)) == [(1, "a"), (2, "z")]
    dotted = flat.withColumnRenamed("snippet_title", "snippet.title")
    assert rows_of(build_lookup(dotted)) == [(1, "a"), (2, "z")]
    nested = flat.select("id", "region", F.struct(F.col("snippet_title").alias("title")).alias("snippet"))
    assert rows_of(build_lookup(nested)) == [(1, "a"), (2, "z")]
    assert build_lookup(flat.drop("id")) is None
    assert build_lookup(flat.drop("snippet_title")) is None


def test_attach_category(spark):
    out = attach_category(silver(spark), lookup(spark))
    assert out.count() == 6
    assert {r.category_id: r.category_name for r in out.collect()} == {
        23: "Comedy", 34: "Comedy", 99: "Unknown", None: "Unknown",
    }
    assert "BroadcastHashJoin" in plan_of(out)


def test_attach_category_without_lookup(spark):
    assert {r[0] for r in attach_category(silver(spark)).select("category_name").collect()} == {"Unknown"}


def test_attach_category_text_ids(spark):
    stats = silver(spark).withColumn("category_id", F.col("category_id").cast("string"))
    assert rows_of(attach_category(stats, lookup(spark))) == rows_of(attach_category(silver(spark), lookup(spark)))


def test_large_lookup_is_shuffled_not_broadcast(without_broadcast):
    spark = without_broadcast
    out = attach_category(silver(spark), lookup(spark), max_rows=1)
    assert "SortMergeJoin" in plan_of(out) and "Broadcast" not in plan_of(out)
    assert rows_of(out) == rows_of(attach_category(silver(spark), lookup(spark)))


def test_trending_analytics(spark):
    out = gold.trending_analytics(silver(spark)).where("region = 'ca'").orderBy("trending_date_parsed")
    row = out.first()
    assert row.asDict() == {
        "region": "ca", "trending_date_parsed": DAY, "total_videos": 3, "total_views": 600, "total_likes": 19,
        "total_dislikes": 1, "total_comments": 2, "avg_views_per_video": 200.0, "avg_like_ratio": 4.0,
        "avg_engagement_rate": 5.0, "max_views": 450, "unique_channels": 2, "unique_categories": 2,
    }


def test_trending_drops_the_unused_lookup_join(spark):
    ref = spark.createDataFrame([("23", "Comedy", "ca")], "id string, snippet_title string, region string")
    assert "Join" not in plan_of(gold.trending_analytics(attach_category(silver(spark), build_lookup(ref))))


def test_channel_analytics(spark):
    rows = {r.channel_title: r for r in gold.channel_analytics(attach_category(silver(spark), lookup(spark))).collect()}
    c1 = rows["c1"]
    # v1 changed its category: it is one video, under one name because both ids are called the same.
    assert (c1.total_videos, c1.total_views, c1.total_likes, c1.total_comments) == (2, 500, 45, 4)
    assert (c1.avg_views_per_video, c1.avg_engagement_rate, c1.peak_views, c1.times_trending) == (125.0, 8.5, 300, 4)
    assert (c1.first_trending, c1.last_trending) == (DAY, dt.date(2024, 1, 3))
    assert c1.categories == ["Comedy", "Unknown"]
    assert (c1.rank_in_region, rows["c2"].rank_in_region, rows[None].rank_in_region) == (1, 2, 1)
    assert (rows[None].times_trending, rows[None].first_trending) == (0, None)


def test_category_analytics(spark):
    out = gold.category_analytics(attach_category(silver(spark), lookup(spark)))
    found = {(r.category_name, r.category_id, r.region, r.trending_date_parsed): r for r in out.collect()}
    assert len(found) == 5
    comedy = found["Comedy", 23, "ca", DAY]
    assert (comedy.video_count, comedy.total_views, comedy.unique_channels, comedy.view_share_pct) == (2, 550, 2, 91.67)
    assert found["Unknown", 99, "ca", DAY].view_share_pct == 8.33
    assert found["Unknown", None, "us", None].view_share_pct is None  # nothing viewed at all


def test_top_channels_ignores_case_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("b", 5, 1, "ca"), ("a", 5, 1, "ca"), ("z", 9, 2, "ca"), ("q", 99, 1, "us")],
        "channel_title string, total_views long, times_trending long, region string",
    )
    top = gold.top_channels(df, " CA", 2)
    assert [r.channel_title for r in top.collect()] == ["z", "a"]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_channel_views_agrees_with_the_gold_table(spark):
    stats = attach_category(silver(spark), lookup(spark))
    columns = ["channel_title", "region", "total_views", "times_trending"]
    assert rows_of(gold.channel_views(stats), *columns) == rows_of(gold.channel_totals(stats), *columns)


@pytest.fixture
def skewed(spark):
    """Two thirds of the rows in one group, many ties, a null group."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 != 0, "hot").when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("g"), (F.col("id") % 7).cast("string"))).alias("region"),
        (F.col("id") * 7919 % 11).alias("views"),
        F.concat(F.lit("ch"), F.col("id").cast("string")).alias("title"),
    )


@pytest.mark.parametrize("broadcast", [True, False])
def test_rank_within_equals_a_window(spark, skewed, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr("trendlake.operators.ranking.broadcast_if_small", lambda df: df)
    order = [F.col("views").desc(), F.col("title").asc()]
    found = rank_within(skewed, ["region"], order, "rank")
    window = Window.partitionBy("region").orderBy(*order)
    assert rows_of(found) == rows_of(skewed.withColumn("rank", F.row_number().over(window)))


def test_rank_within_spreads_the_hot_group(spark, skewed):
    found = rank_within(skewed, ["region"], [F.col("views").desc(), F.col("title").asc()], "rank")
    plan = plan_of(found)
    assert "Exchange rangepartitioning" not in plan and "SortMergeJoin" not in plan  # already placed on disk


@pytest.mark.parametrize("broadcast", [True, False])
def test_share_within_equals_a_window(without_broadcast, skewed, broadcast, monkeypatch):
    if not broadcast:
        monkeypatch.setattr("trendlake.operators.ranking.broadcast_if_small", lambda df: df)
    found = share_within(skewed, "views", ["region"], "share")
    total = F.sum("views").over(Window.partitionBy("region"))
    assert rows_of(found) == rows_of(skewed.withColumn("share", F.round(F.col("views") / total * 100, 2)))
    assert ("BroadcastHashJoin" in plan_of(found)) == broadcast


def test_shares_add_up(spark):
    out = gold.category_analytics(attach_category(silver(spark), lookup(spark))).where("region = 'ca'")
    for row in out.groupBy("trending_date_parsed").agg(F.sum("view_share_pct").alias("s")).collect():
        assert abs(row.s - 100) < 0.05
