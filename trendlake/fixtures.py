"""The statistics and reference roles, derived from generic tables.

``events``, ``lineitem``, ``customer``, ``nation`` and ``documents`` are plain
star-schema tables; the functions here shape them like raw statistics, category
lookups and reference documents, dirt included.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.operators.clean import add_ratios, cleanse, content_order, dedupe_latest

AS_OF = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)
JOB = "events_job"
# event_id decides between copies of a key.
TIE_BREAK = ("event_id",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def newest_event() -> list[Column]:
    return [F.col("event_id").desc()]


def _every(n: int) -> Column:
    return F.col("event_id") % n == 0


def stats_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the CSV layout: text columns, some malformed, absent or oddly cased."""
    user, value = F.col("user_id").cast("string"), F.col("value")
    hundredths = F.floor(value * 100).cast("string")
    return table(spark, sf_dir, "events").select(
        F.when(~_every(97), user).alias("video_id"),
        F.when(_every(101), F.lit("n/a"))
        .when(_every(3), F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.date_format("ts", "yy.dd.MM"))
        .alias("trending_date"),
        F.concat(F.lit("title "), user).alias("title"),
        F.concat(F.lit("ch"), (F.col("user_id") % 20).cast("string")).alias("channel_title"),
        F.get_json_object("props", "$.k").alias("category_id"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("publish_time"),
        F.lit("a|b").alias("tags"),
        F.when(_every(11), F.lit(None))
        .when(_every(17), F.lit("n/a"))
        .when(_every(19), F.concat(hundredths, F.lit(".5")))
        .otherwise(hundredths)
        .alias("views"),
        F.floor(value).cast("string").alias("likes"),
        (F.col("event_id") % 7).cast("string").alias("dislikes"),
        (F.col("event_id") % 13).cast("string").alias("comment_count"),
        F.lit(None).cast("string").alias("thumbnail_link"),
        F.when(_every(2), F.lit("True")).otherwise(F.lit("False")).alias("comments_disabled"),
        F.lit("False").alias("ratings_disabled"),
        F.when(_every(5), F.lit("maybe")).otherwise(F.lit("true")).alias("video_error_or_removed"),
        F.concat(F.lit('He said "'), F.col("event_type"), F.lit('",\nthen left')).alias("description"),
        F.concat(F.lit("  "), F.upper("event_type"), F.lit(" ")).alias("region"),
        "event_id",
    )


def stats_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the API layout: nested objects, counts as text, no trending date."""
    user = F.col("user_id").cast("string")
    return table(spark, sf_dir, "events").select(
        F.concat(user, F.lit("-"), F.col("event_id").cast("string")).alias("id"),
        F.struct(
            F.concat(F.lit("title "), user).alias("title"),
            F.concat(F.lit("ch"), (F.col("user_id") % 20).cast("string")).alias("channelTitle"),
            F.get_json_object("props", "$.k").alias("categoryId"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("publishedAt"),
            F.when(~_every(2), F.array(F.lit("a"), F.lit("b"))).alias("tags"),
            F.lit("text").alias("description"),
        ).alias("snippet"),
        F.struct(
            F.floor(F.col("value") * 100).cast("string").alias("viewCount"),
            F.floor("value").cast("string").alias("likeCount"),
            (F.col("event_id") % 13).cast("string").alias("commentCount"),
        ).alias("statistics"),
        F.col("event_type").alias("region"),
    )


def nation_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nation`` as reference rows: ids as text, several regions."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("snippet_title"),
        F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("region"),
    )


def stats_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` with its dimensions as canonical statistics rows (not yet cleansed).

    The join strategy is Spark's choice, by the size of the dimension files."""
    item, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    joined = (
        item.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    price = F.col("l_extendedprice")
    return joined.select(
        F.col("l_partkey").cast("string").alias("video_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("trending_date"),
        F.col("p_name").alias("title"),
        F.col("s_name").alias("channel_title"),
        F.col("p_size").cast("bigint").alias("category_id"),
        F.floor(price).alias("views"),
        F.floor(price * F.col("l_discount")).alias("likes"),
        F.floor("l_quantity").alias("dislikes"),
        F.col("l_linenumber").cast("bigint").alias("comment_count"),
        F.col("r_name").alias("region"),
    )


def silver_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = cleanse(stats_star(spark, sf_dir))
    measures = ("views", "likes", "dislikes", "comment_count", "channel_title")
    return add_ratios(dedupe_latest(clean, order_by=content_order(clean, measures)))


def _chunk(size: int) -> Column:
    return F.floor(F.col("c_custkey") / size).cast("bigint")


def reference_docs(spark: SparkSession, sf_dir: str, size: int = 50, dirty: bool = True) -> DataFrame:
    """``customer`` packed into JSON documents of ``size`` customers, ``(path, modified, value)``.

    Every fifth customer occurs twice, the later item renamed. Documents come in
    five shapes by number: whole, cut off, top-level list, no items, a single object.
    The region changes every third document, so a region has several documents. Without
    ``dirty`` all are whole.
    """
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    again = customers.where(F.col("c_custkey") % 5 == 0)
    copies = customers.withColumn("copy", F.lit(0)).unionByName(
        again.withColumn("copy", F.lit(1)).withColumn("c_name", F.concat("c_name", F.lit(" (new)")))
    )
    item = F.struct(
        F.lit("category").alias("kind"),
        F.col("c_custkey").cast("string").alias("id"),
        F.struct(
            F.col("c_mktsegment").alias("channelId"),
            F.col("c_name").alias("title"),
            (F.col("c_acctbal") > 0).alias("assignable"),
        ).alias("snippet"),
    )
    ordered = F.sort_array(F.collect_list(F.struct("copy", "c_custkey", item.alias("item"))))
    docs = copies.groupBy(_chunk(size).alias("n")).agg(F.transform(ordered, lambda x: x["item"]).alias("items"))
    whole = F.to_json(F.struct(F.lit("list").alias("kind"), "items"))
    shape = F.col("n") % 5 if dirty else F.lit(0)
    value = (
        F.when(shape == 1, F.expr("left(to_json(struct('list' as kind, items)), 40)"))
        .when(shape == 2, F.to_json("items"))
        .when(shape == 3, F.lit('{"kind":"list","items":[]}'))
        .when(shape == 4, F.to_json(F.col("items")[0]))
        .otherwise(whole)
    )
    number = F.col("n").cast("string")
    key = F.concat(
        F.lit("raw/region=r"), F.floor(F.col("n") / 3).cast("string"), F.lit("/doc+"), number, F.lit("%2Dx.json")
    )
    return docs.select(key.alias("path"), F.timestamp_seconds(F.col("n") * 60).alias("modified"), value.alias("value"))


def landed_docs(spark: SparkSession, sf_dir: str, size: int = 500) -> DataFrame:
    """``customer`` packed into one document per region, for landing as files."""
    item = F.to_json(
        F.struct(F.col("c_custkey").cast("string").alias("id"), F.struct(F.col("c_name").alias("title")).alias("snippet"))
    )
    grouped = table(spark, sf_dir, "customer").groupBy(F.concat(F.lit("r"), _chunk(size).cast("string")).alias("region"))
    items = F.array_join(F.sort_array(F.collect_list(item)), ",")
    return grouped.agg(F.concat(F.lit('{"items":['), items, F.lit("]}")).alias("value"))


def landing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object keys from ``documents``; one in ten has no region, some hold bad escapes."""
    doc_id = F.col("doc_id").cast("string")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("raw/doc+"), doc_id, F.lit(".json")))
        .when(F.col("doc_id") % 7 == 0, F.concat(F.lit("raw/region="), F.col("lang"), F.lit("=x/a%zz+"), doc_id))
        .otherwise(F.concat(F.lit("raw/region="), F.col("lang"), F.lit("/doc+%28"), doc_id, F.lit("%29.json")))
        .alias("raw_key"),
    )
