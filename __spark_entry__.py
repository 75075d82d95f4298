"""

Every query reads whole tables. Results that carry run times (``_processed_at``
and the like) leave them out, or fix them, so that they can be compared.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake import fixtures as fx
from trendlake.functions import (
    decode_key,
    engagement_rate,
    like_ratio,
    normalize_region,
    parse_mixed_date,
    region_from_key,
)
from trendlake.operators import gold, quality
from trendlake.operators.clean import cleanse, dedupe_latest, from_api_layout, from_csv_layout, null_to_zero, to_canonical
from trendlake.operators.clean import silver_statistics as build_silver
from trendlake.operators.enrich import attach_category, build_lookup
from trendlake.operators.reference import (
    dedupe_last,
    explode_items,
    flatten,
    ingest_report,
    parse_documents,
    silver_reference,
)
from trendlake.plans import run
from trendlake.schemas import CANONICAL
from trendlake.session import scratch_path
from trendlake.sinks import overwrite_partitions, write_partitioned
from trendlake.sources import (
    read_reference_docs,
    read_stats,
    read_stats_api,
    read_stats_csv,
    read_table,
    stream_reference_docs,
    stream_stats,
)
from trendlake.streaming import ingest_reference, ingest_stats
from trendlake.streaming.ingest import merge_latest

try:  # the corpus operators are optional: the rest works without their folder
    import corpus_pipeline  # noqa: F401
    from trendlake.llm import queries as corpus_queries
except ModuleNotFoundError:  # the folder, or a package that only it needs
    corpus_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
RUN_DATE = dt.date(2024, 1, 31)
STALE = dt.datetime(2024, 2, 10, tzinfo=dt.timezone.utc)
SILVER_OUT = [
    "video_id", "region", "trending_date_parsed", "title", "channel_title", "category_id", "views", "likes",
    "dislikes", "comment_count", "comments_disabled", "video_error_or_removed", "like_ratio", "engagement_rate",
]
# Columns of the gold tables that are compared whole.
GOLD_OUT = {
    "trending_analytics": ["region", "trending_date_parsed", "total_videos", "total_views", "total_likes", "total_dislikes",
                           "total_comments", "max_views", "unique_channels", "unique_categories"],
    "channel_analytics": ["region", "channel_title", "total_videos", "total_views", "total_likes", "total_comments", "peak_views",
                          "times_trending", "first_trending", "last_trending", "rank_in_region"],
    "category_analytics": ["region", "trending_date_parsed", "category_name", "category_id", "video_count", "total_views",
                           "total_likes", "total_comments", "unique_channels"],
}
RECORD_OUT = ["check", "table", "column", "value", "threshold", "passed", "message"]
REFERENCE_OUT = ["id", "kind", "snippet_channelId", "snippet_title", "snippet_assignable"]


# ── Shared steps ────────────────────────────────────────────────────────────


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    raw = fx.stats_raw(spark, sf)
    return build_silver(raw, fx.JOB, fx.AS_OF, order_by=fx.newest_event(), keep=fx.TIE_BREAK)


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return cleanse(from_csv_layout(fx.stats_raw(spark, sf), keep=fx.TIE_BREAK))


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return attach_category(_silver(spark, sf), build_lookup(fx.nation_reference(spark, sf)))


def _enriched_star(spark: SparkSession, sf: str) -> DataFrame:
    return attach_category(fx.silver_star(spark, sf), build_lookup(fx.nation_reference(spark, sf)))


def _land_csv(raw: DataFrame, root: str) -> None:
    landed = raw.drop("event_id").withColumn("region", normalize_region(F.col("region")))
    landed.write.partitionBy("region").option("quote", '"').option("escape", '"').option("header", True).csv(root)


def _checked(spark: SparkSession, sf: str) -> DataFrame:
    """Silver rows with gaps and stamps, for the checks."""
    silver = _clean(spark, sf)
    return silver.withColumns(
        {
            "title": F.when(F.col("event_id") % 10 != 0, F.col("title")),
            "views": F.when(F.col("event_id") % 1000 == 1, F.lit(-1))
            .when(F.col("event_id") % 1000 == 2, F.lit(60_000_000_000))
            .otherwise(F.col("views")),
            "_processed_at": F.to_timestamp("publish_time"),
        }
    )


# ── Queries ─────────────────────────────────────────────────────────────────


def csv_layout_cast(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "csv")
    _land_csv(fx.stats_raw(spark, sf), root)
    return from_csv_layout(read_stats_csv(spark, root))


def api_layout_flatten(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "api")
    fx.stats_api(spark, sf).write.partitionBy("region").json(root)
    return from_api_layout(read_stats_api(spark, root), RUN_DATE)


def region_pruned_scan(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "regions")
    _land_csv(fx.stats_raw(spark, sf), root)
    kept = read_stats_csv(spark, root, regions=["Click", "view"])
    return kept.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("video_id").alias("videos"))


def parse_mixed_date_query(spark: SparkSession, sf: str) -> DataFrame:
    day = F.col("l_shipdate")
    text = (
        F.when(F.col("l_linenumber") % 3 == 0, F.date_format(day, "yy.dd.MM"))
        .when(F.col("l_linenumber") % 3 == 1, F.date_format(day, "yyyy-MM-dd"))
        .when(F.col("l_linenumber") == 2, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(day, "dd/MM/yyyy"))
    )
    dates = fx.table(spark, sf, "lineitem").select(text.alias("trending_date"))
    parsed = dates.select("trending_date", parse_mixed_date(F.col("trending_date")).alias("parsed"))
    return parsed.groupBy("trending_date", "parsed").agg(F.count(F.lit(1)).alias("n"))


def normalize_region_query(spark: SparkSession, sf: str) -> DataFrame:
    return fx.stats_raw(spark, sf).select("event_id", normalize_region(F.col("region")).alias("region"))


def null_to_zero_query(spark: SparkSession, sf: str) -> DataFrame:
    raw = from_csv_layout(fx.stats_raw(spark, sf), keep=fx.TIE_BREAK)
    return null_to_zero(raw).select("event_id", "views", "likes", "dislikes", "comment_count")


def like_ratio_query(spark: SparkSession, sf: str) -> DataFrame:
    raw = null_to_zero(from_csv_layout(fx.stats_raw(spark, sf), keep=fx.TIE_BREAK))
    return raw.select("event_id", like_ratio().alias("like_ratio"))


def engagement_rate_query(spark: SparkSession, sf: str) -> DataFrame:
    raw = null_to_zero(from_csv_layout(fx.stats_raw(spark, sf), keep=fx.TIE_BREAK))
    return raw.select("event_id", engagement_rate().alias("engagement_rate"))


def dedupe_latest_query(spark: SparkSession, sf: str) -> DataFrame:
    rows = dedupe_latest(_clean(spark, sf), order_by=fx.newest_event())
    return rows.select("video_id", "region", "trending_date_parsed", "event_id")


def silver_statistics(spark: SparkSession, sf: str) -> DataFrame:
    return _silver(spark, sf).select(*SILVER_OUT)


def category_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Customers by market segment as reference rows: ids repeat over regions."""
    ref = fx.table(spark, sf, "customer").select(
        (F.col("c_custkey") % 700).cast("string").alias("id"),
        F.col("c_name").alias("snippet_title"),
        F.col("c_mktsegment").alias("region"),
    )
    return build_lookup(ref)


def attach_category_query(spark: SparkSession, sf: str) -> DataFrame:
    return _enriched(spark, sf).select("video_id", "region", "trending_date_parsed", "category_id", "category_name")


def attach_category_missing_lookup(spark: SparkSession, sf: str) -> DataFrame:
    rows = attach_category(_silver(spark, sf), None)
    return rows.select("video_id", "region", "trending_date_parsed", "category_id", "category_name")


def trending_analytics(spark: SparkSession, sf: str) -> DataFrame:
    return gold.trending_analytics(_enriched(spark, sf))


def channel_analytics(spark: SparkSession, sf: str) -> DataFrame:
    return gold.channel_analytics(_enriched(spark, sf))


def category_analytics(spark: SparkSession, sf: str) -> DataFrame:
    return gold.category_analytics(_enriched(spark, sf))


def top_channels(spark: SparkSession, sf: str) -> DataFrame:
    return gold.top_channels(gold.channel_views(_enriched(spark, sf)), "CLICK")


def star_trending_analytics(spark: SparkSession, sf: str) -> DataFrame:
    return gold.trending_analytics(_enriched_star(spark, sf))


def star_channel_analytics(spark: SparkSession, sf: str) -> DataFrame:
    return gold.channel_analytics(_enriched_star(spark, sf))


def star_category_analytics(spark: SparkSession, sf: str) -> DataFrame:
    return gold.category_analytics(_enriched_star(spark, sf))


def star_top_channels(spark: SparkSession, sf: str) -> DataFrame:
    return gold.top_channels(gold.channel_views(_enriched_star(spark, sf)), "Asia", 25)


def reference_explode(spark: SparkSession, sf: str) -> DataFrame:
    items = explode_items(parse_documents(fx.reference_docs(spark, sf), key_is_uri=False))
    return flatten(items).select("key", "region", F.col("pos").cast("bigint").alias("pos"), *REFERENCE_OUT)


def reference_dedupe_last(spark: SparkSession, sf: str) -> DataFrame:
    items = explode_items(parse_documents(fx.reference_docs(spark, sf, dirty=False), key_is_uri=False))
    return dedupe_last(flatten(items)).select("key", "region", "id", "snippet_title")


def reference_silver(spark: SparkSession, sf: str) -> DataFrame:
    rows = silver_reference(parse_documents(fx.reference_docs(spark, sf), key_is_uri=False), fx.AS_OF)
    return rows.select("region", "id", "snippet_title", "_source_file")


def reference_discovered_schema(spark: SparkSession, sf: str) -> DataFrame:
    items = explode_items(parse_documents(fx.reference_docs(spark, sf, dirty=False), key_is_uri=False))
    return flatten(items, separator=".").drop("pos", "has_id")


def reference_all_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Every field an item has, oddly named, nested and mixed ones included."""
    customers = fx.table(spark, sf, "customer")
    item = F.struct(
        F.col("c_custkey").cast("string").alias("id"),
        F.struct(F.col("c_name").alias("title")).alias("snippet"),
        F.col("c_mktsegment").alias("AVOID"),
        F.upper("c_name").alias("content-type"),
        F.struct(F.col("c_custkey").alias("a.b"), F.struct(F.col("c_nationkey").cast("bigint").alias("my key")).alias("deep")).alias("more"),
        F.array(F.col("c_custkey"), F.col("c_nationkey")).alias("pair"),
        F.when(F.col("c_custkey") % 3 == 0, F.col("c_nationkey")).alias("rare"),
    )
    docs = customers.groupBy(F.floor(F.col("c_custkey") / 50).alias("n")).agg(F.collect_list(item).alias("items"))
    docs = docs.select(
        F.concat(F.lit("raw/region=r/"), "n", F.lit(".json")).alias("path"), F.lit(fx.AS_OF).alias("modified"),
        F.to_json(F.struct("items")).alias("value"),
    )
    return flatten(explode_items(parse_documents(docs, key_is_uri=False))).drop("key", "pos", "has_id", "region")


def region_from_key_query(spark: SparkSession, sf: str) -> DataFrame:
    keys = fx.landing_keys(spark, sf).withColumn("key", decode_key(F.col("raw_key")))
    return keys.select("doc_id", "key", region_from_key(F.col("key")).alias("region"))


def reference_ingest_report(spark: SparkSession, sf: str) -> DataFrame:
    return ingest_report(parse_documents(fx.reference_docs(spark, sf), key_is_uri=False)).drop("missing_columns")


def dq_row_count(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_row_count(_checked(spark, sf), "clean_statistics").select(*RECORD_OUT)


def dq_null_pct(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_null_pct(_checked(spark, sf), "clean_statistics").select(*RECORD_OUT)


def dq_schema(spark: SparkSession, sf: str) -> DataFrame:
    """All records of a table that lacks two of the columns it should have, from one pass."""
    columns = ["video_id", "views", "no_such", "also_missing"]
    records = quality.check_table(_checked(spark, sf), "clean_statistics", as_of=fx.AS_OF, columns=columns)
    return records.select("check", "table", "column", "value", "threshold", "missing_columns", "passed")


def dq_value_range(spark: SparkSession, sf: str) -> DataFrame:
    records = quality.check_value_range(_checked(spark, sf), "clean_statistics")
    return records.select("check", "table", "column", "negative_count", "extreme_count", "passed", "message")


def _freshness(spark: SparkSession, sf: str, as_of: dt.datetime) -> DataFrame:
    records = quality.check_freshness(_checked(spark, sf), "clean_statistics", as_of=as_of)
    return records.select("check", "table", "latest_record", "cutoff", "passed", "message")


def dq_freshness(spark: SparkSession, sf: str) -> DataFrame:
    return _freshness(spark, sf, fx.AS_OF)


def dq_freshness_stale(spark: SparkSession, sf: str) -> DataFrame:
    return _freshness(spark, sf, STALE)


def _records(spark: SparkSession, sf: str) -> DataFrame:
    tables = {
        "clean_statistics": _checked(spark, sf),
        "clean_reference_data": fx.nation_reference(spark, sf),
        "absent": "no_such_table",
    }
    return quality.run_checks(spark, tables, as_of=fx.AS_OF)


def dq_run_checks(spark: SparkSession, sf: str) -> DataFrame:
    return _records(spark, sf).select("check", "table", "column", "value", "threshold", "passed")


def dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    return quality.summary(_records(spark, sf)).drop("details")


def dq_alerts(spark: SparkSession, sf: str) -> DataFrame:
    found = quality.alerts(_records(spark, sf))
    get = lambda path: F.get_json_object("message", path)
    return found.select("subject", *(get(f"$.{name}").alias(name) for name in ("check", "table", "column")))


def write_partitioned_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "silver")
    silver = _silver(spark, sf).select(*SILVER_OUT)
    for _ in range(2):  # the second run replaces, it does not double
        rows = write_partitioned(silver, path)
    back = read_table(spark, path).groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.sum("views").alias("views"))
    return back.withColumn("rows_written", F.lit(rows).cast("bigint"))


def overwrite_partitions_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "overwrite")
    rows = fx.table(spark, sf, "events").select("event_id", F.col("event_type").alias("region"), F.lit(1).alias("version"))
    overwrite_partitions(rows, path)
    second = rows.where(F.col("region").isin("click", "view")).withColumn("version", F.lit(2))
    overwrite_partitions(second, path)
    back = read_table(spark, path).groupBy("region", "version")
    return back.agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


def schema_evolution_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "evolve")
    rows = fx.table(spark, sf, "events").select("event_id", "value", F.col("event_type").alias("region"))
    overwrite_partitions(rows.drop("value"), path)
    overwrite_partitions(rows.where(F.col("region") == "error"), path)
    back = read_table(spark, path, merge_schema=True).groupBy("region")
    return back.agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("with_value"))


def stream_ingest_stats(spark: SparkSession, sf: str) -> DataFrame:
    source, target = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    checkpoint = scratch_path(spark, "stream-state")
    raw = fx.stats_raw(spark, sf)
    # Four folders in two batches; copies of a key fall into different ones.
    raw.withColumn("part", F.col("event_id") % 4).write.partitionBy("part").parquet(f"{source}/all")
    files = len(spark.read.parquet(f"{source}/all").inputFiles())
    reader = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", -(-files // 2)).option("recursiveFileLookup", True)
    stream = reader.parquet(f"{source}/all")
    ingest_stats(stream, f"{target}/silver", checkpoint, order_by=fx.newest_event(), keep=fx.TIE_BREAK)
    return read_table(spark, f"{target}/silver").select(*SILVER_OUT)


def stream_ingest_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Landed CSV files as a stream, one region partition per batch."""
    source, target = scratch_path(spark, "csv-in"), scratch_path(spark, "csv-out")
    _land_csv(fx.stats_raw(spark, sf), source)
    ingest_stats(stream_stats(spark, source, max_files_per_trigger=2), f"{target}/silver", scratch_path(spark, "csv-state"))
    kept = read_table(spark, f"{target}/silver")
    return kept.groupBy("video_id", "region", "trending_date_parsed").agg(F.count(F.lit(1)).alias("n"))


def stream_ingest_blank_regions(spark: SparkSession, sf: str) -> DataFrame:
    """Blank, null and number-like regions, in two batches of one day each time."""
    target = scratch_path(spark, "blank")
    region = F.element_at(F.array(F.lit(""), F.lit(None), F.lit("01"), F.lit(" 1 ")), (F.col("event_id") % 4 + 1).cast("int"))
    raw = fx.stats_raw(spark, sf).withColumns({"region": region, "video_id": F.col("event_id").cast("string")})
    for half in (0, 1):
        rows = to_canonical(raw.where(F.floor(F.col("event_id") / 4) % 2 == half), keep=fx.TIE_BREAK)
        merge_latest(cleanse(rows), f"{target}/silver", f"{target}/staging")
    return read_table(spark, f"{target}/silver").groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


def catalog_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Raw statistics registered in the catalog and read by name, pruned by region."""
    name = f"raw_{uuid.uuid4().hex}"
    raw = fx.stats_raw(spark, sf).withColumn("region", normalize_region(F.col("region")))
    write_partitioned(raw, scratch_path(spark, "catalog"), table=name)
    found = read_stats(spark, name, [" CLICK", "view"])
    return found.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("video_id").alias("videos"))


def stream_ingest_api(spark: SparkSession, sf: str) -> DataFrame:
    """API rows from a stream, on a run date given from outside."""
    source, target = scratch_path(spark, "api-in"), scratch_path(spark, "api-out")
    fx.stats_api(spark, sf).write.partitionBy("region").json(source)
    ingest_stats(stream_stats(spark, source, layout="api"), f"{target}/silver", scratch_path(spark, "api-state"), run_date=RUN_DATE)
    kept = read_table(spark, f"{target}/silver")
    return kept.groupBy("video_id", "region", "trending_date_parsed").agg(F.count(F.lit(1)).alias("n"))


def stream_ingest_reference(spark: SparkSession, sf: str) -> DataFrame:
    source, target = scratch_path(spark, "docs-in"), scratch_path(spark, "docs-out")
    fx.landed_docs(spark, sf).write.partitionBy("region").text(f"{source}/raw")
    stream = stream_reference_docs(spark, f"{source}/raw")
    ingest_reference(stream, f"{target}/silver", scratch_path(spark, "docs-state"), f"{target}/report")
    return read_table(spark, f"{target}/silver").select("region", "id", "snippet_title")


def reference_files_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    root = f"{scratch_path(spark, 'docs')}/raw"
    fx.landed_docs(spark, sf).write.partitionBy("region").text(root)
    rows = silver_reference(parse_documents(read_reference_docs(spark, root)), fx.AS_OF)
    return rows.select("region", "id", "snippet_title")


def _pipeline_docs(spark: SparkSession, sf: str) -> DataFrame:
    return fx.landed_docs(spark, sf).select(
        F.concat(F.lit("raw/region="), "region", F.lit("/a.json")).alias("path"), F.lit(fx.AS_OF).alias("modified"), "value"
    )


def pipeline_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "pipeline")
    docs = _pipeline_docs(spark, sf)
    run(fx.stats_raw(spark, sf), docs, root, fx.JOB, fx.AS_OF, fx.newest_event(), fx.TIE_BREAK)
    return _gold_rows(spark, root)


def _gold_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the three gold tables, as (tbl, row as text without the stamp)."""
    parts = []
    for name, columns in GOLD_OUT.items():
        rows = read_table(spark, f"{root}/gold/{name}")
        parts.append(rows.select(F.lit(name).alias("tbl"), F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]).alias("line")))
    return parts[0].union(parts[1]).union(parts[2])


def pipeline_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The events in three runs over one root, the last run twice: the same gold as in one run."""
    root = scratch_path(spark, "incremental")
    docs = _pipeline_docs(spark, sf)
    raw = fx.stats_raw(spark, sf)
    for part in (0, 1, 2, 2):
        rows = raw.where(F.col("event_id") % 3 == part)
        run(rows, docs, root, fx.JOB, fx.AS_OF, fx.newest_event(), fx.TIE_BREAK)
    return _gold_rows(spark, root)


def pipeline_empty_input(spark: SparkSession, sf: str) -> DataFrame:
    """A first run without rows ends quietly; the next one builds gold as ever."""
    root = scratch_path(spark, "empty")
    raw = fx.stats_raw(spark, sf)
    for rows in (raw.where("event_id is null"), raw):
        run(rows, _pipeline_docs(spark, sf), root, fx.JOB, fx.AS_OF, fx.newest_event(), fx.TIE_BREAK)
    return _gold_rows(spark, root)


def pipeline_bad_documents(spark: SparkSession, sf: str) -> DataFrame:
    """A run with broken documents ends well and says which they were."""
    root = scratch_path(spark, "bad")
    run(fx.stats_raw(spark, sf), fx.reference_docs(spark, sf), root, fx.JOB, fx.AS_OF, fx.newest_event(), fx.TIE_BREAK)
    report = spark.read.parquet(f"{root}/reports/reference").where("error is not null").select("key", "error")
    alerts = spark.read.json(f"{root}/alerts").select(F.get_json_object("message", "$.key").alias("key"), F.lit(True).alias("alerted"))
    return report.join(alerts, "key", "left").withColumn("alerted", F.coalesce("alerted", F.lit(False)))


def entry(spark: SparkSession) -> DataFrame:
    """The ten most viewed channels of a region, from raw rows."""
    return _utc(top_channels)(spark, SMOKE_DIR)


def _utc(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run_in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    return run_in_utc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "csv_layout_cast": csv_layout_cast,
        "api_layout_flatten": api_layout_flatten,
        "region_pruned_scan": region_pruned_scan,
        "parse_mixed_date": parse_mixed_date_query,
        "normalize_region": normalize_region_query,
        "null_to_zero": null_to_zero_query,
        "like_ratio": like_ratio_query,
        "engagement_rate": engagement_rate_query,
        "dedupe_latest": dedupe_latest_query,
        "silver_statistics": silver_statistics,
        "category_lookup": category_lookup,
        "attach_category": attach_category_query,
        "attach_category_missing_lookup": attach_category_missing_lookup,
        "trending_analytics": trending_analytics,
        "channel_analytics": channel_analytics,
        "category_analytics": category_analytics,
        "top_channels": top_channels,
        "star_trending_analytics": star_trending_analytics,
        "star_channel_analytics": star_channel_analytics,
        "star_category_analytics": star_category_analytics,
        "star_top_channels": star_top_channels,
        "reference_explode": reference_explode,
        "reference_dedupe_last": reference_dedupe_last,
        "reference_silver": reference_silver,
        "reference_discovered_schema": reference_discovered_schema,
        "reference_files_roundtrip": reference_files_roundtrip,
        "region_from_key": region_from_key_query,
        "reference_ingest_report": reference_ingest_report,
        "dq_row_count": dq_row_count,
        "dq_null_pct": dq_null_pct,
        "dq_schema": dq_schema,
        "dq_value_range": dq_value_range,
        "dq_freshness": dq_freshness,
        "dq_freshness_stale": dq_freshness_stale,
        "dq_run_checks": dq_run_checks,
        "dq_summary": dq_summary,
        "dq_alerts": dq_alerts,
        "write_partitioned_roundtrip": write_partitioned_roundtrip,
        "overwrite_partitions_roundtrip": overwrite_partitions_roundtrip,
        "schema_evolution_roundtrip": schema_evolution_roundtrip,
        "stream_ingest_stats": stream_ingest_stats,
        "stream_ingest_csv": stream_ingest_csv,
        "stream_ingest_reference": stream_ingest_reference,
        "reference_all_fields": reference_all_fields,
        "stream_ingest_api": stream_ingest_api,
        "catalog_roundtrip": catalog_roundtrip,
        "stream_ingest_blank_regions": stream_ingest_blank_regions,
        "pipeline_incremental": pipeline_incremental,
        "pipeline_bad_documents": pipeline_bad_documents,
        "pipeline_empty_input": pipeline_empty_input,
        "pipeline_end_to_end": pipeline_end_to_end,
    }
    if corpus_queries:
        found |= corpus_queries.queries()
    return {name: _utc(query) for name, query in found.items()}


# ── The same in SQL ─────────────────────────────────────────────────────────

_RAW = r"""
raw AS (
  SELECT event_id,
    CASE WHEN event_id % 97 <> 0 THEN CAST(user_id AS VARCHAR) END AS video_id,
    CASE WHEN event_id % 101 = 0 THEN 'n/a'
         WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d')
         ELSE strftime(ts, '%y.%d.%m') END AS trending_date,
    CASE WHEN event_id % 101 <> 0 THEN CAST(ts AS DATE) END AS day,
    'title ' || user_id AS title,
    'ch' || (user_id % 20) AS channel_title,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS category_id,
    strftime(ts, '%Y-%m-%dT%H:%M:%S') AS publish_time,
    'a|b' AS tags,
    CASE WHEN event_id % 11 = 0 OR event_id % 17 = 0 THEN NULL
         ELSE CAST(floor(value * 100) AS BIGINT) END AS views,
    CAST(floor(value) AS BIGINT) AS likes,
    event_id % 7 AS dislikes,
    event_id % 13 AS comment_count,
    event_id % 2 = 0 AS comments_disabled,
    CASE WHEN event_id % 5 <> 0 THEN true END AS video_error_or_removed,
    'He said "' || event_type || '",' || chr(10) || 'then left' AS description,
    event_type AS region
  FROM events
)"""

_RATIOS = r"""
    CASE WHEN views > 0 THEN round(CAST(likes AS DOUBLE) / views * 100, 4) ELSE 0.0 END AS like_ratio,
    CASE WHEN views > 0 THEN round(CAST(likes + dislikes + comment_count AS DOUBLE) / views * 100, 4)
         ELSE 0.0 END AS engagement_rate"""

_ZERO = (
    _RAW
    + r""",
zeroed AS (SELECT * REPLACE (coalesce(views, 0) AS views), day AS trending_date_parsed FROM raw),
clean AS (SELECT *,"""
    + _RATIOS
    + """ FROM zeroed WHERE video_id IS NOT NULL)"""
)

_SILVER = (
    _ZERO
    + r""",
silver AS (
  SELECT * FROM clean
  QUALIFY row_number() OVER (PARTITION BY video_id, region, trending_date_parsed ORDER BY event_id DESC) = 1
)"""
)

_STAR = (
    r"""
star AS (
  SELECT CAST(l_partkey AS VARCHAR) AS video_id, CAST(l_shipdate AS DATE) AS trending_date_parsed,
    s_name AS channel_title, CAST(p_size AS BIGINT) AS category_id, lower(trim(r_name)) AS region,
    CAST(floor(l_extendedprice) AS BIGINT) AS views,
    CAST(floor(l_extendedprice * l_discount) AS BIGINT) AS likes,
    CAST(floor(l_quantity) AS BIGINT) AS dislikes, CAST(l_linenumber AS BIGINT) AS comment_count
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
silver AS (
  SELECT *,"""
    + _RATIOS
    + r"""
  FROM star
  QUALIFY row_number() OVER (PARTITION BY video_id, region, trending_date_parsed
    ORDER BY views DESC, likes DESC, dislikes DESC, comment_count DESC, channel_title DESC) = 1
)"""
)

_NAMED = r""",
named AS (
  SELECT silver.*, coalesce(n_name, 'Unknown') AS category_name
  FROM silver LEFT JOIN nation ON category_id = n_nationkey
)"""


def _mean(name: str) -> str:
    return f"CAST(sum(CAST({name} AS DECIMAL(18,4))) AS DOUBLE) / count({name}) AS avg_{name}"


_SUMS = """CAST(sum(views) AS BIGINT) AS total_views, CAST(sum(likes) AS BIGINT) AS total_likes,
    CAST(sum(comment_count) AS BIGINT) AS total_comments"""

_TRENDING = f"""
  SELECT region, trending_date_parsed, count(video_id) AS total_videos, {_SUMS},
    CAST(sum(dislikes) AS BIGINT) AS total_dislikes,
    CAST(sum(views) AS DOUBLE) / count(views) AS avg_views_per_video,
    {_mean('like_ratio')}, {_mean('engagement_rate')}, max(views) AS max_views,
    count(DISTINCT channel_title) AS unique_channels, count(DISTINCT category_id) AS unique_categories
  FROM named GROUP BY region, trending_date_parsed"""

_CHANNELS = f"""
channels AS (
  SELECT channel_title, region, count(DISTINCT video_id) AS total_videos, {_SUMS},
    CAST(sum(views) AS DOUBLE) / count(views) AS avg_views_per_video, {_mean('engagement_rate')},
    max(views) AS peak_views, count(trending_date_parsed) AS times_trending,
    min(trending_date_parsed) AS first_trending, max(trending_date_parsed) AS last_trending,
    list_sort(list(DISTINCT category_name)) AS categories
  FROM named GROUP BY channel_title, region
)"""

_RANK = """CAST(row_number() OVER (PARTITION BY region ORDER BY total_views DESC, channel_title) AS INTEGER)
    AS rank_in_region"""

_CATEGORY = f"""
  SELECT *, round(CAST(total_views AS DOUBLE)
      / nullif(sum(total_views) OVER (PARTITION BY region, trending_date_parsed), 0) * 100, 2) AS view_share_pct
  FROM (
    SELECT category_name, category_id, region, trending_date_parsed, count(video_id) AS video_count, {_SUMS},
      {_mean('engagement_rate')}, count(DISTINCT channel_title) AS unique_channels
    FROM named GROUP BY category_name, category_id, region, trending_date_parsed
  )"""


def _top(region: str, k: int) -> str:
    return f"""SELECT channel_title, total_views, times_trending FROM channels WHERE region = '{region}'
      ORDER BY total_views DESC, channel_title LIMIT {k}"""


# Documents of 50 customers; which customers a usable document yields depends on its shape.
_DOCS = r"""
chunks AS (SELECT *, c_custkey // 50 AS n FROM customer),
docs AS (
  SELECT n, n % 5 AS shape, 'r' || (n // 3) AS region,
    'raw/region=r' || (n // 3) || '/doc ' || n || '-x.json' AS key
  FROM chunks GROUP BY n
),
copies AS (
  SELECT *, 0 AS again FROM chunks
  UNION ALL
  SELECT * REPLACE (c_name || ' (new)' AS c_name), 1 AS again FROM chunks WHERE c_custkey % 5 = 0
),
items AS (
  SELECT key, docs.region, docs.n, CAST(pos AS BIGINT) AS pos, CAST(c_custkey AS VARCHAR) AS id, 'category' AS kind,
    c_mktsegment AS "snippet_channelId", c_name AS snippet_title, c_acctbal > 0 AS snippet_assignable
  FROM (SELECT *, row_number() OVER (PARTITION BY n ORDER BY again, c_custkey) - 1 AS pos FROM copies) c
  JOIN docs ON docs.n = c.n
  WHERE shape IN (0, 2) OR (shape = 4 AND pos = 0)
),
last_items AS (SELECT * FROM items QUALIFY row_number() OVER (PARTITION BY key, id ORDER BY pos DESC) = 1)"""

_WHOLE_DOCS = _DOCS.replace("n % 5 AS shape", "0 AS shape")

_CHECKED = (
    _ZERO
    + r""",
checked AS (
  SELECT video_id, CASE WHEN event_id % 10 <> 0 THEN title END AS title, channel_title, region,
    CASE WHEN event_id % 1000 = 1 THEN -1 WHEN event_id % 1000 = 2 THEN 60000000000 ELSE views END AS views,
    CAST(publish_time AS TIMESTAMP) AS processed_at
  FROM clean
)"""
)

_NULL_PCT = ", ".join(
    f"""('{name}', (SELECT count(*) FILTER (WHERE {name} IS NULL) * 100.0 / count(*) FROM checked))"""
    for name in ("video_id", "title", "channel_title", "views", "region")
)

_ALL_RECORDS = f"""
records AS (
  SELECT 'row_count' AS "check", 'clean_statistics' AS "table", NULL AS "column",
    CAST(count(*) AS DOUBLE) AS value, CAST(10 AS DOUBLE) AS threshold, count(*) >= 10 AS passed FROM checked
  UNION ALL SELECT 'null_pct', 'clean_statistics', c, round(CAST(p AS DOUBLE), 2), 5.0, p <= 5
    FROM (VALUES {_NULL_PCT}) v(c, p)
  UNION ALL SELECT 'schema', 'clean_statistics', NULL, NULL, NULL, true
  UNION ALL SELECT 'value_range', 'clean_statistics', 'views', NULL, NULL,
    count(*) FILTER (WHERE views < 0 OR views > 50000000000) = 0 FROM checked
  UNION ALL SELECT 'freshness', 'clean_statistics', NULL, NULL, NULL,
    max(processed_at) >= TIMESTAMP '2024-01-29' FROM checked
  UNION ALL SELECT 'row_count', 'clean_reference_data', NULL, CAST(count(*) AS DOUBLE), 10.0, count(*) >= 10
    FROM nation
  UNION ALL SELECT 'null_pct', 'clean_reference_data', c, 0.0, 5.0, true FROM (VALUES ('id'), ('region')) v(c)
  UNION ALL SELECT 'schema', 'clean_reference_data', NULL, NULL, NULL, true
  UNION ALL SELECT 'freshness', 'clean_reference_data', NULL, NULL, NULL, true
  UNION ALL SELECT 'read_table', 'absent', NULL, NULL, NULL, false
)"""


def _gold_line(name: str, rows: str) -> str:
    line = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in GOLD_OUT[name])
    return f"SELECT '{name}' AS tbl, concat_ws('|', {line}) AS line FROM ({rows})"


_GOLD_SQL = f"""WITH {_SILVER}, named AS (
  SELECT silver.*, coalesce(c_name, 'Unknown') AS category_name FROM silver LEFT JOIN customer ON category_id = c_custkey
), {_CHANNELS}
{_gold_line('trending_analytics', _TRENDING)} UNION ALL
{_gold_line('channel_analytics', f'SELECT *, {_RANK} FROM channels')} UNION ALL
{_gold_line('category_analytics', _CATEGORY)}"""


def _stamp(expression: str) -> str:
    return f"""(strftime({expression}, '%Y-%m-%d %H:%M:%S') || '+00:00')"""


def _fresh(cutoff: str) -> str:
    latest, limit = _stamp("max(processed_at)"), _stamp(f"TIMESTAMP '{cutoff}'")
    return f"""WITH {_CHECKED} SELECT 'freshness' AS "check", 'clean_statistics' AS "table",
      {latest} AS latest_record, {limit} AS cutoff, max(processed_at) >= TIMESTAMP '{cutoff}' AS passed,
      'Latest: ' || {latest} || ', Cutoff: ' || {limit} AS message FROM checked"""


def oracle_sql() -> dict[str, str]:
    return _own_sql() | (corpus_queries.oracle_sql() if corpus_queries else {})


def _own_sql() -> dict[str, str]:
    silver_out = ", ".join(SILVER_OUT)
    canonical = ", ".join(
        {"thumbnail_link": "CAST(NULL AS VARCHAR) AS thumbnail_link", "ratings_disabled": "false AS ratings_disabled"}.get(
            name, name
        )
        for name in CANONICAL
    )
    reference_out = ", ".join(f'"{name}"' for name in REFERENCE_OUT)
    category_rows = "video_id, region, trending_date_parsed, category_id, category_name"
    landed = "'r' || (c_custkey // 500) AS region, CAST(c_custkey AS VARCHAR) AS id, c_name AS snippet_title"
    return {
        "csv_layout_cast": f"WITH {_RAW} SELECT {canonical} FROM raw",
        "api_layout_flatten": f"""WITH {_RAW} SELECT e.user_id || '-' || event_id AS video_id,
            '24.31.01' AS trending_date, raw.title, raw.channel_title, raw.category_id, raw.publish_time,
            CASE WHEN event_id % 2 <> 0 THEN 'a|b' END AS tags,
            CAST(floor(e.value * 100) AS BIGINT) AS views, raw.likes, CAST(0 AS BIGINT) AS dislikes,
            raw.comment_count, CAST(NULL AS VARCHAR) AS thumbnail_link, false AS comments_disabled,
            false AS ratings_disabled, false AS video_error_or_removed, 'text' AS description, raw.region
            FROM raw JOIN events e USING (event_id)""",
        "stream_ingest_api": """SELECT user_id || '-' || event_id AS video_id, event_type AS region,
            DATE '2024-01-31' AS trending_date_parsed, count(*) AS n FROM events GROUP BY ALL""",
        "catalog_roundtrip": f"""WITH {_RAW} SELECT region, count(*) AS n, count(DISTINCT video_id) AS videos
            FROM raw WHERE region IN ('click', 'view') GROUP BY region""",
        "region_pruned_scan": f"""WITH {_RAW} SELECT region, count(*) AS n, count(DISTINCT video_id) AS videos
            FROM raw WHERE region IN ('click', 'view') GROUP BY region""",
        "parse_mixed_date": r"""SELECT trending_date, parsed, count(*) AS n FROM (
            SELECT CASE WHEN l_linenumber % 3 = 0 THEN strftime(l_shipdate, '%y.%d.%m')
                        WHEN l_linenumber % 3 = 1 THEN strftime(l_shipdate, '%Y-%m-%d')
                        WHEN l_linenumber = 2 THEN strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')
                        ELSE strftime(l_shipdate, '%d/%m/%Y') END AS trending_date,
              CASE WHEN l_linenumber % 3 = 0 THEN
                     make_date(2000 + year(l_shipdate) % 100, month(l_shipdate), day(l_shipdate))
                   WHEN l_linenumber % 3 = 1 OR l_linenumber = 2 THEN CAST(l_shipdate AS DATE) END AS parsed
            FROM lineitem) GROUP BY trending_date, parsed""",
        "normalize_region": "SELECT event_id, event_type AS region FROM events",
        "null_to_zero": f"WITH {_ZERO} SELECT event_id, views, likes, dislikes, comment_count FROM zeroed",
        "like_ratio": f"WITH {_ZERO}, r AS (SELECT event_id, {_RATIOS} FROM zeroed) SELECT event_id, like_ratio FROM r",
        "engagement_rate": f"""WITH {_ZERO}, r AS (SELECT event_id, {_RATIOS} FROM zeroed)
            SELECT event_id, engagement_rate FROM r""",
        "dedupe_latest": f"WITH {_SILVER} SELECT video_id, region, trending_date_parsed, event_id FROM silver",
        "silver_statistics": f"WITH {_SILVER} SELECT {silver_out} FROM silver",
        "category_lookup": """SELECT c_custkey % 700 AS category_id, c_name AS category_name FROM customer
            QUALIFY row_number() OVER (PARTITION BY c_custkey % 700 ORDER BY lower(c_mktsegment), c_name) = 1""",
        "attach_category": f"WITH {_SILVER}{_NAMED} SELECT {category_rows} FROM named",
        "attach_category_missing_lookup": f"""WITH {_SILVER} SELECT video_id, region, trending_date_parsed,
            category_id, 'Unknown' AS category_name FROM silver""",
        "trending_analytics": f"WITH {_SILVER}{_NAMED} {_TRENDING}",
        "channel_analytics": f"WITH {_SILVER}{_NAMED}, {_CHANNELS} SELECT *, {_RANK} FROM channels",
        "category_analytics": f"WITH {_SILVER}{_NAMED} {_CATEGORY}",
        "top_channels": f"WITH {_SILVER}{_NAMED}, {_CHANNELS} {_top('click', 10)}",
        "star_trending_analytics": f"WITH {_STAR}{_NAMED} {_TRENDING}",
        "star_channel_analytics": f"WITH {_STAR}{_NAMED}, {_CHANNELS} SELECT *, {_RANK} FROM channels",
        "star_category_analytics": f"WITH {_STAR}{_NAMED} {_CATEGORY}",
        "star_top_channels": f"WITH {_STAR}{_NAMED}, {_CHANNELS} {_top('asia', 25)}",
        "reference_explode": f"WITH {_DOCS} SELECT key, region, pos, {reference_out} FROM items",
        "reference_dedupe_last": f"WITH {_WHOLE_DOCS} SELECT key, region, id, snippet_title FROM last_items",
        "reference_silver": f"""WITH {_DOCS} SELECT region, id, snippet_title, key AS _source_file FROM last_items
            WHERE n IN (SELECT max(n) FROM docs WHERE shape IN (0, 2, 4) GROUP BY region)""",
        "reference_all_fields": """SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS snippet_title, c_mktsegment AS "AVOID",
            upper(c_name) AS "content-type", c_custkey AS "more_a.b", CAST(c_nationkey AS BIGINT) AS "more_deep_my key", [c_custkey, CAST(c_nationkey AS BIGINT)] AS pair,
            CASE WHEN c_custkey % 3 = 0 THEN CAST(c_nationkey AS BIGINT) END AS rare FROM customer""",
        "reference_discovered_schema": f"""WITH {_WHOLE_DOCS} SELECT key, region, id, kind,
            "snippet_channelId" AS "snippet.channelId", snippet_title AS "snippet.title",
            snippet_assignable AS "snippet.assignable" FROM items""",
        "reference_files_roundtrip": f"SELECT {landed} FROM customer",
        "region_from_key": """SELECT doc_id,
            CASE WHEN doc_id % 10 = 0 THEN 'raw/doc ' || doc_id || '.json'
                 WHEN doc_id % 7 = 0 THEN 'raw/region=' || lang || '=x/a%zz ' || doc_id
                 ELSE 'raw/region=' || lang || '/doc (' || doc_id || ').json' END AS key,
            CASE WHEN doc_id % 10 = 0 THEN 'unknown' ELSE lang END AS region FROM documents""",
        "reference_ingest_report": f"""WITH {_DOCS}
            SELECT docs.key, CASE WHEN shape IN (0, 2, 4) THEN docs.region END AS region,
              CASE WHEN shape IN (0, 2, 4) THEN count(id) END AS rows,
              CASE shape WHEN 1 THEN 'Not a JSON document' WHEN 3 THEN 'No category items in the document' END AS error
            FROM docs LEFT JOIN last_items ON docs.n = last_items.n GROUP BY docs.key, docs.region, shape""",
        "dq_row_count": f"""WITH {_CHECKED} SELECT 'row_count' AS "check", 'clean_statistics' AS "table",
            CAST(NULL AS VARCHAR) AS "column", CAST(count(*) AS DOUBLE) AS value, CAST(10 AS DOUBLE) AS threshold,
            count(*) >= 10 AS passed, 'Row count: ' || count(*) || ' (min: 10)' AS message FROM checked""",
        "dq_null_pct": f"""WITH {_CHECKED} SELECT 'null_pct' AS "check", 'clean_statistics' AS "table",
            c AS "column", round(CAST(p AS DOUBLE), 2) AS value, CAST(5 AS DOUBLE) AS threshold, p <= 5 AS passed,
            c || ' null%: ' || printf('%.2f', CAST(p AS DOUBLE)) || '% (max: 5.0%)' AS message
            FROM (VALUES {_NULL_PCT}) v(c, p)""",
        "dq_schema": f"""WITH {_CHECKED}, records AS (
              SELECT 'row_count' AS "check", NULL AS "column", CAST(count(*) AS DOUBLE) AS value, CAST(10 AS DOUBLE) AS threshold,
                count(*) >= 10 AS passed FROM checked
              UNION ALL SELECT 'null_pct', 'video_id', 100.0 * count(*) FILTER (video_id IS NULL) / count(*), 5.0,
                count(*) FILTER (video_id IS NULL) * 20 <= count(*) FROM checked
              UNION ALL SELECT 'null_pct', 'views', 100.0 * count(*) FILTER (views IS NULL) / count(*), 5.0,
                count(*) FILTER (views IS NULL) * 20 <= count(*) FROM checked
              UNION ALL SELECT 'null_pct', c, NULL, NULL, false FROM (VALUES ('no_such'), ('also_missing')) v(c)
              UNION ALL SELECT 'schema', NULL, NULL, NULL, false
              UNION ALL SELECT 'value_range', 'views', NULL, NULL,
                count(*) FILTER (WHERE views < 0 OR views > 50000000000) = 0 FROM checked
              UNION ALL SELECT 'freshness', NULL, NULL, NULL, max(processed_at) >= TIMESTAMP '2024-01-29' FROM checked
            ) SELECT *, 'clean_statistics' AS "table",
              CASE WHEN "check" = 'schema' THEN ['also_missing', 'no_such'] END AS missing_columns FROM records""",
        "dq_value_range": f"""WITH {_CHECKED}, c AS (SELECT count(*) FILTER (WHERE views < 0) AS neg,
            count(*) FILTER (WHERE views > 50000000000) AS ext FROM checked)
            SELECT 'value_range' AS "check", 'clean_statistics' AS "table", 'views' AS "column",
            neg AS negative_count, ext AS extreme_count, neg = 0 AND ext = 0 AS passed,
            'Views: ' || neg || ' negative, ' || ext || ' extreme (>50000000000)' AS message FROM c""",
        "dq_freshness": _fresh("2024-01-29 00:00:00"),
        "dq_freshness_stale": _fresh("2024-02-08 00:00:00"),
        "dq_run_checks": f"WITH {_CHECKED}, {_ALL_RECORDS} SELECT * FROM records",
        "dq_summary": f"""WITH {_CHECKED}, {_ALL_RECORDS} SELECT bool_and(passed) AS quality_passed,
            count(*) FILTER (WHERE passed) AS checks_passed, count(*) AS checks_total FROM records""",
        "dq_alerts": f"""WITH {_CHECKED}, {_ALL_RECORDS} SELECT 'Data quality checks FAILED' AS subject,
            "check", "table", "column" FROM records WHERE NOT passed""",
        "write_partitioned_roundtrip": f"""WITH {_SILVER} SELECT region, count(*) AS n,
            CAST(sum(views) AS BIGINT) AS views, (SELECT count(*) FROM silver) AS rows_written
            FROM silver GROUP BY region""",
        "overwrite_partitions_roundtrip": """SELECT event_type AS region,
            CASE WHEN event_type IN ('click', 'view') THEN 2 ELSE 1 END AS version, count(*) AS n,
            CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY event_type""",
        "schema_evolution_roundtrip": """SELECT event_type AS region, count(*) AS n,
            count(CASE WHEN event_type = 'error' THEN value END) AS with_value FROM events GROUP BY event_type""",
        "stream_ingest_stats": f"WITH {_SILVER} SELECT {silver_out} FROM silver",
        "stream_ingest_csv": f"WITH {_SILVER} SELECT video_id, region, trending_date_parsed, count(*) AS n FROM silver GROUP BY ALL",
        "stream_ingest_blank_regions": """SELECT CASE event_id % 4 WHEN 2 THEN '01' WHEN 3 THEN '1' END AS region, count(*) AS n,
            CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1""",
        "stream_ingest_reference": f"SELECT {landed} FROM customer",
        "pipeline_end_to_end": _GOLD_SQL,
        "pipeline_incremental": _GOLD_SQL,
        "pipeline_empty_input": _GOLD_SQL,
        "pipeline_bad_documents": """SELECT 'raw/region=r' || (n // 3) || '/doc+' || n || '-x.json' AS key,
            CASE n % 5 WHEN 1 THEN 'Not a JSON document' ELSE 'No category items in the document' END AS error, true AS alerted
            FROM (SELECT DISTINCT c_custkey // 50 AS n FROM customer) WHERE n % 5 IN (1, 3)""",
    }
