import datetime as dt
import json
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from trendlake.schemas import CANONICAL, STATS_CSV
from trendlake.sinks import write_partitioned
from trendlake.sources import read_table, stream_reference_docs, stream_stats
from trendlake.streaming import ingest_reference, ingest_stats, merge_latest
from trendlake.streaming.ingest import _touched_only

SCHEMA = "video_id string, region string, trending_date_parsed date, views long"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
BEST = ["video_id", "region", "trending_date_parsed", "views"]


def rows(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def merge(df, base, batch=0):
    merge_latest(df, f"{base}/t", f"{base}/staging-{batch}", order_by=[F.col("views").desc()])


def test_merge_keeps_one_row_per_key_and_only_touches_its_days(spark, tmp_path):
    merge(rows(spark, ("a", "ca", D1, 1), ("a", "ca", D1, 3), ("b", "ca", D2, 1), ("n", "ca", None, 1)), tmp_path)
    untouched = {p: p.stat().st_mtime_ns for p in (tmp_path / "t").glob("*/trending_date_parsed=2024-01-02/*")}
    merge(rows(spark, ("a", "ca", D1, 2), ("c", "us", D1, 5), ("n", "ca", None, 2)), tmp_path, 1)
    assert rows_of(read_table(spark, f"{tmp_path}/t"), *BEST) == [
        ("a", "ca", D1, 3), ("b", "ca", D2, 1), ("c", "us", D1, 5), ("n", "ca", None, 2),
    ]
    assert untouched and all(p.stat().st_mtime_ns == t for p, t in untouched.items())


def test_replaying_a_batch_changes_nothing(spark, tmp_path):
    batch = rows(spark, ("a", "ca", D1, 1), ("b", "us", D2, 2))
    merge(batch, tmp_path)
    before = rows_of(read_table(spark, f"{tmp_path}/t"), *BEST)
    merge(batch, tmp_path)
    assert rows_of(read_table(spark, f"{tmp_path}/t"), *BEST) == before


def test_crash_while_publishing_is_repaired_from_staging(spark, tmp_path):
    merge(rows(spark, ("a", "ca", D1, 1), ("b", "us", D2, 2)), tmp_path)
    # The merged partition was staged completely, then the job died with the old one deleted.
    merged = rows(spark, ("a", "ca", D1, 1), ("c", "ca", D1, 7))
    merged.write.parquet(f"{tmp_path}/staging-1/merged")
    shutil.rmtree(tmp_path / "t" / "region=ca")
    merge(rows(spark, ("c", "ca", D1, 7)), tmp_path, 1)
    assert rows_of(read_table(spark, f"{tmp_path}/t"), *BEST) == [("a", "ca", D1, 1), ("b", "us", D2, 2), ("c", "ca", D1, 7)]
    assert not (tmp_path / "staging-1").exists()


def test_merge_needs_partitions_inside_the_key(spark, tmp_path):
    with pytest.raises(ValueError, match="among the keys"):
        merge_latest(rows(spark), str(tmp_path / "t"), str(tmp_path / "s"), keys=["video_id"], partition_by=["region"])


def test_existing_rows_are_read_from_touched_partitions_only(spark, tmp_path):
    write_partitioned(rows(spark, ("a", "ca", D1, 1), ("b", "us", D2, 2)), f"{tmp_path}/t", ["region", "trending_date_parsed"])
    existing = spark.read.schema(SCHEMA).parquet(f"{tmp_path}/t")
    touched = rows(spark, ("x", "ca", D1, 0)).select("region", "trending_date_parsed")
    found = _touched_only(existing, touched)
    assert rows_of(found, "video_id") == [("a",)]
    assert "PartitionFilters: [region" in plan_of(found).replace("isnotnull(region", "region")


def raw(spark, *data):
    names = STATS_CSV.fieldNames()
    known = [dict(zip(("video_id", "region", "trending_date", "views"), d)) for d in data]
    return spark.createDataFrame([tuple(d.get(n) for n in names) for d in known], STATS_CSV)


def test_each_run_takes_new_files_only(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    order = [F.col("views").desc()]

    def run():
        stream = stream_stats(spark, source, "parquet")
        query = ingest_stats(stream, target, state, "job", order_by=order)
        assert query.exception() is None
        return sum(p["numInputRows"] for p in query.recentProgress)

    raw(spark, ("a", " CA", "24.01.01", "5"), (None, "ca", "24.01.01", "5")).coalesce(1).write.parquet(source)
    run()
    raw(spark, ("a", "ca", "2024-01-01", "9"), ("b", "us", "n/a", "x")).coalesce(1).write.mode("append").parquet(source)
    run()
    assert run() == 0
    table = read_table(spark, target)
    assert set(CANONICAL) <= set(table.columns)
    assert rows_of(table, "video_id", "region", "trending_date_parsed", "views") == [
        ("a", "ca", D1, 9), ("b", "us", None, 0),
    ]


def test_ingest_reference_replaces_regions_and_reports(spark, tmp_path):
    source, target, state, report = (str(tmp_path / n) for n in ("in", "out", "state", "report"))

    def land(region, name, value):
        folder = tmp_path / "in" / f"region={region}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(value if isinstance(value, str) else json.dumps(value, indent=1))

    def run():
        query = ingest_reference(stream_reference_docs(spark, source), target, state, report)
        assert query.exception() is None

    def named(*titles):
        return {"items": [{"id": str(i), "snippet": {"title": t}} for i, t in enumerate(titles)]}

    land("ca", "a.json", named("x", "y"))
    land("us", "b.json", named("z"))
    run()
    land("ca", "c.json", named("new"))
    land("us", "bad.json", "{")
    run()
    table = read_table(spark, target)
    assert rows_of(table, "region", "id", "snippet_title") == [("ca", "0", "new"), ("us", "0", "z")]
    found = spark.read.parquet(report)
    assert found.count() == 4 and found.where("error is not null").count() == 1
