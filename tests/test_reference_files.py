"""Reference items of many regions: a file per region, however many tasks the items are dealt to; profiles by file."""

import json

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from trendlake import fixtures as fx
from trendlake.plans import profiles
from trendlake.plans.pipeline import reference_to_silver
from trendlake.sources import stream_reference_docs
from trendlake.streaming import ingest_reference

REGIONS, ITEMS = 12, 40


@pytest.fixture
def many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def document(region):
    return json.dumps({"items": [{"id": f"{region}-{n}", "snippet": {"title": f"t{n}"}} for n in range(ITEMS)]})


def files_per_region(path):
    return {folder.name: len(list(folder.glob("*.parquet"))) for folder in path.glob("region=*")}


def one_file_each():
    return {f"region=r{n}": 1 for n in range(REGIONS)}


def test_reference_to_silver_writes_a_file_per_region(many_tasks, tmp_path):
    rows = [(f"raw/region=r{n}/a.json", fx.AS_OF, document(n)) for n in range(REGIONS)]
    docs = many_tasks.createDataFrame(rows, "path string, modified timestamp, value string")
    reference_to_silver(docs, str(tmp_path / "t"), fx.AS_OF)
    assert files_per_region(tmp_path / "t") == one_file_each()
    assert many_tasks.read.parquet(str(tmp_path / "t")).count() == REGIONS * ITEMS


def test_ingest_reference_writes_a_file_per_region(many_tasks, tmp_path):
    for n in range(REGIONS):
        (tmp_path / "in" / f"region=r{n}").mkdir(parents=True)
        (tmp_path / "in" / f"region=r{n}" / "a.json").write_text(document(n))
    ingest_reference(stream_reference_docs(many_tasks, str(tmp_path / "in")), str(tmp_path / "t"), str(tmp_path / "state"))
    assert files_per_region(tmp_path / "t") == one_file_each()
    assert many_tasks.read.parquet(str(tmp_path / "t")).count() == REGIONS * ITEMS


def test_profiles_reckon_folders_from_files(spark, tmp_path, monkeypatch):
    rows = spark.range(40).select(
        F.concat(F.lit("v"), "id").alias("video_id"), F.when(F.col("id") % 4 != 0, F.col("id") - 30).alias("views"),
        F.concat(F.lit("r +%"), F.col("id") % 2).alias("region"),
    )
    path = str(tmp_path / "t")
    rows.repartition(3).write.partitionBy("region").parquet(path)
    plans = []
    kept = profiles.materialise

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return kept(df, name)

    monkeypatch.setattr(profiles, "materialise", seen)
    found, _ = profiles.profile_partitions(spark, path, str(tmp_path / "state"), "clean_statistics")
    assert rows_of(found, "agg_n", "agg_negative") == [(20, 15), (20, 7)]
    below = dict(plans)["profiles"].rpartition("Aggregate [")[2].partition("\n")[2]  # what is reckoned from every row
    assert "file_path" in below and "decode" not in below
