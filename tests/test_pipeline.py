import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from trendlake import fixtures as fx
from trendlake.plans import QualityGateError, bronze_to_silver, quality_gate, run, silver_to_gold
from trendlake.session import scratch_root
from trendlake.sources import read_optional, read_table

SF = "/root/testdata/sf0.001"


def docs(spark):
    value = json.dumps({"items": [{"id": str(i), "snippet": {"title": f"cat {i}"}} for i in range(20)]})
    return spark.createDataFrame([("raw/region=ca/x.json", fx.AS_OF, value)], "path string, modified timestamp, value string")


def whole_run(spark, root, **checks):
    return run(fx.stats_raw(spark, SF), docs(spark), root, fx.JOB, fx.AS_OF, fx.newest_event(), fx.TIE_BREAK, **checks)


def test_end_to_end_twice_gives_the_same_tables(spark, tmp_path):
    root = str(tmp_path)
    first = whole_run(spark, root)
    tables = {n: rows_of(read_table(spark, f"{root}/gold/{n}")) for n in first["gold"]}
    second = whole_run(spark, root)
    assert first["gold"] == second["gold"] == {n: len(rows) for n, rows in tables.items()}
    assert {n: rows_of(read_table(spark, f"{root}/gold/{n}")) for n in tables} == tables
    assert first["quality"]["checks_total"] == 14 and first["quality"]["quality_passed"]
    assert first["statistics"]["rows_read"] == fx.table(spark, SF, "events").count()
    silver = read_table(spark, f"{root}/silver/statistics")
    assert silver.count() == first["statistics"]["rows_written"]
    ranks = read_table(spark, f"{root}/gold/channel_analytics").groupBy("region")
    assert all(r.top == r.n for r in ranks.agg(F.max("rank_in_region").alias("top"), F.count("*").alias("n")).collect())


def test_gold_leaves_no_scratch(spark, tmp_path):
    scratch = Path(scratch_root(spark).removeprefix("file:")) / "trendlake"
    before = {p.name for p in scratch.glob("*")} if scratch.exists() else set()
    bronze_to_silver(fx.stats_raw(spark, SF), f"{tmp_path}/s", as_of=fx.AS_OF)
    silver_to_gold(read_table(spark, f"{tmp_path}/s"), None, f"{tmp_path}/g")
    left = {p.name.rpartition("-")[0] for p in scratch.glob("*") if p.name not in before}
    assert not left & {"rank", "share"}


def test_two_runs_keep_history_and_register_tables(spark, tmp_path):
    root, raw = str(tmp_path), fx.stats_raw(spark, SF)
    for part in (0, 1):
        found = run(raw.where(F.col("event_id") % 2 == part), docs(spark), root, fx.JOB, fx.AS_OF, fx.newest_event(), fx.TIE_BREAK, database="merged")
    assert found["reference"] == {"documents": 1, "failed": 0, "missing_columns": []}
    whole = str(tmp_path / "whole")
    run(raw, docs(spark), whole, fx.JOB, fx.AS_OF, fx.newest_event(), fx.TIE_BREAK)
    for name in ("silver/statistics", "gold/channel_analytics", "gold/trending_analytics", "gold/category_analytics"):
        columns = sorted(set(read_table(spark, f"{whole}/{name}").columns) - {"_aggregated_at"})
        assert rows_of(read_table(spark, f"{root}/{name}"), *columns) == rows_of(read_table(spark, f"{whole}/{name}"), *columns)
    assert spark.table("merged.clean_statistics").count() == read_table(spark, f"{root}/silver/statistics").count()
    assert spark.table("merged.channel_analytics").count() == read_table(spark, f"{root}/gold/channel_analytics").count()
    spark.sql("DROP DATABASE merged CASCADE")


def test_files_per_region_are_bounded(spark, tmp_path):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        bronze_to_silver(fx.stats_raw(spark, SF), f"{tmp_path}/s", as_of=fx.AS_OF)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert all(len(list(p.glob("*.parquet"))) <= 2 for p in (tmp_path / "s").glob("region=*"))


def test_an_unreadable_reference_is_left_out(spark, tmp_path):
    (tmp_path / "ref" / "region=ca").mkdir(parents=True)
    (tmp_path / "ref" / "region=ca" / "part-0.parquet").write_bytes(b"PAR1 this is no parquet file PAR1")
    assert read_optional(spark, f"{tmp_path}/ref") is None and read_optional(spark, f"{tmp_path}/none") is None


def test_gate_stops_gold_and_writes_alerts(spark, tmp_path):
    with pytest.raises(QualityGateError) as failed:
        whole_run(spark, str(tmp_path), min_rows=10**9)
    assert failed.value.summary["checks_passed"] == 12
    assert not (tmp_path / "gold").exists()
    assert spark.read.json(str(tmp_path / "alerts")).count() == 2


def test_gate_on_an_unreadable_table(spark):
    with pytest.raises(QualityGateError):
        quality_gate(spark, {"clean_statistics": "no_such_table"})


def test_empty_input_writes_nothing(spark, tmp_path):
    raw = fx.stats_raw(spark, SF)
    assert bronze_to_silver(raw.where("event_id < 0"), f"{tmp_path}/s") == {"rows_read": 0, "rows_written": 0}
    assert not (tmp_path / "s").exists()


def test_gold_without_reference(spark, tmp_path):
    bronze_to_silver(fx.stats_raw(spark, SF), f"{tmp_path}/s", keep=fx.TIE_BREAK, as_of=dt.datetime(2024, 1, 31))
    silver_to_gold(read_table(spark, f"{tmp_path}/s"), None, f"{tmp_path}/g")
    assert rows_of(read_table(spark, f"{tmp_path}/g/category_analytics").select("category_name").distinct()) == [("Unknown",)]
