import datetime as dt

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from trendlake.operators.clean import from_csv_layout
from trendlake.schemas import STATS_CSV
from trendlake.session import materialise, scratch_path, scratch_root
from trendlake.sinks import overwrite_partitions, register_table, write_partitioned
from trendlake.sources import read_optional, read_stats, read_stats_api, read_stats_csv, read_table

HEADER = ",".join(n for n in STATS_CSV.fieldNames() if n != "region")


def csv_line(video, description):
    return f'{video},17.14.11,title,chan,10,p,"a|b",5,1,0,2,link,False,False,False,{description}'


@pytest.fixture
def landed(tmp_path):
    for region, description in {"ca": '"say ""hi"",\nthen go"', "us": "plain", "IN": "x"}.items():
        (tmp_path / f"region={region}").mkdir()
        (tmp_path / f"region={region}" / "videos.csv").write_text(f"{HEADER}\n{csv_line('v' + region, description)}\n")
    return str(tmp_path)


def test_csv_quotes_and_line_breaks(spark, landed):
    rows = {r.region: r for r in from_csv_layout(read_stats_csv(spark, landed)).collect()}
    assert rows["ca"].description == 'say "hi",\nthen go'
    assert (rows["us"].views, rows["us"].tags, len(rows)) == (5, "a|b", 3)


def test_csv_regions_prune_directories(spark, landed):
    df = read_stats_csv(spark, landed, regions=["CA", "in"])
    assert rows_of(df, "video_id") == [("vIN",), ("vca",)]
    plan = df._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_csv_columns_in_another_order_fail_loudly(spark, tmp_path):
    (tmp_path / "region=ca").mkdir()
    names = HEADER.split(",")
    names[0], names[1] = names[1], names[0]
    (tmp_path / "region=ca" / "f.csv").write_text(",".join(names) + "\n" + csv_line("v", "d") + "\n")
    with pytest.raises(Py4JJavaError, match="does not conform"):
        read_stats_csv(spark, str(tmp_path)).collect()


def test_api_json(spark, tmp_path):
    (tmp_path / "region=ca").mkdir()
    line = '{"id":"v","snippet":{"title":"t","tags":["a"]},"statistics":{"viewCount":"5"}}\n'
    (tmp_path / "region=ca" / "f.json").write_text(line)
    row = read_stats_api(spark, str(tmp_path), regions=["ca"]).first()
    assert (row.id, row.snippet.title, row.statistics.viewCount, row.region) == ("v", "t", "5", "ca")


def events(spark, n=100):
    return spark.range(n).select(F.concat(F.lit("r"), (F.col("id") % 3).cast("string")).alias("region"), F.col("id").alias("n"))


def test_write_twice_does_not_double_and_append_does(spark, tmp_path):
    path = str(tmp_path / "t")
    assert [write_partitioned(events(spark), path) for _ in range(2)] == [100, 100]
    assert read_table(spark, path).count() == 100
    write_partitioned(events(spark), path, mode="append", rebalance=True)
    assert read_table(spark, path).count() == 200
    assert list((tmp_path / "t").glob("region=r0/*.snappy.parquet"))


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    write_partitioned(events(spark), str(tmp_path / "t"))
    df = read_stats(spark, str(tmp_path / "t"), regions=["r1"]).where("n > 5").select("n")
    plan = plan_of(df)
    assert "PushedFilters: [IsNotNull(n), GreaterThan(n,5)]" in plan and "ReadSchema: struct<n:bigint>" in plan


def test_overwrite_touches_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    overwrite_partitions(events(spark), path)
    overwrite_partitions(spark.createDataFrame([("r1", -1)], "region string, n long"), path)
    assert {r.region: r["count"] for r in read_table(spark, path).groupBy("region").count().collect()} == {
        "r0": 34, "r1": 1, "r2": 33,
    }


@pytest.mark.parametrize("empty", ["false", "n < 0"])
def test_writing_no_rows_changes_nothing(spark, tmp_path, empty):
    path = str(tmp_path / "t")
    overwrite_partitions(events(spark), path)
    assert overwrite_partitions(events(spark).where(empty), path) == 0
    assert overwrite_partitions(spark.createDataFrame([], "region string, n long"), path) == 0
    assert read_table(spark, path).count() == 100


def test_register_and_evolve(spark, tmp_path):
    path = str(tmp_path / "t")
    try:
        write_partitioned(events(spark), path, table="stats_t")
        assert spark.table("stats_t").count() == 100
        more = spark.createDataFrame([("r9", 1, "x")], "region string, n long, note string")
        write_partitioned(more, path, table="stats_t")
        rows = spark.table("stats_t")
        assert (rows.count(), rows.where("note is null").count()) == (101, 100)
        assert rows_of(rows.where("region = 'r9'"), "n", "note") == [(1, "x")]
        register_table(spark, "stats_t", path, more)  # nothing new: no error
        assert rows_of(read_table(spark, path, merge_schema=True).where("note is not null"), "n") == [(1,)]
    finally:
        spark.sql("DROP TABLE IF EXISTS stats_t")


def test_read_optional(spark, tmp_path):
    assert read_optional(spark, str(tmp_path / "none")) is None
    assert read_optional(spark, "no_such_table") is None


def test_materialise_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, None, ["a"], dt.date(2024, 1, 1)), (None, "x", None, None)],
                               "a int, `b.c` string, d array<string>, e date")
    back = materialise(df, "test")
    assert back.schema == df.schema and rows_of(back, "a", "`b.c`", "d", "e") == rows_of(df, "a", "`b.c`", "d", "e")
    assert "LocalTableScan" not in plan_of(back)


def test_scratch_is_shared_and_fresh(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
    assert scratch_path(spark, "x").startswith(scratch_root(spark))
