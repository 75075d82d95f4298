"""Profiles of partitions add up to a full pass, and only changed partitions are read."""

import datetime as dt
import os

import pytest
from conftest import rows_of
from pyspark.sql import functions as F

from trendlake.operators import quality
from trendlake.plans import profiles
from trendlake.plans.profiles import check_partitions, profile_partitions
from trendlake.sinks import write_partitioned

AS_OF = dt.datetime(2024, 5, 2, tzinfo=dt.timezone.utc)
BY = ("region", "trending_date_parsed")
TABLE = "clean_statistics"


def rows(spark, region, day, n, views="id"):
    return spark.range(n).select(
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("v"), F.col("id").cast("string"))).alias("video_id"),
        F.lit("t").alias("title"), F.lit("c").alias("channel_title"), F.expr(views).cast("bigint").alias("views"),
        F.timestamp_seconds(F.lit(1714600000) + F.col("id")).alias("_processed_at"),
        F.lit(region).cast("string").alias("region"), F.lit(day).cast("date").alias("trending_date_parsed"),
    )


def full(spark, path, **options):
    return rows_of(quality.check_table(spark.read.parquet(path), TABLE, as_of=AS_OF, **options))


def by_parts(spark, path, state, **options):
    return rows_of(check_partitions(spark, path, state, TABLE, as_of=AS_OF, **options).rows)


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "silver")
    for region, day, n in (("ca", "2024-05-01", 20), ("ca", "2024-05-02", 9), ("a b+c%é", "2024-05-01", 5), (None, "2024-05-01", 3), ("us", None, 4)):
        write_partitioned(rows(spark, region, day, n), path, BY)
    return path


def test_records_equal_a_full_pass_after_every_change(spark, table, tmp_path):
    state = str(tmp_path / "state")
    assert by_parts(spark, table, state) == full(spark, table)
    changes = [
        rows(spark, "ca", "2024-05-02", 30, "if(id = 3, -5, 60000000000)"),  # replaced
        rows(spark, "de", "2024-05-02", 11),  # new
        rows(spark, "a b+c%é", "2024-05-01", 2),
        rows(spark, None, "2024-05-01", 8, "null"),
    ]
    for change in changes:
        write_partitioned(change, table, BY)
        assert by_parts(spark, table, state) == full(spark, table)
    folder = next(d for d in os.listdir(table) if d == "region=de")
    spark._jvm.org.apache.hadoop.fs.Path(table).getFileSystem(spark._jsc.hadoopConfiguration()).delete(
        spark._jvm.org.apache.hadoop.fs.Path(f"{table}/{folder}"), True
    )
    assert by_parts(spark, table, state) == full(spark, table)
    assert by_parts(spark, table, state, max_value=5) == full(spark, table, max_value=5)  # other thresholds
    assert by_parts(spark, table, state, columns=["video_id", "views", "nothing"]) == full(spark, table, columns=["video_id", "views", "nothing"])


def test_unchanged_partitions_are_not_read(spark, table, tmp_path):
    """The pages of their files are spoiled in place, with size and time as before: reading one would fail. Footers stay:
    the schema is read from one."""
    state = str(tmp_path / "state")
    want, _ = profile_partitions(spark, table, state, TABLE, as_of=AS_OF)
    want = {r["folder"]: r["agg_n"] for r in want.collect()}
    for base, _, files in os.walk(table):
        for name in files:
            if "region=ca" in base or not name.endswith(".parquet"):
                continue
            path = os.path.join(base, name)
            os.remove(os.path.join(base, f".{name}.crc"))
            before = os.stat(path)
            with open(path, "r+b") as file:
                file.seek(4)
                file.write(b"\xff" * 60)
            os.utime(path, ns=(before.st_atime_ns, before.st_mtime_ns))
    with pytest.raises(Exception, match="(?i)exception"):
        spark.read.parquet(table).agg(F.count("video_id"), F.count("views")).collect()
    write_partitioned(rows(spark, "ca", "2024-05-01", 13), table, BY)
    got, _ = profile_partitions(spark, table, state, TABLE, as_of=AS_OF)
    got = {r["folder"]: r["agg_n"] for r in got.collect()}
    changed = [folder for folder in want if got[folder] != want[folder]]
    assert len(changed) == 1 and "region=ca" in changed[0] and got[changed[0]] == 13 and got.keys() == want.keys()


def test_many_changes_read_everything(spark, table, tmp_path, monkeypatch):
    monkeypatch.setattr(profiles, "LISTED", 1)
    state = str(tmp_path / "state")
    assert by_parts(spark, table, state) == full(spark, table)
    for region in ("ca", "fr", "us"):
        write_partitioned(rows(spark, region, "2024-05-01", 6), table, BY)
    assert by_parts(spark, table, state) == full(spark, table)


def test_a_stopped_run_is_done_again(spark, table, tmp_path):
    state = str(tmp_path / "state")
    by_parts(spark, table, state)
    for base, _, files in os.walk(state):
        if "_SUCCESS" in files:
            os.remove(os.path.join(base, "_SUCCESS"))
    assert by_parts(spark, table, state) == full(spark, table)
