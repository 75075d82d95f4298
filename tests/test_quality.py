import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import plan_of
from trendlake.operators import quality
from trendlake.schemas import CHECK_RECORD

AS_OF = dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc)
STATS = "clean_statistics"


def stats(spark, n=20, **changes):
    df = spark.range(n).select(
        F.concat(F.lit("v"), "id").alias("video_id"),
        F.lit("t").alias("title"),
        F.lit("c").alias("channel_title"),
        F.col("id").alias("views"),
        F.lit("ca").alias("region"),
        F.to_timestamp(F.lit("2024-01-30 12:00:00.5")).alias("_processed_at"),
    )
    return df.withColumns(changes) if changes else df


def one(df):
    (row,) = df.collect()
    return row


def test_row_count(spark):
    row = one(quality.check_row_count(stats(spark), STATS))
    assert (row.value, row.threshold, row.passed, row.message) == (20.0, 10.0, True, "Row count: 20 (min: 10)")
    assert not one(quality.check_row_count(stats(spark, 9), STATS)).passed


def test_null_pct(spark):
    df = stats(spark, title=F.when(F.col("views") != 0, "t"), views=F.when(F.col("views") > 1, F.col("views")))
    rows = {r.column: r for r in quality.check_null_pct(df, STATS).collect()}
    assert (rows["title"].value, rows["title"].passed) == (5.0, True)  # at the limit
    assert (rows["views"].value, rows["views"].passed) == (10.0, False)
    assert rows["title"].message == "title null%: 5.00% (max: 5.0%)"
    assert len(rows) == 5


def test_null_pct_compares_before_rounding(spark):
    df = spark.range(100_000).select(F.when(F.col("id") >= 5001, F.lit(1)).alias("a"))
    row = one(quality.check_null_pct(df, STATS, ["a"]))
    assert (row.value, row.passed) == (5.0, False)


def test_null_pct_missing_column_nan_and_empty(spark):
    row = one(quality.check_null_pct(stats(spark), STATS, ["nope"]))
    assert (row.passed, row.value, row.message) == (False, None, "Column 'nope' missing from table")
    nan = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert one(quality.check_null_pct(nan, STATS, ["x"])).value == 50.0
    assert [r.passed for r in quality.check_null_pct(stats(spark, 0), STATS).collect()] == [True] * 5
    assert quality.check_null_pct(stats(spark), "other").collect() == []


def test_schema(spark):
    assert one(quality.check_schema(stats(spark), STATS)).message == "All expected columns present"
    row = one(quality.check_schema(stats(spark).drop("title", "region"), STATS))
    assert (row.passed, row.missing_columns) == (False, ["region", "title"])
    assert one(quality.check_schema(stats(spark), "unknown_table")).passed


def test_value_range(spark):
    df = stats(spark, views=F.when(F.col("views") == 3, -1).when(F.col("views") == 4, 50_000_000_001).otherwise(F.lit(None)))
    row = one(quality.check_value_range(df, STATS))
    assert (row.negative_count, row.extreme_count, row.passed) == (1, 1, False)
    assert row.message == "Views: 1 negative, 1 extreme (>50000000000)"
    edge = stats(spark, views=F.lit(50_000_000_000))
    assert one(quality.check_value_range(edge, STATS)).passed
    assert quality.check_value_range(df, "other").collect() == []
    assert quality.check_value_range(df.drop("views"), STATS).collect() == []


def test_freshness(spark):
    row = one(quality.check_freshness(stats(spark), STATS, as_of=AS_OF))
    assert (row.passed, row.latest_record, row.cutoff) == (
        True, "2024-01-30 12:00:00.500000+00:00", "2024-01-29 00:00:00+00:00",
    )
    assert not one(quality.check_freshness(stats(spark), STATS, as_of=dt.datetime(2024, 2, 10))).passed
    exact = stats(spark, _processed_at=F.to_timestamp(F.lit("2024-01-29 00:00:00")))
    assert one(quality.check_freshness(exact, STATS, as_of=AS_OF)).passed


@pytest.mark.parametrize(
    "value, passed, text",
    [
        ("2024-01-30T10:00:00+00:00", True, "Latest"),
        ("2024-01-28", False, "Latest"),
        ("yesterday", True, "skipping"),
        (None, False, "Latest: NaT"),
    ],
)
def test_freshness_of_text_stamps(spark, value, passed, text):
    df = stats(spark).drop("_processed_at").withColumn("_ingestion_timestamp", F.lit(value).cast("string"))
    row = one(quality.check_freshness(df, "clean_reference_data", as_of=AS_OF))
    assert row.passed is passed and text in row.message


def test_freshness_without_stamp(spark):
    row = one(quality.check_freshness(stats(spark).drop("_processed_at"), STATS))
    assert row.passed and "skipping" in row.message and row.cutoff is None


def test_run_checks_is_one_pass_per_table(spark):
    records = quality.check_table(stats(spark), STATS, as_of=AS_OF)
    assert records.schema.names == CHECK_RECORD.names
    assert plan_of(records).count("Range (") == 1
    assert [r.check for r in records.collect()] == ["row_count", *["null_pct"] * 5, "schema", "value_range", "freshness"]


@pytest.mark.parametrize("isolate", [False, True])
def test_unreadable_table_does_not_stop_the_others(spark, isolate):
    reference = spark.createDataFrame([(str(i), "ca") for i in range(12)], "id string, region string")
    tables = {"absent": "no_such_table", STATS: stats(spark), "clean_reference_data": lambda: reference}
    results = quality.run_checks(spark, tables, isolate=isolate, as_of=AS_OF)
    rows = results.collect()
    assert len(rows) == 1 + 9 + 5
    (failed,) = [r for r in rows if not r.passed]
    assert (failed.check, failed.table) == ("read_table", "absent") and "no_such_table" in failed.message
    summary = quality.summary(results).first()
    assert (summary.quality_passed, summary.checks_passed, summary.checks_total) == (False, 14, 15)
    assert len(json.loads(summary.details)) == 15


def test_isolate_records_errors_found_while_reading(spark, tmp_path):
    stats(spark).write.parquet(str(tmp_path / "t"))
    good = spark.read.parquet(str(tmp_path / "t"))
    for file in (tmp_path / "t").glob("*.parquet"):
        file.write_bytes(b"PAR1 not parquet PAR1")
    for file in (tmp_path / "t").glob(".*.crc"):
        file.unlink()
    rows = quality.run_checks(spark, {STATS: good}, isolate=True).collect()
    assert [(r.check, r.passed) for r in rows] == [("read_table", False)]


def test_summary_of_nothing_passes(spark):
    row = quality.summary(quality.run_checks(spark, {})).first()
    assert (row.quality_passed, row.checks_passed, row.checks_total) == (True, 0, 0)


def test_a_loaders_own_error_concerns_its_table_only(spark):
    def broken():
        raise FileNotFoundError("gone")

    rows = quality.run_checks(spark, {"broken": broken, STATS: stats(spark, 50)}, as_of=AS_OF).collect()
    assert [r.table for r in rows if r.check == "read_table"] == ["broken"] and {r.table for r in rows} == {"broken", STATS}


@pytest.mark.parametrize("zone", ["UTC", "Asia/Kolkata", "America/New_York"])
def test_freshness_does_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for text, fresh in (("2024-01-29 00:00:00", True), ("2024-01-28 23:59:59", False), ("2024-01-28T23:30:00-01:00", True), ("2024-01-29", True)):
            rows = spark.createDataFrame([(text,)], "_processed_at string")
            found = quality.check_freshness(rows, STATS, as_of=dt.datetime(2024, 1, 31)).first()
            assert found.passed is fresh, (zone, text, found.message)
            assert found.cutoff == "2024-01-29 00:00:00+00:00"
        assert "2024-01-29 00:30:00+00:00" in quality.check_freshness(
            spark.createDataFrame([("2024-01-28T23:30:00-01:00",)], "_processed_at string"), STATS, as_of=dt.datetime(2024, 1, 31)
        ).first().message
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_alerts(spark):
    results = quality.run_checks(spark, {STATS: stats(spark, 3)}, as_of=AS_OF)
    row = one(quality.alerts(results, "x" * 150))
    assert row.subject == "x" * 150
    message = json.loads(row.message)
    assert (message["check"], message["passed"], message["value"]) == ("row_count", False, 3.0)
