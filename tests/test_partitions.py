"""What the catalog is told of a write, and which partitions a list of regions reads."""

import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from trendlake import fixtures as fx
from trendlake.plans import run
from trendlake.sinks import tables as sink
from trendlake.sinks import write_partitioned
from trendlake.sources import read_stats, read_table
from trendlake.sources.tables import region_spellings

SF = "/root/testdata/sf0.001"
DAYS = ("region", "day")


def rows(spark, *values):
    return spark.createDataFrame(values, "region string, day date, n long").withColumn("day", F.coalesce("day", F.lit(None).cast("date")))


@pytest.fixture
def statements(spark, monkeypatch):
    """The statements that the sink sends."""
    seen = []
    own = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: seen.append(text) or own(self, text, *a, **k))
    return seen


def test_a_write_adds_its_own_partitions(spark, tmp_path, statements):
    import datetime as dt

    day, path = dt.date(2024, 1, 1), str(tmp_path / "t")
    try:
        write_partitioned(rows(spark, ("ca", day, 1), ("it's \\ odd/=", day, 2), (None, day, 3)), path, DAYS, table="by_day")
        statements.clear()
        write_partitioned(rows(spark, ("ca", day, 5)), path, DAYS, table="by_day")
        write_partitioned(rows(spark, ("us", dt.date(2024, 1, 2), 6), (None, None, 7)), path, DAYS, table="by_day")
        assert not any("MSCK" in s or "RECOVER" in s for s in statements)
        added = [s for s in statements if "ADD IF NOT EXISTS" in s]
        assert [s.count("PARTITION (") for s in added] == [1, 2]
        assert rows_of(spark.table("by_day"), "n") == [(2,), (3,), (5,), (6,), (7,)]
        assert spark.sql("SHOW PARTITIONS by_day").count() == 5
    finally:
        spark.sql("DROP TABLE IF EXISTS by_day")


def test_many_partitions_are_added_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sink, "PARTITIONS_AT_ONCE", 3)
    more = spark.range(10).select(F.concat(F.lit("r"), "id").alias("region"), "id")
    try:
        write_partitioned(more.where("id < 1"), str(tmp_path / "t"), table="many_parts")
        write_partitioned(more, str(tmp_path / "t"), table="many_parts")
        assert spark.table("many_parts").count() == 10 == spark.sql("SHOW PARTITIONS many_parts").count()
    finally:
        spark.sql("DROP TABLE IF EXISTS many_parts")


@pytest.mark.parametrize("by_name", [True, False])
def test_regions_are_a_list_of_raw_values(spark, tmp_path, by_name):
    path = str(tmp_path / "t")
    raw = spark.createDataFrame([("US", 1), (" us", 2), ("us", 3), ("ca/x", 4), (None, 5)], "region string, n long")
    try:
        write_partitioned(raw, path, table="spelled")
        assert sorted(region_spellings(spark, "spelled" if by_name else path)) == [" us", "US", "ca/x", "us"]
        found = read_stats(spark, "spelled" if by_name else path, ["us ", "none"])
        plan = found._jdf.queryExecution().executedPlan().toString()
        filters = plan[plan.index("PartitionFilters") :].split("]")[0]
        assert "lower" not in filters and "trim" not in filters and "region" in filters
        assert rows_of(found, "n") == [(1,), (2,), (3,)]
        assert "PartitionCount: 3" in plan or "partition" in plan.lower()
        assert read_stats(spark, "spelled" if by_name else path, ["none"]).count() == 0
        assert rows_of(read_stats(spark, path, ["CA/X"]), "n") == [(4,)]
    finally:
        spark.sql("DROP TABLE IF EXISTS spelled")


def test_a_region_that_is_no_partition_is_filtered(spark, tmp_path):
    spark.createDataFrame([("US", 1), ("ca", 2)], "region string, n long").write.parquet(str(tmp_path / "t"))
    assert region_spellings(spark, str(tmp_path / "t")) is None
    assert rows_of(read_stats(spark, str(tmp_path / "t"), [" us"]), "n") == [(1,)]


def test_an_empty_first_run_ends_quietly(spark, tmp_path):
    root = str(tmp_path / "new")
    found = run(fx.stats_raw(spark, SF).where("false"), None, root, fx.JOB, fx.AS_OF, fx.newest_event(), fx.TIE_BREAK)
    assert found == {"statistics": {"rows_read": 0, "rows_written": 0}, "quality": None, "gold": {}}


def test_alerts_are_raised_once(spark, tmp_path):
    root = str(tmp_path)
    docs = spark.createDataFrame([("raw/region=ca/bad.json", "{")], "path string, value string").withColumn("modified", F.lit(fx.AS_OF))
    for _ in range(2):
        run(fx.stats_raw(spark, SF).where("false"), docs, root, fx.JOB, fx.AS_OF)
    assert spark.read.json(f"{root}/alerts").count() == 1 == read_table(spark, f"{root}/reports/reference").count()
