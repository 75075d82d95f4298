"""Gold by increments against gold built whole."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows_of
from trendlake import fixtures as fx
from trendlake.operators import gold
from trendlake.plans import increments, run, silver_to_gold
from trendlake.sources import read_table

SF = "/root/testdata/sf0.001"
TABLES = ("trending_analytics", "channel_analytics", "category_analytics")


def docs(spark, title="cat"):
    value = json.dumps({"items": [{"id": str(i), "snippet": {"title": f"{title} {i}"}} for i in range(20)]})
    return spark.createDataFrame([("raw/region=ca/x.json", fx.AS_OF, value)], "path string, modified timestamp, value string")


def step(spark, root, raw, title="cat"):
    return run(raw, docs(spark, title), root, fx.JOB, fx.AS_OF, fx.newest_event(), fx.TIE_BREAK)["gold"]


def whole(spark, root, into):
    silver = read_table(spark, f"{root}/silver/statistics")
    silver_to_gold(silver, read_table(spark, f"{root}/silver/reference"), into, fx.AS_OF)
    return into


def tables(spark, path):
    found = {}
    for name in TABLES:
        df = read_table(spark, f"{path}/{name}")
        reals = {c: F.round(c, 6) for c, kind in df.dtypes if kind == "double"}
        found[name] = (sorted(df.dtypes), rows_of(df.withColumns(reals), *sorted(df.columns)))
    return found


def files(path):
    return {str(p.relative_to(path)) for p in path.rglob("*.parquet")}


@pytest.fixture(scope="module")
def days(spark):
    """Raw rows without those of one (region, day), and those."""
    raw = fx.stats_raw(spark, SF)
    first = raw.groupBy("region", "trending_date").count().where("region is not null and trim(region) <> ''")
    chosen = first.orderBy(F.col("count").desc(), "region", "trending_date").first()
    of_day = (F.col("region") == chosen["region"]) & (F.col("trending_date") == chosen["trending_date"])
    return raw.where(~F.coalesce(of_day, F.lit(False))), raw.where(of_day)


@pytest.fixture(scope="module")
def root(spark, days, tmp_path_factory):
    """A root after a first run without one day."""
    path = tmp_path_factory.mktemp("increments")
    step(spark, str(path), days[0])
    return path


def test_one_day(spark, days, root, tmp_path, monkeypatch):
    rest, day = days
    before = {name: files(root / "gold" / name) for name in TABLES}
    read = []
    rows = increments.changed_rows
    monkeypatch.setattr(increments, "changed_rows", lambda *a: read.append(rows(*a)) or read[-1])
    written = step(spark, str(root), day)
    assert tables(spark, f"{root}/gold") == tables(spark, whole(spark, str(root), f"{tmp_path}/gold"))

    # Only the folder of that day was read, and only its region written.
    folders = {f.rpartition("/")[0] for f in read[0].inputFiles()}
    assert len(folders) == 1 and len({p.parent for p in (root / "silver" / "statistics").rglob("*.parquet")}) > 10
    region = next(iter(folders)).split("/region=")[1].split("/")[0]
    for name in TABLES:
        kept = {f for f in before[name] if not f.startswith(f"region={region}/")}
        assert kept and kept < files(root / "gold" / name)
        assert written[name] == read_table(spark, f"{root}/gold/{name}").where(F.col("region") == region).count()

    # Nothing new: nothing is read or written.
    now = {name: files(root / "gold" / name) for name in TABLES}
    reference = read_table(spark, f"{root}/silver/reference")
    assert set(increments.update_gold(spark, f"{root}/silver/statistics", reference, str(root), fx.AS_OF).values()) == {0}
    assert {name: files(root / "gold" / name) for name in TABLES} == now

    # Other names: all regions, without a row of silver.
    read.clear()
    step(spark, str(root), day.limit(0), title="other")
    assert not read
    assert tables(spark, f"{root}/gold") == tables(spark, whole(spark, str(root), f"{tmp_path}/other"))

    # A partition that has gone: everything is aggregated again.
    now = increments.partition_files(spark, f"{root}/silver/statistics")
    state = f"{root}/state/{increments.VERSION}"
    assert increments.changes(spark, now, state).folders == []
    assert increments.changes(spark, now.where(~F.endswith("folder", F.lit(next(iter(folders)).split("/statistics/")[1]))), state).folders is None


def test_a_stopped_run_is_done_again(spark, days, tmp_path, monkeypatch):
    rest, day = days
    path = str(tmp_path / "stopped")
    step(spark, path, rest)
    write = increments.write_partitioned

    def stops(df, target, *args, **options):
        if target.endswith("channel_analytics"):
            raise OSError("stopped")
        return write(df, target, *args, **options)

    monkeypatch.setattr(increments, "write_partitioned", stops)
    with pytest.raises(OSError):
        step(spark, path, day)
    monkeypatch.setattr(increments, "write_partitioned", write)
    reference = read_table(spark, f"{path}/silver/reference")
    increments.update_gold(spark, f"{path}/silver/statistics", reference, path, fx.AS_OF)
    assert tables(spark, f"{path}/gold") == tables(spark, whole(spark, path, f"{tmp_path}/gold"))


def test_awkward_rows(spark, tmp_path):
    """No region, day, title or category; a video in several categories and days; no ratios."""
    day, later = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    rows = [
        ("v1", "ch", 1, 5, 1, 0, 2, 20.0, 60.0, "a%b", day), ("v1", "ch", 2, 7, 1, 0, 2, 14.2857, 42.8571, "a%b", later),
        ("v2", "ch", None, None, 0, 0, 0, None, None, "a%b", day), ("v3", None, 1, 0, 0, 0, 0, 0.0, 0.0, None, None),
        ("v4", None, 3, 9, 9, 9, 9, 100.0, 300.0, "01", day), ("v5", "ch", 1, 3, 1, 1, 1, 33.3333, 100.0, None, day),
    ]
    silver, root = f"{tmp_path}/silver", str(tmp_path)
    spark.createDataFrame(rows, increments.SILVER).write.partitionBy(*gold.DAY).parquet(silver)
    reference = spark.createDataFrame([("1", "one", "a"), ("2", "one", "a")], "id string, snippet_title string, region string")
    increments.update_gold(spark, silver, reference, root, fx.AS_OF)
    silver_to_gold(spark.read.schema(increments.SILVER).parquet(silver), reference, f"{tmp_path}/whole", fx.AS_OF)
    assert tables(spark, f"{root}/gold") == tables(spark, f"{tmp_path}/whole")
    days = spark.read.parquet(f"{root}/state/{increments.VERSION}/days").where(increments._in(["01"]))
    assert "region" in plan_of(days).split("PartitionFilters: [")[1].split("]")[0]
    # A change in a partition without values is found as well.
    spark.createDataFrame([("v9", "new", 1, 1, 1, 1, 1, 1.0, 1.0, None, day)], increments.SILVER).write.mode("append").partitionBy(*gold.DAY).parquet(silver)
    increments.update_gold(spark, silver, reference, root, fx.AS_OF)
    silver_to_gold(spark.read.schema(increments.SILVER).parquet(silver), reference, f"{tmp_path}/whole", fx.AS_OF)
    assert tables(spark, f"{root}/gold") == tables(spark, f"{tmp_path}/whole")
