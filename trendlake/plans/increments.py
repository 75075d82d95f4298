"""Gold by increments: only days of silver whose files changed since the last run are read again.

State under ``<root>/state``: ``days`` holds the parts of every (region, day) (``operators.gold_days``), ``seen`` the
files of each silver partition when they were aggregated, ``names`` the category names gold was built
with. What changed is told by the files themselves (names, sizes, times), so it does not matter who wrote
them: a run, a stream or a repair. ``seen`` is written last: a run that was stopped is done again.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from trendlake.operators import gold, gold_days
from trendlake.operators.enrich import attach_category, build_lookup
from trendlake.schemas import LONG, REAL, TEXT, struct
from trendlake.session import delete_path, materialise, path_exists, release
from trendlake.sinks import write_partitioned
from trendlake.sources.tables import NO_VALUE

VERSION = "gold-1"  # of the parts; another one starts with empty state
LISTED = 10_000  # changed partitions that are read by name; beyond it everything is read
SEEN = "folder string, files decimal(38,0)"
NAMES = "category_id bigint, category_name string"
# Columns of silver that gold is made of.
SILVER = StructType(
    [
        *struct(video_id=TEXT, channel_title=TEXT, category_id=LONG, views=LONG, likes=LONG, dislikes=LONG, comment_count=LONG),
        *struct(like_ratio=REAL, engagement_rate=REAL, region=TEXT, trending_date_parsed=DateType()),
    ]
)


@dataclass
class Changes:
    """``folders`` of silver to aggregate again; ``None``: all, the state is begun anew."""

    folders: list[str] | None

    def regions(self) -> list[str | None] | None:
        if self.folders is None:
            return None
        found = {unquote(re.search("/region=([^/]*)", folder)[1]) for folder in self.folders}
        return [None if region == NO_VALUE else region for region in sorted(found)]


def partition_files(spark: SparkSession, path: str) -> DataFrame:
    """(folder, files) of a partitioned table: a digest of the names, sizes and times of each folder's files.
    Folders are listed; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    one = F.xxhash64("path", "length", F.unix_micros("modificationTime")).cast("decimal(38,0)")
    return files.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).agg(F.sum(one).alias("files"))


def _written(spark: SparkSession, path: str, schema) -> DataFrame | None:
    return spark.read.schema(schema).parquet(path) if path_exists(spark, f"{path}/_SUCCESS") else None


def changes(spark: SparkSession, now: DataFrame, state: str) -> Changes:
    """The partitions among ``now`` that differ from what ``state`` was built of. A partition that has gone is
    in no list: everything is aggregated again then."""
    seen = _written(spark, f"{state}/seen", SEEN)
    if seen is None or not path_exists(spark, f"{state}/days"):
        return Changes(None)
    before = seen.select(F.col("folder").alias("old"), F.col("files").alias("old_files"))
    other = now.join(before, F.col("folder") == F.col("old"), "full").where(~F.col("files").eqNullSafe(F.col("old_files")))
    rows = other.select("folder").limit(LISTED + 1).collect()
    if len(rows) > LISTED or any(r["folder"] is None for r in rows):
        return Changes(None)
    return Changes(sorted(r["folder"] for r in rows))


def changed_rows(spark: SparkSession, silver: str, found: Changes) -> DataFrame:
    """The silver rows of the changed partitions; only their folders are listed and read."""
    reader = spark.read.schema(SILVER)
    return reader.parquet(silver) if found.folders is None else reader.option("basePath", silver).parquet(*found.folders)


def _in(regions: list[str | None] | None) -> Column:
    if regions is None:
        return F.lit(True)
    known = F.col("region").isin([r for r in regions if r is not None])
    return known | F.col("region").isNull() if None in regions else known


def _same(a: DataFrame, b: DataFrame) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def update_gold(
    spark: SparkSession,
    silver: str,
    reference: DataFrame | None,
    root: str,
    as_of: dt.datetime | None = None,
    database: str | None = None,
) -> dict[str, int]:
    """Bring the gold tables under ``<root>/gold`` up to date with the silver table, which is partitioned by
    (region, day); returns the rows written per table.

    Only regions with changed days are written; their rows are merged from the parts of their days, and silver
    is read for the changed days alone. Other regions keep their rows and stamps. When category names have
    changed, or a gold table is not there, all regions are merged, again without reading unchanged days of silver.
    """
    state = f"{root}/state/{VERSION}"
    partition_files(spark, silver).write.mode("overwrite").parquet(f"{state}/next")
    now = spark.read.schema(SEEN).parquet(f"{state}/next")
    found = changes(spark, now, state)
    if found.folders is None:
        delete_path(spark, f"{state}/seen")
        delete_path(spark, f"{state}/days")
    if found.folders != []:
        write_partitioned(gold_days.day_parts(changed_rows(spark, silver, found)), f"{state}/days", gold.DAY, rebalance=True)

    lookup = None if reference is None else build_lookup(reference)
    names = spark.createDataFrame([], NAMES) if lookup is None else lookup.select("category_id", "category_name")
    names = materialise(names, "names")
    old_names = _written(spark, f"{state}/names", NAMES)
    named_alike = old_names is not None and _same(old_names, names)
    builders = {
        "trending_analytics": (gold_days.trending_of_days, True),
        "channel_analytics": (gold_days.channel_of_days, False),
        "category_analytics": (gold_days.category_of_days, True),
    }
    table = lambda name: f"{database}.{name}" if database else None
    there = all(path_exists(spark, f"{root}/gold/{n}") and not (database and not spark.catalog.tableExists(table(n))) for n in builders)
    regions = found.regions() if named_alike and there else None
    written = dict.fromkeys(builders, 0)
    if regions != []:
        parts = spark.read.schema(gold_days.day_parts(spark.createDataFrame([], SILVER)).schema).parquet(f"{state}/days").where(_in(regions))
        parts = attach_category(parts, names)
        for name, (build, rebalance) in builders.items():
            rows = build(parts)
            written[name] = write_partitioned(gold.stamp(rows, as_of), f"{root}/gold/{name}", rebalance=rebalance, table=table(name))
            release(rows, "rank", "share")
    if not named_alike:
        names.write.mode("overwrite").parquet(f"{state}/names")
    now.write.mode("overwrite").parquet(f"{state}/seen")
    release(names, "names")
    return written
