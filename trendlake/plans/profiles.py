"""Checks by increments: one stored profile row per partition; only partitions whose files changed are read.

A profile row holds what the checks aggregate (counts, null counts, negatives, extremes, the latest stamp) over one
partition, and the digest of the files it was made of. Rows add up to the profile of the whole table, so the
records are those of a full pass. A partition that has changed gets a new row, one that has gone loses its own:
nothing is taken off a sum. Profiles of other thresholds, columns or types are other tables.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlake.operators import quality
from trendlake.plans.increments import LISTED, partition_files
from trendlake.session import delete_path, materialise, path_exists, release
from trendlake.sources import read_table

KEYS = ("folder", "files")


def _folder(file: Column) -> Column:
    """The folder of a file that rows were read from, spelled as files are listed."""
    path = F.url_decode(F.replace(file, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(path, "/[^/]*$", "")


def _plain(folder: Column) -> Column:
    """One spelling of ``file:/x`` and ``file:///x``."""
    return F.regexp_replace(folder, "^([^:/]+):/+", "$1:/")


def profile_partitions(spark: SparkSession, path: str, state: str, table: str, **options) -> tuple[DataFrame, list[quality.Check]]:
    """(one profile row per partition of the table at ``path``, the checks it is made for). What is stored under ``state``
    is used for partitions whose files are the same, and is replaced."""
    df = read_table(spark, path)
    checks = quality.table_checks(df, table, **options)
    aggregates = quality.aggregates_of(checks)
    kind = zlib.crc32(repr(sorted((name, str(c)) for name, c in aggregates.items()) + [df.schema.json()]).encode())
    store = f"{state}/profile-{table}-{kind:08x}"
    now = materialise(partition_files(spark, path), "partitions")
    known = path_exists(spark, f"{store}/_SUCCESS")
    folders = None
    if known:
        stored = spark.read.parquet(store)
        changed = now.join(stored.select(*KEYS), list(KEYS), "left_anti").select("folder").limit(LISTED + 1).collect()
        folders = sorted(r["folder"] for r in changed) if len(changed) <= LISTED else None
    profiles = None
    if folders != []:
        rows = df if folders is None else spark.read.schema(df.schema).option("basePath", path).parquet(*folders)
        # By file first: folders are reckoned from a row per file, not from every row.
        files = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(*(c.alias(f"agg_{name}") for name, c in aggregates.items()))
        # Never null, or the join would test it below the aggregates, on every row.
        place = F.coalesce(_plain(_folder(F.col("file"))), F.lit(""))
        found = files.groupBy(place.alias("place")).agg(
            *((F.max if name in quality.EXTREMES else F.sum)(f"agg_{name}").alias(f"agg_{name}") for name in aggregates)
        )
        profiles = now.join(found, _plain(F.col("folder")) == F.col("place")).drop("place")
    if folders is not None:
        kept = stored.join(now, list(KEYS), "left_semi")
        profiles = kept if profiles is None else kept.unionByName(profiles)
    new = materialise(profiles, "profiles")
    delete_path(spark, store)  # a run that stops here profiles everything again
    new.coalesce(1).write.parquet(store)  # a row per partition
    release(now, "partitions")
    release(new, "profiles")
    return spark.read.schema(new.schema).parquet(store), checks


def check_partitions(spark: SparkSession, path: str, state: str, table: str, **options) -> quality.Records:
    """The records of ``quality.check_table`` for the table at ``path``, from profiles of its partitions."""
    profiles, checks = profile_partitions(spark, path, state, table, **options)
    return quality.Records(quality.records_of(quality.merged(profiles, checks), checks))
