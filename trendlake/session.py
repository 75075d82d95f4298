"""Session settings, the shared scratch folder and written intermediate tables."""

from __future__ import annotations

import logging
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

# Settings the library is tuned for; every one is a plain Spark setting.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # A few region directories per task: write them side by side instead of
    # sorting every task's rows by region first.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    # collect_set buffers are small here (category names of one channel), so let
    # the hash aggregate hold many groups before it falls back to sorting.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "65536",
}


def build_session(app_name: str = "trendlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session, whose executors share the driver's disk, may go
    without it; a cluster without the setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        if folder.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            # Right only where every machine mounts the folder; nothing here can tell.
            log.warning("the scratch folder %s must be a mount that all executors share", folder)
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="trendlake-")
        spark.sparkContext.setCheckpointDir(folder)
        return folder
    raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path (nothing is there yet) under the shared scratch folder. Its parent is
    removed when the session ends."""
    folder = f"{scratch_root(spark)}/trendlake/{name}-{uuid.uuid4().hex}"
    fs, hadoop_path = _filesystem(spark, folder)
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return f"{folder}/data"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage: later branches read the same rows (also after an executor
    is lost) and only the columns they need, and ``df`` is computed once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside hand at most ``rows`` rows at a time to Python and back (10,000 without it).

    Both sides of every core hold a batch, as Arrow, as Python objects and with room to grow.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _filesystem(spark, path)
    return fs.exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _filesystem(spark, path)
    fs.delete(hadoop_path, True)


def release(df: DataFrame, *names: str) -> None:
    """Deletes the written intermediates of these names that ``df`` reads, once its rows are elsewhere."""
    spark = df.sparkSession
    root = f"{scratch_root(spark)}/trendlake/"
    for file in df.inputFiles():
        _, found, rest = file.partition("/trendlake/")
        folder = rest.split("/")[0]
        if found and folder.rpartition("-")[0] in names and path_exists(spark, root + folder):
            delete_path(spark, root + folder)
