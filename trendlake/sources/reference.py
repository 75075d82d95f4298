"""Reference documents: one JSON file is one row, ``(path, modified, value)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _with_origin(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"), "value"
    )


def read_reference_docs(spark: SparkSession, root: str) -> DataFrame:
    # The region is taken from the key, so directories are not read as partitions.
    return _with_origin(spark.read.text(root, wholetext=True, recursiveFileLookup=True))


def stream_reference_docs(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema("value string")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _with_origin(reader.text(root, wholetext=True, recursiveFileLookup=True))
