"""Silver and gold tables, by catalog name or by Parquet path."""

from __future__ import annotations

import logging
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from trendlake.functions import normalize_region

log = logging.getLogger(__name__)

TEXT_PARTITIONS = ("region",)  # directory names that are text whatever they look like
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the directory of rows without a value


def read_table(spark: SparkSession, name_or_path: str, merge_schema: bool = False) -> DataFrame:
    """A path (it has a ``/``) or a catalog table. ``merge_schema`` reads a path whose
    later files have more columns. Regions stay text: ``01`` and ``1`` are two."""
    if "/" not in name_or_path:
        return spark.table(name_or_path)
    df = spark.read.option("mergeSchema", merge_schema).parquet(name_or_path)
    guessed = [f.name for f in df.schema if f.name in TEXT_PARTITIONS and f.dataType != StringType()]
    if not guessed:
        return df
    fields = [StructField(f.name, StringType(), True) if f.name in guessed else f for f in df.schema]
    return spark.read.schema(StructType(fields)).parquet(name_or_path)


def read_optional(spark: SparkSession, name_or_path: str) -> DataFrame | None:
    """Like ``read_table``, but ``None`` when the table is not there or not readable.

    The table is a small lookup: it is read once here, so that a broken file shows now and
    not in the job that joins it.
    """
    try:
        df = read_table(spark, name_or_path, merge_schema=True)
        df.write.format("noop").mode("overwrite").save()
        return df
    except (PySparkException, Py4JJavaError) as error:
        log.warning("%s is not readable and is left out: %s", name_or_path, getattr(error, "java_exception", error))
        return None


def region_spellings(spark: SparkSession, name_or_path: str) -> list[str] | None:
    """The values of the partition ``region`` as they are spelled in a catalog table or as folders of a path; ``None``
    where region is no (first) partition. Partition names are listed, no file is read."""
    if "/" in name_or_path:
        path = spark._jvm.org.apache.hadoop.fs.Path(name_or_path)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return None
        names = [status.getPath().getName() for status in fs.listStatus(path) if status.isDirectory()]
    elif any(c.name == "region" and c.isPartition for c in spark.catalog.listColumns(name_or_path)):
        part = F.regexp_extract("partition", "(?:^|/)(region=[^/]*)", 1)
        names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {name_or_path}").select(part).distinct().collect()]
    else:
        return None
    found = [unquote(name.removeprefix("region=")) for name in names if name.startswith("region=")]
    return [value for value in found if value != NO_VALUE] if found else None


def only_regions(df: DataFrame, regions: list[str] | None, spellings: list[str] | None = None) -> DataFrame:
    """Keep the given regions, whatever their case and blanks.

    With ``spellings``, what the partitions are called, the filter is a plain list of raw values: the catalog lists only
    the partitions it names. Without, it is computed from the column, which prunes partitions that are listed already.
    """
    if regions is None:
        return df
    wanted = {r.strip(" ").lower() for r in regions} - {""}
    if spellings is not None:
        return df.where(F.col("region").isin([raw for raw in spellings if raw.strip(" ").lower() in wanted]))
    return df.where(normalize_region(F.col("region")).isin(sorted(wanted)))
