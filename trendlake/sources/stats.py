"""Raw statistics, landed as ``<root>/region=xx/`` files, batch or as a stream of new files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trendlake.schemas import STATS_API, STATS_CSV
from trendlake.sources.csv_blocks import read_csv_blocks
from trendlake.sources.tables import only_regions, read_table, region_spellings


SPLIT_ABOVE = 256 << 20  # bytes of a file


def _csv_options(multi_line: bool) -> dict:
    # A quote inside a field is doubled. The header must match the schema, or the read fails.
    return {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line, "enforceSchema": False}


def read_stats_csv(
    spark: SparkSession, root: str, regions: list[str] | None = None, multi_line: bool = True, split_above: int = SPLIT_ABOVE
) -> DataFrame:
    """CSV files, every column as text.

    Fields may hold line breaks inside quotes, as descriptions do. A file of up to ``split_above`` bytes is
    one task; larger ones are read in blocks of ``spark.sql.files.maxPartitionBytes`` by many (``csv_blocks``). ``False``
    for ``multi_line``: files known to have no such breaks, which need no more than a plain scan.
    """
    whole = spark.read.schema(STATS_CSV).options(**_csv_options(multi_line)).csv(root)
    # Files are listed by now; together no larger than the bound, none is.
    if not multi_line or whole._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= split_above:
        return _only(whole, root, regions)
    size = F.col("_metadata.file_size")  # a filter on it leaves files out before they are read
    partitioned = region_spellings(spark, root) is not None
    keep = ["region"] if partitioned else []
    lines = spark.read.schema("value string, region string" if partitioned else "value string").option("lineSep", "\n").text(root)
    data = StructType([f for f in STATS_CSV if f.name not in keep])
    scan = _only(lines, root, regions) if partitioned else lines
    blocks = read_csv_blocks(scan.where(size > split_above), data, keep, _csv_options(True))
    blocks = blocks if partitioned else _only(blocks, root, regions)
    return _only(whole.where(size <= split_above), root, regions).unionByName(blocks)


def _only(df: DataFrame, name_or_path: str, regions: list[str] | None) -> DataFrame:
    return df if regions is None else only_regions(df, regions, region_spellings(df.sparkSession, name_or_path))


def read_stats_api(
    spark: SparkSession, root: str, regions: list[str] | None = None, multi_line: bool = False
) -> DataFrame:
    """JSON objects of the API layout, one per line (``multi_line``: one document per file)."""
    reader = spark.read.schema(STATS_API).option("multiLine", multi_line)
    return _only(reader.json(root), root, regions)


def read_stats(spark: SparkSession, name_or_path: str, regions: list[str] | None = None) -> DataFrame:
    """Raw statistics kept as a catalog table or as Parquet, of either layout."""
    return _only(read_table(spark, name_or_path), name_or_path, regions)


def stream_stats(
    spark: SparkSession,
    root: str,
    layout: str = "csv",
    max_files_per_trigger: int | None = None,
    multi_line: bool | None = None,
) -> DataFrame:
    """New files under ``root`` as a stream. Layout: ``csv``, ``api`` or ``parquet`` (CSV columns).

    ``multi_line`` as in the batch readers: by default on for CSV and off for the API layout."""
    reader = spark.readStream.schema(STATS_API if layout == "api" else STATS_CSV)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if layout == "csv":
        return reader.options(**_csv_options(multi_line is not False)).csv(root)
    if layout == "api":
        return reader.option("multiLine", bool(multi_line)).json(root)
    if layout == "parquet":
        return reader.parquet(root)
    raise ValueError(f"unknown layout '{layout}'")
