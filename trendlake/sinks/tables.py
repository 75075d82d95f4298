"""Partitioned Parquet tables, their catalog entry and their row counts."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

PARTITIONS_AT_ONCE = 200  # added to the catalog by one statement


def _values(partition_by: Sequence[str]) -> Column:
    return F.struct(*(F.col(f"`{c}`").cast("string").alias(c) for c in partition_by))


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("region",),
    mode: str = "overwrite",
    table: str | None = None,
    rebalance: bool = False,
    max_records_per_file: int = 0,
) -> int:
    """Write Parquet/Snappy and return the rows written, counted during the write.

    ``overwrite`` replaces the partitions that occur in ``df`` and no others, so a
    second run does not double rows; ``append`` adds files. ``rebalance`` shuffles
    first so that partitions get few files and a hot partition is split over
    tasks; leave it off for tables whose last shuffle is already wide.
    ``table`` names the catalog entry to create or update; the partitions it lacks are
    seen during the write, so the folders of the table are not listed.
    """
    observed = Observation(f"written-{uuid.uuid4().hex}")
    placed = df.hint("rebalance", *partition_by) if rebalance and partition_by else df
    seen = [F.count(F.lit(1)).alias("rows")]
    if table is not None and partition_by:
        # As many as the directories that the commit of this write lists.
        seen.append(F.collect_set(_values(partition_by)).alias("partitions"))
    # Observed above the last shuffle, where no finished task runs again.
    counted = placed.observe(observed, *seen)
    writer = counted.write.mode(mode).option("compression", "snappy").option("partitionOverwriteMode", "dynamic")
    writer.option("maxRecordsPerFile", max_records_per_file).partitionBy(*partition_by).parquet(path)
    found = observed.get
    if table is not None:
        touched = [tuple(row) for row in found["partitions"]] if partition_by else []
        register_table(df.sparkSession, table, path, df, partition_by, touched)
    return found["rows"]


def overwrite_partitions(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = ("region",),
    table: str | None = None,
    rebalance: bool = False,
) -> int:
    """Replace the touched partitions only. Files may bring new columns (read with ``merge_schema``)."""
    return write_partitioned(df, path, partition_by, "overwrite", table, rebalance)


def _literal(value: str | None) -> str:
    return "null" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def add_partitions(spark: SparkSession, table: str, partition_by: Sequence[str], values: Iterable[Sequence[str | None]]) -> None:
    """Tell the catalog of these partitions; those it knows stay as they are. A blank value is none."""
    wanted = sorted({tuple(v or None for v in row) for row in values}, key=repr)
    for at in range(0, len(wanted), PARTITIONS_AT_ONCE):
        listed = " ".join(
            f"PARTITION ({', '.join(f'`{c}` = {_literal(v)}' for c, v in zip(partition_by, row))})"
            for row in wanted[at : at + PARTITIONS_AT_ONCE]
        )
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {listed}")


def register_table(
    spark: SparkSession,
    table: str,
    path: str,
    df: DataFrame,
    partition_by: Sequence[str] = ("region",),
    touched: Iterable[Sequence[str | None]] | None = None,
) -> None:
    """Create the external table, or add the columns it lacks, and its new partitions.

    ``touched`` lists the partitions (values as text) a write brought. The folders are listed only when the table
    is new, as older files may be there already, or when nothing is known of a write.
    """
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    new_table = not spark.catalog.tableExists(table)
    if new_table:
        columns = ", ".join(f"`{name}` {kind}" for name, kind in kinds.items())
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING parquet "
            + (f"PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)}) " if partition_by else "")
            + f"LOCATION '{path}'"
        )
    else:
        known = {name.lower() for name in spark.table(table).columns}
        new = ", ".join(f"`{name}` {kind}" for name, kind in kinds.items() if name.lower() not in known)
        if new:
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({new})")
    if partition_by and (new_table or touched is None):
        spark.catalog.recoverPartitions(table)
    elif partition_by:
        add_partitions(spark, table, partition_by, touched)
    spark.catalog.refreshTable(table)
