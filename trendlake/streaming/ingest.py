"""Incremental ingestion: each run takes the files it has not seen yet."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from trendlake.operators.clean import add_ratios, cleanse, dedupe_latest, stamp, to_canonical
from trendlake.operators.reference import ingest_report, parse_documents, silver_reference
from trendlake.operators.sizes import broadcast_if_small
from trendlake.schemas import VIDEO_KEY
from trendlake.session import delete_path, materialise, path_exists
from trendlake.sinks import overwrite_partitions, write_partitioned

# The key holds region and date, so rows of one key share one such partition and
# a batch rewrites only the days it brings.
MERGE_PARTITIONS = ("region", "trending_date_parsed")
LISTED = 10_000  # touched partitions that become a partition filter of the scan


def _touched_only(existing: DataFrame, touched: DataFrame) -> DataFrame:
    """Rows of ``existing`` in the partitions listed in ``touched``.

    Values of each partition column become a partition filter, so other directories
    are not read; the semi join then keeps the exact combinations.
    """
    # Directory names of one batch, listed once; the commit of the write lists as many. Of very
    # many (dirty data) none are listed, and the semi join alone decides.
    listed = touched.limit(LISTED + 1).collect()
    filters: list[Column] = [F.lit(True)]
    for name in touched.columns if len(listed) <= LISTED else ():
        values = {row[name] for row in listed}
        known = F.col(name).isin([v for v in values if v is not None])
        filters.append(known | F.col(name).isNull() if None in values else known)
    keys = touched.withColumnsRenamed({c: f"_touched_{c}" for c in touched.columns})
    same = [F.col(c).eqNullSafe(F.col(f"_touched_{c}")) for c in touched.columns]
    pruned = existing.where(reduce(lambda a, b: a & b, filters))
    return pruned.join(broadcast_if_small(keys), reduce(lambda a, b: a & b, same), "left_semi")


def merge_latest(
    incoming: DataFrame,
    target: str,
    staging: str,
    keys: Sequence[str] = VIDEO_KEY,
    order_by: Sequence[Column] | None = None,
    partition_by: Sequence[str] = MERGE_PARTITIONS,
    table: str | None = None,
) -> int:
    """Merge ``incoming`` into the table at ``target``, one row per key, rewriting
    only the partitions it touches. ``partition_by`` must be part of ``keys``.

    The merged partitions are written to ``staging`` before ``target`` is touched. A
    run that finds them complete publishes them again, so a crash while partitions
    are swapped loses nothing, and replaying a batch changes nothing. Returns the rows of
    the partitions that were written.
    """
    if not set(partition_by) <= set(keys):
        raise ValueError(f"partition columns {list(partition_by)} must be among the keys {list(keys)}")
    spark = incoming.sparkSession
    schema = incoming.schema
    merged_path = f"{staging}/merged"
    if not path_exists(spark, f"{merged_path}/_SUCCESS"):
        incoming.write.mode("overwrite").parquet(f"{staging}/incoming")
        rows = spark.read.schema(schema).parquet(f"{staging}/incoming")
        if path_exists(spark, target):
            existing = spark.read.schema(schema).parquet(target)
            rows.select(*partition_by).distinct().write.mode("overwrite").parquet(f"{staging}/touched")
            touched = spark.read.schema(rows.select(*partition_by).schema).parquet(f"{staging}/touched")
            rows = _touched_only(existing, touched).select(*schema.fieldNames()).unionByName(rows)
        dedupe_latest(rows, keys, order_by).write.mode("overwrite").parquet(merged_path)
    return publish(spark, target, staging, partition_by, schema, table)


def publish(
    spark: SparkSession, target: str, staging: str, partition_by: Sequence[str], schema: StructType | None = None, table: str | None = None
) -> int:
    """Swap the merged partitions in ``staging`` into ``target``; nothing when there are none complete."""
    if not path_exists(spark, f"{staging}/merged/_SUCCESS"):
        return 0
    reader = spark.read if schema is None else spark.read.schema(schema)
    written = write_partitioned(reader.parquet(f"{staging}/merged"), target, partition_by, table=table, rebalance=True)
    delete_path(spark, staging)
    return written


def _start(stream: DataFrame, checkpoint: str, each_batch, available_now: bool) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(each_batch).option("checkpointLocation", checkpoint)
    if not available_now:
        return writer.start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def ingest_stats(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    job_name: str = "ingest_stats",
    order_by: Sequence[Column] | None = None,
    keep: Sequence[str] = (),
    partition_by: Sequence[str] = MERGE_PARTITIONS,
    available_now: bool = True,
    run_date: dt.date | None = None,
) -> StreamingQuery:
    """Raw statistics (either layout) from a stream of files into the silver table.

    With ``available_now`` it takes what has landed since the last run and ends; else
    it keeps running. ``keep`` names extra raw columns that ``order_by`` needs; they
    stay in the table, because later batches are ordered against them. ``run_date`` is the
    day API rows trend on; give it when a batch may be replayed on another day.
    """

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        incoming = stamp(add_ratios(cleanse(to_canonical(batch, run_date, keep))), job_name)
        merge_latest(
            incoming, target, f"{checkpoint}-merge/batch-{batch_id}", order_by=order_by, partition_by=partition_by
        )

    return _start(stream, checkpoint, each_batch, available_now)


def ingest_reference(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    report_path: str | None = None,
    schema: StructType | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Reference documents as they arrive; each replaces the partition of its region.

    Bad documents are reported and do not stop the others. The report of a batch goes
    to its own directory, so a replayed batch overwrites it.
    """

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        # Parsed once: the fields, the rows and the report all come from the written items.
        parsed = materialise(parse_documents(batch), "reference-batch")
        # Gathered by region, or every task would leave a file in every region.
        overwrite_partitions(silver_reference(parsed, schema=schema), target, rebalance=True)
        if report_path is not None:
            ingest_report(parsed).write.mode("overwrite").parquet(f"{report_path}/batch_id={batch_id}")

    return _start(stream, checkpoint, each_batch, available_now)
