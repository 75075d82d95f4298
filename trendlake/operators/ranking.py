"""Ranks and shares within groups, without a task that holds a whole group.

A window over ``region`` would sort every channel of a region in one task. Here
the rows are range-partitioned on (group, order), so a group of any size spreads
over many tasks, and only one small row per (task, group) is combined.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlake.operators.sizes import broadcast_if_small
from trendlake.session import materialise


def _renamed(small: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, Column]:
    """``small`` with its key columns renamed, and the null-safe condition that matches them."""
    small = small.withColumnsRenamed({c: f"_key_{c}" for c in columns})
    return small, reduce(lambda a, b: a & b, (F.col(f"`{c}`").eqNullSafe(F.col(f"`_key_{c}`")) for c in columns))


def rank_within(df: DataFrame, within: Sequence[str], order_by: Sequence[Column], out: str) -> DataFrame:
    """``row_number`` of each row in its ``within`` group. ``order_by`` must be total.

    Runs the job that sorts the rows at once: slice and position are written with
    the rows, so they cannot change between the two reads.
    """
    sort = [F.col(f"`{c}`").asc() for c in within] + list(order_by)
    placed = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    placed = placed.withColumns({"_slice": F.spark_partition_id(), "_pos": F.monotonically_increasing_id()})
    placed = materialise(placed, "rank")

    # One row per (slice, group): where the group starts there and how many came before.
    slices = placed.groupBy("_slice", *within).agg(F.min("_pos").alias("_start"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*within).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")

    slices, same = _renamed(slices, ["_slice", *within])
    rank = (F.col("_before") + F.col("_pos") - F.col("_start") + 1).cast("int").alias(out)
    return placed.join(broadcast_if_small(slices), same, "inner").select(*df.columns, rank)


def share_within(df: DataFrame, value: str, within: Sequence[str], out: str, digits: int = 2) -> DataFrame:
    """``value`` as a percentage of its group's total; null when the total is 0.

    The totals are combined map-side and joined back; adaptive execution splits a
    hot group if they are too many to broadcast.
    """
    rows = materialise(df, "share")
    totals, same = _renamed(rows.groupBy(*within).agg(F.sum(value).alias("_total")), within)
    share = F.round(F.try_divide(F.col(value), F.col("_total")) * 100, digits).alias(out)
    return rows.join(broadcast_if_small(totals), same, "inner").select(*df.columns, share)
