"""Category names for the statistics."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from trendlake.functions import normalize_region, to_long
from trendlake.operators.sizes import MAX_BROADCAST_BYTES, MAX_BROADCAST_ROWS, broadcast_if_small

log = logging.getLogger(__name__)

UNKNOWN = "Unknown"  # fixed value: the name of an id without a match


def build_lookup(ref: DataFrame) -> DataFrame | None:
    """Reference rows to one ``(category_id, category_name)`` per id, over all regions.

    The pick is deterministic: the named row of the first region. ``None`` when the
    id or title column is absent.
    """
    title = None
    for flat in ("snippet.title", "snippet_title"):
        if title is None and flat in ref.columns:
            title = F.col(f"`{flat}`")
    if title is None and "snippet" in ref.columns and isinstance(ref.schema["snippet"].dataType, StructType):
        if "title" in ref.schema["snippet"].dataType.fieldNames():
            title = F.col("snippet.title")
    if title is None or "id" not in ref.columns:
        log.warning("no category id or title column; columns found: %s", ref.columns)
        return None
    region = normalize_region(F.col("region")) if "region" in ref.columns else F.lit(None).cast("string")
    rows = ref.select(
        to_long(F.col("id")).alias("category_id"),
        F.struct(title.isNull().alias("unnamed"), region.alias("region"), title.alias("name")).alias("pick"),
    ).where(F.col("category_id").isNotNull())
    return rows.groupBy("category_id").agg(F.min("pick")["name"].alias("category_name"))


def attach_category(
    stats: DataFrame,
    lookup: DataFrame | None = None,
    max_rows: int = MAX_BROADCAST_ROWS,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Left join on ``category_id``; rows without a name get ``Unknown``.

    ``lookup`` is unique by id, so no row fans out. It is broadcast when it measures
    within the bounds. Without a lookup every row is ``Unknown``.
    """
    if lookup is not None:
        if not isinstance(stats.schema["category_id"].dataType, LongType):
            stats = stats.withColumn("category_id", to_long(F.col("category_id")))
        stats = stats.join(broadcast_if_small(lookup, max_rows, max_bytes), "category_id", "left")
    if "category_name" not in stats.columns:
        return stats.withColumn("category_name", F.lit(UNKNOWN))
    return stats.fillna(UNKNOWN, subset=["category_name"])
