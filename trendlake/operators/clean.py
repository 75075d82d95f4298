"""Raw statistics of either layout to the clean silver table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from trendlake.functions import (
    engagement_rate,
    instant,
    like_ratio,
    normalize_region,
    parse_mixed_date,
    to_boolean,
    to_long,
)
from trendlake.schemas import CANONICAL, MEASURES, VIDEO_KEY

# Canonical column -> path of the field in the API layout.
API_FIELDS = {
    "title": "snippet.title",
    "channel_title": "snippet.channelTitle",
    "category_id": "snippet.categoryId",
    "publish_time": "snippet.publishedAt",
    "tags": "snippet.tags",
    "views": "statistics.viewCount",
    "likes": "statistics.likeCount",
    "dislikes": "statistics.dislikeCount",
    "comment_count": "statistics.commentCount",
    "thumbnail_link": "snippet.thumbnails.default.url",
    "description": "snippet.description",
}

# What the API layout does not carry.
API_DEFAULTS = {"tags": None, "dislikes": 0, "thumbnail_link": None}
API_FLAGS = ("comments_disabled", "ratings_disabled", "video_error_or_removed")


def _field(df: DataFrame, path: str) -> Column | None:
    """The column holding ``path``: flat dotted name, flat ``__`` name or nested struct."""
    for flat in (path, path.replace(".", "__")):
        if flat in df.columns:
            return F.col(f"`{flat}`")
    schema, parts, found = df.schema, path.split("."), None
    for i, part in enumerate(parts):
        if not isinstance(schema, StructType) or part not in schema.fieldNames():
            return None
        schema = schema[part].dataType
        found = F.col(f"`{part}`") if i == 0 else found.getField(part)
    # A list of tags takes the form it has in the CSV layout.
    return F.when(found.isNotNull(), F.concat_ws("|", found)) if isinstance(schema, ArrayType) else found


def detect_layout(df: DataFrame) -> str:
    """``"api"`` when a ``snippet.title`` field exists in any spelling, else ``"csv"``."""
    return "csv" if _field(df, "snippet.title") is None else "api"


def _typed(c: Column, name: str) -> Column:
    kind = CANONICAL[name]
    if kind == "bigint":
        return to_long(c).alias(name)
    if kind == "boolean":
        return to_boolean(c).alias(name)
    return c.cast(kind).alias(name)


def from_api_layout(df: DataFrame, run_date: dt.date | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """API rows to the canonical columns; they trend on the run date (UTC by default)."""
    if run_date is None:
        now_utc = F.to_utc_timestamp(instant(), F.current_timezone())
        trending_date = F.date_format(now_utc, "yy.dd.MM")
    else:
        trending_date = F.lit(run_date.strftime("%y.%d.%m"))
    columns = {"video_id": F.col("id"), "trending_date": trending_date, "region": F.col("region")}
    columns |= {flag: F.lit(False) for flag in API_FLAGS}
    for name, path in API_FIELDS.items():
        source = _field(df, path)
        if source is None and name not in API_DEFAULTS:
            raise ValueError(f"field '{path}' is missing; columns found: {df.columns}")
        default = API_DEFAULTS.get(name)
        if source is None:
            source = F.lit(default)
        elif default is not None:
            # Absent from this row, though some rows or the schema have it.
            source = F.coalesce(source, F.lit(default).cast("string"))
        columns[name] = source
    return df.select(*(_typed(columns[name], name) for name in CANONICAL), *keep)


def from_csv_layout(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """CSV rows (all text) to the canonical columns; malformed values become null."""
    return df.select(*(_typed(F.col(name), name) for name in CANONICAL), *keep)


def to_canonical(df: DataFrame, run_date: dt.date | None = None, keep: Sequence[str] = ()) -> DataFrame:
    if detect_layout(df) == "api":
        return from_api_layout(df, run_date, keep)
    return from_csv_layout(df, keep)


def null_to_zero(df: DataFrame, columns: Sequence[str] = MEASURES) -> DataFrame:
    return df.withColumns({name: F.coalesce(F.col(name), F.lit(0).cast("bigint")) for name in columns})


def cleanse(df: DataFrame) -> DataFrame:
    """Drop rows without a video, normalise region and date, fill the counts."""
    df = df.where(F.col("video_id").isNotNull()).withColumns(
        {"region": normalize_region(F.col("region")), "trending_date_parsed": parse_mixed_date(F.col("trending_date"))}
    )
    return null_to_zero(df)


def add_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns({"like_ratio": like_ratio(), "engagement_rate": engagement_rate()})


def stamp(df: DataFrame, job_name: str, as_of: dt.datetime | None = None) -> DataFrame:
    return df.withColumns({"_processed_at": instant(as_of), "_job_name": F.lit(job_name)})


def content_order(
    df: DataFrame, first: Sequence[str] = ("_processed_at", *MEASURES), keys: Sequence[str] = VIDEO_KEY
) -> list[Column]:
    """A total order of the rows of one key by content: newest and most viewed first, then
    every other column. Rows that tie in all of it are equal, so the pick does not depend
    on partitioning."""
    names = [name for name in first if name in df.columns]
    names += [name for name in df.columns if name not in names and name not in keys]
    return [F.col(f"`{name}`").desc() for name in names]


def dedupe_latest(
    df: DataFrame, keys: Sequence[str] = VIDEO_KEY, order_by: Sequence[Column] | None = None
) -> DataFrame:
    """One row per key, the first in ``order_by`` (default: ``content_order``).

    ``row_number() = 1`` makes Spark cut every key to one row per task before the
    shuffle (WindowGroupLimit), so a key that holds a third of the rows sends one
    row per map task, not all its copies.
    """
    window = Window.partitionBy(*keys).orderBy(*(order_by or content_order(df, keys=keys)))
    return df.withColumn("_row_num", F.row_number().over(window)).where(F.col("_row_num") == 1).drop("_row_num")


def silver_statistics(
    df: DataFrame,
    job_name: str,
    as_of: dt.datetime | None = None,
    run_date: dt.date | None = None,
    order_by: Sequence[Column] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Raw rows of either layout to deduplicated silver rows. ``keep`` names extra raw
    columns that ``order_by`` needs; they do not reach the result.

    What can be computed from a surviving row is added after the shuffle."""
    kept = dedupe_latest(cleanse(to_canonical(df, run_date, keep)), order_by=order_by)
    return stamp(add_ratios(kept.drop(*keep)), job_name, as_of)
