"""The gold tables merged from partial results of days, so that a run aggregates only the days that changed.

``day_parts`` reduces the rows of each (region, day) to partial sums, counts and extremes per channel and
category; ``merged`` puts such parts together to any measure of ``gold.DEFINITIONS``. Extremes and distinct
counts cannot be taken back, so a changed day replaces its parts, and what depends on it is merged again
from the parts of all its days. Parts hold video ids in ``SLOTS`` lists, so no row holds all videos of a channel
that a third of a day's rows belong to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlake.functions import mean_of_ratios, sum_of_ratios
from trendlake.operators.gold import CATEGORY, CATEGORY_MEASURES, CHANNEL, CHANNEL_MEASURES, DAY, DAY_MEASURES, DEFINITIONS
from trendlake.operators.ranking import rank_within, share_within

SLOTS = 64
START = {"total": F.sum, "most": F.max, "least": F.min, "count": F.count, "ratios": sum_of_ratios}
COMBINE = {"total": F.sum, "most": F.max, "least": F.min, "count": F.sum, "ratios": F.sum}
PARTS_OF = {"mean": ("total", "count"), "mean of ratios": ("ratios", "count"), "different": ()}


def _parts(*measures: str) -> list[tuple[str, str]]:
    """(kind, column) of the parts that these measures are merged from."""
    found = set()
    for how, column in map(DEFINITIONS.get, measures):
        found |= {(kind, column) for kind in PARTS_OF.get(how, (how,))}
    return sorted(found)


def _name(kind: str, column: str) -> str:
    return f"{kind}_{column}"


def _combined(kind: str, column: str) -> Column:
    return COMBINE[kind](F.col(_name(kind, column)))


def merged(measure: str) -> Column:
    """A measure of ``gold.DEFINITIONS`` from parts; the same value as from the rows."""
    how, column = DEFINITIONS[measure]
    if how == "mean":
        value = F.try_divide(_combined("total", column).cast("double"), _combined("count", column))
    elif how == "mean of ratios":
        value = mean_of_ratios(_combined("ratios", column), _combined("count", column))
    elif how == "different":  # of a column that parts are keyed by
        value = F.countDistinct(column)
    else:
        value = _combined(how, column)
    return value.alias(measure)


def day_parts(stats: DataFrame) -> DataFrame:
    """Parts of silver rows: one row per region, day, channel, category and slot of videos. Rows are unique by
    (video, region, day), as silver's are."""
    measures = _parts(*DAY_MEASURES, *CATEGORY_MEASURES, *CHANNEL_MEASURES)
    slot = F.pmod(F.xxhash64("video_id"), F.lit(SLOTS)).cast("int").alias("slot")
    return stats.groupBy(*DAY, "channel_title", "category_id", slot).agg(
        *(START[kind](F.col(column)).alias(_name(kind, column)) for kind, column in measures),
        F.array_agg("video_id").alias("videos"),
    )


def trending_of_days(parts: DataFrame) -> DataFrame:
    """``gold.trending_analytics`` from parts."""
    return parts.groupBy(*DAY).agg(*map(merged, DAY_MEASURES))


def category_of_days(parts: DataFrame) -> DataFrame:
    """``gold.category_analytics`` from parts with category names."""
    totals = parts.groupBy(*CATEGORY, *DAY).agg(*map(merged, CATEGORY_MEASURES))
    return share_within(totals, "total_views", DAY, "view_share_pct")


def channel_of_days(parts: DataFrame) -> DataFrame:
    """``gold.channel_analytics`` from parts with category names.

    Names and sums come from one row per (channel, category name), videos are counted from one row per
    video; both are one aggregate's input, so no join has to match channels without a title.
    """
    measures = _parts(*CHANNEL_MEASURES, "avg_views_per_video")
    named = parts.groupBy(*CHANNEL, "category_name").agg(*(_combined(*part).alias(_name(*part)) for part in measures))
    videos = parts.select(*CHANNEL, F.explode("videos").alias("video_id")).distinct()
    totals = named.unionByName(videos, allowMissingColumns=True).groupBy(*CHANNEL).agg(
        F.count("video_id").alias("total_videos"),
        *map(merged, (*CHANNEL_MEASURES, "avg_views_per_video")),
        F.sort_array(F.array_agg("category_name")).alias("categories"),
    )
    return rank_within(totals, ["region"], [F.col("total_views").desc(), F.col("channel_title").asc()], "rank_in_region")
