from trendlake.functions.keys import decode_key, region_from_key
from trendlake.functions.scalars import (
    engagement_rate,
    exact_avg,
    instant,
    like_ratio,
    mean_of_ratios,
    normalize_region,
    parse_mixed_date,
    ratio_pct,
    sum_of_ratios,
    to_boolean,
    to_long,
)

__all__ = [
    "decode_key",
    "engagement_rate",
    "exact_avg",
    "instant",
    "like_ratio",
    "mean_of_ratios",
    "normalize_region",
    "parse_mixed_date",
    "ratio_pct",
    "region_from_key",
    "sum_of_ratios",
    "to_boolean",
    "to_long",
]
