"""Scalar column functions. All are built-in expressions, so they stay in codegen."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The short date form is year.day.month with two digits each.
SHORT_DATE = r"^\d{2}\.\d{2}\.\d{2}$"
SHORT_DATE_FORMAT = "yy.dd.MM"


def to_long(c: Column) -> Column:
    """Text to bigint, null when malformed; a decimal fraction is cut off.

    The strict cast rejects ``12.5``. The regular expression runs only for the
    values it rejected.
    """
    text = c.cast("string")
    whole_part = F.regexp_extract(text, r"^\s*([+-]?\d+)\.\d*\s*$", 1)
    return F.coalesce(c.try_cast("bigint"), whole_part.try_cast("bigint"))


def to_boolean(c: Column) -> Column:
    return c.try_cast("boolean")


def normalize_region(c: Column) -> Column:
    """Lower case, trimmed; a blank region is none. A directory cannot tell the two apart, so
    nothing may be keyed on a blank."""
    region = F.lower(F.trim(c))
    return F.when(region != "", region)


def parse_mixed_date(c: Column) -> Column:
    """``17.14.11`` (year, day, month) or an ISO date / timestamp prefix; null otherwise."""
    short = F.try_to_timestamp(c, F.lit(SHORT_DATE_FORMAT)).cast("date")
    return F.when(c.rlike(SHORT_DATE), short).otherwise(c.try_cast("date"))


def ratio_pct(numerator: Column, denominator: Column, digits: int = 4) -> Column:
    """Percentage rounded half up, 0.0 unless the denominator is positive."""
    return F.when(denominator > 0, F.round(numerator / denominator * 100, digits)).otherwise(F.lit(0.0))


def like_ratio(likes: str = "likes", views: str = "views") -> Column:
    return ratio_pct(F.col(likes), F.col(views))


def engagement_rate(parts=("likes", "dislikes", "comment_count"), views: str = "views") -> Column:
    """Sum of the interaction counts over views. Adds as double, so that one
    absurd raw count cannot overflow bigint and fail the job."""
    total = F.col(parts[0]).cast("double")
    for name in parts[1:]:
        total = total + F.col(name).cast("double")
    return ratio_pct(total, F.col(views))


RATIO_SCALE = 10_000  # the ratios have 4 decimals


def sum_of_ratios(c: Column) -> Column:
    """Sum of a column with 4 decimals, in ten-thousandths: see ``mean_of_ratios``."""
    return F.sum(F.rint(c * RATIO_SCALE))


def mean_of_ratios(total: Column, n: Column) -> Column:
    """Mean from ``sum_of_ratios`` and a count.

    A float sum of ratios depends on the order in which tasks finish. Whole
    ten-thousandths add up exactly as doubles up to 2^53, a sum of 9e11 percent, at
    a fraction of the cost of decimals; beyond that the last digits are rounded, and
    no value can overflow.
    """
    return F.try_divide(total / RATIO_SCALE, n)


def exact_avg(c: Column) -> Column:
    """Mean of a column with at most 4 decimals, independent of row order."""
    return mean_of_ratios(sum_of_ratios(c), F.count(c))


def instant(as_of: dt.datetime | None = None) -> Column:
    """``as_of`` as a timestamp (without a zone: UTC), or the start of the query."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of if as_of.tzinfo else as_of.replace(tzinfo=dt.timezone.utc))
