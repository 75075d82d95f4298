import datetime as dt

from pyspark.sql import functions as F

from trendlake.functions import (
    decode_key,
    engagement_rate,
    exact_avg,
    like_ratio,
    normalize_region,
    parse_mixed_date,
    region_from_key,
    to_boolean,
    to_long,
)


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_to_long_is_lenient_and_never_raises(spark):
    values = ["12", " 7 ", "12.9", "-3.5", "5.", "x", "", None, "1e3", "99999999999999999999", "12.5.1"]
    assert apply(spark, to_long, values) == [12, 7, 12, -3, 5, None, None, None, None, None, None]


def test_to_long_keeps_longs(spark):
    assert apply(spark, to_long, [1, None, 2**62], "bigint") == [1, None, 2**62]


def test_to_boolean(spark):
    assert apply(spark, to_boolean, ["True", "false", "1", "maybe", None]) == [True, False, True, None, None]


def test_normalize_region_trims_blanks_only(spark):
    assert apply(spark, normalize_region, ["  CA ", "Gb", "\tus", None]) == ["ca", "gb", "\tus", None]


def test_parse_mixed_date(spark):
    values = ["17.14.11", "2018-01-02", "2018-01-02 10:11:12", "98.03.10", "17.31.02", "17.14.13", "14/11/2017", "", None]
    assert apply(spark, parse_mixed_date, values) == [
        dt.date(2017, 11, 14), dt.date(2018, 1, 2), dt.date(2018, 1, 2), dt.date(2098, 10, 3),
        None, None, None, None, None,
    ]


def test_ratios(spark):
    rows = [(0, 5, 1, 1, 1), (1, 5, 1, 1, 1), (3, 200, 1, 2, 3), (1, 0, 9, 9, 9), (1, -4, 1, 1, 1), (1, None, 1, 1, 1)]
    df = spark.createDataFrame(rows, "likes long, views long, dislikes long, comment_count long, x int")
    found = [tuple(r) for r in df.select(like_ratio(), engagement_rate()).collect()]
    assert found == [(0.0, 40.0), (20.0, 60.0), (1.5, 3.0), (0.0, 0.0), (0.0, 0.0), (0.0, 0.0)]


def test_ratio_rounds_half_up(spark):
    df = spark.createDataFrame([(1, 80000, 0, 0)], "likes long, views long, dislikes long, comment_count long")
    assert df.select(like_ratio()).first()[0] == 0.0013  # 0.00125


def test_engagement_survives_absurd_counts(spark):
    big = 2**63 - 1
    df = spark.createDataFrame([(big, 1, big, big)], "likes long, views long, dislikes long, comment_count long")
    assert df.select(engagement_rate()).first()[0] > 1e21
    rated = df.select(engagement_rate().alias("r"))
    assert rated.agg(exact_avg(F.col("r"))).first()[0] > 1e21


def test_exact_avg(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,), (None,)], "r double")
    assert df.agg(exact_avg(F.col("r"))).first()[0] == 0.6 / 3
    assert df.where("r is null").agg(exact_avg(F.col("r"))).first()[0] is None


def test_decode_key(spark):
    values = ["a+b%20c", "100%", "a%zz+%41", "caf%C3%A9", "plain", None]
    assert apply(spark, decode_key, values) == ["a b c", "100%", "a%zz A", "café", "plain", None]
    assert apply(spark, lambda c: decode_key(c, plus_is_blank=False), ["a+b%20c"]) == ["a+b c"]


def test_region_from_key(spark):
    values = ["x/region=ca/f.json", "region=us=z/f", "x/f.json", "x/region=/f", "x/region=a/region=b/f", "xregion=ca/f"]
    assert apply(spark, region_from_key, values) == ["ca", "us", "unknown", "", "a", "unknown"]
