from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from growthmill.functions import (
    channel_ga4,
    channel_segment,
    channel_utm,
    lenient_number,
    normalize_channel,
    safe_divide,
    safe_divide_or,
    surrogate_key,
    week_of_year_sunday,
    week_start_sunday,
)
from growthmill.plans.marketing import performance_tier


def test_weeks_start_on_sunday_for_every_day_of_many_years(spark):
    days = [date(2019, 12, 20) + timedelta(days=i) for i in range(2600)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select("d", week_start_sunday(F.col("d")), week_of_year_sunday(F.col("d"))).collect()
    for day, start, week in got:
        assert start == day - timedelta(days=(day.weekday() + 1) % 7)
        assert week == int(day.strftime("%U"))


def test_division_by_zero_is_null_or_filled(spark):
    df = spark.createDataFrame([(10.0, 0.0), (0.0, 0.0), (None, 2.0), (1.0, 4.0)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    got = [tuple(r) for r in df.select(safe_divide(a, b), safe_divide_or(a, b), safe_divide_or(a, b, -1.0)).collect()]
    assert got == [(None, 0.0, -1.0), (None, 0.0, -1.0), (None, 0.0, -1.0), (0.25, 0.25, 0.25)]


def test_text_that_is_no_number_counts_as_zero(spark):
    texts = ["12.5", " 7 ", "1e3", "-.5", "abc", "", None, "nan", "12d", "3f", "1,000"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(lenient_number(F.col("t"))).collect()]
    assert got == [12.5, 7.0, 1000.0, -0.5, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]


@pytest.mark.parametrize(
    ("source", "medium", "channel"),
    [
        ("facebook", "cpc", "paid_search"),
        ("Google", "CPC", "paid_search"),
        ("Google", "organic", "organic_search"),
        ("x", "cpm", "paid_social"),
        ("TikTok", None, "paid_social"),
        ("x", "EMAIL", "email"),
        ("", "", "other"),
        (None, None, "direct"),
        ("", None, "other"),
        (None, "referral", "referral"),
    ],
)
def test_utm_channel(spark, source, medium, channel):
    df = spark.createDataFrame([(source, medium)], "s string, m string")
    assert df.select(channel_utm(F.col("s"), F.col("m"))).first()[0] == channel


def test_other_channel_mappings(spark):
    df = spark.createDataFrame([("Organic Social",), ("PAID SOCIAL",), ("Video",), (None,)], "g string")
    assert [r[0] for r in df.select(channel_ga4(F.col("g"))).collect()] == [
        "organic_search", "paid_social", "other", "other",
    ]
    df = spark.createDataFrame([("",), (None,), ("  Google Ads",), ("SEARCH",), ("metadata",), ("seo-blog",)], "t string")
    assert [r[0] for r in df.select(normalize_channel(F.col("t"))).collect()] == [
        "unknown", "unknown", "paid_search", "other", "paid_social", "organic_search",
    ]
    df = spark.createDataFrame(
        [("utm_source", "Bing"), ("utm_source", "Partner"), ("utm_source", None), ("os", "google")], "p string, v string"
    )
    assert [r[0] for r in df.select(channel_segment(F.col("p"), F.col("v"))).collect()] == [
        "paid_search", "partner", None, None,
    ]


def test_surrogate_key_tells_null_from_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", None)], "x string, y string")
    keys = [r[0] for r in df.select(surrogate_key(F.col("x"), F.col("y"))).collect()]
    assert keys[0] == keys[2] != keys[1]


def test_performance_tiers(spark):
    df = spark.createDataFrame([(4.0,), (3.99,), (2.0,), (1.0,), (0.99,), (None,)], "r double")
    assert [r[0] for r in df.select(performance_tier(F.col("r"))).collect()] == [
        "high_performer", "mid_performer", "mid_performer", "break_even", "underperformer", "underperformer",
    ]
