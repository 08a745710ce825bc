from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from growthmill.operators import campaign, staging
from growthmill.plans import growth, marketing, revenue

ADS = "campaign_id string, ad_group_id string, date date, device string, impressions bigint, clicks bigint, cost double, conversions double, conversion_value double"


def test_google_ratios_use_the_raw_metrics(spark):
    df = spark.createDataFrame(
        [
            ("1", "g", date(2024, 1, 1), "MOBILE", 100, 4, None, 2.0, 8.0),
            ("2", "g", date(2024, 1, 1), None, 0, 0, 0.0, 0.0, 5.0),
            ("3", "g", None, "X", 1, 1, 1.0, 1.0, 1.0),
            (None, "g", date(2024, 1, 1), "X", 1, 1, 1.0, 1.0, 1.0),
        ],
        ADS,
    )
    got = {r.campaign_id: r for r in staging.stg_google_ads(df).collect()}
    assert set(got) == {"1", "2"}
    assert (got["1"].cost_usd, got["1"].cpc, got["1"].ctr, got["1"].roas, got["1"].device) == (0.0, None, 0.04, None, "mobile")
    assert (got["2"].ctr, got["2"].cpa, got["2"].roas, got["2"].conversion_value_usd) == (None, None, None, 5.0)


def test_fractional_counts_round_half_away_from_zero(spark):
    df = spark.createDataFrame([("1", "g", date(2024, 1, 1), 2.5, -2.5)],
                               "campaign_id string, ad_group_id string, date date, impressions double, clicks double")
    row = staging.stg_google_ads(df).first()
    assert (row.impressions, row.clicks) == (3, -3)


def test_orders_keep_the_landed_status_for_is_paid(spark):
    df = spark.createDataFrame(
        [(1, "Paid", 1.0, None), (2, "paid", None, 2.0), (3, None, 0.0, None), (4, "refunded", 0.0, None)],
        "order_id bigint, financial_status string, total_discounts double, total_tax double",
    ).withColumns({"object_type": F.lit("order"), "total_price": F.lit(10.0)})
    got = {r.order_id: r for r in staging.stg_shopify_orders(df).collect()}
    assert set(got) == {"1", "2"}
    assert (got["1"].is_paid, got["1"].order_type, got["1"].net_revenue) == (False, "discounted", None)
    assert (got["2"].is_paid, got["2"].order_type, got["2"].net_revenue, got["2"].is_cancelled) == (True, "full_price", 8.0, False)


def test_contacts_accept_both_tags_and_spellings(spark, rows):
    df = spark.createDataFrame(
        [("1", "contact", "MQL"), ("2", "contacts", "SalesQualifiedLead"), ("3", "deals", "mql"), (None, "contact", "x"), ("5", "contact", None)],
        "id string, object_type string, lifecyclestage string",
    )
    assert rows(staging.stg_hubspot_contacts(df), "contact_id", "is_mql", "is_sql") == [
        ("1", True, False), ("2", False, True), ("5", None, None),
    ]


def test_campaign_transform_of_the_known_row(spark):
    df = spark.createDataFrame(
        [("c1", date(2026, 1, 1), 1000, 50, 100.0, 5.0, 500.0, "google_ads", "SEARCH")] * 2
        + [("c2", date(2026, 1, 1), -1, 50, 100.0, 5.0, 500.0, "google_ads", "SEARCH")],
        "campaign_id string, date date, impressions int, clicks int, cost double, conversions double, conversion_value double, _source string, channel_type string",
    )
    (row,) = campaign.campaign_transform(df).collect()
    assert (row.ctr, row.cpc, row.roas, row.cpm, row.channel_normalized) == (0.05, 2.0, 5.0, 100.0, "other")


def test_campaign_transform_without_conversions(spark):
    df = spark.createDataFrame([("a", "2024-01-05", "abc", "4", "2.0"), ("b", "someday", "10", "0", None)],
                               "ad_id string, date_start string, impressions string, clicks string, spend string")
    got = {r.ad_id: r for r in campaign.campaign_transform(df).collect()}
    assert (got["a"].date, got["a"].impressions, got["a"].cpc, got["a"].cpa, got["a"].roas) == (date(2024, 1, 5), 0.0, 0.5, 0.0, 0.0)
    assert (got["b"].date, got["b"].cost, got["b"].ctr) == (None, 0.0, 0.0)


def test_canonical_names_are_not_overwritten(spark):
    df = spark.createDataFrame([(1, 2, 3)], "cost int, spend int, cost_micros int")
    assert campaign.canonical_rename(df).columns == ["cost", "spend", "cost_micros"]
    df = spark.createDataFrame([(1, 2)], "cost_micros int, spend int")
    assert campaign.canonical_rename(df).columns == ["cost", "spend"]


def test_linkedin_joins_the_unified_fact(spark):
    none = spark.createDataFrame([], ADS)
    meta = spark.createDataFrame([], "campaign_id string, ad_id string, date_start date")
    linkedin = spark.createDataFrame([("u", date(2024, 1, 7), 10, 2, 4.0)], "pivot_value string, date_start date, impressions bigint, clicks bigint, cost double")
    (row,) = marketing.fct_campaign_performance(
        staging.stg_google_ads(none), staging.stg_meta_ads(meta), staging.stg_linkedin_ads(linkedin)
    ).collect()
    assert (row.channel_source, row.campaign_id, row.cost_usd, row.week_start, row.week_of_year) == ("linkedin_ads", "u", 4.0, date(2024, 1, 7), 1)


def orders_of(spark, data):
    df = spark.createDataFrame(data, "order_id bigint, created_at timestamp, total_price double, currency string, source_name string")
    return staging.stg_shopify_orders(
        df.withColumns({"object_type": F.lit("order"), "financial_status": F.lit("paid"), "total_tax": F.lit(0.0),
                        "total_discounts": F.lit(0.0), "customer_id": F.col("order_id")})
    )


def test_previous_revenue_follows_calendar_months_across_years(spark):
    data = [
        (1, datetime(2022, 1, 3), 10.0, "EUR", "a"), (2, datetime(2022, 1, 3), 20.0, "USD", "a"),
        (3, datetime(2022, 1, 9), 30.0, "EUR", "a"), (4, datetime(2022, 3, 1), 99.0, "EUR", "a"),
        (5, datetime(2024, 1, 1), 60.0, "EUR", "a"), (6, datetime(2024, 1, 1), 15.0, "EUR", "b"),
    ]
    got = [
        (r.order_date, r.currency, r.traffic_source, r.gross_revenue, r.prev_month_revenue)
        for r in revenue.fct_revenue(orders_of(spark, data)).collect()
    ]
    expected, before = [], {}
    for _, at, price, currency, source in sorted(data, key=lambda r: (r[1], r[3], r[4])):
        expected.append((at.date(), currency, source, price, before.get(at.month)))
        before[at.month] = price
    assert sorted(got) == sorted(expected)


def test_monthly_growth_skips_missing_months(spark):
    data = [(1, datetime(2022, 1, 3), 10.0, "EUR", "a"), (2, datetime(2022, 4, 3), 15.0, "EUR", "a"), (3, datetime(2024, 1, 9), 30.0, "EUR", "a")]
    orders = orders_of(spark, data)
    mom = {r.month_start: r.growth_rate for r in revenue.revenue_mom(orders).collect()}
    yoy = {r.month_start: r.growth_rate for r in revenue.revenue_yoy(orders).collect()}
    assert mom == {date(2022, 1, 1): None, date(2022, 4, 1): 0.5, date(2024, 1, 1): 1.0}
    assert yoy == {date(2022, 1, 1): None, date(2022, 4, 1): None, date(2024, 1, 1): 2.0}


def test_funnel_steps_repeat_for_a_repeated_first_step(spark):
    df = spark.createDataFrame(
        [(1, date(2024, 1, 1), 0, 10), (1, date(2024, 1, 1), 0, 20), (1, date(2024, 1, 1), 1, 5), (2, date(2024, 1, 1), 1, 5)],
        "funnel_id bigint, date date, step_index int, count bigint",
    )
    got = growth.fct_mixpanel_funnel(staging.stg_mixpanel_funnels(df)).collect()
    assert len(got) == 7
    assert sorted(r.cumulative_drop_off_rate for r in got if r.step_index == 1 and r.funnel_id == "1") == [0.5, 0.75]
    assert [r.top_of_funnel_count for r in got if r.funnel_id == "2"] == [None]


def test_bridged_attribution_finds_spend_that_the_literal_join_does_not(spark):
    sessions = spark.createDataFrame(
        [(date(2024, 1, 1), "google", "cpc", "Camp", "paid_search", 100.0, 2, 5)],
        "date date, session_source string, session_medium string, campaign_name string, channel_normalized string, revenue_usd double, conversions bigint, sessions bigint",
    )
    roi = spark.createDataFrame(
        [(date(2024, 1, 1), "google_ads", "1", "Camp", 30.0), (date(2024, 1, 1), "google_ads", "2", "camp", 20.0)],
        "date date, channel_source string, campaign_id string, campaign_name string, total_spend double",
    )
    (literal,) = revenue.fct_attribution(sessions, roi).collect()
    (bridged,) = revenue.fct_attribution_bridged(sessions, roi).collect()
    assert (literal.total_spend, literal.attributed_roas) == (None, None)
    assert (bridged.total_spend, bridged.attributed_roas) == (50.0, 2.0)
    daily = spark.createDataFrame(
        [(date(2024, 1, 1), "camp", "google", "cpc", "paid_search", "Order Completed", 4, 3)],
        "event_date date, utm_campaign string, utm_source string, utm_medium string, channel_normalized string, event_name string, event_count bigint, unique_users bigint",
    )
    (row,) = marketing.fct_mixpanel_campaign_attribution_bridged(daily, roi).collect()
    assert (row.total_spend, row.cpa_orders, row.cpa_leads) == (50.0, 12.5, None)
    (row,) = marketing.fct_mixpanel_campaign_attribution(daily, roi).collect()
    assert row.total_spend is None and row.orders == 4




def test_spend_of_a_platform_named_like_a_channel_does_not_multiply_rows(spark):
    roi = spark.createDataFrame(
        [(date(2024, 1, 1), "email", c, 1.0) for c in ("a", "b", "c")] + [(date(2024, 1, 1), "email", "a", 2.0)],
        "date date, channel_source string, campaign_name string, total_spend double",
    )
    sessions = spark.createDataFrame(
        [(date(2024, 1, 1), "email", "s", "m", "a", 9.0, 1, 5)],
        "date date, channel_normalized string, session_source string, session_medium string, campaign_name string, "
        "revenue_usd double, conversions bigint, sessions bigint",
    )
    rows = revenue.fct_attribution(sessions, roi).collect()
    assert [(r.total_spend, r.attributed_revenue) for r in rows] == [(5.0, 9.0)]
