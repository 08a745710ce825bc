"""Paid-media and product-event marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthmill.functions import (
    month_start,
    safe_divide,
    spend_channel,
    week_of_year_sunday,
    week_start_sunday,
)

# Columns of the unified fact and their types.
CAMPAIGN_TYPES = {
    "date": "date",
    "campaign_id": "string",
    "campaign_name": "string",
    "ad_group_id": "string",
    "ad_group_name": "string",
    "campaign_type": "string",
    "device": "string",
    "objective": "string",
    "impressions": "bigint",
    "clicks": "bigint",
    "cost_usd": "double",
    "conversions": "double",
    "conversion_value_usd": "double",
    "video_views": "bigint",
    "ctr": "double",
    "cpc": "double",
    "cpm": "double",
    "cvr": "double",
    "cpa": "double",
    "roas": "double",
    "channel_source": "string",
}

# --- Fixed values: tier floors and the events counted for attribution ---------
TIER_FLOORS = ((4.0, "high_performer"), (2.0, "mid_performer"), (1.0, "break_even"))
LOWEST_TIER = "underperformer"

CONVERSION_EVENTS = (
    ("Order Completed", "orders"),
    ("Lead Form Submitted", "leads"),
    ("Demo Requested", "demo_requests"),
    ("Signed Up", "signups"),
    ("Checkout Started", "checkout_starts"),
    ("Add to Cart", "add_to_carts"),
    ("Page Viewed", "page_views"),
)
# ------------------------------------------------------------------------------


def performance_tier(roas: Column) -> Column:
    tier = F
    for floor, name in TIER_FLOORS:
        tier = tier.when(roas >= floor, name)
    return tier.otherwise(LOWEST_TIER)


def _campaign_shape(staged: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Project a staged platform onto the shared campaign columns, nulls where it has none."""
    source_of = {new: old for old, new in renames.items()}
    present = set(staged.columns)
    columns = []
    for name, kind in CAMPAIGN_TYPES.items():
        source = source_of.get(name, name)
        column = F.col(source) if source in present else F.lit(None)
        columns.append(column.cast(kind).alias(name))
    return staged.select(*columns)


def fct_campaign_performance(
    google: DataFrame, meta: DataFrame, linkedin: DataFrame | None = None
) -> DataFrame:
    """All paid channels in one shape, with calendar columns."""
    rows = _campaign_shape(google, {"channel_type": "campaign_type"}).unionByName(
        _campaign_shape(
            meta, {"adset_id": "ad_group_id", "ad_set_name": "ad_group_name", "purchases": "conversions"}
        )
    )
    if linkedin is not None:
        rows = rows.unionByName(_campaign_shape(linkedin, {}))
    day = F.col("date")
    return rows.select(
        "*",
        week_start_sunday(day).alias("week_start"),
        month_start(day).alias("month_start"),
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        week_of_year_sunday(day).alias("week_of_year"),
    )


def fct_ad_spend_roi(performance: DataFrame) -> DataFrame:
    """Daily spend, value and ratio-of-sums KPIs per channel and campaign."""
    sums = performance.groupBy(
        "date", "week_start", "month_start", "channel_source", "campaign_id", "campaign_name"
    ).agg(
        F.sum("cost_usd").alias("total_spend"),
        F.sum("conversion_value_usd").alias("total_conversion_value"),
        F.sum("conversions").alias("total_conversions"),
        F.sum("impressions").alias("total_impressions"),
        F.sum("clicks").alias("total_clicks"),
    )
    spend, value = F.col("total_spend"), F.col("total_conversion_value")
    clicks, views = F.col("total_clicks"), F.col("total_impressions")
    roas = safe_divide(value, spend)
    return sums.select(
        "*",
        safe_divide(clicks, views).alias("ctr"),
        safe_divide(spend, clicks).alias("cpc"),
        (safe_divide(spend, views) * 1000).alias("cpm"),
        safe_divide(F.col("total_conversions"), clicks).alias("cvr"),
        safe_divide(spend, F.col("total_conversions")).alias("cpa"),
        roas.alias("roas"),
        safe_divide(value - spend, spend).alias("roi"),
        performance_tier(roas).alias("performance_tier"),
    )


def fct_mixpanel_events(events: DataFrame) -> DataFrame:
    """Daily event volume and unique users per event, channel, UTM tags, country and device."""
    day = F.col("event_date")
    users = F.count_distinct("distinct_id")
    return events.groupBy(
        "event_date",
        week_start_sunday(day).alias("week_start"),
        month_start(day).alias("month_start"),
        "event_name",
        "channel_normalized",
        "utm_source",
        "utm_medium",
        "utm_campaign",
        "utm_content",
        "country_code",
        "operating_system",
        "device_type",
    ).agg(
        F.count(F.lit(1)).alias("event_count"),
        users.alias("unique_users"),
        safe_divide(F.count(F.lit(1)), users).alias("events_per_user"),
    )


def _campaign_conversions(daily_events: DataFrame) -> DataFrame:
    """Event counts pivoted to one column per conversion event, per day and UTM campaign."""
    volume = F.col("event_count")
    return (
        daily_events.filter(F.col("utm_campaign").isNotNull())
        .groupBy("event_date", "utm_campaign", "utm_source", "utm_medium", "channel_normalized")
        .agg(
            *[
                F.sum(F.when(F.col("event_name") == event, volume).otherwise(0)).alias(name)
                for event, name in CONVERSION_EVENTS
            ],
            F.sum("unique_users").alias("total_unique_users"),
            F.sum("event_count").alias("total_events"),
        )
    )


def _conversion_kpis(joined: DataFrame) -> DataFrame:
    spend = F.col("total_spend")

    def rate(top: str, bottom: str) -> Column:
        return safe_divide(F.col(top), F.col(bottom))

    return joined.select(
        "*",
        safe_divide(spend, F.col("orders")).alias("cpa_orders"),
        safe_divide(spend, F.col("leads")).alias("cpa_leads"),
        safe_divide(spend, F.col("signups")).alias("cpa_signups"),
        rate("checkout_starts", "add_to_carts").alias("cart_to_checkout_rate"),
        rate("orders", "checkout_starts").alias("checkout_to_order_rate"),
        rate("orders", "page_views").alias("page_to_order_rate"),
    )


def fct_mixpanel_campaign_attribution(daily_events: DataFrame, roi: DataFrame) -> DataFrame:
    """Conversions per UTM campaign next to the spend of the same day, name and channel.

    Spend is rolled up to the join key, so no conversion row multiplies. The channel column is compared with the platform name as it stands, so spend is found only
    where a platform is named like a channel; the bridged form maps one to the other.
    """
    spend = roi.groupBy(
        F.col("date").alias("event_date"),
        F.col("campaign_name").alias("utm_campaign"),
        F.col("channel_source").alias("channel_normalized"),
    ).agg(F.sum("total_spend").alias("total_spend"))
    keys = ["event_date", "utm_campaign", "channel_normalized"]
    return _conversion_kpis(_campaign_conversions(daily_events).join(spend, keys, "left"))


def spend_by_channel(roi: DataFrame, *extra: Column) -> DataFrame:
    """Spend rolled up to day, marketing channel and any extra keys; one row per key."""
    return roi.groupBy("date", spend_channel(F.col("channel_source")).alias("channel"), *extra).agg(
        F.sum("total_spend").alias("total_spend")
    )


def fct_mixpanel_campaign_attribution_bridged(daily_events: DataFrame, roi: DataFrame) -> DataFrame:
    """As above, with platforms mapped to channels and names compared in lower case."""
    spend = spend_by_channel(roi, F.lower("campaign_name").alias("utm_campaign")).withColumnsRenamed(
        {"date": "event_date", "channel": "channel_normalized"}
    )
    keys = ["event_date", "utm_campaign", "channel_normalized"]
    return _conversion_kpis(_campaign_conversions(daily_events).join(spend, keys, "left"))
