"""Silver models: rename, type and derive, one projection per bronze table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from growthmill.functions import (
    channel_ga4,
    channel_segment,
    channel_utm,
    lower_or_null,
    safe_divide,
    surrogate_key,
)
from growthmill.sources import specs
from growthmill.sources.specs import conform

# --- Fixed values: CRM lifecycle spellings and object tags --------------------
MQL_STAGES = ("marketingqualifiedlead", "mql")
SQL_STAGES = ("salesqualifiedlead", "sql")
CONTACT_TAGS = ("contact", "contacts")
# ------------------------------------------------------------------------------


def _whole(df: DataFrame, name: str) -> Column:
    """Cast to bigint, rounding halves away from zero where the landed column is fractional."""
    column = F.col(name)
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
        column = F.round(column)
    return column.cast("bigint")


def _count(df: DataFrame, name: str) -> Column:
    return F.coalesce(_whole(df, name), F.lit(0).cast("bigint"))


def _amount(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def stg_google_ads(raw: DataFrame) -> DataFrame:
    """One row per campaign, ad group, day and device. Ratios use the raw, nullable metrics."""
    df = conform(raw, specs.GOOGLE_ADS)
    impressions, clicks, cost = F.col("impressions"), F.col("clicks"), F.col("cost")
    return df.filter(F.col("date").isNotNull() & F.col("campaign_id").isNotNull()).select(
        F.col("campaign_id").cast("string").alias("campaign_id"),
        F.col("ad_group_id").cast("string").alias("ad_group_id"),
        F.col("date").cast("date").alias("date"),
        F.lower("device").alias("device"),
        "campaign_name",
        F.lower("campaign_status").alias("campaign_status"),
        F.lower("channel_type").alias("channel_type"),
        "ad_group_name",
        F.lower("ad_group_status").alias("ad_group_status"),
        _count(df, "impressions").alias("impressions"),
        _count(df, "clicks").alias("clicks"),
        _amount("cost").alias("cost_usd"),
        _amount("conversions").alias("conversions"),
        _amount("conversion_value").alias("conversion_value_usd"),
        _count(df, "video_views").alias("video_views"),
        safe_divide(clicks, impressions).alias("ctr"),
        safe_divide(cost, clicks).alias("cpc"),
        (safe_divide(cost, impressions) * 1000).alias("cpm"),
        safe_divide(F.col("conversions"), clicks).alias("cvr"),
        safe_divide(cost, F.col("conversions")).alias("cpa"),
        safe_divide(F.col("conversion_value"), cost).alias("roas"),
        "_extracted_at",
        F.lit("google_ads").alias("channel_source"),
    )


def stg_meta_ads(raw: DataFrame) -> DataFrame:
    """One row per ad and day."""
    df = conform(raw, specs.META_ADS)
    impressions, clicks, spend = F.col("impressions"), F.col("clicks"), F.col("spend")
    return df.filter(F.col("date_start").isNotNull() & F.col("ad_id").isNotNull()).select(
        F.col("campaign_id").cast("string").alias("campaign_id"),
        F.col("adset_id").cast("string").alias("adset_id"),
        F.col("ad_id").cast("string").alias("ad_id"),
        F.col("date_start").cast("date").alias("date"),
        "campaign_name",
        F.col("adset_name").alias("ad_set_name"),
        "ad_name",
        F.lower("objective").alias("objective"),
        F.lower("buying_type").alias("buying_type"),
        _count(df, "impressions").alias("impressions"),
        _count(df, "clicks").alias("clicks"),
        _amount("spend").alias("cost_usd"),
        _count(df, "reach").alias("reach"),
        _amount("frequency").alias("frequency"),
        _amount("action_link_click").alias("link_clicks"),
        _amount("action_purchase").alias("purchases"),
        _amount("action_lead").alias("leads"),
        _amount("action_add_to_cart").alias("add_to_cart"),
        _amount("action_view_content").alias("view_content"),
        _amount("action_initiate_checkout").alias("initiate_checkout"),
        safe_divide(clicks, impressions).alias("ctr"),
        safe_divide(spend, clicks).alias("cpc"),
        (safe_divide(spend, impressions) * 1000).alias("cpm"),
        "_extracted_at",
        F.lit("meta_ads").alias("channel_source"),
    )


def stg_linkedin_ads(raw: DataFrame) -> DataFrame:
    """One row per campaign and day, shaped like the other ad platforms."""
    df = conform(raw, specs.LINKEDIN_ADS)
    impressions, clicks, cost = F.col("impressions"), F.col("clicks"), F.col("cost")
    return df.filter(F.col("date_start").isNotNull() & F.col("pivot_value").isNotNull()).select(
        F.col("pivot_value").cast("string").alias("campaign_id"),
        F.col("date_start").cast("date").alias("date"),
        F.lower("pivot").alias("pivot"),
        _count(df, "impressions").alias("impressions"),
        _count(df, "clicks").alias("clicks"),
        _amount("cost").alias("cost_usd"),
        _amount("conversions").alias("conversions"),
        _count(df, "one_click_leads").alias("leads"),
        _count(df, "video_views").alias("video_views"),
        _count(df, "total_engagements").alias("engagements"),
        safe_divide(clicks, impressions).alias("ctr"),
        safe_divide(cost, clicks).alias("cpc"),
        (safe_divide(cost, impressions) * 1000).alias("cpm"),
        "_extracted_at",
        F.lit("linkedin_ads").alias("channel_source"),
    )


def stg_ga4_sessions(raw: DataFrame) -> DataFrame:
    df = conform(raw, specs.GA4)
    return df.filter(F.col("date").isNotNull()).select(
        F.col("date").cast("date").alias("date"),
        F.col("sessionSource").alias("session_source"),
        F.col("sessionMedium").alias("session_medium"),
        F.col("sessionCampaignName").alias("campaign_name"),
        F.lower("deviceCategory").alias("device_category"),
        "country",
        F.col("landingPage").alias("landing_page"),
        F.col("sessionDefaultChannelGroup").alias("default_channel_group"),
        _count(df, "sessions").alias("sessions"),
        _count(df, "activeUsers").alias("active_users"),
        _count(df, "newUsers").alias("new_users"),
        _count(df, "screenPageViews").alias("page_views"),
        _count(df, "engagedSessions").alias("engaged_sessions"),
        _count(df, "conversions").alias("conversions"),
        _amount("totalRevenue").alias("revenue_usd"),
        _amount("bounceRate").alias("bounce_rate"),
        _amount("engagementRate").alias("engagement_rate"),
        _amount("averageSessionDuration").alias("avg_session_duration_sec"),
        safe_divide(F.col("sessions"), _count(df, "activeUsers")).alias("sessions_per_user"),
        safe_divide(F.col("conversions"), F.col("sessions")).alias("conversion_rate"),
        channel_ga4(F.col("sessionDefaultChannelGroup")).alias("channel_normalized"),
        "_extracted_at",
        F.lit("google_analytics_4").alias("channel_source"),
    )


def stg_hubspot_contacts(raw: DataFrame) -> DataFrame:
    df = conform(raw, specs.HUBSPOT)
    stage = F.lower("lifecyclestage")
    return df.filter(F.col("object_type").isin(*CONTACT_TAGS) & F.col("id").isNotNull()).select(
        F.col("id").alias("contact_id"),
        F.lower("email").alias("email"),
        F.col("firstname").alias("first_name"),
        F.col("lastname").alias("last_name"),
        stage.alias("lifecycle_stage"),
        F.lower("hs_lead_status").alias("lead_status"),
        F.col("hubspot_owner_id").alias("owner_id"),
        F.lower("hs_analytics_source").alias("original_source"),
        F.col("hs_analytics_source_data_1").alias("original_source_detail"),
        F.col("createdate").cast("timestamp").alias("created_at"),
        F.col("lastmodifieddate").cast("timestamp").alias("updated_at"),
        "num_conversion_events",
        "recent_conversion_event_name",
        stage.isin(*MQL_STAGES).alias("is_mql"),
        stage.isin(*SQL_STAGES).alias("is_sql"),
        (stage == "opportunity").alias("is_opportunity"),
        (stage == "customer").alias("is_customer"),
        "_extracted_at",
    )


def stg_shopify_orders(raw: DataFrame) -> DataFrame:
    """Orders that are not refunded. ``is_paid`` compares the status as landed, case and all."""
    df = conform(raw, specs.SHOPIFY)
    price, tax, discount = (F.col(c).cast("double") for c in ("total_price", "total_tax", "total_discounts"))
    keep = (
        (F.col("object_type") == "order")
        & F.col("order_id").isNotNull()
        & (F.col("financial_status") != "refunded")
    )
    return df.filter(keep).select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("created_at").cast("timestamp").alias("order_date"),
        F.col("updated_at").cast("timestamp").alias("updated_at"),
        F.lower("email").alias("customer_email"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.lower("financial_status").alias("financial_status"),
        F.lower("fulfillment_status").alias("fulfillment_status"),
        price.alias("gross_revenue"),
        F.col("subtotal_price").cast("double").alias("subtotal_revenue"),
        tax.alias("tax_amount"),
        discount.alias("discount_amount"),
        (price - tax).alias("net_revenue"),
        "currency",
        "item_count",
        "discount_codes",
        "source_name",
        F.lower("referring_site").alias("referring_site"),
        F.lower("landing_site").alias("landing_page"),
        F.col("cancelled_at").isNotNull().alias("is_cancelled"),
        (F.col("financial_status") == "paid").alias("is_paid"),
        F.when(discount > 0, "discounted").otherwise("full_price").alias("order_type"),
        "_extracted_at",
    )


def stg_mixpanel_events(raw: DataFrame) -> DataFrame:
    df = conform(raw, specs.MIXPANEL_EVENTS)
    required = F.col("event").isNotNull() & F.col("distinct_id").isNotNull() & F.col("time").isNotNull()
    key = surrogate_key(F.col("distinct_id"), F.col("event"), F.col("time"))
    return df.filter(required).select(
        F.coalesce(F.col("insert_id"), key).alias("event_id"),
        F.col("event").alias("event_name"),
        "distinct_id",
        F.col("time").cast("timestamp").alias("event_timestamp"),
        F.col("event_date").cast("date").alias("event_date"),
        F.hour(F.col("time").cast("timestamp")).alias("event_hour"),
        F.upper("country_code").alias("country_code"),
        "city",
        F.col("region").alias("region_name"),
        F.lower("os").alias("operating_system"),
        F.lower("browser").alias("browser"),
        "browser_version",
        F.lower("device").alias("device_type"),
        _whole(df, "screen_width").alias("screen_width"),
        _whole(df, "screen_height").alias("screen_height"),
        *[
            lower_or_null(F.col(name)).alias(name)
            for name in ("utm_source", "utm_medium", "utm_campaign", "utm_content", "utm_term")
        ],
        channel_utm(F.col("utm_source"), F.col("utm_medium")).alias("channel_normalized"),
        "current_url",
        "initial_referrer",
        "referrer",
        F.col("lib").alias("sdk_library"),
        "custom_properties",
        "_extracted_at",
    )


def stg_mixpanel_segmentation(raw: DataFrame) -> DataFrame:
    df = conform(raw, specs.MIXPANEL_SEGMENTATION)
    return df.filter(F.col("date").isNotNull() & F.col("event").isNotNull()).select(
        F.col("date").cast("date").alias("date"),
        F.col("event").alias("event_name"),
        "segment_property",
        lower_or_null(F.col("segment_value")).alias("segment_value"),
        _count(df, "event_count").alias("event_count"),
        channel_segment(F.col("segment_property"), F.col("segment_value")).alias("channel_normalized"),
        "_extracted_at",
    )


def stg_mixpanel_funnels(raw: DataFrame) -> DataFrame:
    df = conform(raw, specs.MIXPANEL_FUNNELS)
    return df.filter(F.col("date").isNotNull() & F.col("funnel_id").isNotNull()).select(
        F.col("date").cast("date").alias("date"),
        F.col("funnel_id").cast("string").alias("funnel_id"),
        "funnel_name",
        _whole(df, "step_index").alias("step_index"),
        "step_label",
        _count(df, "count").alias("entered_count"),
        _amount("conversion_rate").alias("step_conversion_rate"),
        _amount("avg_time_to_convert_sec").alias("avg_time_to_convert_sec"),
        _count(df, "goal_count").alias("goal_completions"),
        _amount("goal_conversion_rate").alias("overall_funnel_conversion_rate"),
        safe_divide(F.lit(1.0), F.col("avg_time_to_convert_sec")).alias("time_to_convert_inverse"),
        "_extracted_at",
    )
