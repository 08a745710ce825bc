"""Ad-platform payloads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthmill.functions.numeric import from_micros
from growthmill.sources.specs import META_ACTION_TYPES

GOOGLE_ADS_PAYLOAD = """
    campaign struct<id: bigint, name: string, status: string, advertising_channel_type: string>,
    ad_group struct<id: bigint, name: string, status: string>,
    segments struct<date: string, device: string>,
    metrics struct<impressions: bigint, clicks: bigint, cost_micros: bigint, conversions: double,
        conversions_value: double, video_views: bigint, ctr: double, average_cpc: double,
        search_impression_share: double>"""

META_PAYLOAD = """
    campaign_id string, campaign_name string, adset_id string, adset_name string, ad_id string,
    ad_name string, date_start string, date_stop string, impressions string, clicks string, spend string,
    reach string, frequency string, objective string, buying_type string,
    actions array<struct<action_type: string, value: string>>,
    cost_per_action_type array<struct<action_type: string, value: string>>"""

LINKEDIN_PAYLOAD = """
    elements array<struct<pivot: string, pivotValue: string,
        dateRange: struct<start: struct<year: int, month: int, day: int>>,
        impressions: bigint, clicks: bigint, costInLocalCurrency: struct<amount: string>,
        oneClickLeads: bigint, conversions: bigint, videoViews: bigint, totalEngagements: bigint,
        likes: bigint, shares: bigint, comments: bigint, follows: bigint>>"""


def flatten_google_ads(df: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Nested report rows to flat columns, without removed campaigns."""
    day = F.to_date("segments.date")
    keep = F.col("campaign.status") != "REMOVED"
    if start is not None and end is not None:
        keep = keep & day.between(F.lit(start), F.lit(end))
    return df.filter(keep).select(
        F.col("campaign.id").cast("string").alias("campaign_id"),
        F.col("campaign.name").alias("campaign_name"),
        F.col("campaign.status").alias("campaign_status"),
        F.col("campaign.advertising_channel_type").alias("channel_type"),
        F.col("ad_group.id").cast("string").alias("ad_group_id"),
        F.col("ad_group.name").alias("ad_group_name"),
        F.col("ad_group.status").alias("ad_group_status"),
        day.alias("date"),
        F.col("segments.device").alias("device"),
        F.col("metrics.impressions").alias("impressions"),
        F.col("metrics.clicks").alias("clicks"),
        from_micros(F.col("metrics.cost_micros")).alias("cost"),
        F.col("metrics.conversions").alias("conversions"),
        F.col("metrics.conversions_value").alias("conversion_value"),
        F.col("metrics.video_views").alias("video_views"),
        F.col("metrics.ctr").alias("ctr"),
        from_micros(F.col("metrics.average_cpc")).alias("average_cpc"),
        F.col("metrics.search_impression_share").alias("search_impression_share"),
    )


def with_action_maps(df: DataFrame, *names: str) -> DataFrame:
    """Entries as a map, value by action type, dots in types as underscores: the last entry of a type counts, 0.0 when it has no number.

    Entries and types are columns of their own on the way, so that a function over entries does not work them out again
    for each of them.
    """
    latest_first = {f"_{n}": F.reverse(F.filter(n, lambda e: e["action_type"].isNotNull())) for n in names}
    types = {
        f"_{n}_types": F.transform(f"_{n}", lambda e: F.translate(e["action_type"], ".", "_")) for n in names
    }

    def last_of_each_type(name: str) -> Column:
        at = F.col(f"_{name}_types")
        last = F.filter(f"_{name}", lambda e, i: F.array_position(at, F.get(at, i)) == i + 1)
        values = F.transform(last, lambda e: F.coalesce(e["value"].try_cast("double"), F.lit(0.0)))
        return F.map_from_arrays(F.array_distinct(at), values)

    maps = {n: last_of_each_type(n) for n in names}
    return df.withColumns(latest_first).withColumns(types).withColumns(maps).drop(*latest_first, *types)


def flatten_meta(df: DataFrame, action_types: Sequence[str] = META_ACTION_TYPES) -> DataFrame:
    """Insight rows with all actions and costs as maps, and a column per action type of the fixed list.

    A column is null when its action is absent.
    """
    df = with_action_maps(df, "actions", "cost_per_action_type")
    plain = [
        "campaign_id",
        "campaign_name",
        "adset_id",
        "adset_name",
        "ad_id",
        "ad_name",
        "objective",
        "buying_type",
    ]
    return df.select(
        *plain,
        F.to_date("date_start").alias("date_start"),
        *[F.col(name).try_cast("double").cast("bigint").alias(name) for name in ("impressions", "clicks", "reach")],
        *[F.col(name).try_cast("double").alias(name) for name in ("spend", "frequency")],
        *[F.try_element_at("actions", F.lit(kind)).alias(f"action_{kind}") for kind in action_types],
        *[F.try_element_at("cost_per_action_type", F.lit(kind)).alias(f"cpa_{kind}") for kind in action_types],
        "actions",
        F.col("cost_per_action_type").alias("cost_per_action"),
    )


def meta_action_rows(df: DataFrame) -> DataFrame:
    """One row per ad, day and action entry, for action types not known in advance."""
    return df.select("ad_id", F.to_date("date_start").alias("date_start"), F.explode("actions").alias("action")).select(
        "ad_id",
        "date_start",
        F.translate("action.action_type", ".", "_").alias("action_type"),
        F.coalesce(F.col("action.value").try_cast("double"), F.lit(0.0)).alias("value"),
    )


def flatten_linkedin(df: DataFrame) -> DataFrame:
    """One row per report element, dated by the element's own start day."""
    element = df.select(F.explode("elements").alias("e"))

    def count(field: str, name: str) -> Column:
        return F.coalesce(F.col(f"e.{field}"), F.lit(0).cast("bigint")).alias(name)

    start = "e.dateRange.start"
    return element.select(
        F.make_date(f"{start}.year", f"{start}.month", f"{start}.day").alias("date_start"),
        F.col("e.pivot").alias("pivot"),
        F.col("e.pivotValue").alias("pivot_value"),
        count("impressions", "impressions"),
        count("clicks", "clicks"),
        F.coalesce(F.col("e.costInLocalCurrency.amount").try_cast("double"), F.lit(0.0)).alias("cost"),
        count("oneClickLeads", "one_click_leads"),
        count("conversions", "conversions"),
        count("videoViews", "video_views"),
        count("totalEngagements", "total_engagements"),
        count("likes", "likes"),
        count("shares", "shares"),
        count("comments", "comments"),
        count("follows", "follows"),
    )
