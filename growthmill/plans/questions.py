"""Business questions answered from the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthmill.functions import channel_utm, safe_divide, spend_channel
from growthmill.operators.skew import join_key_table
from growthmill.operators.touches import asof_utm_attribution, channel_credit_report
from growthmill.plans.marketing import performance_tier

# --- Fixed values -------------------------------------------------------------
MIN_SPEND = 0.01
PAID_CHANNELS = ("paid_search", "paid_social", "display", "affiliate")
PURCHASE = "Order Completed"
PREDICTORS = ("Add to Cart", "Checkout Started")
# ------------------------------------------------------------------------------


def top_roas(roi: DataFrame, k: int = 10, min_spend: float = MIN_SPEND) -> DataFrame:
    """The ``k`` campaigns with the highest return on spend."""
    campaigns = (
        roi.groupBy("channel_source", "campaign_id", "campaign_name")
        .agg(
            F.sum("total_spend").alias("total_spend"),
            F.sum("total_conversion_value").alias("total_conversion_value"),
        )
        .filter(F.col("total_spend") >= min_spend)
        .withColumn("roas", safe_divide(F.col("total_conversion_value"), F.col("total_spend")))
        .withColumn("performance_tier", performance_tier(F.col("roas")))
    )
    return campaigns.orderBy(F.desc_nulls_last("roas"), "channel_source", "campaign_id", "campaign_name").limit(k)


def cost_per_customer(roi: DataFrame, funnel: DataFrame) -> DataFrame:
    """Weekly spend per CRM customer, by channel."""
    spend = roi.groupBy("week_start", spend_channel(F.col("channel_source")).alias("channel")).agg(
        F.sum("total_spend").alias("total_spend")
    )
    won = funnel.groupBy("week_start", "channel").agg(F.sum("customers").alias("customers"))
    return spend.join(won, ["week_start", "channel"], "left").withColumn(
        "cost_per_customer", safe_divide(F.col("total_spend"), F.col("customers"))
    )


def leads_dropoff(funnel: DataFrame) -> DataFrame:
    """Stage totals and rates per channel over all weeks."""
    stages = ("total_leads", "mqls", "sqls", "opportunities", "customers")
    totals = funnel.groupBy("channel").agg(*[F.sum(stage).alias(stage) for stage in stages])
    rates = [
        safe_divide(F.col(after), F.col(before)).alias(f"{before}_to_{after}")
        for before, after in zip(stages, stages[1:])
    ]
    return totals.select("*", *rates)


def channel_revenue(touches: DataFrame, attribution: DataFrame) -> DataFrame:
    """Revenue per channel: last touch, linear, and as reported by web sessions."""
    report = channel_credit_report(touches).select("channel", "last_touch_value", "linear_value")
    sessions = attribution.groupBy("channel").agg(F.sum("attributed_revenue").alias("session_revenue"))
    return report.join(sessions, "channel", "full")


def three_views(touches: DataFrame, attribution: DataFrame, events: DataFrame) -> DataFrame:
    """Channels side by side: touch models, web sessions, and conversions by their latest tagged event."""
    tagged = asof_utm_attribution(events).filter(F.col("touch_event_id").isNotNull())
    by_tag = tagged.groupBy(channel_utm(F.col("utm_source"), F.col("utm_medium")).alias("channel")).agg(
        F.count(F.lit(1)).alias("tagged_conversions")
    )
    return channel_revenue(touches, attribution).join(by_tag, "channel", "full")


def campaign_user_actions(daily_events: DataFrame) -> DataFrame:
    """What users of paid campaigns do, by campaign and event."""
    paid = F.col("channel_normalized").isin(*PAID_CHANNELS) & F.col("utm_campaign").isNotNull()
    return (
        daily_events.filter(paid)
        .groupBy("utm_campaign", "event_name")
        .agg(F.sum("event_count").alias("event_count"), F.sum("unique_users").alias("user_days"))
    )


def purchase_predictors(events: DataFrame) -> DataFrame:
    """How often users who did, and did not do, an action before their first purchase went on the list of buyers.

    Only actions earlier than the user's first purchase count; without a purchase all do. Actions are counted per user and
    moment before they meet the purchases. Rows without a user are never matched to a purchase.
    """
    user = "distinct_id"
    purchase = F.col("event_name") == PURCHASE
    marks = events.groupBy(user).agg(F.count_if(purchase).alias("bought"))
    first = events.filter(purchase & F.col(user).isNotNull()).groupBy(user).agg(F.min("event_timestamp").alias("first_purchase"))
    actions = (
        events.filter(F.col("event_name").isin(*PREDICTORS)).groupBy(user, "event_name", "event_timestamp").agg(F.count(F.lit(1)).alias("n"))
    )
    before = join_key_table(actions, first, [user]).filter(
        F.col("first_purchase").isNull() | (F.col("event_timestamp") < F.col("first_purchase"))
    )

    def acted(name: str) -> Column:
        return F.when(F.col("event_name") == name, F.col("n")).otherwise(F.lit(0).cast("bigint"))

    names = [f"p{i}" for i in range(len(PREDICTORS))]
    none = F.lit(0).cast("bigint")
    parts = marks.select(user, "bought", *[none.alias(n) for n in names]).unionAll(
        before.select(user, none.alias("bought"), *[acted(p).alias(n) for n, p in zip(names, PREDICTORS)])
    )
    per_user = parts.groupBy(user).agg(*[F.sum(c).alias(c) for c in ("bought", *names)])
    buyer = F.col("bought") > 0
    totals = []
    for i in range(len(PREDICTORS)):
        did = F.col(f"p{i}") > 0
        totals += [
            F.sum(f"p{i}").alias(f"events{i}"),
            F.count_if(did).alias(f"did{i}"),
            F.count_if(did & buyer).alias(f"did_bought{i}"),
            F.count_if(~did).alias(f"not{i}"),
            F.count_if(~did & buyer).alias(f"not_bought{i}"),
        ]
    rows = [
        F.struct(
            F.lit(action).alias("action"),
            F.col(f"events{i}").alias("event_count"),
            F.col(f"did{i}").alias("users_did"),
            F.col(f"did_bought{i}").alias("users_did_bought"),
            F.col(f"not{i}").alias("users_did_not"),
            F.col(f"not_bought{i}").alias("users_did_not_bought"),
            safe_divide(F.col(f"did_bought{i}"), F.col(f"did{i}")).alias("buy_rate_did"),
            safe_divide(F.col(f"not_bought{i}"), F.col(f"not{i}")).alias("buy_rate_did_not"),
        )
        for i, action in enumerate(PREDICTORS)
    ]
    return per_user.agg(*totals).select(F.inline(F.array(*rows)))


def time_to_convert(funnel: DataFrame) -> DataFrame:
    """Mean hours to convert per funnel step, weighted by the users who entered it."""
    weight = F.sum("entered_count")
    hours = F.sum(F.col("avg_time_to_convert_hrs") * F.col("entered_count"))
    return funnel.groupBy("funnel_id", "funnel_name", "step_index", "step_label").agg(
        weight.alias("entered_count"), safe_divide(hours, weight).alias("avg_hours_to_convert")
    )


def reach(performance: DataFrame) -> DataFrame:
    return performance.groupBy("channel_source").agg(F.sum("impressions").alias("impressions"))


def buyer_origin(performance: DataFrame, attribution: DataFrame) -> DataFrame:
    """Paid delivery next to session revenue, by marketing channel."""
    paid = performance.groupBy(spend_channel(F.col("channel_source")).alias("channel")).agg(
        F.sum("impressions").alias("impressions"),
        F.sum("clicks").alias("clicks"),
        F.sum("cost_usd").alias("total_spend"),
        F.sum("conversions").alias("conversions"),
    )
    sessions = attribution.groupBy("channel").agg(
        F.sum("attributed_revenue").alias("attributed_revenue"),
        F.sum("attributed_conversions").alias("attributed_conversions"),
    )
    return paid.join(sessions, "channel", "full")
