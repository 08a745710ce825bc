"""Revenue and session-attribution marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthmill.functions import month_start, safe_divide, week_start_sunday
from growthmill.plans.marketing import spend_by_channel

# Order of the revenue rows inside a day, so that "the row before" is always the same row.
DAY_ORDER = ("currency", "traffic_source", "order_type")


def paid_orders(orders: DataFrame) -> DataFrame:
    return orders.filter(~F.col("is_cancelled") & F.col("is_paid"))


def _growth(current: Column, previous: Column) -> Column:
    return safe_divide(current - previous, previous)


def daily_revenue(orders: DataFrame) -> DataFrame:
    """Paid revenue per day, currency, traffic source and order type."""
    day = F.to_date("order_date")
    return (
        paid_orders(orders)
        .groupBy(
            day.alias("order_date"),
            week_start_sunday(day).alias("week_start"),
            month_start(day).alias("month_start"),
            F.year("order_date").alias("year"),
            "currency",
            F.col("source_name").alias("traffic_source"),
            "order_type",
        )
        .agg(
            F.count_distinct("order_id").alias("order_count"),
            F.count_distinct("customer_id").alias("unique_customers"),
            F.sum("gross_revenue").alias("gross_revenue"),
            F.sum("net_revenue").alias("net_revenue"),
            F.sum("discount_amount").alias("total_discounts"),
            F.sum("tax_amount").alias("total_taxes"),
            F.sum("item_count").alias("total_items"),
            F.avg("gross_revenue").alias("avg_order_value"),
            F.avg("item_count").alias("avg_items_per_order"),
            safe_divide(F.sum("discount_amount"), F.sum("gross_revenue")).alias("discount_rate"),
        )
    )


def with_previous_revenue(daily: DataFrame) -> DataFrame:
    """Add the revenue of the row before, among rows of the same calendar month of any year.

    Twelve groups would be few and large. Inside a day the row before comes from a window over
    that day; only the first row of a day looks back to the last row of the day before, in a
    second window where each calendar month holds one row per day. The other rows of a day
    take part in that window in a group of their own.
    """
    day = Window.partitionBy("order_date").orderBy(*DAY_ORDER)
    whole_day = day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    numbered = daily.select(
        "*",
        F.row_number().over(day).alias("_position"),
        F.lag("gross_revenue").over(day).alias("_in_day"),
        F.last("gross_revenue").over(whole_day).alias("_day_end"),
    )
    is_first = F.col("_position") == 1
    days = Window.partitionBy(
        F.month("order_date"), F.when(~is_first, F.col("order_date"))
    ).orderBy("order_date", "_position")
    previous = F.when(is_first, F.lag("_day_end").over(days)).otherwise(F.col("_in_day"))
    return numbered.withColumn("prev_month_revenue", previous).drop("_position", "_in_day", "_day_end")


def fct_revenue(orders: DataFrame) -> DataFrame:
    rows = with_previous_revenue(daily_revenue(orders))
    return rows.withColumn(
        "revenue_mom_growth_rate", _growth(F.col("gross_revenue"), F.col("prev_month_revenue"))
    )


def _monthly(orders: DataFrame) -> DataFrame:
    return (
        paid_orders(orders)
        .groupBy(month_start(F.to_date("order_date")).alias("month_start"))
        .agg(F.sum("gross_revenue").alias("gross_revenue"))
    )


def _with_growth(monthly: DataFrame, window) -> DataFrame:
    return monthly.withColumn("previous_revenue", F.lag("gross_revenue").over(window)).withColumn(
        "growth_rate", _growth(F.col("gross_revenue"), F.col("previous_revenue"))
    )


def revenue_mom(orders: DataFrame) -> DataFrame:
    """Growth against the month before that has revenue. One row per month reaches the window."""
    return _with_growth(_monthly(orders), Window.partitionBy(F.lit(1)).orderBy("month_start"))


def revenue_yoy(orders: DataFrame) -> DataFrame:
    """Growth against the same month of the year before that has revenue."""
    return _with_growth(_monthly(orders), Window.partitionBy(F.month("month_start")).orderBy("month_start"))


def _channel_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy(
        "date",
        F.col("channel_normalized").alias("channel"),
        F.col("session_source").alias("source"),
        F.col("session_medium").alias("medium"),
        "campaign_name",
    ).agg(
        F.sum("revenue_usd").alias("attributed_revenue"),
        F.sum("conversions").alias("attributed_conversions"),
        F.sum("sessions").alias("sessions"),
    )


def _with_spend(channels: DataFrame, spend: DataFrame) -> DataFrame:
    return channels.join(spend, ["date", "channel"], "left").withColumn(
        "attributed_roas", safe_divide(F.col("attributed_revenue"), F.col("total_spend"))
    )


def fct_attribution(sessions: DataFrame, roi: DataFrame) -> DataFrame:
    """Session revenue per channel next to the day's spend of the platform named like the channel.

    Spend is rolled up to the join key, so no session row multiplies.
    """
    spend = roi.groupBy("date", F.col("channel_source").alias("channel")).agg(F.sum("total_spend").alias("total_spend"))
    return _with_spend(_channel_sessions(sessions), spend)


def fct_attribution_bridged(sessions: DataFrame, roi: DataFrame) -> DataFrame:
    """As above, with spend rolled up to day and mapped channel: one spend row per join key."""
    return _with_spend(_channel_sessions(sessions), spend_by_channel(roi))
