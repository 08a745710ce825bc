"""First-touch, last-touch and linear credit over customer touch points.

Input columns: customer_id, session_date, channel, source, medium, campaign, order_id,
order_value, is_conversion, plus a ``touch_id`` that settles equal dates. Every model starts
from a grouped aggregate with map-side partial results, so a customer with a very large
share of the touches is reduced before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from growthmill.functions import safe_divide
from growthmill.operators.skew import heaviest_keys, join_key_table

TOUCH_COLUMNS = ("channel", "source", "medium", "campaign")


def _touch_order() -> Column:
    """Sort position of a touch; touches without a date come last."""
    return F.struct(F.col("session_date").isNull(), F.col("session_date"), F.col("touch_id"))


def _ends(which: Sequence[str]) -> list[Column]:
    """Earliest or latest non-null value of each touch column, every column on its own."""
    pick = {"first": F.min_by, "last": F.max_by}
    return [
        pick[end](column, F.when(F.col(column).isNotNull(), _touch_order())).alias(f"{end}_touch_{column}")
        for end in which
        for column in TOUCH_COLUMNS
    ]


def _known_customers(touches: DataFrame) -> DataFrame:
    return touches.filter(F.col("customer_id").isNotNull())


def last_touch(touches: DataFrame) -> DataFrame:
    return _known_customers(touches).groupBy("customer_id").agg(*_ends(["last"]))


def first_touch(touches: DataFrame) -> DataFrame:
    return _known_customers(touches).groupBy("customer_id").agg(*_ends(["first"]))


def attribution_models(touches: DataFrame) -> DataFrame:
    """Distinct conversion rows with the first and last touch of their customer.

    Duplicates go before the join: the touch columns depend on the customer only, so the
    result is the same and copies never reach the shuffle.
    """
    conversions = touches.filter(F.col("is_conversion"))
    ends = _known_customers(touches).groupBy("customer_id").agg(*_ends(["last", "first"]))
    hot = heaviest_keys(conversions, ["customer_id"])
    return join_key_table(conversions.dropDuplicates(), ends, ["customer_id"], hot=hot)


def _channel_totals(touches: DataFrame) -> DataFrame:
    """Per customer and channel: touches, dated touches, conversion value, latest touch."""
    value = F.when(F.col("is_conversion"), F.col("order_value"))
    return (
        _known_customers(touches)
        .groupBy("customer_id", "channel")
        .agg(
            F.count(F.lit(1)).alias("touches"),
            F.count("session_date").alias("dated"),
            F.sum(value).alias("order_value"),
            F.max(_touch_order()).alias("latest"),
        )
    )


def _credits(totals: DataFrame) -> DataFrame:
    # The window sees one row per channel of a customer, never the touches themselves.
    customer = Window.partitionBy("customer_id")
    credit = safe_divide(F.col("touches"), F.sum("dated").over(customer))
    return totals.withColumn("linear_attribution_credit", credit)


def linear_attribution(touches: DataFrame) -> DataFrame:
    """Equal credit per touch: a channel gets its touches over the customer's dated touches."""
    return (
        _credits(_channel_totals(touches))
        .filter(F.col("channel").isNotNull())
        .select("customer_id", "channel", "linear_attribution_credit")
    )


def channel_credit_report(touches: DataFrame) -> DataFrame:
    """Order value per channel under last touch and under linear credit, side by side."""
    customer = Window.partitionBy("customer_id")
    latest = F.when(F.col("channel").isNotNull(), F.struct("latest", "channel"))
    rows = _credits(_channel_totals(touches)).select(
        "channel",
        "linear_attribution_credit",
        F.sum("order_value").over(customer).alias("customer_value"),
        (latest == F.max(latest).over(customer)).alias("is_last"),
    )
    value = F.col("customer_value")
    return (
        rows.filter(F.col("channel").isNotNull())
        .groupBy("channel")
        .agg(
            F.sum(F.when(F.col("is_last"), value).otherwise(0.0)).alias("last_touch_value"),
            F.sum(value * F.col("linear_attribution_credit")).alias("linear_value"),
            F.count_if("is_last").alias("last_touch_customers"),
            F.sum("linear_attribution_credit").alias("linear_credit"),
        )
    )


def _latest_tags(events: DataFrame, is_conversion: Column, coarse: str, fine: str) -> DataFrame:
    """``distinct_id``, ``event_timestamp`` and ``touch``, the latest tag up to then, for all moments with a conversion.

    An index of prefix maxima on three levels. Events are first reduced, with partial results, to the greatest tag of each
    user and moment. Then every moment finds the greatest tag up to it in its ``fine`` bucket, every fine bucket
    the greatest before it in its ``coarse`` bucket, and every coarse bucket the greatest before it. A window so holds the
    moments of a second, the seconds of an hour or the hours of a user, never the events of one.
    """
    user = "distinct_id"
    tag = F.when(
        F.col("utm_campaign").isNotNull(), F.struct("event_timestamp", "event_id", "utm_source", "utm_medium", "utm_campaign")
    )
    keys = [user, "coarse", "fine", "event_timestamp"]
    # The last condition holds for every moment; with it all three levels need the same columns and share one shuffle.
    moments = (
        events.withColumns({"coarse": F.date_trunc(coarse, "event_timestamp"), "fine": F.date_trunc(fine, "event_timestamp")})
        .dropna(subset=keys)
        .groupBy(*keys)
        .agg(F.max(tag).alias("tag"), F.max(is_conversion).alias("converts"))
        .filter(F.col("tag").isNotNull() | F.col("converts"))
    )
    fine_rows = moments.groupBy(user, "coarse", "fine").agg(F.max("tag").alias("tag"))
    coarse_rows = fine_rows.groupBy(user, "coarse").agg(F.max("tag").alias("tag"))

    def before(*keys: str, order: str) -> Column:
        earlier = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return F.max("tag").over(earlier)

    so_far = Window.partitionBy(user, "coarse", "fine").orderBy("event_timestamp")
    within = moments.withColumn("near", F.max("tag").over(so_far)).filter("converts")
    in_coarse = fine_rows.select(user, "coarse", "fine", before(user, "coarse", order="fine").alias("carried"))
    in_user = coarse_rows.select(user, "coarse", before(user, order="coarse").alias("brought"))
    return (
        within.join(in_coarse, [user, "coarse", "fine"], "left")
        .join(in_user, [user, "coarse"], "left")
        .select(user, "event_timestamp", F.coalesce("near", "carried", "brought").alias("touch"))
    )


def asof_utm_attribution(
    events: DataFrame,
    conversion_events: Sequence[str] = ("Order Completed",),
    days: int = 30,
    bucket: str = "hour",
    fine_bucket: str = "second",
) -> DataFrame:
    """Latest UTM-tagged event at or before each conversion, not older than ``days`` days.

    Tags are looked up per user and moment (see ``_latest_tags``) and joined to the conversions. Tags of one
    moment are settled by the greatest event id. A conversion without a user or time has no touch.
    """
    is_conversion = F.col("event_name").isin(*conversion_events)
    columns = ["distinct_id", "event_id", "event_name", "event_timestamp", "utm_source", "utm_medium", "utm_campaign"]
    relevant = events.filter(is_conversion | F.col("utm_campaign").isNotNull()).select(*columns)
    conversions = relevant.filter(is_conversion).select("distinct_id", "event_id", "event_name", "event_timestamp")
    touches = _latest_tags(relevant, is_conversion, bucket, fine_bucket)
    joined = conversions.join(touches, ["distinct_id", "event_timestamp"], "left")
    in_time = F.col("event_timestamp") <= F.col("touch.event_timestamp") + F.make_dt_interval(F.lit(days))

    def touched(field: str) -> Column:
        return F.when(in_time, F.col(f"touch.{field}"))

    return joined.select(
        F.col("event_id").alias("conversion_id"),
        "distinct_id",
        F.col("event_name").alias("conversion_event"),
        F.col("event_timestamp").alias("converted_at"),
        touched("event_id").alias("touch_event_id"),
        touched("event_timestamp").alias("touched_at"),
        touched("utm_source").alias("utm_source"),
        touched("utm_medium").alias("utm_medium"),
        touched("utm_campaign").alias("utm_campaign"),
    )
