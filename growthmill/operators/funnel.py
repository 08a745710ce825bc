"""Stage funnels of customers and ordered-step funnels of raw events."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthmill.functions import safe_divide_or

# --- Fixed values: ordered customer stages and the declared event funnels -----
FUNNEL_STAGES = ("visitor", "lead", "mql", "sql", "opportunity", "customer")

EVENT_FUNNELS = {
    "acquisition_funnel": ("Page Viewed", "Signed Up", "Feature Used"),
    "purchase_funnel": ("Page Viewed", "Add to Cart", "Checkout Started", "Order Completed"),
    "lead_gen_funnel": ("Page Viewed", "Lead Form Submitted", "Demo Requested"),
}

SEGMENT_PROPERTIES = ("utm_source", "utm_medium", "utm_campaign", "utm_content", "country_code", "city", "operating_system", "browser")
SEGMENTED_EVENTS = (
    "Signed Up",
    "Logged In",
    "Page Viewed",
    "Campaign Clicked",
    "Add to Cart",
    "Checkout Started",
    "Order Completed",
    "Lead Form Submitted",
    "Demo Requested",
    "Feature Used",
)
# ------------------------------------------------------------------------------


def stage_order(stage: Column) -> Column:
    """0-based position of a stage; null for an unknown one."""
    position = F.array_position(F.array(*[F.lit(s) for s in FUNNEL_STAGES]), stage)
    return F.nullif(position, F.lit(0)).cast("int") - 1


def funnel_stage_counts(events: DataFrame) -> DataFrame:
    """Distinct customers per day, stage and channel; rows with a missing key are left out."""
    return (
        events.dropna(subset=["event_date", "stage", "channel"])
        .groupBy("event_date", "stage", "channel")
        .agg(F.count_distinct("customer_id").alias("unique_visitors"))
    )


def funnel_max_stage(events: DataFrame) -> DataFrame:
    """Furthest stage each customer reached."""
    furthest = (
        events.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.max(stage_order(F.col("stage"))).alias("stage_order"))
    )
    stages = F.array(*[F.lit(s) for s in FUNNEL_STAGES])
    return furthest.withColumn("max_stage", F.get(stages, F.col("stage_order")))


def funnel_conversion_rates(events: DataFrame) -> DataFrame:
    """Customers at or beyond each stage and at or beyond the next one."""
    reached = funnel_max_stage(events).agg(
        *[F.count_if(F.col("stage_order") >= i).alias(f"n{i}") for i in range(len(FUNNEL_STAGES))]
    )
    pairs = [
        F.struct(
            F.lit(FUNNEL_STAGES[i]).alias("from_stage"),
            F.lit(FUNNEL_STAGES[i + 1]).alias("to_stage"),
            F.col(f"n{i}").alias("from_count"),
            F.col(f"n{i + 1}").alias("to_count"),
        )
        for i in range(len(FUNNEL_STAGES) - 1)
    ]
    return (
        reached.select(F.inline(F.array(*pairs)))
        .withColumn("conversion_rate", safe_divide_or(F.col("to_count"), F.col("from_count")))
    )


def _transitions(marks: Column, steps: Sequence[int]) -> Column:
    """The transition table of one bucket for one funnel: at place s, the times of the steps reached by a user who enters with s.

    ``marks`` are a bucket's (time, event number) pairs in order, ``steps`` the event numbers of the funnel. The next step
    counts from the first mark later than the step before it; every earlier bucket lies before all marks.
    """

    def entering(s: int) -> Column:
        none = F.array().cast("array<timestamp>")

        def follow(times: Column, mark: Column) -> Column:
            position = F.size(times)
            wanted = F.get(F.array(*[F.lit(k) for k in steps[s:]]), position)
            later = (position == 0) | (mark["event_timestamp"] > F.get(times, position - 1))
            return F.when((mark["event"] == wanted) & later, F.concat(times, F.array(mark["event_timestamp"]))).otherwise(times)

        return F.aggregate(marks, none, follow)

    return F.array(*[entering(s) for s in range(len(steps))])


def _reached_times(events: DataFrame, funnels: Mapping[str, Sequence[str]], bucket: str) -> DataFrame:
    """One row per user and funnel with ``times``, when each step was reached, up to the last reached one.

    A user's time line is cut into buckets, and each bucket becomes a table of transitions, which needs nothing from other buckets. Tables
    compose in the order of time: the step one leaves with is the step the next is entered with. So a busy user is
    worked on in as many tasks as there are buckets, and only the tables of the user come together. A bucket holds each pair of
    moment and event once, however often it occurs.
    """
    numbers = {event: k for k, event in enumerate(dict.fromkeys(e for names in funnels.values() for e in names))}
    number = F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])[F.col("event_name")]
    marks = F.array_sort(F.collect_set(F.struct("event_timestamp", number.alias("event"))))
    # A user without an id stays at the first step: rows without an id are not one user.
    known = F.col("distinct_id").isNotNull()
    buckets = (
        events.filter(F.col("event_name").isin(*numbers) & F.col("event_timestamp").isNotNull())
        .groupBy("distinct_id", F.date_trunc(bucket, "event_timestamp").alias("bucket"))
        .agg(marks.alias("marks"))
        .select(
            "distinct_id",
            "bucket",
            F.array(*[_transitions(F.col("marks"), [numbers[e] for e in names]) for names in funnels.values()]).alias("tables"),
        )
    )
    lines = buckets.groupBy("distinct_id").agg(F.array_sort(F.collect_list(F.struct("bucket", "tables"))).alias("line"))

    def composed(place: int) -> Column:
        def after(times: Column, one: Column) -> Column:
            step = F.get(F.get(one["tables"], F.lit(place)), F.size(times))
            return F.concat(times, F.coalesce(step, F.array().cast("array<timestamp>")))

        return F.aggregate("line", F.array().cast("array<timestamp>"), after)

    rows = [F.struct(F.lit(name).alias("funnel_name"), composed(k).alias("times")) for k, name in enumerate(funnels)]
    times = F.when(known, F.col("times")).otherwise(F.slice("times", 1, 1))
    return lines.select("distinct_id", F.inline(F.array(*rows))).select("distinct_id", "funnel_name", times.alias("times"))


def event_funnel_steps(
    events: DataFrame, funnels: Mapping[str, Sequence[str]] = EVENT_FUNNELS, bucket: str = "hour"
) -> DataFrame:
    """Users per ordered step of each funnel, with rates and mean seconds from the step before.

    A user reaches step i with the first such event after the moment step i-1 was reached. Events are read once and
    shuffled once, whatever the number of steps; a second shuffle brings the transition tables of a user's buckets together.
    """
    depth = max(len(names) for names in funnels.values())

    def gap(i: int) -> Column:
        micros = F.unix_micros(F.get("times", F.lit(i))) - F.unix_micros(F.get("times", F.lit(i - 1)))
        return F.avg(micros.cast("double") / 1_000_000.0)

    totals = (
        _reached_times(events, funnels, bucket)
        .groupBy("funnel_name")
        .agg(
            F.array(*[F.count(F.get("times", F.lit(i))) for i in range(depth)]).alias("users_at"),
            F.array(F.lit(None).cast("double"), *[gap(i) for i in range(1, depth)]).alias("seconds_at"),
        )
    )
    steps = [(name, i, event) for name, names in funnels.items() for i, event in enumerate(names)]
    declared = events.sparkSession.createDataFrame(steps, "funnel_name string, step_index int, step_label string")

    def users_at(position: Column) -> Column:
        return F.coalesce(F.get("users_at", position), F.lit(0).cast("bigint"))

    step = F.col("step_index")
    return declared.join(totals, "funnel_name", "left").select(
        "funnel_name",
        "step_index",
        "step_label",
        users_at(step).alias("users"),
        safe_divide_or(users_at(step), users_at(F.greatest(step - 1, F.lit(0)))).alias("step_conversion_rate"),
        safe_divide_or(users_at(step), users_at(F.lit(0))).alias("overall_conversion_rate"),
        F.get("seconds_at", step).alias("avg_seconds_from_previous"),
    )


def event_segmentation(
    events: DataFrame, prop: str = "utm_source", event_names: Sequence[str] = SEGMENTED_EVENTS
) -> DataFrame:
    """Daily counts of the tracked events by the value of one property."""
    return (
        events.filter(F.col("event_name").isin(*event_names))
        .groupBy(
            F.col("event_name").alias("event"),
            F.lit(prop).alias("segment_property"),
            F.col(prop).alias("segment_value"),
            F.to_date("event_timestamp").alias("date"),
        )
        .agg(F.count(F.lit(1)).alias("event_count"))
    )


def event_segmentation_all(
    events: DataFrame, properties: Sequence[str] = SEGMENT_PROPERTIES, event_names: Sequence[str] = SEGMENTED_EVENTS
) -> DataFrame:
    """Daily counts of the tracked events by the value of every property, in one scan.

    Rows are counted per event, day and combination of values before they are unfolded by property, so
    that as few rows as possible are repeated.
    """
    day = F.to_date("event_timestamp").alias("date")
    tracked = events.filter(F.col("event_name").isin(*event_names))
    combined = tracked.groupBy(F.col("event_name").alias("event"), day, *properties).agg(F.count(F.lit(1)).alias("n"))
    cells = [F.struct(F.lit(p).alias("segment_property"), F.col(p).cast("string").alias("segment_value")) for p in properties]
    return (
        combined.select("event", "date", "n", F.inline(F.array(*cells)))
        .groupBy("event", "segment_property", "segment_value", "date")
        .agg(F.sum("n").alias("event_count"))
    )
