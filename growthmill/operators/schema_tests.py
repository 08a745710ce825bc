"""Column tests of the silver and gold models: not null, unique, accepted values, accepted range."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthmill.functions.channels import UTM_CHANNELS

# --- Fixed values: the tests each model must pass -----------------------------
NOT_NULL = {
    "stg_google_ads": ("campaign_id", "date"),
    "stg_meta_ads": ("ad_id", "date"),
    "stg_ga4_sessions": ("date",),
    "stg_hubspot_contacts": ("contact_id",),
    "stg_shopify_orders": ("order_id",),
    "stg_mixpanel_events": ("event_id", "event_name", "distinct_id", "event_date"),
    "stg_mixpanel_segmentation": ("event_name", "date"),
    "stg_mixpanel_funnels": ("funnel_id", "date", "step_index"),
    "fct_campaign_performance": ("date", "campaign_id"),
    "fct_ad_spend_roi": ("date",),
    "fct_funnel_conversion": ("week_start",),
    "fct_revenue": ("order_date",),
    "fct_attribution": ("date", "channel"),
    "fct_mixpanel_events": ("event_date", "event_name", "channel_normalized"),
    "fct_mixpanel_funnel": ("date", "funnel_id", "step_index"),
    "fct_mixpanel_campaign_attribution": ("event_date", "channel_normalized"),
}

UNIQUE = {
    "stg_hubspot_contacts": ("contact_id",),
    "stg_shopify_orders": ("order_id",),
    "stg_mixpanel_events": ("event_id",),
}

ACCEPTED_VALUES = {
    "stg_mixpanel_events": {"channel_normalized": UTM_CHANNELS},
    "fct_ad_spend_roi": {
        "performance_tier": ("high_performer", "mid_performer", "break_even", "underperformer")
    },
}

# Column to its lowest and highest value; None leaves that side open.
ACCEPTED_RANGE = {
    "stg_google_ads": {"impressions": (0, None), "cost_usd": (0, None), "roas": (0, None)},
    "stg_meta_ads": {"cost_usd": (0, None)},
    "stg_ga4_sessions": {"sessions": (0, None)},
    "stg_shopify_orders": {"gross_revenue": (0, None)},
    "stg_mixpanel_segmentation": {"event_count": (0, None)},
    "stg_mixpanel_funnels": {"entered_count": (0, None)},
    "fct_campaign_performance": {"cost_usd": (0, None), "roas": (0, None)},
    "fct_funnel_conversion": {"lead_to_mql_rate": (0, 1), "overall_conversion_rate": (0, 1)},
    "fct_revenue": {"gross_revenue": (0, None), "avg_order_value": (0, None)},
    "fct_mixpanel_events": {"event_count": (0, None), "unique_users": (0, None), "events_per_user": (0, None)},
    "fct_mixpanel_funnel": {
        "step_conversion_rate": (0, 1),
        "cumulative_drop_off_rate": (0, 1),
        "overall_funnel_conversion_rate": (0, 1),
    },
    "fct_mixpanel_campaign_attribution": {
        "orders": (0, None),
        "cart_to_checkout_rate": (0, 1),
        "checkout_to_order_rate": (0, 1),
    },
}
# ------------------------------------------------------------------------------


def out_of_range(column: str, low: float | None, high: float | None) -> Column:
    """True for values outside the range; nulls pass."""
    below = F.col(column) < low if low is not None else F.lit(False)
    above = F.col(column) > high if high is not None else F.lit(False)
    return below | above


def failing_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def failing_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their row count."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    return counts.filter(F.col("rows") > 1)


def failing_accepted_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    return df.filter(~F.col(column).isin(*values))


def failing_accepted_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    return df.filter(out_of_range(column, low, high))


def _summary(df: DataFrame, model: str, predicates: Mapping[str, Column]) -> DataFrame:
    """Failing row count per column of a model, all columns in one pass."""
    totals = df.agg(*[F.count_if(p).alias(f"n_{c}") for c, p in predicates.items()])
    rows = [
        F.struct(
            F.lit(model).alias("model_name"), F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("failing_rows")
        )
        for c in predicates
    ]
    return totals.select(F.inline(F.array(*rows)))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def summarize_not_null(models: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        [
            _summary(models[m], m, {c: F.col(c).isNull() for c in columns})
            for m, columns in NOT_NULL.items()
            if m in models
        ]
    )


def summarize_accepted_values(models: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        [
            _summary(models[m], m, {c: ~F.col(c).isin(*values) for c, values in columns.items()})
            for m, columns in ACCEPTED_VALUES.items()
            if m in models
        ]
    )


def summarize_accepted_range(models: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        [
            _summary(models[m], m, {c: out_of_range(c, *limits) for c, limits in columns.items()})
            for m, columns in ACCEPTED_RANGE.items()
            if m in models
        ]
    )


def summarize_unique(models: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        [
            failing_unique(models[m], c)
            .agg(F.count(F.lit(1)).alias("failing_rows"))
            .select(F.lit(m).alias("model_name"), F.lit(c).alias("column_name"), "failing_rows")
            for m, columns in UNIQUE.items()
            if m in models
            for c in columns
        ]
    )


def column_tests(model: str) -> dict[tuple[str, str], Column]:
    """Condition of a failing row for every declared test of a model except uniqueness."""
    tests = {("not_null", c): F.col(c).isNull() for c in NOT_NULL.get(model, ())}
    tests |= {("accepted_values", c): ~F.col(c).isin(*v) for c, v in ACCEPTED_VALUES.get(model, {}).items()}
    return tests | {("accepted_range", c): out_of_range(c, *v) for c, v in ACCEPTED_RANGE.get(model, {}).items()}


def check_model(df: DataFrame, model: str, unique: Sequence[str] | None = None) -> DataFrame:
    """Failing rows of every declared test of a model, all kinds in one scan; for uniqueness, values that repeat.

    With unique columns, rows are first grouped by value, with the failing rows of the other tests counted beside, so one
    shuffle of partial counts serves all tests. Several unique columns become one row each before it. Nulls pass all tests
    but ``not_null`` and are never repeated values.
    """
    unique = UNIQUE.get(model, ()) if unique is None else unique
    tests = column_tests(model)
    failing = {f"f{i}": condition for i, condition in enumerate(tests.values())}
    if unique:
        if len(unique) == 1:
            values = df.withColumns({"_column": F.lit(0), "_value": F.col(unique[0])})
        else:
            values = df.select("*", F.posexplode(F.array(*[F.col(c).cast("string") for c in unique])).alias("_column", "_value"))
        first = F.col("_column") == 0
        by_value = values.groupBy("_column", "_value").agg(
            F.count(F.lit(1)).alias("_rows"), *[F.count_if(first & c).alias(f) for f, c in failing.items()]
        )
        repeated = F.col("_value").isNotNull() & (F.col("_rows") > 1)
        totals = by_value.agg(
            *[F.coalesce(F.sum(f), F.lit(0)).cast("bigint").alias(f) for f in failing],
            *[F.count_if(repeated & (F.col("_column") == i)).alias(f"u{i}") for i in range(len(unique))],
        )
    else:
        totals = df.agg(*[F.count_if(c).alias(f) for f, c in failing.items()])
    named = [*zip(tests, failing), *((("unique", c), f"u{i}") for i, c in enumerate(unique))]
    rows = [
        F.struct(
            F.lit(model).alias("model_name"),
            F.lit(kind).alias("test_name"),
            F.lit(column).alias("column_name"),
            F.col(total).alias("failing_rows"),
        )
        for (kind, column), total in named
    ]
    return totals.select(F.inline(F.array(*rows)))


def check_models(models: Mapping[str, DataFrame]) -> DataFrame:
    """All declared tests of all given models, one scan per model."""
    declared = {**NOT_NULL, **UNIQUE, **ACCEPTED_VALUES, **ACCEPTED_RANGE}
    return _union([check_model(models[m], m) for m in declared if m in models])
