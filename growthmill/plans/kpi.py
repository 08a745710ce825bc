"""The KPI catalogue: each KPI is an aggregate expression over a mart or silver model."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthmill.functions import safe_divide
from growthmill.plans.revenue import paid_orders, revenue_yoy

Kpi = Callable[[], Column]


def _sum(column: str) -> Kpi:
    return lambda: F.sum(column)


def _ratio(top: Kpi, bottom: Kpi, scale: float | None = None) -> Kpi:
    def build() -> Column:
        value = safe_divide(top(), bottom())
        return value if scale is None else value * scale

    return build


_SPEND, _CLICKS, _VIEWS = _sum("cost_usd"), _sum("clicks"), _sum("impressions")
_VALUE, _CONVERSIONS = _sum("conversion_value_usd"), _sum("conversions")


def _leads() -> Column:
    return F.count_distinct("contact_id")


def _flagged(column: str) -> Kpi:
    return lambda: F.count_if(column)


# Over fct_campaign_performance.
PAID_MEDIA: dict[str, Kpi] = {
    "impressions": _VIEWS,
    "clicks": _CLICKS,
    "cost": _SPEND,
    "ctr": _ratio(_CLICKS, _VIEWS),
    "cpc": _ratio(_SPEND, _CLICKS),
    "cpm": _ratio(_SPEND, _VIEWS, 1000),
    "cvr": _ratio(_CONVERSIONS, _CLICKS),
    "cpa": _ratio(_SPEND, _CONVERSIONS),
    "roas": _ratio(_VALUE, _SPEND),
    "roi": _ratio(lambda: F.sum("conversion_value_usd") - F.sum("cost_usd"), _SPEND),
}

# Over stg_hubspot_contacts.
FUNNEL: dict[str, Kpi] = {
    "leads": _leads,
    "mqls": _flagged("is_mql"),
    "sqls": _flagged("is_sql"),
    "lead_to_mql_rate": _ratio(_flagged("is_mql"), _leads),
    "mql_to_sql_rate": _ratio(_flagged("is_sql"), _flagged("is_mql")),
    "sql_to_customer_rate": _ratio(_flagged("is_customer"), _flagged("is_sql")),
    "overall_conversion_rate": _ratio(_flagged("is_customer"), _leads),
}

# Over fct_revenue, or its daily rows.
REVENUE: dict[str, Kpi] = {
    "gross_revenue": _sum("gross_revenue"),
    "net_revenue": _sum("net_revenue"),
    "aov": _ratio(_sum("gross_revenue"), _sum("order_count")),
}

# Over revenue_yoy: the growth of the latest month.
REVENUE_GROWTH: dict[str, Kpi] = {
    "revenue_mom_growth": lambda: F.max_by("growth_rate", "month_start"),
}

# Over stg_ga4_sessions.
WEB: dict[str, Kpi] = {
    "sessions": _sum("sessions"),
    "bounce_rate": lambda: F.avg("bounce_rate"),
    "engagement_rate": lambda: F.avg("engagement_rate"),
}


def kpi(df: DataFrame, catalogue: Mapping[str, Kpi], names: Sequence[str] | None = None, by=()) -> DataFrame:
    """The named KPIs, or all of the catalogue, per group."""
    chosen = names or list(catalogue)
    return df.groupBy(*by).agg(*[catalogue[name]().alias(name) for name in chosen])


def as_rows(df: DataFrame) -> DataFrame:
    """A one-row KPI frame as (kpi, value) rows."""
    pairs = [F.struct(F.lit(c).alias("kpi"), F.col(c).cast("double").alias("value")) for c in df.columns]
    return df.select(F.inline(F.array(*pairs)))


def kpi_revenue_web(daily: DataFrame, orders: DataFrame, sessions: DataFrame) -> DataFrame:
    growth = kpi(revenue_yoy(orders), REVENUE_GROWTH)
    frames = [kpi(daily, REVENUE), growth, kpi(sessions, WEB)]
    rows = [as_rows(frame) for frame in frames]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def kpi_repeat_rate(orders: DataFrame) -> DataFrame:
    """Share of paying customers with more than one order."""
    per_customer = (
        paid_orders(orders)
        .filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.count_distinct("order_id").alias("orders"))
    )
    totals = per_customer.agg(
        F.count_if(F.col("orders") > 1).alias("repeat_customers"), F.count(F.lit(1)).alias("customers")
    )
    return totals.withColumn("repeat_rate", safe_divide(F.col("repeat_customers"), F.col("customers")))


def kpi_ltv(orders: DataFrame) -> DataFrame:
    """Net revenue and paid orders of each customer so far."""
    return (
        paid_orders(orders)
        .filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.sum("net_revenue").alias("lifetime_value"), F.count_distinct("order_id").alias("orders"))
    )
