"""Web-analytics report payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GA4_PAYLOAD = """
    dimension_headers array<struct<name: string>>,
    metric_headers array<struct<name: string>>,
    rows array<struct<dimension_values: array<struct<value: string>>,
        metric_values: array<struct<value: string>>>>"""

# --- Fixed values: report dimensions and metrics -----------------------------
DIMENSIONS = (
    "sessionSource",
    "sessionMedium",
    "sessionCampaignName",
    "deviceCategory",
    "country",
    "landingPage",
    "sessionDefaultChannelGroup",
)
COUNT_METRICS = ("sessions", "activeUsers", "newUsers", "screenPageViews", "conversions", "engagedSessions")
RATE_METRICS = ("bounceRate", "averageSessionDuration", "totalRevenue", "engagementRate")
# ----------------------------------------------------------------------------


def _named(headers: str, values: str, name: str) -> Column:
    """The value at the position of ``name`` among the headers; null when either is missing."""
    position = F.array_position(F.col(f"{headers}.name"), name).cast("int")
    return F.try_element_at(F.col(f"{values}.value"), F.nullif(position, F.lit(0)))


def flatten_ga4(df: DataFrame) -> DataFrame:
    """Positional report rows to named, typed columns."""
    rows = df.select("dimension_headers", "metric_headers", F.explode("rows").alias("row"))

    def dimension(name: str) -> Column:
        return _named("dimension_headers", "row.dimension_values", name)

    def metric(name: str) -> Column:
        return _named("metric_headers", "row.metric_values", name).try_cast("double")

    return rows.select(
        F.to_date(dimension("date"), "yyyyMMdd").alias("date"),
        *[dimension(name).alias(name) for name in DIMENSIONS],
        *[F.round(metric(name)).cast("bigint").alias(name) for name in COUNT_METRICS],
        *[metric(name).alias(name) for name in RATE_METRICS],
    )
