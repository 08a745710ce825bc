"""Freshness, volume, null-rate and KPI monitors."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthmill.functions import hours_between, safe_divide
from growthmill.sources.specs import SOURCES

# --- Fixed values: thresholds -------------------------------------------------
FRESHNESS_HOURS = {
    "google_ads_campaigns": 6,
    "meta_ads_insights": 6,
    "ga4_sessions": 6,
    "hubspot_objects": 12,
    "shopify_raw": 6,
    "mixpanel_events": 12,
    "mixpanel_segmentation": 12,
    "mixpanel_funnel_conversions": 24,
}

ROW_MINIMUMS = {
    "google_ads_campaigns": 10,
    "meta_ads_insights": 10,
    "ga4_sessions": 100,
    "mixpanel_events": 50,
}

# Table to its day column and the highest null rate of each watched column.
NULL_RATE_MAXIMUMS = {
    "fct_campaign_performance": ("date", {"campaign_id": 0.0, "cost_usd": 0.0, "date": 0.0}),
    "fct_revenue": ("order_date", {"order_date": 0.0, "gross_revenue": 0.0}),
}

CTR_MIN = 0.005
ROAS_MIN = 1.0
DATA_FRESHNESS_HOURS = 4
NULL_RATE_MAX = 0.05
# ------------------------------------------------------------------------------


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _last_loads(tables: Mapping[str, DataFrame], limits: Mapping[str, tuple[int, ...]], names: tuple[str, ...]):
    """One row per table with its last load time and its limits."""
    return _union(
        [
            tables[table]
            .agg(F.max("_extracted_at").cast("timestamp").alias("last_loaded"))
            .select(
                F.lit(table).alias("table_name"),
                "last_loaded",
                *[F.lit(hours).alias(name) for name, hours in zip(names, hours_of)],
            )
            for table, hours_of in limits.items()
            if table in tables
        ]
    )


def freshness_breaches(
    tables: Mapping[str, DataFrame], as_of: datetime, limits: Mapping[str, int] = FRESHNESS_HOURS
) -> DataFrame:
    """Tables whose last load is more whole hours ago than allowed, or that were never loaded (null hours)."""
    return _too_old(_last_loads(tables, {t: (h,) for t, h in limits.items()}, ("max_hours",)), as_of)


def _too_old(loads: DataFrame, as_of: datetime) -> DataFrame:
    return loads.withColumn("hours_since_load", hours_between(F.col("last_loaded"), F.lit(as_of))).filter(
        (F.col("hours_since_load") > F.col("max_hours")) | F.col("last_loaded").isNull()
    )


def source_freshness(tables: Mapping[str, DataFrame], as_of: datetime) -> DataFrame:
    """Pass, warn or error for every source table with declared limits; one never loaded is an error."""
    limits = {
        spec.table: (spec.warn_hours, spec.error_hours) for spec in SOURCES.values() if spec.warn_hours is not None
    }
    return _with_status(_last_loads(tables, limits, ("warn_hours", "error_hours")), as_of)


def _with_status(loads: DataFrame, as_of: datetime) -> DataFrame:
    age = (F.unix_timestamp(F.lit(as_of)) - F.unix_timestamp("last_loaded")) / 3600
    status = (
        F.when(age.isNull() | (age > F.col("error_hours")), "error").when(age > F.col("warn_hours"), "warn").otherwise("pass")
    )
    return loads.withColumns(
        {"hours_since_load": hours_between(F.col("last_loaded"), F.lit(as_of)), "status": status}
    )


# The same monitors over the ledger that loads write (see ``loading.record_load``): no table is read. A table with a limit
# and without an entry was never loaded.


def _beside_limits(entries: DataFrame, limits: Mapping[str, tuple[int, ...]], names: tuple[str, ...]) -> DataFrame:
    """One row per table with limits, with what the ledger says of it."""
    columns = ", ".join(["table_name string", *[f"{name} int" for name in names]])
    listed = entries.sparkSession.createDataFrame([(t, *hours) for t, hours in limits.items()], columns)
    return listed.join(entries, "table_name", "left").select("table_name", *entries.drop("table_name").columns, *names)


def _last_entries(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("table_name").agg(F.max("last_loaded").alias("last_loaded"))


def ledger_freshness_breaches(
    ledger: DataFrame, as_of: datetime, limits: Mapping[str, int] = FRESHNESS_HOURS
) -> DataFrame:
    """``freshness_breaches`` from the ledger."""
    loads = _beside_limits(_last_entries(ledger), {t: (h,) for t, h in limits.items()}, ("max_hours",))
    return _too_old(loads, as_of)


def ledger_source_freshness(ledger: DataFrame, as_of: datetime) -> DataFrame:
    """``source_freshness`` from the ledger."""
    limits = {s.table: (s.warn_hours, s.error_hours) for s in SOURCES.values() if s.warn_hours is not None}
    return _with_status(_beside_limits(_last_entries(ledger), limits, ("warn_hours", "error_hours")), as_of)


def ledger_row_count_breaches(
    ledger: DataFrame, day: date, minimums: Mapping[str, int] = ROW_MINIMUMS
) -> DataFrame:
    """``row_count_breaches`` from the ledger: rows loaded on ``day`` that are stored now."""
    of_day = ledger.filter(F.col("load_day") == F.lit(day)).groupBy("table_name").agg(F.sum("row_count").alias("row_count"))
    counts = _beside_limits(of_day, {t: (n,) for t, n in minimums.items()}, ("minimum_rows",))
    counts = counts.withColumn("row_count", F.coalesce("row_count", F.lit(0).cast("bigint")))
    return counts.filter(F.col("row_count") < F.col("minimum_rows"))


def row_count_breaches(
    tables: Mapping[str, DataFrame], day: date, minimums: Mapping[str, int] = ROW_MINIMUMS
) -> DataFrame:
    """Tables that received fewer rows on ``day`` than expected."""
    start = F.lit(day).cast("timestamp")
    end = F.date_add(F.lit(day), 1).cast("timestamp")
    loaded = F.col("_extracted_at").cast("timestamp")
    counts = [
        tables[table]
        .filter((loaded >= start) & (loaded < end))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(table).alias("table_name"), "row_count", F.lit(minimum).alias("minimum_rows"))
        for table, minimum in minimums.items()
        if table in tables
    ]
    return _union(counts).filter(F.col("row_count") < F.col("minimum_rows"))


def null_rates(tables: Mapping[str, DataFrame], day: date, maximums=None) -> DataFrame:
    """Null rate of every watched column on ``day``, all columns of a table in one pass."""
    frames = []
    for table, (day_column, columns) in (maximums or NULL_RATE_MAXIMUMS).items():
        if table not in tables:
            continue
        rates = [safe_divide(F.count_if(F.col(c).isNull()), F.count(F.lit(1))).alias(f"r_{c}") for c in columns]
        rows = [
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(c).alias("column_name"),
                F.col(f"r_{c}").alias("null_rate"),
                F.lit(limit).alias("max_rate"),
                F.coalesce(F.col(f"r_{c}") > limit, F.lit(False)).alias("breached"),
            )
            for c, limit in columns.items()
        ]
        measured = tables[table].filter(F.col(day_column) == F.lit(day)).agg(*rates)
        frames.append(measured.select(F.inline(F.array(*rows))))
    return _union(frames)


def kpi_alerts(
    roi: DataFrame,
    bronze: Mapping[str, DataFrame],
    marts: Mapping[str, DataFrame],
    as_of: datetime,
    day: date,
    watched=None,
) -> DataFrame:
    """Everything beyond an alert threshold, one row each.

    Days on which a channel's click rate or return on spend was below its floor, bronze tables
    loaded too long before ``as_of``, and mart columns with too many nulls on ``day``.
    """
    daily = roi.groupBy("date", "channel_source").agg(
        safe_divide(F.sum("total_clicks"), F.sum("total_impressions")).alias("ctr"),
        safe_divide(F.sum("total_conversion_value"), F.sum("total_spend")).alias("roas"),
    )
    floors = F.array(
        *[
            F.struct(F.lit(kpi).alias("kpi"), F.col(kpi).alias("value"), F.lit(floor).alias("threshold"))
            for kpi, floor in (("ctr", CTR_MIN), ("roas", ROAS_MIN))
        ]
    )
    below = daily.select("date", F.col("channel_source").alias("subject"), F.inline(floors)).filter(
        F.col("value") < F.col("threshold")
    )
    late = freshness_breaches(bronze, as_of, dict.fromkeys(FRESHNESS_HOURS, DATA_FRESHNESS_HOURS)).select(
        F.to_date(F.lit(as_of)).alias("date"),
        F.col("table_name").alias("subject"),
        F.lit("data_freshness_hours").alias("kpi"),
        F.col("hours_since_load").cast("double").alias("value"),
        F.col("max_hours").cast("double").alias("threshold"),
    )
    limits = {
        table: (day_column, dict.fromkeys(columns, NULL_RATE_MAX))
        for table, (day_column, columns) in (watched or NULL_RATE_MAXIMUMS).items()
    }
    sparse = (
        null_rates(marts, day, limits)
        .filter("breached")
        .select(
            F.lit(day).alias("date"),
            F.concat_ws(".", "table_name", "column_name").alias("subject"),
            F.lit("null_rate").alias("kpi"),
            F.col("null_rate").alias("value"),
            F.col("max_rate").alias("threshold"),
        )
    )
    return below.unionByName(late).unionByName(sparse)
