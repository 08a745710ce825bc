"""CRM and product funnel marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthmill.functions import month_start, safe_divide, week_start_sunday


def fct_funnel_conversion(contacts: DataFrame) -> DataFrame:
    """Weekly lead, MQL, SQL, opportunity and customer counts per original source."""
    counts = (
        contacts.filter(F.col("created_at").isNotNull())
        .groupBy(
            week_start_sunday(F.to_date("created_at")).alias("week_start"),
            F.col("original_source").alias("channel"),
        )
        .agg(
            F.count_distinct("contact_id").alias("total_leads"),
            F.count_if("is_mql").alias("mqls"),
            F.count_if("is_sql").alias("sqls"),
            F.count_if("is_opportunity").alias("opportunities"),
            F.count_if("is_customer").alias("customers"),
        )
    )
    steps = (
        ("lead_to_mql_rate", "mqls", "total_leads"),
        ("mql_to_sql_rate", "sqls", "mqls"),
        ("sql_to_opp_rate", "opportunities", "sqls"),
        ("opp_to_customer_rate", "customers", "opportunities"),
        ("overall_conversion_rate", "customers", "total_leads"),
    )
    return counts.select(
        "*", *[safe_divide(F.col(top), F.col(bottom)).alias(name) for name, top, bottom in steps]
    )


def fct_mixpanel_funnel(steps: DataFrame) -> DataFrame:
    """Funnel steps with the share lost since the first step of the same day and funnel."""
    entries = steps.filter(F.col("step_index") == 0).select(
        "date", "funnel_id", F.col("entered_count").alias("top_of_funnel_count")
    )
    seconds, top = F.col("avg_time_to_convert_sec"), F.col("top_of_funnel_count")
    return steps.join(entries, ["date", "funnel_id"], "left").select(
        "date",
        week_start_sunday(F.col("date")).alias("week_start"),
        month_start(F.col("date")).alias("month_start"),
        "funnel_id",
        "funnel_name",
        "step_index",
        "step_label",
        "entered_count",
        "step_conversion_rate",
        "avg_time_to_convert_sec",
        (seconds / 60).alias("avg_time_to_convert_min"),
        (seconds / 3600).alias("avg_time_to_convert_hrs"),
        "goal_completions",
        "overall_funnel_conversion_rate",
        safe_divide(top - F.col("entered_count"), top).alias("cumulative_drop_off_rate"),
        "top_of_funnel_count",
    )
