"""Validation checks on marts and bronze tables: one result row per check."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESULT = "check_name string, table_name string, passed boolean, actual bigint, expected bigint, error string"
DUPLICATE_KEYS = ("campaign_id", "ad_group_id", "date", "device")

# --- Fixed values: limits of the checks ---------------------------------------
MIN_EVENTS = 50
MAX_ROAS = 1000
MIN_ROAS_SPEND = 1
# ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """Counts the rows for which ``bad`` holds on a day; at most, or at least, ``expected`` of them pass."""

    name: str
    table: str
    bad: Callable[[Column, Column], Column]
    expected: int = 0
    at_least: bool = False
    duplicates_of: tuple[str, ...] = ()

    def passed(self, actual: Column) -> Column:
        return actual >= self.expected if self.at_least else actual == self.expected


def _funnel_out_of_order() -> Column:
    c = F.col
    return (c("mqls") > c("total_leads")) | (c("sqls") > c("mqls")) | (c("customers") > c("opportunities"))


CHECKS = (
    Check(
        "no_negative_spend",
        "fct_campaign_performance",
        lambda day, today: (F.col("date") == day) & (F.col("cost_usd") < 0),
    ),
    Check("no_future_dates", "google_ads_campaigns", lambda day, today: F.col("date") > today),
    Check(
        "ctr_within_bounds",
        "fct_campaign_performance",
        lambda day, today: (F.col("date") == day) & ((F.col("ctr") < 0) | (F.col("ctr") > 1)),
    ),
    Check(
        "roas_not_astronomical",
        "fct_campaign_performance",
        lambda day, today: (F.col("date") == day)
        & (F.col("roas") > MAX_ROAS)
        & (F.col("cost_usd") > MIN_ROAS_SPEND),
    ),
    Check(
        "funnel_stage_order",
        "fct_funnel_conversion",
        lambda day, today: (F.col("week_start") >= F.date_sub(day, 7)) & _funnel_out_of_order(),
    ),
    Check(
        "revenue_not_negative",
        "fct_revenue",
        lambda day, today: (F.col("order_date") == day)
        & ((F.col("gross_revenue") < 0) | (F.col("net_revenue") < 0)),
    ),
    Check(
        "no_duplicate_campaign_rows",
        "fct_campaign_performance",
        lambda day, today: F.col("date") == day,
        duplicates_of=DUPLICATE_KEYS,
    ),
    Check(
        "mixpanel_minimum_event_count",
        "mixpanel_events",
        lambda day, today: F.col("event_date") == day,
        expected=MIN_EVENTS,
        at_least=True,
    ),
    Check("no_future_mixpanel_events", "mixpanel_events", lambda day, today: F.col("event_date") > day),
)


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter(F.col("cnt") > 1)


def _result_row(check: Check, actual: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.table).alias("table_name"),
        check.passed(actual).alias("passed"),
        actual.cast("bigint").alias("actual"),
        F.lit(check.expected).cast("bigint").alias("expected"),
        F.lit(None).cast("string").alias("error"),
    )


def _table_results(df: DataFrame, checks: Sequence[Check], day: Column, today: Column) -> DataFrame:
    """All checks of one table from one scan, limited to the rows any of them looks at."""
    predicates = [check.bad(day, today) for check in checks]
    looked_at = predicates[0]
    for predicate in predicates[1:]:
        looked_at = looked_at | predicate
    rows = df.filter(looked_at)
    keys = next((check.duplicates_of for check in checks if check.duplicates_of), ())
    counts = []
    if keys:
        rows = rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.count_if(p).alias(f"_c{i}") for i, p in enumerate(predicates)],
        )
    for i, (check, predicate) in enumerate(zip(checks, predicates)):
        if check.duplicates_of:
            total = F.count_if(F.col("_n") > 1)
        elif keys:
            total = F.coalesce(F.sum(f"_c{i}"), F.lit(0))
        else:
            total = F.count_if(predicate)
        counts.append(total.alias(f"_t{i}"))
    totals = rows.agg(*counts)
    return totals.select(F.inline(F.array(*[_result_row(c, F.col(f"_t{i}")) for i, c in enumerate(checks)])))


def _problem(tables: Mapping[str, DataFrame], check: Check, day: Column, today: Column) -> str | None:
    """Why a check cannot run on the given tables; None when it can."""
    if check.table not in tables:
        return f"no table {check.table}"
    try:
        tables[check.table].select(check.bad(day, today), *check.duplicates_of).schema
    except AnalysisException as failure:
        return str(failure)
    return None


def run_checks(
    tables: Mapping[str, DataFrame],
    execution_date: date,
    as_of: date | None = None,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Result rows of the named checks, or all; a check that cannot run fails with its error."""
    day = F.lit(execution_date)
    today = F.current_date() if as_of is None else F.lit(as_of)
    chosen = [check for check in CHECKS if names is None or check.name in names]
    runnable: dict[str, list[Check]] = {}
    failed = []
    for check in chosen:
        problem = _problem(tables, check, day, today)
        if problem is None:
            runnable.setdefault(check.table, []).append(check)
        else:
            failed.append((check.name, check.table, False, None, check.expected, problem))
    frames = [_table_results(tables[table], checks, day, today) for table, checks in runnable.items()]
    if failed:
        spark = next(iter(tables.values())).sparkSession
        frames.append(spark.createDataFrame(failed, RESULT))
    results = frames[0]
    for frame in frames[1:]:
        results = results.unionByName(frame)
    return results


def with_pass_count(results: DataFrame) -> DataFrame:
    """Add an ``all_checks`` row: how many of the checks passed."""
    own = F.struct("check_name", "table_name")
    overall = F.struct(F.lit("all_checks").alias("check_name"), F.lit("*").alias("table_name"))
    is_all = F.col("key.check_name") == "all_checks"
    grouped = (
        results.withColumn("key", F.explode(F.array(own, overall)))
        .groupBy("key")
        .agg(
            F.bool_and("passed").alias("passed"),
            F.when(F.first(is_all), F.count_if("passed")).otherwise(F.max("actual")).alias("actual"),
            F.when(F.first(is_all), F.count(F.lit(1))).otherwise(F.max("expected")).alias("expected"),
            F.max("error").alias("error"),
        )
    )
    return grouped.select("key.*", "passed", "actual", "expected", "error")
