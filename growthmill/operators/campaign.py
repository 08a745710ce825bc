"""Platform-neutral campaign rows: canonical names, lenient numbers, zero-filled ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from growthmill.functions import lenient_number, normalize_channel, safe_divide_or

# --- Fixed values: platform column to canonical column, in order of preference --
CANONICAL_NAMES = (
    ("cost_micros", "cost"),
    ("conversions_value", "conversion_value"),
    ("spend", "cost"),
    ("date_start", "date"),
)
METRICS = ("impressions", "clicks", "cost", "conversions", "conversion_value")
# --------------------------------------------------------------------------------


def canonical_rename(df: DataFrame) -> DataFrame:
    """Rename platform columns whose canonical name is not taken yet."""
    renames: dict[str, str] = {}
    for old, new in CANONICAL_NAMES:
        if old in df.columns and new not in df.columns and new not in renames.values():
            renames[old] = new
    return df.withColumnsRenamed(renames)


def _number(df: DataFrame, name: str) -> Column:
    """Metric as a zero-filled number; absent metrics count as zero."""
    if name not in df.columns:
        return F.lit(0.0)
    kind = df.schema[name].dataType
    if isinstance(kind, T.StringType):
        return lenient_number(F.col(name))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.coalesce(F.nanvl(F.col(name), F.lit(0.0)), F.lit(0.0)).cast("double")
    return F.coalesce(F.col(name), F.lit(0))


def _day(df: DataFrame) -> Column:
    if isinstance(df.schema["date"].dataType, T.StringType):
        return F.to_date(F.try_to_timestamp("date"))
    return F.col("date").cast("date")


def coerce_metrics(df: DataFrame) -> DataFrame:
    """Unusable numbers become zero, unusable dates null."""
    columns = {name: _number(df, name) for name in METRICS if name in df.columns}
    if "date" in df.columns:
        columns["date"] = _day(df)
    return df.withColumns(columns)


def campaign_transform(df: DataFrame) -> DataFrame:
    """Canonical campaign rows with six ratios, a channel, no negative impressions, no copies."""
    rows = coerce_metrics(canonical_rename(df))

    def ratio(top: str, bottom: str) -> Column:
        return safe_divide_or(_number(rows, top), _number(rows, bottom))

    columns = {
        "ctr": ratio("clicks", "impressions"),
        "cpc": ratio("cost", "clicks"),
        "cpm": ratio("cost", "impressions") * 1000,
        "cvr": ratio("conversions", "clicks"),
        "cpa": ratio("cost", "conversions"),
        "roas": ratio("conversion_value", "cost"),
    }
    for name in ("channel_type", "_source"):
        if name in rows.columns:
            columns["channel_normalized"] = normalize_channel(F.col(name))
            break
    if "impressions" in rows.columns:
        rows = rows.filter(F.col("impressions") >= 0)
    return rows.withColumns(columns).dropDuplicates()


def full_row_dedupe(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def dedupe_report(df: DataFrame) -> DataFrame:
    """Rows before and after ``full_row_dedupe`` and how many were dropped, as one row; copies are counted map-side first."""
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    rows, kept = F.coalesce(F.sum("_copies"), F.lit(0)), F.count(F.lit(1))
    return counted.agg(rows.alias("rows_in"), kept.alias("rows_kept"), (rows - kept).alias("rows_dropped"))
