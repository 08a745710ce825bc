"""Product-analytics payloads: event lines, segmentation and funnel reports."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from growthmill.functions.text import surrogate_key

EVENT_LINES = "objects array<struct<event: string, properties: map<string, variant>>>, seal bigint, _corrupt_record string"

SEGMENTATION_PAYLOAD = "data struct<values: map<string, map<string, bigint>>>"

FUNNEL_PAYLOAD = """
    meta struct<funnel_name: string, steps: array<string>>,
    data map<string, struct<
        steps: array<struct<count: double, step_conv_ratio: double, avg_time: double>>,
        analysis: struct<completion: double, completion_ratio: double>>>"""

# --- Fixed values: event property to bronze column ----------------------------
TEXT_PROPERTIES = (
    ("distinct_id", "distinct_id"),
    ("$insert_id", "insert_id"),
    ("mp_country_code", "country_code"),
    ("mp_city", "city"),
    ("mp_region", "region"),
    ("$os", "os"),
    ("$browser", "browser"),
    ("$browser_version", "browser_version"),
    ("$device", "device"),
    ("utm_source", "utm_source"),
    ("utm_medium", "utm_medium"),
    ("utm_campaign", "utm_campaign"),
    ("utm_content", "utm_content"),
    ("utm_term", "utm_term"),
    ("$current_url", "current_url"),
    ("$initial_referrer", "initial_referrer"),
    ("$referrer", "referrer"),
    ("mp_lib", "lib"),
)
WHOLE_PROPERTIES = (("$screen_width", "screen_width"), ("$screen_height", "screen_height"))
RESERVED_PREFIXES = ("$", "mp_")
RESERVED_NAMES = (
    "distinct_id",
    "time",
    "utm_source",
    "utm_medium",
    "utm_campaign",
    "utm_content",
    "utm_term",
)
# ------------------------------------------------------------------------------


def custom_properties(properties: Column) -> Column:
    """JSON text of the properties that are neither reserved nor mapped to a column."""

    def is_custom(name: Column, _: Column) -> Column:
        reserved = name.isin(*RESERVED_NAMES)
        for prefix in RESERVED_PREFIXES:
            reserved = reserved | name.startswith(prefix)
        return ~reserved

    return F.coalesce(F.to_json(F.map_filter(properties, is_custom)), F.lit("{}"))


def read_lines(spark: SparkSession, path: str, export_day: date | None = None) -> DataFrame:
    """Lines of the event files under ``path``; the export day comes from ``event_date=...`` folders unless given."""
    if export_day is None:
        return spark.read.schema("value string, event_date date").text(path)
    return spark.read.schema("value string").text(path).withColumn("event_date", F.lit(export_day))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Add ``parsed``, the event on the line, or null for a line that is rejected; blank lines are no lines.

    This is the only rule by which lines are kept or rejected. A line is an event if it is exactly one JSON object whose
    properties, if it has any, are an object too. Text that is cut off, other JSON values, properties of another
    shape and several objects on one line are rejected. ``NaN`` and single quotes are read as numbers and quotes.
    """
    # As an element of an array, a second object on the line is a second element or an error, not ignored text. A line that
    # closes the array itself does not reach the seal behind it, which it cannot know.
    seal = F.xxhash64("value")
    wrapped = F.from_json(F.concat(F.lit('{"objects":['), "value", F.lit('],"seal":'), seal, F.lit("}")), EVENT_LINES)

    def only_object(line: Column) -> Column:
        whole = line["_corrupt_record"].isNull() & line["seal"].eqNullSafe(seal) & (F.size(line["objects"]) == 1)
        return F.when(whole, line["objects"][0])

    # The lambda binds the parsed line, so that the text is parsed once.
    parsed = F.explode_outer(F.transform(F.array(wrapped), only_object))
    return lines.filter(F.trim("value") != "").select("*", parsed.alias("parsed"))


def event_columns() -> list[Column]:
    """Bronze columns of a parsed line; all but the day are null where the line is rejected."""
    props = F.col("parsed.properties")
    return [
        F.col("parsed.event").alias("event"),
        *[props[name].cast("string").alias(column) for name, column in TEXT_PROPERTIES],
        F.timestamp_seconds(F.expr("try_variant_get(parsed.properties['time'], '$', 'double')")).alias("time"),
        *[
            F.expr(f"try_variant_get(parsed.properties['{name}'], '$', 'bigint')").alias(column)
            for name, column in WHOLE_PROPERTIES
        ],
        custom_properties(props).alias("custom_properties"),
        F.col("event_date"),
    ]


def read_events(
    spark: SparkSession, path: str, events: Sequence[str] | None = None, export_day: date | None = None
) -> DataFrame:
    """Newline-delimited event files under ``path``, rejected lines left out.

    ``events`` keeps only the named events; lines that do not mention one of them are passed over before they are parsed.
    """
    lines = read_lines(spark, path, export_day)
    if events is not None:
        # A name may also be written with escapes.
        mentioned = F.col("value").contains("\\")
        for name in events:
            mentioned = mentioned | F.col("value").contains(name)
        lines = lines.filter(mentioned)
    kept = parse_lines(lines).filter(F.col("parsed").isNotNull())
    if events is not None:
        kept = kept.filter(F.col("parsed.event").isin(*events))
    return kept.select(*event_columns())


def rejected_lines(spark: SparkSession, path: str) -> DataFrame:
    """Rejected lines per export day, for the run log: the lines that ``read_events`` leaves out."""
    rejected = parse_lines(read_lines(spark, path)).filter(F.col("parsed").isNull())
    return rejected.groupBy("event_date").agg(F.count(F.lit(1)).alias("rejected_lines"))


def with_event_key(df: DataFrame) -> DataFrame:
    """Give events without an insert id a key made from user, name and time."""
    key = surrogate_key(F.col("distinct_id"), F.col("event"), F.col("time"))
    return df.withColumn("insert_id", F.coalesce("insert_id", key))


def flatten_segmentation(df: DataFrame) -> DataFrame:
    """``event``, ``segment_property`` and a value -> day -> count map to one row per cell."""
    values = df.select("event", "segment_property", F.explode("data.values").alias("segment_value", "days"))
    cells = values.select("event", "segment_property", "segment_value", F.explode("days").alias("day", "n"))
    return cells.select(
        "event",
        "segment_property",
        "segment_value",
        F.to_date("day").alias("date"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("event_count"),
    )


def flatten_funnels(df: DataFrame) -> DataFrame:
    """Funnel reports to one row per funnel, day and step position."""
    days = df.select("funnel_id", "meta", F.explode("data").alias("day", "report"))
    steps = days.select("funnel_id", "meta", "day", "report.analysis", F.posexplode("report.steps").alias("i", "step"))
    label = F.coalesce(
        F.try_element_at("meta.steps", F.col("i") + 1),
        F.concat(F.lit("step_"), F.col("i").cast("string")),
    )

    def number(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0))

    return steps.select(
        "funnel_id",
        F.coalesce("meta.funnel_name", F.col("funnel_id").cast("string")).alias("funnel_name"),
        F.to_date("day").alias("date"),
        F.col("i").alias("step_index"),
        label.alias("step_label"),
        number("step.count").cast("bigint").alias("count"),
        number("step.step_conv_ratio").alias("conversion_rate"),
        number("step.avg_time").alias("avg_time_to_convert_sec"),
        number("analysis.completion").cast("bigint").alias("goal_count"),
        number("analysis.completion_ratio").alias("goal_conversion_rate"),
    )
