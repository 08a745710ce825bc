"""Event streams: duplicate removal, daily counts, micro-batch upserts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthmill.operators.loading import merge
from growthmill.sources.product_events import with_event_key

# Events may arrive this late: the days each run pulls again.
LATENESS = "2 days"


def read_event_stream(
    spark: SparkSession, path: str, schema, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Parquet event files as a stream."""
    reader = spark.readStream.schema(schema)
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def merge_events(stream: DataFrame, path: str, checkpoint: str, partition_field: str = "event_date") -> None:
    """Keep one copy of each event in a table, however late it comes: batches merge on the event key.

    Of copies that differ the one with the latest time stays.
    """

    def load(batch: DataFrame, _: int) -> None:
        merge(batch, path, ["insert_id", partition_field], ["time"], partition_field)

    _run_batches(with_event_key(stream), checkpoint, load, "append")


def deduplicate(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """First copy of each event id for a stream without a table; state goes once the watermark has passed it.

    Rows later than ``lateness`` are dropped by the watermark; the progress of the query counts them as
    ``numRowsDroppedByWatermark``, which ``append_to`` returns. Bronze uses ``merge_events``, which drops none.
    """
    keyed = with_event_key(events.withColumn("time", F.col("time").cast("timestamp")))
    return keyed.withWatermark("time", lateness).dropDuplicatesWithinWatermark(["insert_id"])


def daily_counts(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Events per day, name and channel in tumbling one-day windows; later rows are dropped and counted."""
    return (
        events.withWatermark("event_timestamp", lateness)
        .groupBy(F.window("event_timestamp", "1 day"), "event_name", "channel_normalized")
        .agg(F.count(F.lit(1)).alias("event_count"), F.approx_count_distinct("distinct_id").alias("approx_users"))
        .select(
            F.to_date("window.start").alias("event_date"),
            "event_name",
            "channel_normalized",
            "event_count",
            "approx_users",
        )
    )


def closed_daily_counts(events: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Events and exact users per day, name and channel; a day is given out once, when the watermark has closed it.

    Two chained stateful steps: the first counts the events of every user within a day, name and channel, the second counts
    users and adds up their events. Both reduce rows before their shuffle, so neither a busy day nor a busy user is held by
    one task, and state goes with its day. Events without a user are counted as events only. For append mode;
    ``daily_counts`` shows days that are still open. Rows later than ``lateness`` are dropped and counted.
    """
    of_user = (
        events.withWatermark("event_timestamp", lateness)
        .groupBy(F.window("event_timestamp", "1 day"), "event_name", "channel_normalized", "distinct_id")
        .agg(F.count(F.lit(1)).alias("user_events"))
    )
    return (
        of_user.groupBy("window", "event_name", "channel_normalized")
        .agg(F.sum("user_events").alias("event_count"), F.count("distinct_id").alias("unique_users"))
        .select(
            F.to_date("window.start").alias("event_date"),
            "event_name",
            "channel_normalized",
            "event_count",
            "unique_users",
        )
    )


def late_rows(query) -> int:
    """Rows that the watermark of a finished query dropped."""
    return sum(
        operator.numRowsDroppedByWatermark for progress in query.recentProgress for operator in progress.stateOperators
    )


def append_to(stream: DataFrame, path: str, checkpoint: str) -> int:
    """Run the stream over everything available, append its output to a parquet table, return the rows dropped as too late."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return late_rows(query)


def upsert_into(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str] = (),
    partition_field: str | None = None,
    output_mode: str = "append",
    schema=None,
) -> None:
    """Run the stream over everything available and merge each micro-batch into a table.

    A batch that is run again after a failure merges to the same rows. With an ``order`` the result is the same
    however the rows fall into batches.
    """

    def load(batch: DataFrame, _: int) -> None:
        merge(batch, path, keys, order, partition_field, schema)

    _run_batches(stream, checkpoint, load, output_mode)


def _run_batches(
    stream: DataFrame, checkpoint: str, load: Callable[[DataFrame, int], None], output_mode: str
) -> None:
    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
