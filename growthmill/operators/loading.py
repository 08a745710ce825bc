"""Writing bronze and mart tables: append, overwrite, merge, refresh, retention, run log."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextlib import contextmanager
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from growthmill.functions.dates import in_days
from growthmill.operators.skew import any_null, rows_without_match
from growthmill.session import remove_folder, work_dir
from growthmill.sources import product_events
from growthmill.sources.product_events import with_event_key
from growthmill.sources.specs import RETENTION_DAYS, SourceSpec, with_metadata

# A merge or refresh of more partitions than this is refused: the table is partitioned too finely.
MOST_PARTITIONS = 10_000
# Up to so many keys with copies are looked up in a list, 8 bytes each; with more all rows are sorted out.
MOST_REPEATED = 1_000_000


def run_query(spark: SparkSession, sql: str, **frames: DataFrame) -> DataFrame:
    """Result of any SQL text; ``{name}`` in it stands for the frame passed as ``name``."""
    return spark.sql(sql, **frames)


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def materialize(
    df: DataFrame,
    name: str,
    kind: str,
    path: str | None = None,
    partition_by: str | None = None,
    cluster_by: Sequence[str] = (),
) -> DataFrame:
    """Publish a model under a name: ``view`` keeps the query, ``table`` stores its rows in the given layout."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    else:
        writer = laid_out(df, partition_by, cluster_by).write.mode("overwrite")
        if partition_by is not None:
            writer = writer.partitionBy(partition_by)
        if path is not None:
            writer = writer.option("path", path)
        writer.saveAsTable(name)
    return df.sparkSession.table(name)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at ``path``, or None when there is none.

    Without a ``schema`` it has every column that any of its files has.
    """
    reader = spark.read.option("mergeSchema", "true") if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def stringify_complex(df: DataFrame) -> DataFrame:
    """Struct, map and array columns as JSON text; nulls stay null."""
    nested = (T.StructType, T.MapType, T.ArrayType)
    columns = {f.name: F.to_json(f.name) for f in df.schema.fields if isinstance(f.dataType, nested)}
    return df.withColumns(columns) if columns else df


def laid_out(df: DataFrame, partition_by: str | None, cluster_by: Sequence[str] = ()) -> DataFrame:
    """Arrange rows for a write: one set of files per partition value, clustered by the cluster keys.

    Without cluster keys rebalancing lets the adaptive planner split a partition value that is much larger than the
    others over several tasks and join small ones. With them rows are dealt out by sampled ranges of partition value and
    cluster keys, so the files of a partition value hold ranges that do not overlap and scans can skip files. Only
    rows with equal partition value and cluster keys must be in one task.
    """
    if not cluster_by:
        return df if partition_by is None else df.hint("rebalance", partition_by)
    keys = [*([partition_by] if partition_by is not None else []), *cluster_by]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def day_partition(df: DataFrame, field: str | None) -> tuple[DataFrame, str | None]:
    """The day column to partition by: the field itself, or a derived one for a timestamp field.

    A frame without the field is written unpartitioned.
    """
    if field is None or field not in df.columns:
        return df, None
    if isinstance(df.schema[field].dataType, (T.TimestampType, T.TimestampNTZType)):
        return df.withColumn(f"{field}_day", F.to_date(field)), f"{field}_day"
    return df, field


@contextmanager
def staging(spark: SparkSession, label: str):
    """A folder for staged rows, removed once they are in place; a failure names it and leaves it."""
    stage = work_dir(spark, label)
    try:
        yield stage
    except Exception as failure:
        failure.add_note(f"staged rows, if any, are in {stage}")
        raise
    remove_folder(spark, stage)


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "append",
    partition_field: str | None = None,
    cluster_by: Sequence[str] = (),
) -> bool:
    """Append to or replace the table at ``path``. An empty frame changes nothing.

    Rows are computed once, into the stage, where they are also counted.
    """
    rows, partition = day_partition(stringify_complex(df), partition_field)
    spark, seen = df.sparkSession, Observation()
    with staging(spark, "write") as stage:
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(stage)
        if seen.get["rows"] == 0:
            return False
        _write(spark.read.schema(rows.schema).parquet(stage), path, mode, partition, cluster_by)
    return True


def _write(rows: DataFrame, path: str, mode: str, partition: str | None, cluster_by: Sequence[str] = ()) -> None:
    writer = laid_out(rows, partition, cluster_by).write.mode(mode)
    if partition is not None:
        writer = writer.partitionBy(partition)
    writer.parquet(path)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], null_safe: bool = False) -> DataFrame:
    """One row per key: the greatest by ``order``, remaining ties settled by the other columns.

    A grouped maximum reduces copies of a key before the shuffle. Rows with a null key have no identity
    and all stay, each in a group of its own; with ``null_safe`` a null is a key value like any other.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    kept = [c for c in order if c not in keys]
    alone = F.lit(0) if null_safe else F.when(any_null(keys), F.monotonically_increasing_id()).otherwise(F.lit(-1))
    return (
        df.withColumn("_alone", alone.cast("bigint"))
        .groupBy(*keys, "_alone")
        .agg(F.max(F.struct(*kept, *rest)).alias("_best"))
        .select(*keys, "_best.*")
        .select(*df.columns)
    )


def with_key_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Add ``key_bucket``, a partition for tables whose keys hold no day.

    Merged on the keys and the bucket, an update rewrites only the buckets its keys fall into. The number of
    buckets belongs to the stored layout: see ``SourceSpec.buckets``.
    """
    return df.withColumn("key_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def _in_partitions(column: str, values: list) -> Column:
    condition = F.col(column).isin([v for v in values if v is not None])
    return condition | F.col(column).isNull() if None in values else condition


def _partition_values(df: DataFrame, column: str) -> list:
    """Distinct partition values: as many as the table has folders, not rows."""
    values = [row[0] for row in df.select(column).distinct().limit(MOST_PARTITIONS + 1).collect()]
    if len(values) > MOST_PARTITIONS:
        raise ValueError(f"more than {MOST_PARTITIONS} partitions of {column}: use a coarser partition")
    return values


def overwrite_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace exactly the partitions that occur in ``df``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def partition_folder(path: str, partition: str, value) -> str:
    return f"{path}/{partition}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def merge(
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str] = (),
    partition_field: str | None = None,
    schema: T.StructType | None = None,
    cluster_by: Sequence[str] = (),
    null_safe: bool = False,
) -> list:
    """Upsert ``source`` into the table at ``path``, which is created on the first run; returns the partitions it rewrote.

    Matched rows are replaced, new rows added, all others kept; a second run changes nothing. With an
    ``order`` the greatest of the stored and the new row stays, ties going to the new one, so
    the result does not depend on how rows are dealt to batches. ``null_safe`` lets nulls in keys match.
    Only partitions that receive or lose a row are rewritten, and read if they keep one. Copies of a key are looked for
    by the keys alone, and only rows of keys that have some are sorted out. The new state is written in full to the shared
    work folder before the table is touched, so a lost executor or a failed overwrite leaves a copy to repeat
    it from; the folder is named in the error and removed after success. With a ``schema`` of the table no
    file footers are looked at. An unpartitioned table has no partitions to return.
    """
    spark = source.sparkSession
    rows, partition = day_partition(stringify_complex(source), partition_field)
    seen = Observation()
    with staging(spark, "merge") as stage:
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{stage}/source")
        if seen.get["rows"] == 0:
            return []
        updates = given = spark.read.schema(rows.schema).parquet(f"{stage}/source")
        target = read_table(spark, path, _stored_schema(schema, rows.schema))
        # Versions of an unpartitioned table, or of very many keys, are sorted out once, together with the stored ones,
        # unless they can lie in several partitions.
        together = bool(order) and target is not None and (partition is None or partition in keys)
        if not together or partition is not None:
            repeated = _repeated_keys(given, keys, null_safe, f"{stage}/repeated")
            together = together and repeated > MOST_REPEATED
            if repeated and not together:
                updates = _one_per_key(given, keys, order, null_safe, stage, repeated)
        if target is None:
            _write(updates, path, "overwrite", partition, cluster_by)
            return [] if partition is None else _partition_values(updates, partition)
        days = reads = None
        if partition is not None:
            # A partition of which every row is replaced need not be read.
            if partition not in keys:
                days = _partition_values(updates, partition)
                replaced = _replaced_rows(target, updates, keys, order, partition, null_safe)
                days = list({*days, *replaced})
                stored = _rows_by_partition(target, partition)
                reads = [day for day in days if stored.get(day, 0) > replaced.get(day, 0)]
            else:
                days = reads = _partition_values(given, partition)
                kind = given.schema[partition].dataType
                # Types that differ, or NaN, cannot be counted by value.
                if order and not together and target.schema[partition].dataType == kind and not isinstance(kind, T.FractionalType):
                    reads = _kept_partitions(target, given, updates, keys, order, partition, days, null_safe)
            target = target.filter(_in_partitions(partition, reads)) if reads else spark.createDataFrame([], target.schema)
        if partition is not None and not reads:
            result = updates.unionByName(target, allowMissingColumns=True).select(*_merged_columns(target, updates))
        elif order and partition in keys:
            read = F.coalesce(_in_partitions(partition, reads), F.lit(False))
            merged = _merged(target, updates.filter(read), keys, order, null_safe)
            result = merged.unionByName(updates.filter(~read), allowMissingColumns=True)
        else:
            result = _merged(target, updates, keys, order, null_safe)
        if reads != [] or updates is not given:
            result.write.parquet(f"{stage}/merged")
            result = spark.read.schema(result.schema).parquet(f"{stage}/merged")
        if partition is None:
            _write(result, path, "overwrite", None, cluster_by)
            return []
        overwrite_partitions(laid_out(result, partition, cluster_by), path, partition)
        if partition not in keys:
            for day in set(days) - set(_partition_values(result, partition)):
                # Every row of this day moved elsewhere.
                remove_folder(spark, partition_folder(path, partition, day))
        return days


def _repeated_keys(rows: DataFrame, keys: Sequence[str], null_safe: bool, path: str) -> int:
    """Write the hashes of keys with several rows and count them. Only a hash of the keys is shuffled."""
    seen = Observation()
    known = rows if null_safe else rows.filter(~any_null(keys))
    counts = known.groupBy(F.xxhash64(*keys).alias("_hash")).agg(F.count(F.lit(1)).alias("_rows"))
    several = counts.filter("_rows > 1").select("_hash")
    several.observe(seen, F.count(F.lit(1)).alias("keys")).write.parquet(path)
    return seen.get["keys"]


def _one_per_key(rows: DataFrame, keys: Sequence[str], order, null_safe: bool, stage: str, repeated: int) -> DataFrame:
    """The newest row of each key, given the number of ``_repeated_keys``.

    Their rows alone are sorted out, those of all other keys stay where they are. A hash that two keys share only sends
    some more rows to be sorted out.
    """
    spark = rows.sparkSession
    hashes = spark.read.schema("_hash bigint").parquet(f"{stage}/repeated")
    marked = rows.withColumn("_hash", F.xxhash64(*keys))
    few = repeated <= MOST_REPEATED
    copies = marked.join(hashes, "_hash", "left_semi").drop("_hash") if few else rows
    latest_per_key(copies, keys, order, null_safe).write.parquet(f"{stage}/latest")
    latest = spark.read.schema(rows.schema).parquet(f"{stage}/latest")
    return marked.join(hashes, "_hash", "left_anti").drop("_hash").unionByName(latest) if few else latest


def _kept_partitions(target, given, updates, keys, order, partition: str, days: list, null_safe: bool) -> list:
    """Of the partitions ``days``, those of which a stored row stays; the partition is one of the keys.

    One with more stored rows than given ones keeps some, so keys are compared only in the others.
    """
    stored = _rows_by_partition(target.filter(_in_partitions(partition, days)), partition)
    coming = _rows_by_partition(given, partition)
    open_ = [day for day in days if 0 < stored.get(day, 0) <= coming[day]]
    replaced = {}
    if open_:
        inside = _in_partitions(partition, open_)
        replaced = _replaced_rows(target.filter(inside), updates.filter(inside), keys, order, partition, null_safe)
    return [day for day in days if stored.get(day, 0) > replaced.get(day, 0)]


def _replaced_rows(target: DataFrame, updates: DataFrame, keys, order, partition: str, null_safe: bool) -> dict:
    """Stored rows that an update replaces, by partition; 0 where all stored rows with an update are the greater ones.

    ``updates`` has one row per key. Only keys and the columns of ``order`` are shuffled.
    """
    olds = [(F.col(c) if c in target.columns else F.lit(None)).alias(f"_old{i}") for i, c in enumerate(order)]
    news = [F.col(c).alias(f"_new{i}") for i, c in enumerate(order)]
    old = target.select(*keys, F.col(partition).alias("_of"), *olds)
    new = updates.select(*keys, *news)
    both = old.join(new, _same_key(old, new, keys) if null_safe else [old[key] == new[key] for key in keys])
    # As in ``latest_per_key`` a null is less than any value; ties go to the update.
    stays = F.lit(False)
    for i in reversed(range(len(order))):
        a, b = F.col(f"_old{i}"), F.col(f"_new{i}")
        stays = F.coalesce(a > b, a.isNotNull() & b.isNull()) | (a.eqNullSafe(b) & stays)
    return dict(map(tuple, both.groupBy("_of").agg(F.count_if(~stays)).collect()))


def _rows_by_partition(df: DataFrame, column: str) -> dict:
    """Rows of each partition: as many as the table has folders."""
    return dict(map(tuple, df.groupBy(column).agg(F.count(F.lit(1))).collect()))


def _merged(target: DataFrame, updates: DataFrame, keys, order, null_safe: bool) -> DataFrame:
    if order:
        # Columns of the updates come first, so ties among them are settled as without a stored table.
        both = updates.withColumn("_new", F.lit(1)).unionByName(
            target.withColumn("_new", F.lit(0)), allowMissingColumns=True
        )
        return latest_per_key(both, keys, [*order, "_new"], null_safe).select(*_merged_columns(target, updates))
    if null_safe:
        kept = target.join(updates, _same_key(target, updates, keys), "left_anti")
    else:
        kept = rows_without_match(target, updates, keys)
    return kept.unionByName(updates, allowMissingColumns=True)


def _merged_columns(target: DataFrame, updates: DataFrame) -> list[str]:
    return [*target.columns, *[c for c in updates.columns if c not in target.columns]]


def _stored_schema(schema: T.StructType | None, incoming: T.StructType) -> T.StructType | None:
    """Columns of a stored table: those declared and those that rows bring along."""
    if schema is None:
        return None
    given = {f.name for f in incoming}
    complex_types = (T.StructType, T.MapType, T.ArrayType)
    declared = [
        T.StructField(f.name, T.StringType() if isinstance(f.dataType, complex_types) else f.dataType)
        for f in schema
        if f.name not in given
    ]
    return T.StructType([*incoming.fields, *declared])


def lookback_window(df: DataFrame, column: str, end: date, days: int = 30) -> DataFrame:
    """Rows from ``days`` days before ``end`` to the end of day ``end``; prunes a table partitioned by the column."""
    return df.filter(in_days(F.col(column), end - timedelta(days), end))


def date_range_chunks(bounds: DataFrame, days: int = 7) -> DataFrame:
    """Split each ``start_date``..``end_date`` into inclusive chunks of at most ``days`` days, other columns kept."""
    starts = F.explode(F.sequence("start_date", "end_date", F.make_dt_interval(F.lit(days))))
    others = [c for c in bounds.columns if c not in ("start_date", "end_date")]
    return bounds.select(*others, starts.alias("chunk_start"), "end_date").select(
        *others, "chunk_start", F.least(F.date_add("chunk_start", days - 1), F.col("end_date")).alias("chunk_end")
    )


def changed_between(rows: DataFrame, spec: SourceSpec, start: date, end: date) -> DataFrame:
    """Rows of a source that last changed from day ``start`` to the end of day ``end``."""
    kinds = {f.name: f.dataType for f in rows.schema}
    moments = [
        F.try_to_timestamp(F.col(c)) if isinstance(kinds[c], T.StringType) else F.col(c)
        for c in spec.window_columns
        if c in kinds
    ]
    return rows.filter(in_days(moments[0] if len(moments) == 1 else F.coalesce(*moments), start, end))


def load_source(
    rows: DataFrame, path: str, spec: SourceSpec, order: Sequence[str] = (), ledger: str | None = None
) -> list:
    """Merge flat rows of a source into its bronze table; loading the same rows again changes nothing. Returns the partitions it rewrote.

    Rows get their load time and source unless they have them, events their key, and tables without a day
    their key bucket. Nulls in keys match, so no row is lost or doubled for a missing dimension. Without an ``order``
    the row that says it changed last stays, so loading an older export later takes nothing back. With a ``ledger`` the load
    is recorded there, for monitors that then need not read the table.
    """
    if "_extracted_at" not in rows.columns:
        rows = with_metadata(rows, spec.table)
    if "insert_id" in spec.merge_keys:
        rows = with_event_key(rows)
    keys, partition = list(spec.merge_keys), spec.partition
    if spec.buckets is not None:
        rows = with_key_bucket(rows, keys, spec.buckets)
        keys, partition = [*keys, "key_bucket"], "key_bucket"
    order = order or [c for c in spec.versions if c in rows.columns]
    touched = merge(rows, path, keys, [*order, "_extracted_at"], partition, spec.schema, null_safe=True)
    if ledger is not None:
        record_load(rows, path, spec.table, partition, touched, ledger)
    return touched


# One row per table, partition and day of loading: rows stored now and the time of the last load among them.
LEDGER = "partition_value string, load_day date, row_count bigint, last_loaded timestamp, table_name string"


def record_load(
    rows: DataFrame, path: str, table: str, partition_field: str | None, touched: Sequence, ledger: str
) -> None:
    """Bring the ledger entries of the partitions that a load rewrote up to date; repeating it changes nothing.

    Only these partitions are read, and of them only the load time. An unpartitioned table is counted whole.
    """
    spark = rows.sparkSession
    shaped, partition = day_partition(rows, partition_field)
    fields = [shaped.schema[c] for c in ("_extracted_at", partition) if c is not None]
    stored = spark.read.schema(T.StructType(fields)).parquet(path)
    if partition is None:
        value, touched = F.lit(None).cast("string"), [None]
    else:
        value, stored = F.col(partition).cast("string"), stored.filter(_in_partitions(partition, list(touched)))
    loaded = F.col("_extracted_at").cast("timestamp")
    entries = stored.groupBy(value.alias("partition_value"), F.to_date(loaded).alias("load_day")).agg(
        F.count(F.lit(1)).alias("row_count"), F.max(loaded).alias("last_loaded")
    )
    _replace_entries(spark, ledger, table, touched, entries)


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    """Entries of all tables; none if nothing was loaded yet."""
    schema = T._parse_datatype_string(LEDGER)
    entries = read_table(spark, ledger, schema)
    return spark.createDataFrame([], schema) if entries is None else entries


def _replace_entries(spark: SparkSession, ledger: str, table: str, touched: Sequence, entries: DataFrame | None) -> None:
    """Replace the entries of a table's touched partitions; other tables have folders of their own."""
    gone = _in_partitions("partition_value", [None if v is None else str(v) for v in touched])
    kept = read_ledger(spark, ledger).filter((F.col("table_name") == table) & ~F.coalesce(gone, F.lit(False)))
    if entries is not None:
        kept = kept.unionByName(entries.withColumn("table_name", F.lit(table)))
    with staging(spark, "ledger") as stage:
        kept.coalesce(1).write.parquet(stage)
        result = spark.read.schema(kept.schema).parquet(stage)
        if result.isEmpty():
            remove_folder(spark, partition_folder(ledger, "table_name", table))
        else:
            overwrite_partitions(result, ledger, "table_name")


def load_event_files(
    spark: SparkSession, files: str, path: str, rejects: str, spec: SourceSpec, ledger: str | None = None
) -> tuple[list, int, int]:
    """Load event files; returns the partitions rewritten, the events and the rejected lines of the files.

    The text is read and parsed once, into the stage. Events are merged into the table at ``path``; the rejected lines of
    a day replace those that an earlier load of the day left at ``rejects``, so every line that is not blank ends up in one of
    the two. Repeating a load changes nothing.
    """
    bad, seen = F.col("parsed").isNull(), Observation()
    lines = product_events.parse_lines(product_events.read_lines(spark, files)).observe(
        seen, F.count_if(~bad).alias("events"), F.count_if(bad).alias("rejects")
    )
    rows = lines.select(*product_events.event_columns(), F.when(bad, F.col("value")).alias("line"), bad.alias("rejected"))
    with staging(spark, "events") as stage:
        rows.write.partitionBy("rejected").parquet(stage)
        if seen.get["events"] + seen.get["rejects"] == 0:
            return [], 0, 0
        staged = spark.read.schema(rows.schema).parquet(stage)
        days = _partition_values(staged, "event_date")
        refused = staged.filter("rejected").select("line", "event_date")
        overwrite_partitions(laid_out(refused, "event_date"), rejects, "event_date")
        for day in set(days) - set(_partition_values(refused, "event_date")):
            remove_folder(spark, partition_folder(rejects, "event_date", day))
        touched = load_source(staged.filter("NOT rejected").drop("line", "rejected"), path, spec, ledger=ledger)
    return touched, seen.get["events"], seen.get["rejects"]


def backfill(
    rows: DataFrame, path: str, spec: SourceSpec, start: date, end: date, order: Sequence[str] = ()
) -> None:
    """Load the rows that changed in a range of days, in one merge; repeating it gives the same table."""
    load_source(changed_between(rows, spec, start, end), path, spec, order)


def expire(df: DataFrame, column: str, as_of: date, layer: str) -> DataFrame:
    """Rows the layer still keeps on ``as_of``."""
    days = RETENTION_DAYS[layer]
    return df if days is None else df.filter(F.col(column) >= F.date_sub(F.lit(as_of), days))


def expire_partitions(
    spark: SparkSession,
    path: str,
    partition: str,
    as_of: date,
    layer: str,
    table_name: str | None = None,
    ledger: str | None = None,
) -> list[date]:
    """Remove the stored days that the layer no longer keeps on ``as_of``, with their ledger entries; returns them."""
    keep_days = RETENTION_DAYS[layer]
    table = read_table(spark, path)
    if keep_days is None or table is None:
        return []
    oldest = as_of - timedelta(keep_days)
    gone = sorted(d for d in _partition_values(table.filter(F.col(partition) < F.lit(oldest)), partition) if d is not None)
    for day in gone:
        remove_folder(spark, partition_folder(path, partition, day))
    if gone and ledger is not None:
        _replace_entries(spark, ledger, table_name, gone, None)
    return gone


def refresh_partitions(mart: DataFrame, path: str, partition: str, days: Sequence[date], cluster_by=()) -> None:
    """Rebuild only the given days of a stored mart; a day without rows any more goes."""
    spark = mart.sparkSession
    with staging(spark, "refresh") as stage:
        rows = mart.filter(_in_partitions(partition, list(days)))
        laid_out(rows, partition, cluster_by).write.partitionBy(partition).parquet(stage)
        built = spark.read.schema(mart.schema).parquet(stage)
        overwrite_partitions(built, path, partition)
        for day in set(days) - set(_partition_values(built, partition)):
            remove_folder(spark, partition_folder(path, partition, day))


def days_to_refresh(touched: Sequence[date | None], before: int = 0, after: int = 0) -> list[date | None]:
    """Output days that read one of the ``touched`` input days.

    A mart declares what its rows read: an output day reads the input days from ``before`` days earlier to ``after`` days
    later. Rows without a day are read by the output without a day.
    """
    known = {d + timedelta(n) for d in touched if d is not None for n in range(-after, before + 1)}
    return [*sorted(known), *([None] if None in touched else [])]


def refresh_touched(
    mart: DataFrame, path: str, partition: str, touched: Sequence[date | None], before: int = 0, after: int = 0, cluster_by=()
) -> list[date | None]:
    """Rebuild the days of a stored mart that read one of the partitions ``merge`` rewrote; returns them.

    The touched days of several inputs are joined by the caller. Nothing touched leaves the mart as it is.
    """
    days = days_to_refresh(touched, before, after)
    if days:
        refresh_partitions(mart, path, partition, days, cluster_by)
    return days


RUN_LOG = "source string, rows_extracted bigint, rows_loaded bigint, success boolean, error string"


def run_load(
    source: str,
    rows: DataFrame,
    load: Callable[[DataFrame], None],
    transform: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Transform and load one source and return its run-log row; a failure is logged, not raised.

    Row counts are observed while ``load`` writes the rows, so they cost no extra pass; it must run the frame once. After a
    failure the source is counted by itself; the count is null if the source cannot be read.
    """
    spark = rows.sparkSession
    seen, kept = Observation(), Observation()
    total = F.count(F.lit(1)).alias("rows")
    extracted = loaded = 0
    error = None
    try:
        incoming = rows.observe(seen, total)
        outgoing = (transform(incoming) if transform else incoming).observe(kept, total)
        load(outgoing)
        extracted, loaded = seen.get["rows"], kept.get["rows"]
    except Exception as failure:
        error = str(failure)
        extracted = _readable_rows(rows)
    return spark.createDataFrame([(source, extracted, loaded, error is None, error)], RUN_LOG)


def _readable_rows(rows: DataFrame) -> int | None:
    """Rows of a source whose load failed; null if the source cannot be read either."""
    try:
        return rows.count()
    except Exception:
        return None
