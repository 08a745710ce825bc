"""Helpers shared by the training-data operators: reading, staging, words, balanced ranks and joins."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from growthmill.session import has_shared_folder, shared_folder

WORD = re.compile("[^\x20\x09-\x0d]+")

# Characters of text a task handles at a time, so that its memory does not depend on the batch.
SLICE_CHARS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which every executor can reach.

    A local session that has not set it gets a folder of its own; a cluster must set it.
    """
    if not has_shared_folder(spark) and spark.sparkContext.master.startswith("local"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="growthmill-"))
    return f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later steps never recompute it."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(docs: DataFrame, *more: Column) -> DataFrame:
    """``doc_id`` as it is, ``text`` with null as empty, and nothing else: other columns cannot clash."""
    return docs.select(docs["doc_id"], F.coalesce(docs["text"], F.lit("")).alias("text"), *more)


def map_texts(
    docs: DataFrame, columns: Iterable[str], make: Callable[[], Callable[[list, list[str]], dict]], schema: str
) -> DataFrame:
    """Map documents in tasks: ``make()`` runs once per task and gives ``(ids, texts) -> columns``.

    The function sees slices of about ``SLICE_CHARS`` characters and returns lists by column name, or None;
    it may return more or fewer rows than it got. If it has a ``finish``, the rows of that come last.
    ``columns`` are the id column and the text column.
    """
    out = pa.schema(_arrow_fields(docs.sparkSession, schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for start, stop in slices(texts):
                part = [t or "" for t in texts.slice(start, stop - start).to_pylist()]
                got = apply(ids[start:stop], part)
                if got is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in out], schema=out)
        if hasattr(apply, "finish"):
            got = apply.finish()
            yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in out], schema=out)

    return docs.select(*columns).mapInArrow(run, schema)


def slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold about ``SLICE_CHARS`` bytes of text each; a longer text is alone."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > SLICE_CHARS:
            yield start, i
            start, total = i, 0
        total += n
    if len(sizes) > start:
        yield start, len(sizes)


def keep_rows(docs: DataFrame, make: Callable[[], Callable[[list[str]], list[bool]]]) -> DataFrame:
    """The rows, with all their columns, whose text ``make()(texts)`` marks true. No shuffle."""
    position = docs.columns.index("text")
    types = _arrow_fields(docs.sparkSession, docs.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            texts = batch.column(position)
            for start, stop in slices(texts):
                part = [t or "" for t in texts.slice(start, stop - start).to_pylist()]
                kept = batch.slice(start, stop - start).filter(pa.array(apply(part), pa.bool_()))
                yield pa.RecordBatch.from_arrays(kept.columns, schema=pa.schema(types))

    return docs.mapInArrow(run, docs.schema)


def _arrow_fields(spark: SparkSession, schema) -> list[pa.Field]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    parsed = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    return list(to_arrow_schema(parsed))


def lower_ascii(text: str) -> str:
    """Lower-case A to Z only."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def partitions(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def with_rank(df: DataFrame, key: str, order: list[str], name: str = "rank") -> DataFrame:
    """Number the rows of each ``key`` from 0 without gaps, also when one key holds most rows.

    Rows of a key are dealt to buckets by a hash of ``order``, numbered inside the bucket, and moved
    up by the rows of the buckets before it. Only per-bucket counts are windowed by key. Rows that are
    equal in ``order`` are told apart by nothing that matters and get neighbouring numbers.
    """
    from pyspark.sql import Window

    buckets = partitions(df.sparkSession)
    dealt = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy(key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(key).alias("_key"), F.col("_bucket").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_up")
    )
    inside = Window.partitionBy(key, "_bucket").orderBy(*order)
    numbered = dealt.withColumn("_in", F.row_number().over(inside) - 1)
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_bucket") == F.col("_of"))
    return numbered.join(offsets, same).withColumn(name, F.col("_up") + F.col("_in")).drop(
        "_bucket", "_key", "_of", "_up", "_in"
    )


def join_by_share(
    rows: DataFrame, groups: DataFrame, keys: list[str], count: str, spread_by: list[str], how: str = "inner"
) -> DataFrame:
    """Join many ``rows`` per key to ``groups``, one row per key with its number of rows in ``count``.

    A key is hot when it holds more than one partition's share of the rows, so there are at most as many
    hot keys as partitions. Their rows are spread over salts and their group is repeated per salt.
    """
    spark = rows.sparkSession
    parts = partitions(spark)
    total = groups.agg(F.sum(count)).first()[0] or 0
    is_hot = F.col(count) * parts > total
    key_hash = F.xxhash64(*keys)
    # At most ``parts`` numbers.
    hot = [r[0] for r in groups.where(is_hot).select(key_hash).collect()]
    flag = key_hash.isin(hot) if hot else F.lit(False)
    salt = F.pmod(F.xxhash64(*spread_by) + F.spark_partition_id(), F.lit(parts)).cast("int")
    left = rows.withColumn("_salt", F.when(flag, salt).otherwise(F.lit(0)))
    salts = F.when(flag, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    right = groups.withColumn("_salt", F.explode(salts))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def labelled_sample(spark: SparkSession, sf_dir: str, label: str, per_class: int, allowed: Column | None = None) -> DataFrame:
    """At most ``per_class`` document ids of each label value 0 and 1: ``doc_id``, ``label``.

    Ids are taken in the order of a hash, so the sample does not depend on how rows are stored. A document
    with two labels counts as the smaller one; null ids and labels are left out.
    """
    labels = table(spark, sf_dir, "labels").where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
    if allowed is not None:
        labels = labels.where(allowed)
    one = labels.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return one.where("label = 0").orderBy(*order).limit(per_class).unionAll(
        one.where("label = 1").orderBy(*order).limit(per_class)
    )
