"""Joins that stay balanced when some keys, or missing keys, hold much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def heaviest_keys(df: DataFrame, keys: Sequence[str], parts: int | None = None) -> DataFrame:
    """The non-null keys that hold more than one partition's share of the rows.

    ``parts`` is the number of partitions, by default that of a shuffle. There are fewer such keys than partitions,
    so the list is small enough to broadcast; evenly spread keys give an empty list.
    """
    counts = df.select(*keys).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    names = ", ".join(f"`{key}`" for key in keys)
    return df.sparkSession.sql(
        f"SELECT {names} FROM {{counts}} WHERE _rows * {parts or salt_count(df)} > (SELECT sum(_rows) FROM {{counts}})",
        counts=counts,
    )


def salt_count(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def row_salt(df: DataFrame) -> Column:
    """A salt from the content of a row and the input partition it came from.

    The partition number spreads copies of one row; it stays the same when a task runs again.
    """
    return F.pmod(F.xxhash64(*df.columns) + F.spark_partition_id(), F.lit(salt_count(df))).cast("int")


def flag_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``_hot``: true for the keys in ``hot``, a list shorter than the number of partitions."""
    flagged = df.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), list(keys), "left")
    return flagged.withColumn("_hot", F.coalesce("_hot", F.lit(False)))


def repeat_hot(table: DataFrame) -> DataFrame:
    """Add ``_salt``: a row of a hot key is repeated once per salt, any other row gets salt 0."""
    every_salt = F.sequence(F.lit(0), F.lit(salt_count(table) - 1))
    return table.withColumn("_salt", F.explode(F.when(F.col("_hot"), every_salt).otherwise(F.array(F.lit(0)))))


def join_key_table(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], how: str = "left", hot: DataFrame | None = None
) -> DataFrame:
    """Join many ``rows`` per key to a ``table`` with at most one row per key.

    Rows of the ``hot`` keys (by default those above a partition's share) are spread over salts and the few
    table rows they match are repeated once per salt. Rows with a null key cannot match; they are
    spread too, since a left join would otherwise send them all to one task. Every other key
    joins as usual.
    """
    keys = list(keys)
    if hot is None:
        hot = heaviest_keys(rows, keys)
    spread = F.when(F.col("_hot") | any_null(keys), row_salt(rows)).otherwise(F.lit(0))
    left = flag_hot(rows, hot, keys).withColumn("_salt", spread).drop("_hot")
    right = repeat_hot(flag_hot(table, hot, keys)).drop("_hot")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def any_null(keys: Sequence[str]) -> Column:
    condition = F.lit(False)
    for key in keys:
        condition = condition | F.col(key).isNull()
    return condition


def rows_without_match(rows: DataFrame, table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``table``. A null key matches nothing, and such rows are spread out."""
    left = rows.withColumn("_salt", F.when(any_null(keys), row_salt(rows)).otherwise(F.lit(0)))
    right = table.select(*keys, F.lit(0).alias("_salt"))
    return left.join(right, [*keys, "_salt"], "left_anti").drop("_salt")
