"""Exact copies by distributed radix partitioning, most significant bytes first.

Each round splits every open group by its next run of bytes. A group of one row is finished, and so is a group
whose texts have ended: its rows have agreed in every byte. Only open groups, with what is left of their
texts, enter the next round. The runs of bytes grow eightfold, so the number of rounds is the logarithm of the
longest text. Equality is decided by the bytes themselves; the digest is only an output column.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthmill.llm.common import join_by_share, map_texts, staged

FIRST_BYTES = 256
GROWTH = 8


def _heads(docs: DataFrame, width: int) -> DataFrame:
    """First bytes of every normalised text, without the rest."""

    def make():
        def apply(ids, texts):
            bodies = [t[:width].encode("utf-8", "replace").lower()[: width + 1] for t in texts]
            ended = [len(t) <= width and len(b) <= width for t, b in zip(texts, bodies)]
            return {"doc_id": ids, "gid": [0] * len(ids), "chunk": [b[:width] for b in bodies], "ended": ended}

        return apply

    return map_texts(docs, ["doc_id", "text"], make, "doc_id long, gid long, chunk binary, ended boolean")


def _whole(docs: DataFrame, width: int) -> DataFrame:
    """First bytes, the rest, and the digest of every normalised text."""
    schema = "doc_id long, text_sha256 string, gid long, chunk binary, ended boolean, rest binary"

    def make():
        def apply(ids, texts):
            bodies = [t.encode("utf-8", "replace").lower() for t in texts]
            return {
                "doc_id": ids,
                "text_sha256": [hashlib.sha256(b).hexdigest() for b in bodies],
                "gid": [0] * len(ids),
                "chunk": [b[:width] for b in bodies],
                "ended": [len(b) <= width for b in bodies],
                "rest": [b[width:] for b in bodies],
            }

        return apply

    return map_texts(docs, ["doc_id", "text"], make, schema)


def exact_copies(docs: DataFrame, first_bytes: int = FIRST_BYTES, growth: int = GROWTH) -> DataFrame:
    """For every document the row that stays among those with the same text, A-Z lower-cased.

    Returns ``doc_id``, ``keep_id`` (largest of the group), ``group_size``, ``kept`` and ``text_sha256``. A null text is
    empty. Rows that repeat a doc_id and its text are the same document, and all of them are marked kept if
    it stays; a null doc_id stays only where no row of the group has one. An empty table gives no rows.
    """
    keys = ["gid", "chunk", "ended"]
    heads, cut, width, finished = _heads(docs, first_bytes), _whole(docs, first_bytes), first_bytes, []
    while True:
        groups = heads.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep_id"))
        # Written before it is joined, so the ids stay as they are.
        groups = staged(groups.where("n > 1").withColumn("next_gid", F.monotonically_increasing_id()), "radix-groups")
        placed = join_by_share(cut, groups, keys, "n", ["doc_id", "text_sha256"], "left")
        done = F.col("n").isNull() | F.col("ended")
        rows = staged(
            placed.select(
                "doc_id", "text_sha256", F.col("next_gid").alias("gid"), done.alias("done"),
                F.coalesce("keep_id", F.when(F.col("n").isNull(), F.col("doc_id"))).alias("keep_id"),
                F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
                F.when(~done, F.col("rest")).alias("rest"),
            ),
            "radix-rows",
        )
        finished.append(rows.where("done"))
        left = rows.where("not done")
        if left.isEmpty():
            break
        width *= growth
        cut = left.select(
            "doc_id", "text_sha256", "gid",
            F.expr(f"substring(rest, 1, {width})").alias("chunk"),
            (F.octet_length("rest") <= width).alias("ended"),
            F.expr(f"substring(rest, {width + 1})").alias("rest"),
        )
        heads = cut.select("doc_id", *keys)
    out = finished[0]
    for more in finished[1:]:
        out = out.unionByName(more)
    return out.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )
