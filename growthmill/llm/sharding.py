"""Sharding by best-fit-decreasing bin packing of groups of equal texts.

Groups are indivisible. Their sizes are counted in classes, sizes rounded up to 12 significant bits: at most
2048 classes per power of two, however many groups there are. The classes enter the bins from the largest
to the smallest; a group goes to the bin with the least room that still holds it, found in a balanced tree
of the rooms. After a group has entered the tightest bin, that bin is still the tightest, so a
whole run of equal groups is placed at once. Groups find their bin by their rank within their class.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthmill.llm.common import join_by_share, staged, text_of, with_rank

CLASS_BITS = 12
ROW_BYTES = 8


class RoomTree:
    """A height-balanced search tree of (room, bin)."""

    def __init__(self):
        self.root = None

    @staticmethod
    def _height(node) -> int:
        return node[3] if node else 0

    def _node(self, key, left, right):
        return (key, left, right, 1 + max(self._height(left), self._height(right)))

    def _balanced(self, key, left, right):
        lean = self._height(left) - self._height(right)
        if lean > 1:
            k, inner, outer, _ = left
            if self._height(inner) < self._height(outer):
                k2, a, b, _ = outer
                return self._node(k2, self._node(k, inner, a), self._node(key, b, right))
            return self._node(k, inner, self._node(key, outer, right))
        if lean < -1:
            k, outer, inner, _ = right
            if self._height(inner) < self._height(outer):
                k2, a, b, _ = outer
                return self._node(k2, self._node(key, left, a), self._node(k, b, inner))
            return self._node(k, self._node(key, left, outer), inner)
        return self._node(key, left, right)

    def add(self, key) -> None:
        def into(node):
            if node is None:
                return (key, None, None, 1)
            k, left, right, _ = node
            return self._balanced(k, into(left), right) if key < k else self._balanced(k, left, into(right))

        self.root = into(self.root)

    def remove(self, key) -> None:
        def least(node):
            return node[0] if node[1] is None else least(node[1])

        def out_of(node, gone):
            k, left, right, _ = node
            if gone < k:
                return self._balanced(k, out_of(left, gone), right)
            if gone > k:
                return self._balanced(k, left, out_of(right, gone))
            if left is None or right is None:
                return left or right
            after = least(right)
            return self._balanced(after, left, out_of(right, after))

        self.root = out_of(self.root, key)

    def tightest(self, size: int):
        """The (room, bin) with the least room of at least ``size``, or None."""
        node, best = self.root, None
        while node:
            if node[0][0] >= size:
                best, node = node[0], node[1]
            else:
                node = node[2]
        return best


def best_fit(classes: list[tuple[int, int]], capacity: int, most: int | None = None):
    """Pack runs of equal sizes, largest first, into as few bins of ``capacity`` as best fit needs.

    ``classes`` holds (size, count) with falling sizes, none above the capacity. Returns the bins used and
    for each size its runs (first rank, bin), or None once more than ``most`` bins would be needed.
    """
    rooms, bins, runs = RoomTree(), 0, {}
    for size, count in classes:
        rank = 0
        while rank < count:
            found = rooms.tightest(size)
            if found is None:
                if bins == most:
                    return None
                found = (capacity, bins)
                bins += 1
            else:
                rooms.remove(found)
            room, at = found
            entered = min(count - rank, room // size)
            runs.setdefault(size, []).append((rank, at))
            rank += entered
            rooms.add((room - entered * size, at))
    return bins, runs


def fill_shards(histogram: dict[int, int], shards: int) -> dict[int, list[tuple[int, int]]]:
    """Runs (first rank, shard) per size for ``shards`` shards of nearly equal size.

    A group larger than an equal share gets a shard of its own, and the others share the remaining
    shards. Those are packed with the smallest capacity found for which best fit needs no more of them.
    """
    classes = sorted(histogram.items(), reverse=True)
    total, alone, runs = sum(s * c for s, c in classes), 0, {}
    while classes and alone < shards - 1 and classes[0][0] * (shards - alone) > total:
        size, count = classes[0]
        runs.setdefault(size, []).append((histogram[size] - count, alone))
        alone, total = alone + 1, total - size
        classes[:1] = [(size, count - 1)] if count > 1 else []
    if not classes:
        return runs
    left = shards - alone
    low = max(-(-total // left), classes[0][0]) - 1
    step, packed = 1, None
    while packed is None:
        packed = best_fit(classes, low + step, left)
        step *= 2
    high = low + step // 2
    low += step // 4 if step > 2 else 0
    while high - low > 1:
        middle = (low + high) // 2
        tried = best_fit(classes, middle, left)
        if tried is None:
            low = middle
        else:
            high, packed = middle, tried
    in_bins = dict(classes)
    for size, of in packed[1].items():
        started = histogram[size] - in_bins[size]
        runs.setdefault(size, []).extend((started + rank, alone + at) for rank, at in of)
    return runs


def size_class(size: str) -> F.Column:
    """``size`` rounded up to ``CLASS_BITS`` significant bits."""
    cut = f"greatest(length(bin({size})) - {CLASS_BITS}, 0)"
    return F.expr(f"shiftleft(shiftright({size} + shiftleft(1L, {cut}) - 1, {cut}), {cut})")


def fixed_capacity(histogram: dict[int, int], capacity: int) -> tuple[int, dict[int, list[tuple[int, int]]]]:
    """As few shards of ``capacity`` as best fit needs; a group above it is a shard of its own size."""
    large = [(s, c) for s, c in sorted(histogram.items(), reverse=True) if s > capacity]
    alone = sum(c for _, c in large)
    bins, packed = best_fit([(s, c) for s, c in sorted(histogram.items(), reverse=True) if s <= capacity], capacity)
    runs, at = {}, 0
    for size, count in large:
        runs[size] = [(k, at + k) for k in range(count)]
        at += count
    runs |= {size: [(rank, alone + of) for rank, of in found] for size, found in packed.items()}
    return alone + bins, runs


def shard_documents(docs: DataFrame, shards: int | None = 24, capacity: int | None = None) -> DataFrame:
    """Put every document into one of ``shards`` shards of nearly equal bytes, equal texts together.

    With ``shards`` None, into as few shards of ``capacity`` bytes as best fit needs. Returns ``doc_id``, ``size``
    (UTF-8 bytes plus 8), ``text_crc32``, ``law`` (``bytes``), ``shard``, ``slot`` (gapless from 0 in each shard, by
    hashed ``doc_id``) and ``grown_shard`` (null). A null text counts as empty and stands with the empty texts. Repeated rows
    are rows of the same group; an empty table gives none; other columns are ignored.
    """
    text = F.col("text")
    rows = text_of(docs).select(
        "doc_id",
        (F.octet_length(text) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    rows = staged(rows, "shard-rows")
    groups = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    groups = staged(groups.withColumn("class", size_class("bytes")), "shard-groups")
    # One row per class; see the bound above.
    histogram = {r["class"]: r["n"] for r in groups.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()}
    planned = fill_shards(histogram, shards) if shards else fixed_capacity(histogram, capacity)[1]
    runs = docs.sparkSession.sparkContext.broadcast({s: np.array(r, np.int64) for s, r in planned.items()})

    def place(batches):
        for batch in batches:
            sizes, ranks = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            shard = np.empty(len(ranks), np.int32)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                of = runs.value[int(size)]
                shard[at] = of[np.searchsorted(of[:, 0], ranks[at], side="right") - 1, 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(shard)], names=["digest", "n", "shard"])

    ranked = with_rank(groups, "class", ["digest"]).select("digest", "n", "class", F.col("rank").cast("long"))
    placed = staged(ranked.mapInArrow(place, "digest binary, n long, shard int"), "shard-places")
    whole = join_by_share(rows, placed, ["digest"], "n", ["doc_id"])
    return with_rank(whole, "shard", ["doc_id", "digest"], "slot").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
