"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints that differ in at most three of 64 bits agree in at least two of five blocks, so each distinct
fingerprint enters ten tables keyed by two blocks. Inside a bucket the fingerprints are stored as bit planes, 64 to a
machine word. One fingerprint is compared with a word of 64 others by adding the differing planes into
carry-save counters; a word whose counters have all passed the radius is abandoned. Buckets return
the edges of a spanning forest, never all their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthmill.llm.common import join_by_share, map_texts, partitions, staged
from growthmill.llm.components import connected_components

BITS = 64
RADIUS = 3
SHINGLE_WORDS = 3
SEED = 42
# Planes added between two looks at which words can be abandoned.
PLANES_PER_LOOK = 8
# (fingerprint, word) comparisons done at once, and fingerprints per tile of a hot bucket.
COMPARED_AT_ONCE = 1 << 17
TILE = 8192
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(body: bytes, digest, words_of, width: int = SHINGLE_WORDS) -> int:
    """Majority bits over the hashes of all word shingles of a lower-cased UTF-8 text."""
    words = words_of(body)
    if not words:
        return 0
    if len(words) < width:
        hashes = np.array([digest(b" ".join(words), SEED)], np.uint64)
    else:
        joined = b" ".join(words)
        ends = list(accumulate(map(len, words), lambda end, n: end + 1 + n))
        starts = [0, *(e + 1 for e in ends[: len(words) - width])]
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :])], np.uint64)
    set_bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long."""

    def make():
        import re

        from xxhash import xxh64_intdigest

        words_of = re.compile(b"[^\x20\x09-\x0d]+").findall

        def apply(ids, texts):
            bodies = (t.encode("utf-8", "replace").lower() for t in texts)
            values = np.array([fingerprint(b, xxh64_intdigest, words_of, width) for b in bodies], np.uint64)
            return {"doc_id": ids, "fp": values.view(np.int64)}

        return apply

    return map_texts(docs, ["doc_id", "text"], make, "doc_id long, fp long")


class Forest:
    """Union by smallest position, many pairs at a time."""

    def __init__(self, size: int):
        self.low = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.low[a], self.low[b]
            differ = ra != rb
            if not differ.any():
                return
            a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
            np.minimum.at(self.low, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                further = self.low[self.low]
                if np.array_equal(further, self.low):
                    break
                self.low = further


def linked(groups: np.ndarray, values: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each value the position of another of its group that links reach, or its own.

    ``groups`` holds equal numbers side by side.
    """
    edge = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    sizes = np.diff(np.r_[edge, len(groups)])
    words_each = -(-sizes // 64)
    word_start = np.r_[0, np.cumsum(words_each)]
    of_group = np.repeat(np.arange(len(sizes)), sizes)
    slot = 64 * word_start[of_group] + np.arange(len(groups)) - edge[of_group]
    at_slot = np.full(64 * word_start[-1], -1, np.int64)
    at_slot[slot] = np.arange(len(groups))
    filled = np.packbits(at_slot >= 0, bitorder="little").view("<u8")
    planes = np.zeros((BITS, word_start[-1]), np.uint64)
    for bit in range(BITS):
        column = np.zeros(len(at_slot), bool)
        column[slot] = (values >> np.uint64(bit)) & np.uint64(1)
        planes[bit] = np.packbits(column, bitorder="little").view("<u8")
    forest = Forest(len(groups))
    # Each value meets the words of its group from its own word on.
    todo = np.where(sizes[of_group] > 1, word_start[of_group + 1] - slot // 64, 0)
    done = np.cumsum(todo)
    first = 0
    while first < len(todo):
        last = max(first + 1, int(np.searchsorted(done, (done[first - 1] if first else 0) + COMPARED_AT_ONCE, "right")))
        asking = np.repeat(np.arange(first, last), todo[first:last])
        nth = np.arange(len(asking)) - np.repeat(np.cumsum(todo[first:last]) - todo[first:last], todo[first:last])
        words = slot[asking] // 64 + nth
        for a, b in _close(values, planes, filled, slot, asking, words, radius):
            forest.join(a, at_slot[b])
        first = last
    return forest.low


def close_pairs(values: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions (a, b), a < b, of all values within the radius, each pair once, some at a time."""
    position = np.arange(len(values))
    size = -(-len(values) // 64)
    planes = np.zeros((BITS, size), np.uint64)
    column = np.zeros(64 * size, bool)
    column[: len(values)] = True
    filled = np.packbits(column, bitorder="little").view("<u8")
    for bit in range(BITS):
        column[: len(values)] = (values >> np.uint64(bit)) & np.uint64(1)
        planes[bit] = np.packbits(column, bitorder="little").view("<u8")
    rows = max(1, COMPARED_AT_ONCE // max(1, size))
    for first in range(0, len(values), rows):
        some = position[first : first + rows]
        # Each value meets the words from its own word on.
        todo = size - some // 64
        asking = np.repeat(some, todo)
        nth = np.arange(len(asking)) - np.repeat(np.cumsum(todo) - todo, todo)
        yield from _close(values, planes, filled, position, asking, asking // 64 + nth, radius)


def _close(values, planes, filled, slot, asking, words, radius) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (position, slot) within the radius, each pair once."""
    levels = max(1, radius.bit_length())
    # Counters start so that they overflow with the first bit beyond the radius.
    start = (1 << levels) - 1 - radius
    counters = [np.full(len(words), FULL if start >> k & 1 else 0, np.uint64) for k in range(levels)]
    beyond = ~filled[words]
    for plane in range(BITS):
        bits = np.uint64(0) - ((values[asking] >> np.uint64(plane)) & np.uint64(1))
        carry = planes[plane][words] ^ bits
        for k in range(levels):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        beyond |= carry
        if plane % PLANES_PER_LOOK == PLANES_PER_LOOK - 1:
            open_ = beyond != FULL
            if open_.sum() < 0.8 * len(open_):
                asking, words, beyond = asking[open_], words[open_], beyond[open_]
                counters = [c[open_] for c in counters]
    near = ~beyond
    hit = np.flatnonzero(near)
    for at in range(0, len(hit), 1 << 15):
        rows = hit[at : at + (1 << 15)]
        marks = np.unpackbits(near[rows].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, bit = np.nonzero(marks)
        a, b = asking[rows][row], 64 * words[rows][row] + bit
        later = b > slot[a]
        if later.any():
            yield a[later], b[later]


def block_keys(blocks: list[tuple[int, int]]) -> list[str]:
    """SQL of the key of each table: its number and the bits of its two blocks."""
    keys = []
    for number, (left, right) in enumerate(combinations(blocks, 2)):
        (a, m), (b, n) = left, right
        bits = f"shiftleft(shiftrightunsigned(fp, {a}) & {2**m - 1}L, {n}) | (shiftrightunsigned(fp, {b}) & {2**n - 1}L)"
        keys.append(f"shiftleft({number}L, 32) | {bits}")
    return keys


def near_edges(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``a``, ``b`` of spanning forests of all buckets of the distinct fingerprints ``fp``."""
    count = radius + 2
    starts = [round(k * BITS / count) for k in range(count + 1)]
    blocks = [(a, b - a) for a, b in zip(starts, starts[1:])]
    keys = F.array(*[F.expr(k) for k in block_keys(blocks)])
    rows = distinct.select(F.explode(keys).alias("key"), "fp")
    parts = partitions(distinct.sparkSession)
    total = distinct.count() * len(block_keys(blocks))
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    # Buckets above a partition's share: fewer than there are partitions.
    hot = {r["key"]: -(-r["n"] // TILE) for r in sizes.where((F.col("n") > TILE) & (F.col("n") * parts > total)).collect()}
    tile = F.lit(0)
    if hot:
        # A bucket in T tiles becomes T * (T + 1) / 2 buckets, one per pair of tiles.
        tiles = F.create_map(*[F.lit(x) for item in hot.items() for x in item])[F.col("key")]
        own = F.pmod(F.xxhash64("fp"), tiles).cast("int")
        pairs = F.transform(
            F.sequence(F.lit(0), tiles - 1), lambda other: F.least(own, other) * tiles + F.greatest(own, other)
        )
        tile = F.explode(F.when(F.col("key").isin(list(hot)), pairs).otherwise(F.array(F.lit(0))))
    rows = rows.withColumn("tile", tile).repartition(parts, "key", "tile")
    rows = rows.sortWithinPartitions("key", "tile", "fp")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key = held_tile = held = np.empty(0, np.int64)

        def edges(key, tile_, fp):
            groups = np.cumsum(np.r_[0, (key[1:] != key[:-1]) | (tile_[1:] != tile_[:-1])]) if len(key) else key
            if not len(key):
                return
            low = linked(groups, fp.view(np.uint64), radius)
            at = np.flatnonzero(low != np.arange(len(low)))
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(fp[at]), pa.array(fp[low[at]])], names=["a", "b"])

        for batch in batches:
            key = np.r_[held_key, batch.column("key").to_numpy()]
            tile_ = np.r_[held_tile, batch.column("tile").to_numpy()]
            fp = np.r_[held, batch.column("fp").to_numpy()]
            if not len(key):
                continue
            same = (key == key[-1]) & (tile_ == tile_[-1])
            cut = int(np.argmax(same))
            yield from edges(key[:cut], tile_[:cut], fp[:cut])
            held_key, held_tile, held = key[cut:], tile_[cut:], fp[cut:]
        yield from edges(held_key, held_tile, held)

    return rows.select("key", "tile", "fp").mapInArrow(compare, "a long, b long")


def simhash_components(docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE_WORDS) -> DataFrame:
    """Fingerprint of every document and the smallest doc_id that links of its fingerprint reach.

    Returns ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``. Null and wordless texts have fingerprint
    zero and link like any other. Repeated rows and equal texts share a fingerprint and so a component. A component in which
    every doc_id is null has a null id; an empty table gives no rows; other columns are ignored.
    """
    prints = staged(fingerprints(docs, width), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    distinct = staged(distinct, "distinct-fingerprints")
    nodes = connected_components(near_edges(distinct.select("fp"), radius))
    # Roots are nodes of their own component too.
    member = nodes.select(F.col("node").alias("fp"), "root").unionAll(
        nodes.select(F.col("root").alias("fp"), "root").distinct()
    )
    member = staged(member.join(distinct, "fp").select("fp", "root", "first"), "members")
    lowest = member.groupBy("root").agg(F.min("first").alias("low"), F.count(F.lit(1)).alias("m"))
    lowest = staged(lowest, "lowest")
    known = join_by_share(member.select("fp", "root"), lowest, ["root"], "m", ["fp"]).select("fp", "low")
    classes = distinct.join(known, "fp", "left").select("fp", "n", F.coalesce("low", "first").alias("component_id"))
    whole = join_by_share(prints, staged(classes, "classes"), ["fp"], "n", ["doc_id"])
    return whole.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, radius: int = RADIUS, width: int = SHINGLE_WORDS) -> DataFrame:
    """The documents, all columns, with the smallest doc_id of their component.

    Rows that share that doc_id are one document and stay together. Documents with a null doc_id stay only
    where their component has no other.
    """
    kept = simhash_components(docs, radius, width).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = kept.select(F.col("doc_id").alias("_kept_id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["_kept_id"]), "left_semi")
