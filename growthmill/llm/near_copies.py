"""One document of each group of near copies: SimHash comparison in bit slices, then an exact check of shingles.

Documents are linked when the sets of their word shingles have a Jaccard similarity of ``SIMILARITY`` or more. Documents
with equal sets are one node from the start. Nodes that agree on all hashes of a band of smallest shingle hashes meet in a
bucket. In a bucket the SimHash fingerprints lie as bit planes and carry-save counters find the pairs within ``RADIUS``, which is
wide enough for the similarity; a pair is linked if its shingles, counted exactly, are similar enough. Pairs
that links already join are not looked at, and buckets return spanning forests. Shingle sets are larger than the text, so
only those of nodes in a bucket are sent anywhere.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from growthmill.llm.common import map_texts, partitions, staged
from growthmill.llm.components import connected_components
from growthmill.llm.simhash import BITS, Forest, close_pairs

WIDTH = 5
# The similarity as a fraction, so that it is compared in whole numbers.
SIMILARITY = (4, 5)
# At a similarity of 0.8 fingerprints differ in 10 bits on average, with a deviation of 3.
RADIUS = 22
# A pair at a similarity of 0.8 shares a band with a probability of 0.995.
BANDS = 10
BAND_ROWS = 4
SEED = 42
# Nodes of a bucket compared in one task; a larger one is dealt out in pairs of tiles.
TILE = 2048
# Shingle hashes worked on at once.
HASHES_AT_ONCE = 1 << 16

PRINTS = "doc_id long, text_hash long, shingle_set binary, fp long, bands array<long>"
# A node and the buckets it is in.
MEETINGS = "struct<node: long, fp: long, met: array<struct<key: long, side: int, tiles: int>>>"


class Prints:
    """Shingle sets of documents with their fingerprints and band keys."""

    def __init__(self, width: int):
        import re

        from xxhash import xxh64_intdigest, xxh128_digest

        self.digest, self.digest_of_set, self.width = xxh64_intdigest, xxh128_digest, width
        self.words_of = re.compile(b"[^\x20\x09-\x0d]+").findall
        # Odd factors give permutations of the hashes.
        self.factors = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * BAND_ROWS, np.uint64) * np.uint64(2) + np.uint64(1)

    def shingles(self, body: bytes) -> np.ndarray:
        """Hashes of the distinct shingles, in order; fewer words than a shingle has are one."""
        words = self.words_of(body)
        if not words:
            return np.empty(0, np.uint64)
        joined, width = b" ".join(words), min(self.width, len(words))
        ends = list(accumulate(map(len, words), lambda end, n: end + 1 + n))
        starts = [0, *(e + 1 for e in ends[: len(words) - width])]
        return np.unique(np.array([self.digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :])], np.uint64))

    def fingerprint(self, hashes: np.ndarray) -> int:
        set_bits = np.zeros(BITS, np.int64)
        for at in range(0, len(hashes), HASHES_AT_ONCE):
            part = hashes[at : at + HASHES_AT_ONCE].astype("<u8").view(np.uint8).reshape(-1, 8)
            set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        return int(np.packbits(2 * set_bits > len(hashes), bitorder="little").view("<i8")[0])

    def bands(self, hashes: np.ndarray) -> list[int]:
        """Keys of the bands; an empty set has none."""
        if not len(hashes):
            return []
        least = np.full(len(self.factors), np.iinfo(np.uint64).max, np.uint64)
        step = HASHES_AT_ONCE // 8
        for at in range(0, len(hashes), step):
            least = np.minimum(least, (hashes[None, at : at + step] * self.factors[:, None]).min(axis=1))
        rows = least.reshape(BANDS, BAND_ROWS)
        return np.array([self.digest(r.tobytes(), SEED + i) for i, r in enumerate(rows)], np.uint64).view(np.int64).tolist()

    def __call__(self, ids, texts):
        out = {name.split()[0]: [] for name in PRINTS.split(", ")}
        out["doc_id"] = ids
        for text in texts:
            raw = text.encode("utf-8", "replace")
            hashes = self.shingles(raw.lower())
            out["text_hash"].append(self.digest(raw, SEED))
            out["shingle_set"].append(self.digest_of_set(hashes.tobytes()))
            out["fp"].append(self.fingerprint(hashes))
            out["bands"].append(self.bands(hashes))
        out["text_hash"] = np.array(out["text_hash"], np.uint64).view(np.int64)
        return out


class Shingles(Prints):
    """Shingle sets themselves, for documents that meet others."""

    def __call__(self, ids, texts):
        bodies = (text.encode("utf-8", "replace").lower() for text in texts)
        return {"of": ids, "shingles": [self.shingles(body).tobytes() for body in bodies]}


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets in order are as similar as ``SIMILARITY``."""
    up, down = SIMILARITY
    # The smaller set cannot be too small for the larger.
    if min(len(a), len(b)) * down < up * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both * down >= up * (len(a) + len(b) - both)


def linked_nodes(fps: np.ndarray, shingles: list[bytes], sides: np.ndarray | None = None, radius: int = RADIUS) -> np.ndarray:
    """For each node of a bucket the smallest position that links reach; with ``sides`` only links between different ones."""
    forest = Forest(len(fps))
    for a, b in close_pairs(fps.view(np.uint64), radius):
        if sides is not None:
            crossing = sides[a] != sides[b]
            a, b = a[crossing], b[crossing]
        while True:
            apart = forest.low[a] != forest.low[b]
            a, b = a[apart], b[apart]
            if not len(a):
                break
            # One pair of each later node at a time: what it joins settles other pairs.
            _, some = np.unique(b, return_index=True)
            good = [i for i in some if similar(np.frombuffer(shingles[a[i]], np.uint64), np.frombuffer(shingles[b[i]], np.uint64))]
            forest.join(a[good], b[good])
            rest = np.ones(len(a), bool)
            rest[some] = False
            a, b = a[rest], b[rest]
    return forest.low


def compare_buckets(rows: DataFrame) -> DataFrame:
    """Edges ``a``, ``b`` of a spanning forest of each bucket and tile of ``rows``, which are sorted by them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        open_ = None
        for batch in batches:
            if not len(batch):
                continue
            key, tile = batch.column("key").to_numpy(), batch.column("tile").to_numpy()
            first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])])
            for start, stop in zip(first, [*first[1:], len(batch)]):
                if held and open_ != (key[start], tile[start]):
                    yield from edges(held)
                    held = []
                open_ = key[start], tile[start]
                held.append(batch.slice(start, stop - start))
        if held:
            yield from edges(held)

    def edges(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, fp, side = (np.concatenate([p.column(c).to_numpy() for p in parts]) for c in ("node", "fp", "side"))
        if len(node) < 2:
            return
        shingles = [x for p in parts for x in p.column("shingles").to_pylist()]
        # In a pair of different tiles, pairs within one tile are the business of that tile.
        crossing = parts[0].column("tile")[0].as_py() >= 0
        low = linked_nodes(fp, shingles, side if crossing else None)
        at = np.flatnonzero(low != np.arange(len(low)))
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(node[low[at]])], names=["a", "b"])

    return rows.select("key", "tile", "side", "node", "fp", "shingles").mapInArrow(run, "a long, b long")


def near_copy_edges(nodes: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """Edges between similar ``nodes`` (``node``, ``place``, ``fp``, ``bands``): spanning forests of all buckets.

    Shingles are made again from the text of ``docs``, and only of nodes that are in a bucket with others; they go to their
    buckets in one shuffle.
    """
    parts = partitions(nodes.sparkSession)
    keys = staged(nodes.select("node", F.explode("bands").alias("key")), "band-keys")
    buckets = keys.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("members"), F.min("node").alias("least")
    )
    # Buckets of the same nodes would find the same links.
    buckets = buckets.where("n > 1").groupBy("n", "members", "least").agg(F.min("key").alias("key"))
    buckets = staged(buckets.select("key", F.ceil(F.col("n") / TILE).cast("int").alias("tiles")), "buckets")
    met = keys.join(buckets, "key").withColumn("side", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    # A node has at most as many as there are bands.
    met = met.groupBy("node").agg(F.collect_list(F.struct("key", "side", "tiles")).alias("met"))
    met = met.join(nodes, "node").select(F.struct("node", "fp", "met").alias("of"), *_place_keys("place.doc_id", "place.text_hash"))
    # Rows that share their id and text are one document, so its text is sent once.
    texts = docs.select(*_place_keys("doc_id", F.xxhash64(F.coalesce("text", F.lit("")))), "text")
    texts = texts.groupBy("_id", "_no_id", "_text").agg(F.any_value("text").alias("text"))
    meeting = met.join(texts, ["_id", "_no_id", "_text"])
    whole = map_texts(meeting, ["of", "text"], lambda: Shingles(width), f"of {MEETINGS}, shingles binary")
    whole = whole.select("of.node", "of.fp", "shingles", F.inline("of.met"))
    # A pair of tiles has a number from 0; a tile by itself, or a bucket that is not dealt out, a negative one.
    tile = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda t: F.when(t == F.col("side"), -1 - t).otherwise(F.least(t, "side") * F.col("tiles") + F.greatest(t, "side")),
    )
    whole = whole.select("key", F.explode(tile).alias("tile"), "side", "node", "fp", "shingles")
    whole = whole.repartition(parts, "key", "tile").sortWithinPartitions("key", "tile", "node")
    return compare_buckets(whole)


def _place_keys(doc_id: str, text_hash: str | Column) -> list[Column]:
    """The id and text hash of a document as columns that join by plain equality, also without an id."""
    text_hash = F.col(text_hash) if isinstance(text_hash, str) else text_hash
    return [F.coalesce(doc_id, F.lit(0)).alias("_id"), F.col(doc_id).isNull().alias("_no_id"), text_hash.alias("_text")]


def one_of_each(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents, all columns, with the smallest doc_id of each group of near copies.

    Rows that share that doc_id and their text are one document and stay together; an id used by two texts is two
    documents. A null doc_id stays only where its group has no other. Null, empty and wordless texts are one
    group; texts of fewer words than a shingle has are alike if their words are. An empty table gives no rows.
    """
    prints = staged(map_texts(docs, ["doc_id", "text"], lambda: Prints(width), PRINTS), "shingle-prints")
    # The document that would stay if the node were alone.
    place = F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "text_hash")
    # Equal sets have equal fingerprints and bands.
    nodes = prints.groupBy("shingle_set").agg(
        F.min(place).alias("place"), F.any_value("fp").alias("fp"), F.any_value("bands").alias("bands")
    )
    nodes = staged(nodes.select(F.monotonically_increasing_id().alias("node"), "place", "fp", "bands"), "nodes")
    roots = connected_components(staged(near_copy_edges(nodes, docs, width), "near-copy-edges"))
    member = nodes.select("node", "place").join(roots, "node", "left").select(F.coalesce("root", "node").alias("root"), "place")
    kept = member.groupBy("root").agg(F.min("place").alias("place")).select(
        F.col("place.doc_id").alias("_kept_id"), F.col("place.text_hash").alias("_kept_text")
    )
    text_hash = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    same = docs["doc_id"].eqNullSafe(kept["_kept_id"]) & (text_hash == kept["_kept_text"])
    return docs.join(kept, same, "left_semi")
