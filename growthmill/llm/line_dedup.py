"""Line dedup by a segment-partition edit join.

Two lines within ``EDITS`` edits share, intact and nearly in place, at least one of the ``EDITS + 1`` segments the
shorter is cut into. Every line indexes its segments and probes, for each length it may be matched with, the
substrings of its own that could be such a segment: only positions that edits before and after the segment can reach.
Keys are hashes of (length, segment number, substring). Keys met by two lines lead to candidates, whose texts
are compared by a bit-parallel edit distance on the band of the few diagonals that matter. Linked lines form
classes, and the first line of a class stays. Equal lines are one line from the start.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthmill.llm.common import WORD, join_by_share, map_texts, slices, staged
from growthmill.llm.components import connected_components

EDITS = 2
# Shorter lines are compared for equality only.
MIN_CHARS = 24
# Bits of the filter that spares unlinked lines the shuffle of their text; its size does not depend on the data.
FILTER_BITS = 26
# Lines of a key compared in one task; beyond it a key is dealt out in pairs of tiles.
TILE = 2048
HELD_ROWS = 1_000_000
# Line lengths whose cuts a task remembers.
KNOWN_LENGTHS = 4096
PAIRS_AT_ONCE = 1 << 18
SEED = 42


def segments(length: int, edits: int = EDITS) -> list[tuple[int, int]]:
    """(start, size) of the segments of a line: sizes differ by one at most, the shorter ones first."""
    count = edits + 1
    size, longer = divmod(length, count)
    out, start = [], 0
    for i in range(count):
        n = size + (i >= count - longer)
        out.append((start, n))
        start += n
    return out


def probe_starts(number: int, start: int, size: int, length: int, mine: int, edits: int = EDITS) -> range:
    """Where segment ``number`` of a line of ``length`` can lie in one of ``mine`` characters, ``mine >= length``.

    With the first ``number`` segments hit by an edit each, at most ``number`` edits come before this one, and at most
    ``edits - number`` after it; both limit how far it can have moved.
    """
    more = mine - length
    low = max(0, start - number, start + more - (edits - number))
    high = min(mine - size, start + number, start + more + (edits - number))
    return range(low, high + 1)


def within(a: str, b: str, edits: int = EDITS) -> bool:
    """Whether at most ``edits`` insertions, deletions and substitutions lead from ``a`` to ``b``."""
    if len(a) > len(b):
        a, b = b, a
    drift = len(b) - len(a)
    if drift > edits:
        return False
    start = _common(a, b)
    a, b = a[start:], b[start:]
    end = _common(a[::-1], b[::-1])
    if end:
        a, b = a[:-end], b[:-end]
    if not a:
        return len(b) <= edits
    positions: dict[str, int] = {}
    for i, c in enumerate(a):
        positions[c] = positions.get(c, 0) | 1 << i
    # Bit t stands for row j - edits + t of column j, so each step down a column moves the band by one row.
    mask = (1 << (2 * edits + 1)) - 1
    plus, minus = mask >> edits << edits, 0
    watched, distance = edits - drift, drift
    for j, c in enumerate(b, 1):
        at = positions.get(c, 0)
        shift = j - edits - 1
        equal = (at >> shift if shift >= 0 else at << -shift) & mask
        level = (((equal & plus) + plus) ^ plus | equal | minus) & mask
        up = minus | (mask ^ (level | plus))
        down = level & plus
        plus = down | (mask ^ (level >> 1 | up))
        minus = level >> 1 & up
        if j > drift and not level >> watched & 1:
            distance += 1
            if distance > edits:
                return False
    return True


def _common(a: str, b: str) -> int:
    """Length of the common prefix, by halving."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, step = 0, 16
    while a[low : low + step] == b[low : low + step]:
        low += step
        step *= 2
    high = min(n, low + step)
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def shared_key(short: str, long: str, key_of, edits: int = EDITS) -> int | None:
    """The first key that both lines meet; the pair counts under this one only."""
    for i, (start, size) in enumerate(segments(len(short), edits)):
        piece = short[start : start + size]
        for at in probe_starts(i, start, size, len(short), len(long), edits):
            if long[at : at + size] == piece:
                return key_of(len(short), i, piece)
    return None


def hasher():
    from xxhash import xxh64_intdigest

    def key_of(length: int, number: int, piece: str) -> int:
        return xxh64_intdigest(f"{length} {number} {piece}".encode("utf-8", "replace"), SEED)

    return key_of


class LineKeys:
    """Keys of the lines of a task, each distinct line once. The last bit of ``line`` marks an index entry."""

    def __init__(self, min_chars: int, edits: int):
        from xxhash import xxh64_intdigest

        self.digest = xxh64_intdigest
        self.min_chars, self.edits, self.seen = min_chars, edits, set()
        self.known: dict[int, tuple[list, list]] = {}

    def __call__(self, ids, texts):
        keys, lines = [], []
        for text in texts:
            for line in text.split("\n"):
                if len(line) < self.min_chars or not WORD.search(line):
                    continue
                name = self.digest(line.encode("utf-8", "replace"), SEED)
                if name in self.seen:
                    continue
                self.seen.add(name)
                index, probe = self.keys(line)
                keys.extend(index)
                keys.extend(probe)
                lines.extend([name | 1] * len(index))
                lines.extend([name & ~1] * len(probe))
        return {"key": np.array(keys, np.uint64).view(np.int64), "line": np.array(lines, np.uint64).view(np.int64)}

    def keys(self, line: str) -> tuple[set[int], set[int]]:
        digest = self.digest
        return tuple(
            {digest((prefix + line[start:end]).encode("utf-8", "replace"), SEED) for prefix, start, end in of}
            for of in self.cuts(len(line))
        )

    def cuts(self, mine: int) -> tuple[list, list]:
        """Index and probe cuts of a line of ``mine`` characters as (key prefix, start, end), remembered per length."""
        if mine not in self.known:
            if len(self.known) >= KNOWN_LENGTHS:
                self.known.clear()
            index = [(f"{mine} {i} ", s, s + n) for i, (s, n) in enumerate(segments(mine, self.edits))]
            probe = [
                (f"{length} {i} ", at, at + n)
                for length in range(max(self.min_chars, mine - self.edits), mine + 1)
                for i, (s, n) in enumerate(segments(length, self.edits))
                for at in probe_starts(i, s, n, length, mine, self.edits)
            ]
            self.known[mine] = index, probe
        return self.known[mine]


def met_keys(rows: DataFrame, parts: int) -> DataFrame:
    """The (key, line) of keys that an indexing line shares with another line."""
    dealt = rows.repartition(parts, "key").sortWithinPartitions("key", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, line = np.empty(0, np.int64), np.empty(0, np.int64)
        open_key = None

        def out(k, n):
            return pa.RecordBatch.from_arrays([pa.array(k), pa.array(n)], names=["key", "line"])

        for batch in batches:
            key = np.r_[key, batch.column(0).to_numpy()]
            line = np.r_[line, batch.column(1).to_numpy()]
            if not len(key):
                continue
            last = int(np.searchsorted(key, key[-1]))
            yield out(*_met(key[:last], line[:last], open_key))
            key, line = key[last:], line[last:]
            if len(key) > HELD_ROWS:
                line = np.unique(line)
                key = key[: len(line)]
                if len(line) > HELD_ROWS // 2:
                    # So many lines of one key have certainly met; what follows goes out as it comes.
                    yield out(key, line)
                    open_key, key, line = key[0], key[:0], line[:0]
        if len(key):
            yield out(*_met(key, line, open_key))

    return dealt.mapInArrow(run, "key long, line long")


def _met(key: np.ndarray, line: np.ndarray, open_key) -> tuple[np.ndarray, np.ndarray]:
    if not len(key):
        return key, line
    new = np.r_[True, (key[1:] != key[:-1]) | (line[1:] != line[:-1])]
    key, line = key[new], line[new]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    sizes = np.diff(np.r_[first, len(key)])
    name = line & ~np.int64(1)
    several = np.minimum.reduceat(name, first) != np.maximum.reduceat(name, first)
    met = np.repeat(several & np.bitwise_or.reduceat(line & 1, first).astype(bool), sizes)
    if open_key is not None:
        met |= key == open_key
    return key[met], line[met]


def signature(line: str) -> np.ndarray:
    """Parities of 256 classes of character pairs; one edit changes at most four."""
    codes = np.frombuffer(line.encode("utf-32-le", "replace"), np.uint32)
    counts = np.bincount((codes[:-1] * np.uint32(31) + codes[1:] * np.uint32(17)) & 255, minlength=256)
    return np.packbits(counts & 1, bitorder="little").view("<u8")


def links_of_key(key: int, lines: list[str], nodes: np.ndarray, index: np.ndarray, edits: int = EDITS):
    """Links of one key: positions (a, b) of lines within ``edits``, each pair only under its first key."""
    key_of = hasher()
    order = np.arange(len(lines))
    sizes = np.array([len(x) for x in lines])
    marks = np.stack([signature(x) for x in lines])
    indexing = np.flatnonzero(index)
    rows = max(1, PAIRS_AT_ONCE // len(lines))
    for at in range(0, len(indexing), rows):
        some = indexing[at : at + rows]
        more = sizes[None, :] - sizes[some][:, None]
        able = (more >= 0) & (more <= edits) & ((more > 0) | (nodes[some][:, None] < nodes[None, :]))
        able &= nodes[some][:, None] != nodes[None, :]
        differ = np.zeros(able.shape, np.int64)
        for word in range(marks.shape[1]):
            differ += np.bitwise_count(marks[some, word][:, None] ^ marks[None, :, word])
        for i, b in zip(*np.nonzero(able & (differ <= 4 * edits))):
            a = int(some[i])
            if within(lines[a], lines[b], edits) and shared_key(lines[a], lines[b], key_of, edits) == key:
                yield a, int(order[b])


def compare_lines(rows: DataFrame, edits: int) -> DataFrame:
    """``a`` with its representative ``b`` of a spanning forest and its number of links, per key and tile."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, text = None, 5
        for batch in batches:
            # Offsets of 64 bits: the text of one key may be larger than a chunk with 32-bit offsets can hold.
            batch = batch.set_column(text, "text", batch.column(text).cast(pa.large_string()))
            joined = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks().to_batches()
            if not joined:
                continue
            (whole,) = joined
            key, tile = whole.column("key").to_numpy(), whole.column("tile").to_numpy()
            first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (tile[1:] != tile[:-1])])
            for start, stop in zip(first, first[1:]):
                yield from links(whole.slice(start, stop - start))
            held = whole.slice(first[-1])
        if held is not None:
            yield from links(held)

    def links(group: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        if len(group) < 2:
            return
        from growthmill.llm.simhash import Forest

        nodes = group.column("node").to_numpy()
        side = group.column("side").to_numpy()
        crossing = group.column("tile")[0].as_py() >= 0
        key = group.column("key")[0].as_py() & (2**64 - 1)
        lines, forest = group.column("text").to_pylist(), Forest(len(group))
        degree = np.zeros(len(group), np.int64)
        found = links_of_key(key, lines, nodes, group.column("indexing").to_numpy(zero_copy_only=False), edits)
        for a, b in found:
            # In a pair of different tiles, pairs within one tile are the business of that tile.
            if crossing and side[a] == side[b]:
                continue
            forest.join(np.array([a]), np.array([b]))
            degree[a] += 1
            degree[b] += 1
        at = np.flatnonzero(degree)
        if len(at):
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes[at]), pa.array(nodes[forest.low[at]]), pa.array(degree[at])], names=["a", "b", "links"]
            )

    return rows.select("key", "tile", "side", "node", "indexing", "text").mapInArrow(run, "a long, b long, links long")


def line_links(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Every line with a link: ``text``, ``name`` (a hash), ``root`` (a number for its class) and ``links``, how many lines it links to.

    Lines are distinct and have at least ``min_chars`` characters.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = map_texts(docs, ["doc_id", "text"], lambda: LineKeys(min_chars, edits), "key long, line long")
    met = staged(met_keys(keys, parts), "met-keys").distinct()
    met = met.select("key", F.expr("line & -2L").alias("name"), (F.col("line") % 2 != 0).alias("indexing"))
    met = met.groupBy("key", "name").agg(F.max("indexing").alias("indexing"))
    met = staged(met, "met")
    texts = staged(_texts_of(docs, met, min_chars), "met-texts")
    texts = texts.select(F.monotonically_increasing_id().alias("node"), "name", "text")
    texts = staged(texts, "nodes")
    large = staged(met.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > TILE), "large-keys")
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    side = F.when(F.col("n").isNull(), 0).otherwise(F.pmod(F.xxhash64("name"), tiles)).cast("int")
    dealt = met.join(large, "key", "left").withColumn("side", side).withColumn("tiles", tiles)
    # A pair of tiles has a number from 0; a tile by itself, or a key that is not dealt out, a negative one.
    tile = F.when(
        F.col("n").isNotNull(),
        F.transform(
            F.sequence(F.lit(0), F.col("tiles") - 1),
            lambda t: F.when(t == F.col("side"), -2 - t).otherwise(F.least(t, "side") * F.col("tiles") + F.greatest(t, "side")),
        ),
    ).otherwise(F.array(F.lit(-1)))
    dealt = dealt.select("key", "name", "indexing", "side", F.explode(tile).alias("tile"))
    whole = dealt.join(texts, "name").repartition(parts, "key", "tile").sortWithinPartitions("key", "tile", "node")
    found = staged(compare_lines(whole, edits), "line-links")
    roots = connected_components(found.select("a", "b"))
    degrees = found.groupBy("a").agg(F.sum("links").alias("links"))
    linked = degrees.join(roots, degrees["a"] == roots["node"], "left")
    linked = linked.select(F.col("a").alias("node"), F.coalesce("root", "a").alias("root"), "links")
    return texts.join(linked, "node").select("text", "name", "root", "links")


def _texts_of(docs: DataFrame, met: DataFrame, min_chars: int) -> DataFrame:
    """``name`` and ``text`` of the distinct lines whose name is in ``met``, and perhaps of some others."""
    words = met.select(F.expr(f"(name >> 1) & {2**FILTER_BITS - 1}L").alias("bit"))
    words = words.groupBy(F.expr("bit >> 5").cast("int").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(bit & 31 AS int)))").alias("bits")
    )
    # At most 2 ** (FILTER_BITS - 5) rows.
    held = np.zeros(2 ** (FILTER_BITS - 5), np.uint32)
    for batch in words.toArrow().to_batches():
        held[batch.column(0).to_numpy()] = batch.column(1).to_numpy().astype(np.uint32)
    sent = docs.sparkSession.sparkContext.broadcast(held)

    def make():
        from xxhash import xxh64_intdigest

        seen: set[int] = set()

        def apply(ids, texts):
            names, lines = [], []
            for text in texts:
                for line in text.split("\n"):
                    if len(line) < min_chars or not WORD.search(line):
                        continue
                    name = xxh64_intdigest(line.encode("utf-8", "replace"), SEED) & ~1
                    bit = name >> 1 & (2**FILTER_BITS - 1)
                    if sent.value[bit >> 5] >> np.uint32(bit & 31) & 1 and name not in seen:
                        seen.add(name)
                        names.append(name)
                        lines.append(line)
            return {"name": np.array(names, np.uint64).view(np.int64), "text": lines}

        return apply

    found = map_texts(docs, ["doc_id", "text"], make, "name long, text string").distinct()
    return found.join(met.select("name").distinct(), "name", "left_semi")


def line_decisions(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per document (``doc_id``, ``text_hash``) the numbers of the lines that stay and figures about its lines.

    ``kept`` lists the lines that are the first of their class in the order of ``doc_id``, ``text_hash`` and line number;
    ``near`` counts lines that are new but near an earlier one; ``links`` sums the links of the lines it brings first.
    """
    lines = docs.select(
        "doc_id",
        F.xxhash64(_text()).alias("text_hash"),
        F.posexplode(F.split(_text(), "\n", -1)).alias("line_no", "line"),
    ).where(F.col("line").rlike("[^\\x20\\x09-\\x0D]"))
    first = lines.select(
        F.unhex(F.md5("line")).alias("digest"),
        F.expr("xxhash64(line) & -2L").alias("name"),
        F.struct("doc_id", "text_hash", "line_no").alias("place"),
    )
    first = staged(first.groupBy("digest", "name").agg(F.min("place").alias("place")), "first-lines")
    linked = line_links(docs, edits, min_chars).select(F.unhex(F.md5("text")).alias("digest"), "name", "root", "links")
    linked = staged(linked.join(first, ["digest", "name"]).select("place", "root", "links"), "linked-lines")
    lead = staged(linked.groupBy("root").agg(F.min("place").alias("lead"), F.count(F.lit(1)).alias("n")), "leads")
    near = join_by_share(linked, lead, ["root"], "n", ["place"]).select(
        "place", (F.col("place") != F.col("lead")).alias("near"), "links"
    )
    every = first.select("place", F.lit(False).alias("near"), F.lit(0).cast("long").alias("links"), F.lit(1).alias("new"))
    both = every.unionByName(near.withColumn("new", F.lit(0))).select("place.*", "near", "links", "new")
    return both.groupBy("doc_id", "text_hash").agg(
        F.array_except(
            F.collect_list(F.when(F.col("new") == 1, F.col("line_no"))), F.collect_list(F.when(F.col("near"), F.col("line_no")))
        ).alias("kept"),
        F.sum(F.col("near").cast("int")).cast("long").alias("near"),
        F.sum("links").alias("links"),
    )


def _text() -> F.Column:
    return F.coalesce(F.col("text"), F.lit(""))


def dedup_lines(docs: DataFrame, edits: int = EDITS, min_chars: int = MIN_CHARS, figures: bool = False) -> DataFrame:
    """The documents, all columns, with only those lines that are the first of their class; blank lines stay.

    With ``figures`` the struct column ``_lines`` (lines, kept, near, links) is added. A document all of whose lines are copies is
    left with its blank lines or the empty text. A null text stays null. Rows that repeat a doc_id and its
    text are the same document and keep the same lines; an empty table gives no rows.
    """
    decisions = line_decisions(docs.select("doc_id", "text"), edits, min_chars).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "kept", "near", "links"
    )
    fresh = "_" + max(docs.columns, key=len)
    decisions = decisions.select("_id", "_hash", F.struct("kept", "near", "links").alias(fresh))
    same = docs["doc_id"].eqNullSafe(decisions["_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == decisions["_hash"])
    joined = docs.join(decisions, same, "left").select(*[docs[c] for c in docs.columns], decisions[fresh])
    position, names = docs.columns.index("text"), list(docs.columns)
    schema = docs.schema
    if figures:
        schema = docs.select("*", F.expr("named_struct('lines', 0L, 'kept', 0L, 'near', 0L, 'links', 0L)").alias("_lines")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in slices(batch.column(position)):
                part = batch.slice(start, stop - start)
                texts, counts = [], []
                for text, decided in zip(part.column(position).to_pylist(), part.column(len(names)).to_pylist()):
                    lines = (text or "").split("\n")
                    worded = [bool(WORD.search(x)) for x in lines]
                    kept = set(decided["kept"]) if decided else set()
                    stay = [x for i, x in enumerate(lines) if i in kept or not worded[i]]
                    texts.append(None if text is None else "\n".join(stay))
                    near, links = (decided["near"], decided["links"]) if decided else (0, 0)
                    counts.append({"lines": sum(worded), "kept": len(kept), "near": near, "links": links})
                columns = list(part.columns[: len(names)])
                columns[position] = pa.array(texts, columns[position].type)
                if figures:
                    kind = pa.struct([pa.field(k, pa.int64(), False) for k in ("lines", "kept", "near", "links")])
                    columns.append(pa.array(counts, kind))
                yield pa.RecordBatch.from_arrays(columns, names=names + ["_lines"] * figures)

    return joined.mapInArrow(run, schema)
