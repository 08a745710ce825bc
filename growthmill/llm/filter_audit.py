"""Audit of how filters interact, in any order, by a Gray-code walk over the subsets of filters.

Every document becomes a mask of the filters it fails. Spark counts documents per part and mask. For each part the walk
visits all subsets of filters so that each differs from the one before by one filter. Every mask cell keeps a counter of the active
filters it fails, and the survivors are the cells at zero: toggling a filter moves the counters of the cells that
fail it, and only a counter that leaves or reaches zero changes the running survivors. The survivors of all subsets
are stored, and each step of each order is a difference of two of them.
"""

from __future__ import annotations

import hashlib
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


FILTERS = "ABCDE"
COPY = FILTERS.index("E")
MIN_WORDS = 50
MIN_DISTINCT_PERCENT = 65
MAX_CAPITAL_PERCENT = 5
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SYMBOLS = b"#$%&*|"
# Documents, good ones and toxic ones: what is counted in every cell.
WEIGHTS = ("n", "good", "toxic")

FAILS = "doc_id long, part string, mask int, text_high long, text_low long"
AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def text_mask(text: str) -> int:
    """The filters, of those that need no other document, that a text fails; bit k is the k-th filter."""
    raw = text.encode()
    words = raw.split()
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < MIN_DISTINCT_PERCENT * len(words)) << 1
        | (100 * capitals > MAX_CAPITAL_PERCENT * len(text)) << 2
        | (len(raw.translate(None, SYMBOLS)) < len(raw)) << 3
    )


def text_fails(docs: DataFrame) -> DataFrame:
    """Per document its part (the source, null as empty), the mask of its text, and a 128-bit digest of the text."""
    part = F.coalesce(docs["source"], F.lit("")).alias("part")
    rows = docs.select(docs["doc_id"].alias("doc_id"), docs["text"].alias("text"), part)
    names = [column.split()[0] for column in FAILS.split(", ")]

    def run(batches):
        for batch in batches:
            masks, highs, lows = [], [], []
            # One text at a time is a Python object.
            for value in batch.column(1):
                text = value.as_py() or ""
                digest = hashlib.blake2b(text.encode(), digest_size=16).digest()
                masks.append(text_mask(text))
                highs.append(int.from_bytes(digest[:8], "little", signed=True))
                lows.append(int.from_bytes(digest[8:], "little", signed=True))
            columns = [batch.column(0), batch.column(2), pa.array(masks, pa.int32()), pa.array(highs, pa.int64()), pa.array(lows, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, FAILS)


def mask_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents, good and toxic ones, per part and mask: ``part``, ``mask``, ``n``, ``good``, ``toxic``.

    Equal texts are counted per digest, part and label before any join, so a group of copies of any size is a few rows
    per task; the copies among them are all but the rows of the group's smallest id.
    """
    text = ["text_high", "text_low"]
    rows = text_fails(docs).groupBy("doc_id", "part", "mask", *text).agg(F.count(F.lit(1)).alias("n"))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    marked = rows.join(marks, "doc_id", "left").fillna(0, ["good", "toxic"])
    groups = marked.groupBy("part", "mask", *text, "good", "toxic").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("without_id"),
        F.min("doc_id").alias("lowest"),
        F.min_by("n", "doc_id").alias("at_lowest"),
    )
    first = groups.groupBy(*text).agg(F.min("lowest").alias("first_id"))
    originals = F.col("without_id") + F.when(F.col("lowest") == F.col("first_id"), F.col("at_lowest")).otherwise(0)
    both = F.array(
        F.struct(F.col("mask").alias("mask"), originals.alias("n")),
        F.struct(F.col("mask").bitwiseOR(1 << COPY).alias("mask"), (F.col("n") - originals).alias("n")),
    )
    split = groups.join(first, text).select("part", "good", "toxic", F.inline(both))
    return split.where("n > 0").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


def walk_subsets(cells: np.ndarray, filters: int) -> np.ndarray:
    """Survivors of every subset of filters; ``cells`` is (parts, masks, weights), the result (parts, subsets, weights)."""
    masks = np.arange(1 << filters)
    counters = np.zeros(1 << filters, np.int64)
    running = cells.sum(axis=1)
    states = np.empty_like(cells)
    subset = 0
    states[:, subset] = running
    for turn in range(1, 1 << filters):
        toggled = (turn & -turn).bit_length() - 1
        subset ^= 1 << toggled
        fails = masks[(masks >> toggled & 1).astype(bool)]
        if subset >> toggled & 1:
            gone = fails[counters[fails] == 0]
            counters[fails] += 1
            running = running - cells[:, gone].sum(axis=1)
        else:
            counters[fails] -= 1
            back = fails[counters[fails] == 0]
            running = running + cells[:, back].sum(axis=1)
        states[:, subset] = running
    return states


def audit_steps(states: np.ndarray, filters: str = FILTERS) -> dict[str, list]:
    """Every step of every order, per part, as differences of the stored survivors; columns without the part."""
    k, full = len(filters), (1 << len(filters)) - 1
    documents, good, toxic = states[:, :, 0], states[:, :, 1], states[:, :, 2]
    fails = [documents[:, 0] - documents[:, 1 << f] for f in range(k)]
    unique = [documents[:, full ^ 1 << f] - documents[:, full] for f in range(k)]
    shapley = []
    for f in range(k):
        total = np.zeros(len(states), np.int64)
        for s in range(full + 1):
            if not s >> f & 1:
                before = s.bit_count()
                total += factorial(before) * factorial(k - 1 - before) * (documents[:, s] - documents[:, s | 1 << f])
        shapley.append(total)
    out: dict[str, list] = {name.split()[0]: [] for name in AUDIT.split(", ")[1:]}
    for order in permutations(range(k)):
        s = 0
        for step, f in enumerate(order, 1):
            after = s | 1 << f
            removed = documents[:, s] - documents[:, after]
            values = (
                "".join(filters[i] for i in order), step, documents[:, after], removed, fails[f] - removed, unique[f],
                good[:, s] - good[:, after], toxic[:, s] - toxic[:, after], shapley[f],
            )
            for column, value in zip(out.values(), values):
                column.append(value)
            s = after
    return out


def audit_cells(cells: DataFrame) -> DataFrame:
    """All orders and steps of every part, from its mask cells; a part is one row of at most 32 cells on the way."""
    parts = cells.groupBy("part").agg(F.collect_list(F.struct("mask", *WEIGHTS)).alias("cells"))
    names = [name.split()[0] for name in AUDIT.split(", ")]

    def run(batches):
        for batch in batches:
            # Few parts at a time: each gives 600 rows.
            for start in range(0, batch.num_rows, 256):
                some = batch.slice(start, 256)
                table = np.zeros((some.num_rows, 1 << len(FILTERS), len(WEIGHTS)), np.int64)
                for i, row in enumerate(some.column(1).to_pylist()):
                    for cell in row:
                        table[i, cell["mask"]] = [cell[w] for w in WEIGHTS]
                steps = audit_steps(walk_subsets(table, len(FILTERS)))
                orders, times, n = len(steps["step"]), some.num_rows, [steps[name] for name in names[3:]]
                part = pa.array(np.repeat(some.column(0).to_pylist(), orders).tolist(), pa.string())
                columns = [
                    part, pa.array(steps["filter_order"] * times, pa.string()), pa.array(steps["step"] * times, pa.int32()),
                    *(pa.array(np.stack(c, axis=1).ravel(), pa.int64()) for c in n),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return parts.mapInArrow(run, AUDIT)


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each of five filters removes at each step of all 120 orders, per source.

    A null text counts as empty, a null source as the empty one. A row without an id is never a copy, nor does it make others
    copies; rows that repeat the smallest id of their text are all originals. A document with several labels is good
    or toxic if any of them says so; labels without an id are left out. Other columns are ignored. An empty
    table gives no rows. Texts are told apart by a 128-bit digest.
    """
    return audit_cells(mask_cells(docs, labels))


AUDIT_SQL = r"""
WITH t AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), l AS (
    SELECT doc_id, coalesce(max(CASE WHEN quality = 1 THEN 1 ELSE 0 END), 0) AS good,
           coalesce(max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END), 0) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), f AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
           (CASE WHEN len(words) < 50 THEN 1 ELSE 0 END)
         + (CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END)
         + (CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body) THEN 4 ELSE 0 END)
         + (CASE WHEN regexp_matches(body, '[#$%&*|]') THEN 8 ELSE 0 END)
         + (CASE WHEN t.doc_id > min(t.doc_id) OVER (PARTITION BY body) THEN 16 ELSE 0 END) AS mask
    FROM t LEFT JOIN l ON t.doc_id = l.doc_id
), cells AS (
    SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, mask
), letters AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)),
orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
           [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
    SELECT filter_order, step, bits[step] AS bit, list_sum(bits[1:step]) AS done
    FROM orders, (SELECT unnest(range(1, 6)) AS step)
), counted AS (
    SELECT part, filter_order, step, bit,
           sum(CASE WHEN mask & done::INT = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN mask & (done - bit)::INT = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN mask & (done - bit)::INT <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN mask & (done - bit)::INT = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN mask & (done - bit)::INT = 0 AND mask & bit <> 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM cells, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM counted
"""
