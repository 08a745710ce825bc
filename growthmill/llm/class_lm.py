"""Class-based bigram language model with exchange clustering.

Words and their bigrams are counted over the whole corpus. The exchange algorithm first moves units, the most frequent
words and the endings of the others, one at a time to the class in which the class bigrams become likeliest. Then every
word seen ``MIN_COUNT`` times or more is clustered for itself: in alternating sweeps over one half of these words and the
other, tasks gather the classes to the left and right of each word and assign it to the class of largest gain against the
class bigrams of the sweep. Rare words, and words never seen, keep the class of their ending. A text has
the probability of its class transitions times that of its words within their classes. Clustered words have their counts at
hand; the others find theirs by a join. Clustered words are told apart by a hash of 64 bits. Texts are split into words twice, to
count them and to write each text as the numbers of its words, from which bigrams are counted and texts are scored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthmill.llm.common import join_by_share, map_texts, slices, staged
from growthmill.llm.sharding import size_class

# Bounds of what the driver holds: words among which it chooses the units, of at most so many bytes;
# words that are units; units of endings; classes.
DICTIONARY = 100_000
DICTIONARY_BYTES = 64
WORD_UNITS = 512
ENDINGS = 255
CLASSES = 64

ADDED = 0.1
TRANSITION_PRIOR = 20.0
SWEEPS = 8
# Words seen so often are clustered, at most so many (about 14 bytes each); each round sweeps both halves of them.
MIN_COUNT = 5
CLUSTERED = 1 << 24
ROUNDS = 2
# One in so many of the moves of a sweep is made.
PARTS = (1, 2, 4, 8, 16)
# Bigrams a task holds before it hands them on, bigrams of a row, and words whose gains are worked out at once.
HELD_PAIRS = 4_000_000
ROW_PAIRS = 1_000_000
WORDS_AT_ONCE = 32
# Clustered words a task of a sweep moves; it depends on the words alone, so a corpus gives the same classes on any cluster.
TASK_WORDS = 8192
SEED = 42
# Words a task counts before it hands them on, and their bytes.
COUNTED_WORDS = 400_000
COUNTED_BYTES = 32_000_000

END = WORD_UNITS + ENDINGS
UNITS = END + 1
WORDS = re.compile(b"[^\x20\x09-\x0d]+")
PUNCTUATION = b".,;:!?\"')]}"


def words_of(text: str) -> list[bytes]:
    """Words of a text in UTF-8, A-Z lower-cased."""
    return WORDS.findall(text.encode("utf-8", "replace").lower())


def ending(word: bytes) -> int:
    """The unit of a word that is not a unit of its own: its last bytes, without punctuation."""
    return crc32((word.rstrip(PUNCTUATION) or word)[-3:]) % ENDINGS


class CountWords:
    """Counts the words of a task."""

    def __init__(self):
        self.counts: Counter = Counter()
        self.bytes = 0

    def __call__(self, ids, texts):
        for text in texts:
            self.counts.update(words_of(text))
            # Nearly all of a text that is long for its words may be held now.
            self.bytes += len(text) if len(text) > COUNTED_BYTES // 64 else 0
        return self.finish() if len(self.counts) > COUNTED_WORDS or self.bytes > COUNTED_BYTES else None

    def finish(self):
        out = {"word": list(self.counts), "n": list(self.counts.values())}
        self.counts.clear()
        self.bytes = 0
        return out


class Clusters:
    """The clustered words, by their hashes in order, with their counts and the class of each and of every ending.

    The number of a clustered word is its place; the endings and the end follow.
    """

    def __init__(self, hashes: np.ndarray, endings: np.ndarray, counts: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.endings = hashes[order], endings[order].astype(np.uint8)
        self.counts = counts[order].astype(np.min_scalar_type(counts.max(initial=0)))
        self.classes = np.zeros(self.end + 1, np.uint8)

    @property
    def end(self) -> int:
        return len(self.hashes) + ENDINGS

    def ids(self, words: list[bytes]) -> np.ndarray:
        from xxhash import xxh64_intdigest

        hashes = np.fromiter((xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words)).view(np.int64)
        at = np.searchsorted(self.hashes, hashes)
        missed = np.ones(len(words), bool)
        inside = at < len(self.hashes)
        missed[inside] = self.hashes[at[inside]] != hashes[inside]
        for i in np.flatnonzero(missed):
            at[i] = len(self.hashes) + ending(words[i])
        return at

    def units(self, top: np.ndarray) -> np.ndarray:
        """The unit each number starts from; ``top`` are the numbers of the words that are units."""
        units = WORD_UNITS + np.r_[self.endings.astype(np.int64), np.arange(ENDINGS), ENDINGS]
        units[top] = np.arange(len(top))
        return units


class CodeTexts:
    """Writes texts as the numbers of their words; words that are not clustered are listed with how often they occur."""

    def __init__(self, clusters: Clusters):
        self.clusters, self.known, self.bytes = clusters, {}, 0

    def __call__(self, ids, texts):
        split = [words_of(t) for t in texts]
        words = list(chain.from_iterable(split))
        new = set(words).difference(self.known)
        size = sum(map(len, new))
        if len(self.known) + len(new) > COUNTED_WORDS or self.bytes + size > COUNTED_BYTES:
            self.known, self.bytes = {}, 0
            new = set(words)
            size = sum(map(len, new))
        new = list(new)
        self.known.update(zip(new, self.clusters.ids(new).tolist()))
        self.bytes += size
        numbers = np.fromiter(map(self.known.__getitem__, words), np.int32, len(words))
        ends = np.cumsum([0, *map(len, split)])
        rare = np.flatnonzero(numbers >= len(self.clusters.hashes))
        cuts = np.searchsorted(rare, ends)
        others = [Counter(words[i] for i in rare[a:b].tolist()) for a, b in zip(cuts, cuts[1:])]
        return {
            "doc_id": ids, "codes": [numbers[a:b].tobytes() for a, b in zip(ends, ends[1:])],
            "words": [list(o) for o in others], "counts": [list(o.values()) for o in others],
        }


CODED = "doc_id long, codes binary, words array<binary>, counts array<long>"


def coded_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of the batches with the numbers of their words one after the other, and the words of each text."""
    for batch in batches:
        codes = batch.column("codes")
        for start, stop in slices(codes):
            raw = codes.slice(start, stop - start).to_pylist()
            sizes = np.array([len(x) // 4 for x in raw], np.int64)
            yield batch.slice(start, stop - start), np.frombuffer(b"".join(raw), np.int32).astype(np.int64), sizes


def between_ends(numbers: np.ndarray, sizes: np.ndarray, end: int) -> np.ndarray:
    """The numbers with an end before the first text and after each one: texts that follow each other share one."""
    return np.r_[end, np.insert(numbers, np.cumsum(sizes), end)]


def count_pairs(coded: DataFrame, end: int) -> DataFrame:
    """The bigrams of all texts, each between two ends, as packed rows."""

    def run(batches):
        held, size = [], 0
        for _, numbers, sizes in coded_slices(batches):
            numbers = between_ends(numbers, sizes, end)
            held.append(numbers[:-1] * (end + 1) + numbers[1:])
            size += len(numbers) - 1
            if size >= HELD_PAIRS:
                yield out(held)
                held, size = [], 0
        if held:
            yield out(held)

    def out(held):
        codes, counts = np.unique(np.concatenate(held), return_counts=True)
        cuts = range(0, len(codes), ROW_PAIRS)
        parts = [(codes[i : i + ROW_PAIRS], counts[i : i + ROW_PAIRS]) for i in cuts]
        rows = [pa.array([len(c) for c, _ in parts], pa.int64()), pa.array([pack(c, n) for c, n in parts], pa.binary())]
        return pa.RecordBatch.from_arrays(rows, names=["n", "packed"])

    return coded.select("codes").mapInArrow(run, "n long, packed binary")


def pack(codes: np.ndarray, counts: np.ndarray) -> bytes:
    """Codes in order with their counts: steps and counts by byte position, compressed."""
    steps = np.diff(codes, prepend=0)
    planes = np.stack([steps, counts.astype(np.int64)]).view(np.uint8).reshape(2, len(codes), 8).transpose(0, 2, 1)
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(size: int, packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(pa.decompress(packed, size * 16, codec="zstd"), np.uint8).reshape(2, 8, size)
    steps, counts = np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.int64).reshape(2, size)
    return np.cumsum(steps), counts


def add_up(codes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct codes in order and the sums of their counts."""
    if not len(codes):
        return codes, counts
    order = np.argsort(codes)
    codes = codes[order]
    first = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
    return codes[first], np.add.reduceat(counts[order], first)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for size, packed in zip(batch.column("n").to_pylist(), batch.column("packed")):
            yield unpack(size, packed.as_buffer())


def bigrams_of(pairs: DataFrame, of: np.ndarray, size: int) -> np.ndarray:
    """How often a number of group ``i`` comes before one of group ``j``; ``of`` has the group of each number."""
    sent = pairs.sparkSession.sparkContext.broadcast(of)

    def run(batches):
        of, table = sent.value, np.zeros(size * size, np.int64)
        for codes, counts in _unpacked(batches):
            left, right = np.divmod(codes, len(of))
            cell = of[left].astype(np.int64) * size + of[right]
            table += np.bincount(cell, counts, size * size).astype(np.int64)
        cells = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(table[cells])], names=["cell", "n"])

    # At most one row per pair of groups.
    found = pairs.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros(size * size)
    table[found["cell"].to_numpy()] = found["n"].to_numpy()
    return table.reshape(size, size)


# Of each word: its right neighbours by class, its left ones, and how often it follows itself.
SLOTS = 2 * CLASSES + 1


def neighbours(codes, counts, classes: np.ndarray, movable: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts by movable word and slot of the bigrams ``codes``."""
    left, right = np.divmod(codes, len(classes))
    same = left == right
    a, b = movable[left] & ~same, movable[right] & ~same
    own = same & movable[left]
    slots = [left[a] * SLOTS + classes[right[a]], right[b] * SLOTS + CLASSES + classes[left[b]], left[own] * SLOTS + 2 * CLASSES]
    return add_up(np.concatenate(slots), np.concatenate([counts[a], counts[b], counts[own]]))


def weight(x):
    return x * np.log(np.maximum(x, 1e-12))


def gains(table: np.ndarray, old: np.ndarray, right: np.ndarray, left: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Gain in likelihood of each word entering each class, once it has left its ``old`` one: (words, classes).

    ``right`` and ``left`` are the counts of neighbours by class, without the ``own`` of a word beside itself.
    """
    at = np.arange(len(old))

    def side(table, right, left):
        word, c = np.nonzero(right)
        n = right[word, c]
        was, each = old[word], np.arange(len(word))
        # Row g of the table without the word: it has left row and column ``old``.
        cell = table.T[c]
        cell[each, was] -= n
        home = np.flatnonzero(c == was)
        cell[home] -= left[word[home]]
        cell[home, was[home]] -= own[word[home]]
        gain = weight(cell + n[:, None]) - weight(cell)
        # The corner counts once, below.
        gain[each, c] = 0
        out = np.zeros(right.shape)
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]]) if len(word) else word
        if len(word):
            out[word[first]] = np.add.reduceat(gain, first, axis=0)
        return out

    gain = side(table, right, left) + side(table.T, left, right)
    corner = np.tile(np.diagonal(table), (len(old), 1))
    corner[at, old] -= right[at, old] + left[at, old] + own
    gain += weight(corner + right + left + own[:, None]) - weight(corner)
    for sums, more in ((table.sum(1), right.sum(1) + own), (table.sum(0), left.sum(1) + own)):
        rest = np.tile(sums, (len(old), 1))
        rest[at, old] -= more
        gain -= weight(rest + more[:, None]) - weight(rest)
    return gain


def moves_of(codes, counts, classes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words that change, and their new classes; ties go to the lower class, words without a gain stay.

    What a few words do is seen by those after them, so that they do not all enter one class.
    """
    table = table.copy()
    word, slot = np.divmod(codes, SLOTS)
    words = np.unique(word)
    out = []
    for i in range(0, len(words), WORDS_AT_ONCE):
        some = words[i : i + WORDS_AT_ONCE]
        low, high = np.searchsorted(word, [some[0], some[-1] + 1])
        slots = np.zeros((len(some), SLOTS))
        slots[np.searchsorted(some, word[low:high]), slot[low:high]] = counts[low:high]
        old = classes[some].astype(np.int64)
        size = len(table)
        gain = gains(table, old, slots[:, :size], slots[:, CLASSES : CLASSES + size], slots[:, -1])
        new, at = gain.argmax(1), np.arange(len(some))
        better = gain[at, new] > gain[at, old] + 1e-6
        out.append((some[better], new[better]))
        right, left = slots[better, :size], slots[better, CLASSES : CLASSES + size]
        for sign, of in ((-1, old[better]), (1, new[better])):
            np.add.at(table, of, sign * right)
            np.add.at(table.T, of, sign * left)
            np.add.at(table, (of, of), sign * slots[better, -1])
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (words, words)


def sweep(pairs: DataFrame, classes: np.ndarray, movable: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Classes after every movable word has gone to the class of its largest gain against ``table``."""
    context = pairs.sparkSession.sparkContext
    # A task sees only what its own words do, so few words are not dealt out thinly.
    parts = max(1, len(classes) // TASK_WORDS)
    sent = context.broadcast((classes, movable, table))
    # Numbers are in the order of a hash, so ranges of them are even.
    bounds = np.linspace(0, len(classes), parts + 1).astype(np.int64) * SLOTS

    def deal(batches):
        classes, movable, _ = sent.value

        def out(held):
            codes, counts = add_up(*(np.concatenate(x) for x in zip(*held)))
            cuts = np.searchsorted(codes, bounds)
            some = [(p, codes[i:j], counts[i:j]) for p, (i, j) in enumerate(zip(cuts, cuts[1:])) if j > i]
            columns = [p for p, _, _ in some], [len(c) for _, c, _ in some], [pack(c, n) for _, c, n in some]
            kinds = pa.int32(), pa.int64(), pa.binary()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["part", "n", "packed"])

        held = []
        for codes, counts in _unpacked(batches):
            held.append(neighbours(codes, counts, classes, movable))
            if sum(len(c) for c, _ in held) >= HELD_PAIRS:
                yield out(held)
                held = []
        if held:
            yield out(held)

    def move(batches):
        classes, _, table = sent.value
        held = list(_unpacked(batches))
        if held:
            word, new = moves_of(*add_up(*(np.concatenate(x) for x in zip(*held))), classes, table)
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(new, pa.int64())], names=["word", "class"])

    dealt = pairs.mapInArrow(deal, "part int, n long, packed binary").repartitionById(parts, F.col("part"))
    # At most one row per clustered word.
    moved = dealt.select("n", "packed").mapInArrow(move, "word long, class long").toArrow()
    classes = classes.copy()
    classes[moved["word"].to_numpy()] = moved["class"].to_numpy()
    return classes


def likelihood(table: np.ndarray) -> float:
    """Log-likelihood of the class bigrams, but for what no class changes."""
    return float(weight(table).sum() - weight(table.sum(0)).sum() - weight(table.sum(1)).sum())


def cluster(pairs: DataFrame, clusters: Clusters, top: np.ndarray, of_unit: np.ndarray) -> np.ndarray:
    """Give every clustered word its class, from those of the units; returns the class bigrams.

    The words that are units have been exchanged one by one and stay. Many moves at once may lose likelihood though each
    one gains; of such a sweep only an even part of the moves is made, the largest of ``PARTS`` that gains.
    """
    classes = of_unit[clusters.units(top)].astype(np.uint8)
    size = int(of_unit.max()) + 1
    table = bigrams_of(pairs, classes, size)
    number = np.arange(len(classes))
    free = number < len(clusters.hashes)
    free[top] = False
    for half in [0, 1] * ROUNDS if free.any() else []:
        moved = sweep(pairs, classes, free & (number % 2 == half), table)
        for part in PARTS if (moved != classes).any() else []:
            some = np.where(number // 2 % part == 0, moved, classes)
            after = bigrams_of(pairs, some, size)
            if likelihood(after) > likelihood(table):
                classes, table = some, after
                break
    clusters.classes = classes
    return table


def exchange(bigrams: np.ndarray, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit, by moving units one at a time to the class of the largest gain in likelihood.

    Units start in the class of their rank modulo ``classes`` and are visited from frequent to rare; ties go to
    the lower class. Ends after a sweep without a move.
    """
    units = len(bigrams)
    classes = min(classes, units)
    counts = bigrams.astype(np.float64)
    visits = np.argsort(-(counts.sum(0) + counts.sum(1)), kind="stable")
    of = np.empty(units, np.int64)
    of[visits] = np.arange(units) % classes
    member = np.eye(classes)[of]
    table = member.T @ counts @ member
    right_of, left_of = counts @ member, counts.T @ member

    for _ in range(sweeps):
        moved = False
        for unit in visits:
            old = of[unit]
            own = counts[unit, unit]
            right, left = right_of[unit].copy(), left_of[unit].copy()
            if right.sum() + left.sum() == 0:
                continue
            right[old] -= own
            left[old] -= own
            table[old] -= right
            table[:, old] -= left
            table[old, old] -= own
            # Gain of entering class g: row g and column g change, the corner once.
            rows = weight(table + right) - weight(table)
            columns = weight(table + left[:, None]) - weight(table)
            corner = np.diagonal(table)
            gain = rows.sum(1) + columns.sum(0) - np.diagonal(rows) - np.diagonal(columns)
            gain += weight(corner + right + left + own) - weight(corner)
            out, into = table.sum(1), table.sum(0)
            gain -= weight(out + right.sum() + own) - weight(out) + weight(into + left.sum() + own) - weight(into)
            new = int(np.argmax(gain))
            table[new] += right
            table[:, new] += left
            table[new, new] += own
            if new != old and gain[new] > gain[old] + 1e-6:
                moved = True
                of[unit] = new
                right_of[:, old] -= counts[:, unit]
                right_of[:, new] += counts[:, unit]
                left_of[:, old] -= counts[unit]
                left_of[:, new] += counts[unit]
            elif new != old:
                table[new] -= right
                table[:, new] -= left
                table[new, new] -= own
                table[old] += right
                table[:, old] += left
                table[old, old] += own
        if not moved:
            break
    return of


class ClassModel:
    """What scoring needs; its size is bounded by the dictionary, the clustered words and the classes.

    ``bigrams`` are those of units, or with ``clusters`` those of classes; ``unit_types`` are the types of each.
    ``counts`` are those of the words among which the units were chosen.
    """

    def __init__(
        self, counts: dict[bytes, int], tokens: int, types: int, ends: int, unit_types: np.ndarray, bigrams: np.ndarray,
        clusters: Clusters | None = None,
    ):
        self.tokens, self.types, self.ends, self.clusters = tokens, types, ends, clusters
        if clusters is None:
            word_units = dict(zip(list(counts)[:WORD_UNITS], range(WORD_UNITS)))
            units = np.array([word_units.get(w, WORD_UNITS + ending(w)) for w in counts], np.int64)
            of_unit = exchange(bigrams, CLASSES)
            self.classes, self.end_class = of_unit[units], of_unit[END]
            member = np.eye(int(of_unit.max()) + 1)[of_unit]
            moves, kinds = member.T @ bigrams @ member, member.T @ unit_types
        else:
            self.classes, self.end_class = self.classes_of(list(counts)), int(clusters.classes[-1])
            moves, kinds = bigrams, unit_types
        classes = len(moves)
        entered = moves.sum(0)
        share = (entered + 1) / (entered.sum() + classes)
        smoothed = (moves + TRANSITION_PRIOR * share) / (moves.sum(1, keepdims=True) + TRANSITION_PRIOR)
        self.move = np.log10(smoothed)
        # log10 of what the counts of a class are divided by.
        self.below = np.log10(entered + ADDED * (kinds + 1))
        self.base_below = float(np.log10(tokens + ADDED * (types + 1)))
        self.log_count = np.log10(np.array(list(counts.values()), np.float64) + ADDED)
        self.end_log_count = float(np.log10(ends + ADDED))

    def classes_of(self, words: list[bytes]) -> np.ndarray:
        return self.clusters.classes[self.clusters.ids(words)].astype(np.int64)

    def for_tasks(self) -> tuple:
        """What tasks need to score numbered texts."""
        return self.clusters.counts, self.clusters.classes, self.move, self.below, self.ends, self.end_log_count, self.base_below


def score_texts(coded: DataFrame, model: ClassModel) -> DataFrame:
    """``SCORED``: texts scored but for the counts of the words that are not clustered, which are passed on."""
    sent = coded.sparkSession.sparkContext.broadcast(model.for_tasks())

    def run(batches):
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        counts, classes, move, below, ends, end_log_count, base_below = sent.value
        end = len(classes) - 1
        for part, numbers, sizes in coded_slices(batches):
            seq = between_ends(numbers, sizes, end)
            of, token = classes[seq].astype(np.int64), seq[1:]
            clustered = token < len(counts)
            logs = np.zeros(len(token))
            logs[clustered] = np.log10(counts[token[clustered]] + ADDED)
            logs[token == end] = end_log_count
            first = np.r_[0, np.cumsum(sizes + 1)[:-1]]
            counted = np.add.reduceat(logs, first)
            moved = np.add.reduceat(move[of[:-1], of[1:]] - below[of[1:]], first)
            known = np.add.reduceat(clustered.astype(np.int64), first) + (ends > 0)
            columns = {
                "uid": pa.array(np.arange(row, row + len(sizes))), "doc_id": part.column("doc_id"), "n_tokens": pa.array(sizes + 1),
                "known": pa.array(known), "base": pa.array(counted - (sizes + 1) * base_below), "score": pa.array(counted + moved),
                "words": part.column("words"), "counts": part.column("counts"),
            }
            row += len(sizes)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return coded.mapInArrow(run, SCORED)


SCORED = (
    "uid long, doc_id long, n_tokens long, known long, base double, score double, words array<binary>, counts array<long>"
)


def count_words(docs: DataFrame) -> DataFrame:
    """``word`` (UTF-8, A-Z lower-cased) and its count ``n``, over whole texts."""
    words = map_texts(docs, ["doc_id", "text"], CountWords, "word binary, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n"))


def ending_of(word: str) -> F.Column:
    """``ending`` of a column of words."""
    bare = F.rtrim(F.col(word).cast("string"), F.lit(PUNCTUATION.decode()))
    tail = F.when(bare != "", bare).otherwise(F.col(word).cast("string"))
    return (F.crc32(F.substring(tail.cast("binary"), -3, 3)) % ENDINGS).cast("short")


def _least_counts(counts: DataFrame, *limits: int) -> list[int]:
    """For each limit the count from which words number so many at most: as low as that allows.

    Counts are put into classes of 12 significant bits, so the driver sees 2048 rows per power of two at most.
    """
    sizes = counts.groupBy(size_class("n").alias("c")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least"))
    rows = sorted(sizes.collect(), key=lambda r: -r["c"])
    found = []
    for limit in limits:
        least, words = 1 << 62, 0
        for row in rows:
            words += row["words"]
            if words > limit:
                break
            least = row["least"]
        found.append(least)
    return found


def fit(training: DataFrame) -> tuple[ClassModel, DataFrame]:
    """The model of the training documents, and the counts of the words that are not clustered."""
    return fit_and_code(training, F.lit(True))[:2]


def fit_and_code(docs: DataFrame, learnt: F.Column) -> tuple[ClassModel, DataFrame, DataFrame]:
    """As ``fit`` for the documents that are ``learnt`` (a condition on ``doc_id``), and all documents in numbers (``CODED``)."""
    training = docs.where(learnt)
    counts = staged(count_words(training), "word-counts")
    ends = training.count()
    total = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("types"), F.coalesce(F.max("n"), F.lit(0)).alias("most")
    ).first()
    least, clustered = _least_counts(counts, DICTIONARY, CLUSTERED)
    # At most DICTIONARY rows.
    top = counts.where((F.col("n") >= least) & (F.octet_length("word") <= DICTIONARY_BYTES)).toArrow()
    known = dict(sorted(zip(top["word"].to_pylist(), top["n"].to_pylist()), key=lambda item: (-item[1], item[0])))
    units = list(known)[:WORD_UNITS]
    # The words that are units are clustered however rare they are. At most CLUSTERED rows.
    often = max(min([MIN_COUNT, *(known[w] for w in units[-1:])]), clustered)
    n = F.col("n").cast("int" if total["most"] < 1 << 31 else "long")
    held = counts.where(F.col("n") >= often).select(F.xxhash64("word").alias("hash"), ending_of("word").alias("ending"), n.alias("n")).toArrow()
    clusters = Clusters(held["hash"].to_numpy(), held["ending"].to_numpy(), held["n"].to_numpy())
    sent = docs.sparkSession.sparkContext.broadcast(clusters)
    coded = staged(map_texts(docs, ["doc_id", "text"], lambda: CodeTexts(sent.value), CODED), "coded-texts")
    pairs = staged(count_pairs(coded.where(learnt), clusters.end), "word-bigrams")
    top = clusters.ids(units)
    of_unit = exchange(bigrams_of(pairs, clusters.units(top), UNITS), CLASSES)
    table = cluster(pairs, clusters, top, of_unit)
    # Types of each number: one of a clustered word, the others of each ending, and the end.
    of_ending = np.zeros(ENDINGS)
    for row in counts.groupBy(ending_of("word").alias("ending")).agg(F.count(F.lit(1)).alias("types")).collect():
        of_ending[row["ending"]] = row["types"]
    of_ending -= np.bincount(clusters.endings, minlength=ENDINGS)
    kinds = np.bincount(clusters.classes, np.r_[np.ones(len(clusters.hashes)), of_ending, ends > 0], len(table))
    types = total["types"] + (ends > 0)
    model = ClassModel(known, total["n"] + ends, types, ends, kinds, table, clusters)
    return model, counts.where(F.col("n") < often), coded


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 10 == 0, F.lit(False))


def score_documents(docs: DataFrame) -> DataFrame:
    """Learn from the documents that are not held out and score all of them.

    Returns ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` and ``perplexity`` of the class
    model. A null or empty text is its end alone. A null doc_id is never held out. Repeated rows count and score
    each; an empty table gives no rows, and with nothing to learn from all words are unknown. Other
    columns are ignored.
    """
    model, outside, coded = fit_and_code(docs, ~held_out())
    scored = score_texts(coded, model)
    # A blank is in no word, so the first row of a text finds no count; the number keeps such rows apart.
    first = F.concat(F.lit(" "), F.col("uid").cast("string")).cast("binary")
    words = F.arrays_zip(F.concat(F.array(first), "words").alias("word"), F.concat(F.array(F.lit(0).cast("long")), "counts").alias("n"))
    rows = scored.select("uid", F.struct("doc_id", "n_tokens", "known", "base", "score").alias("sums"), F.posexplode(words).alias("at", "of"))
    rows = rows.select("uid", "of.word", "of.n", F.when(F.col("at") == 0, F.col("sums")).alias("sums"))
    counted = join_by_share(rows, outside.withColumnRenamed("n", "c"), ["word"], "c", ["uid"], "left")
    of_word = F.col("n") * F.log10(F.coalesce("c", F.lit(0)) + ADDED)
    sums = counted.groupBy("uid").agg(
        F.max("sums").alias("s"),
        F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("found"),
        F.sum(of_word).alias("logs"),
    )
    score = F.col("s.score") + F.col("logs")
    return sums.select(
        "s.doc_id", held_out("s.doc_id").alias("held_out"), "s.n_tokens", (F.col("s.known") + F.col("found")).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("s.base") + F.col("logs")).alias("base_score"),
        score.alias("score"), F.pow(F.lit(10.0), -score / F.col("s.n_tokens")).alias("perplexity"),
    )
