"""Periodic runs of words, found online by a sparse diagonal dynamic programme.

A run of period q is a stretch in which every word equals the word q places before it. The programme walks the
words of a text once and keeps, for each active lag q, how many words in a row have equalled the word q
before (the diagonal). A word's earlier occurrences make its lags active; a lag whose diagonal breaks emits its run at
that word if it was long enough, and is forgotten.

Only diagonals that can become runs are entered. A run of length ``max(6, 4q)`` needs a diagonal of
``max(6, 4q) - q`` words. Let the stride of q be the greatest power of two up to half of that: such a diagonal holds a word
whose number is a multiple of the stride with a stride of equal words before it. So word i looks up only its earlier
occurrences at lags whose stride divides i, and a lag becomes active if the words before agree so far. Lags that are a multiple
of an active lag and stay inside its stretch end with it and are never the smallest period. A text of n
words makes about 2/3 n log(n) look-ups even if all its words are equal, and few lags are active at a time.
"""

from __future__ import annotations

import hashlib
import re
import zlib

from pyspark.sql import DataFrame

from growthmill.llm.common import WORD, map_texts

MIN_LENGTH = 6
MIN_PERIODS = 4

RUNS = "doc_id long, start long, length long, period long"
COLLAPSED = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
    "collapsed_sha256 string, n_words long, n_kept long"
)


class RunFinder:
    """Runs of at least ``min_length`` words and ``min_periods`` periods."""

    def __init__(self, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS):
        if min_periods < 3 or min_length < 3:
            raise ValueError("a run holds three words and three periods at least")
        self.min_length = min_length
        self.min_periods = min_periods
        self.reach: list[int] = []

    def needed(self, lag: int) -> int:
        """Words of a diagonal that make a run of period ``lag``."""
        return max(self.min_length, self.min_periods * lag) - lag

    def farthest(self, level: int) -> int:
        """The greatest lag whose stride divides 2 ** level: half its diagonal is under 2 ** (level + 1) words."""
        while len(self.reach) <= level:
            lag = self.reach[-1] if self.reach else 0
            most = 4 << len(self.reach)
            while self.needed(lag + 1) < most:
                lag += 1
            self.reach.append(lag)
        return self.reach[level]

    def stride(self, lag: int) -> int:
        return 1 << ((self.needed(lag) // 2).bit_length() - 1)

    def runs(self, words: list) -> list[tuple[int, int, int]]:
        """All runs as ``(start, length, period)``, in the order of their last words and then of their periods."""
        found: list[tuple[int, int, int]] = []
        # Lag: number of the first word of its diagonal.
        active: dict[int, int] = {}
        newest: dict = {}
        before: list[int] = []
        # The greatest power of two below which no lag can start.
        shallow = 1
        while not self.farthest(shallow.bit_length() - 1):
            shallow *= 2
        n = len(words)
        for i, word in enumerate(words):
            if active:
                broken = [q for q in active if words[i - q] != word]
                if broken:
                    self._emit(broken, active, i, found)
            at = newest.get(word, -1)
            before.append(at)
            newest[word] = i
            if at < 0 or i % shallow:
                continue
            level = (i & -i).bit_length() - 1
            nearest = i - self.farthest(level)
            while at >= nearest and at >= 0:
                lag = i - at
                if lag not in active and not self._inside(lag, i, active):
                    first = self._first(words, i, lag)
                    if i - first >= self.stride(lag):
                        active[lag] = first
                at = before[at]
        self._emit(list(active), active, n, found)
        return found

    @staticmethod
    def _first(words: list, i: int, lag: int) -> int:
        """The first word of the diagonal of ``lag`` that holds word i; slices of growing length are compared."""
        size = 4
        while i - lag >= size and words[i - size : i] == words[i - size - lag : i - lag]:
            i -= size
            size *= 2
        while i > lag and words[i - 1] == words[i - 1 - lag]:
            i -= 1
        return i

    @staticmethod
    def _inside(lag: int, i: int, active: dict[int, int]) -> bool:
        """Whether ``lag`` is a multiple of an active lag and word i - lag is in the stretch of that."""
        return any(lag % q == 0 and i - lag >= first - q for q, first in active.items())

    def _emit(self, broken: list[int], active: dict[int, int], end: int, found: list) -> None:
        """Forget the lags whose diagonal ended before word ``end``; long ones with a smallest period are runs."""
        here: list[tuple[int, int]] = []
        for q in sorted(broken):
            first = active.pop(q)
            if end - first >= self.needed(q):
                start = first - q
                if not any(q % p == 0 and other <= start for other, p in here):
                    here.append((start, q))
                    found.append((start, end - start, q))


def kept_words(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    # Stretches to drop, joined where they overlap.
    drops = sorted((start + period, start + length) for start, length, period in runs)
    out, upto = [], 0
    for low, high in drops:
        if low > upto:
            out += words[upto:low]
        upto = max(upto, high)
    return out + words[upto:]


def planted_repeats(doc_id: int | None, words: list[str]) -> list[str]:
    """The words, in one of ten documents with a repeated stretch that ``crc32`` of the decimal id places.

    A document without an id, or without words, is as it is.
    """
    n = len(words)
    if doc_id is None or not n:
        return words
    of_id = zlib.crc32(str(doc_id).encode())
    if of_id % 10:
        return words
    g = of_id // 10
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    times = -(-(n - start) // period)
    return words[:start] + (words[start : start + period] * times)[: n - start]


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS) -> DataFrame:
    """One row per periodic run of every document: ``doc_id``, ``start``, ``length``, ``period``, words numbered from 0.

    Null and empty texts have no runs; rows that repeat give their runs each; ids may be null. No shuffle.
    """

    def make():
        finder = RunFinder(min_length, min_periods)

        def apply(ids, texts):
            out = {"doc_id": [], "start": [], "length": [], "period": []}
            for doc_id, text in zip(ids, texts):
                for run in sorted(finder.runs(WORD.findall(text)), key=lambda r: (r[0], r[2])):
                    for name, value in zip(out, (doc_id, *run)):
                        out[name].append(value)
            return out

        return apply

    return map_texts(docs, ["doc_id", "text"], make, RUNS)


def collapse_runs(docs: DataFrame) -> DataFrame:
    """All rows and columns, with every run in ``text`` cut to its first period.

    A run's dropped words go with the blanks before them; all other blanks stay. Null texts stay null.
    """
    position = docs.columns.index("text")
    spans = re.compile(r"[\x20\x09-\x0d]*[^\x20\x09-\x0d]+")

    def run(batches):
        import pyarrow as pa

        finder = RunFinder()
        for batch in batches:
            texts = []
            for text in batch.column(position):
                text = text.as_py()
                found = finder.runs(WORD.findall(text)) if text else []
                if found:
                    pieces = spans.findall(text)
                    tail = text[sum(map(len, pieces)) :]
                    text = "".join(kept_words(pieces, found)) + tail
                texts.append(text)
            columns = list(batch.columns)
            columns[position] = pa.array(texts, batch.schema.field(position).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def run_report(docs: DataFrame, rewrite=None) -> DataFrame:
    """One row per document: its number of runs, its longest run, and digests of all runs and of the words that stay.

    The longest run is that of most words; of those the one with the smallest start, then period; without a run its
    columns are null. Null and empty texts have no words. ``rewrite(doc_id, words)`` may change the words first. Repeated
    rows are reported each, ids may be null, other columns are ignored, an empty table gives no rows. No shuffle:
    a document is read and reported in one task, and its memory follows the words of one text.
    """

    def make():
        finder = RunFinder()

        def report(doc_id, text):
            words = WORD.findall(text)
            if rewrite:
                words = rewrite(doc_id, words)
            runs = sorted(finder.runs(words), key=lambda r: (r[0], r[2]))
            kept = kept_words(words, runs)
            best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
            listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
            return (
                doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(listed.encode()).hexdigest(),
                hashlib.sha256(" ".join(kept).encode()).hexdigest(), len(words), len(kept),
            )

        def apply(ids, texts):
            names = [column.split()[0] for column in COLLAPSED.split(", ")]
            return dict(zip(names, zip(*map(report, ids, texts))))

        return apply

    return map_texts(docs, ["doc_id", "text"], make, COLLAPSED)
