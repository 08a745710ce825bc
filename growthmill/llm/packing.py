"""Packing token sequences by minimum bin slack.

Every document is tokenized and cut into pieces of at most one window. Full pieces are windows of
their own. The rest is packed from the counts of piece lengths alone: a window starts with the longest length left, a
bitset of reachable sums says how close the other lengths can come to its capacity, and the choice is
traced back through the stored bitsets. The choice is repeated as often as the counts allow, so
the number of different windows is bounded by the capacity, not by the corpus: each choice uses up
a length to below its own multiplicity, which gives at most about capacity * ln(capacity) choices.
Pieces then find their window by their rank within their length.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from growthmill.llm.common import WORD, lower_ascii, map_texts, staged, with_rank

CAPACITY = 4096
END_ID = 2
# Words a task remembers; beyond it the newest half, which is the rarer one, is forgotten.
MEMORY_WORDS = 600_000
# Longer words are not remembered, so that a corpus of unbroken strings cannot fill a task.
REMEMBERED_CHARS = 64
CLOSING = ".,;:!?&%$#*)"

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class WordTokenizer(dict):
    """Little-endian 32-bit ids per blank-separated word, worked out when a word is first met.

    The vocabulary drops blanks and case and ends a run of letters or digits at punctuation, so a word is the ids
    of its lower-case stem and those of its closing punctuation. A stem of small Latin letters is passed to the
    library's merges as it is; anything else goes through the library's whole chain.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer, pre_tokenizers

        super().__init__()
        self.library = Tokenizer.from_file(tokenizer_file)
        self.merges = self.library.model
        # The printable character that stands for each byte.
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.byte_chars = {b: byte_level.pre_tokenize_str(chr(b))[0][0] for b in range(128)}
        for code in range(128, 0x250):
            for b, c in zip(chr(code).encode(), byte_level.pre_tokenize_str(chr(code))[0][0]):
                self.byte_chars[b] = c

    def __missing__(self, word: str) -> bytes:
        ids = self._ids(word)
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= MEMORY_WORDS:
                for old in list(islice(reversed(self), len(self) // 2)):
                    del self[old]
            self[word] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        if "<|" in word:
            # May hold a special token, which is matched as it is written.
            return self._by_library(word)
        low = lower_ascii(word)
        stem = low.rstrip(CLOSING)
        # The library lower-cases all letters; some then end in a mark, which it keeps with the punctuation.
        last = stem[-1:].lower()[-1:]
        if len(stem) < len(low) and (last.isalpha() or last.isdecimal()):
            return self[stem] + self[low[len(stem) :]]
        if low != word:
            return self[low]
        if word.isalpha() and word.islower() and max(word) < "\u0250":
            mapped = word.encode().decode("latin-1").translate(self.byte_chars)
            return array("I", [t.id for t in self.merges.tokenize(mapped)]).tobytes()
        return self._by_library(word)

    def _by_library(self, word: str) -> bytes:
        return array("I", self.library.encode(word, add_special_tokens=False).ids).tobytes()

    def ids(self, words: list[str]) -> bytes:
        return b"".join(map(self.__getitem__, words))


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(tokenizer_file: str) -> WordTokenizer:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    if tokenizer_file not in _TOKENIZERS:
        _TOKENIZERS[tokenizer_file] = WordTokenizer(tokenizer_file)
    return _TOKENIZERS[tokenizer_file]


def cut_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Tokenize whole texts, end each with ``end_id`` and cut it into pieces of at most ``capacity`` ids."""
    end = np.array([end_id], "<u4").tobytes()

    def make():
        words_of = WORD.findall
        coder = tokenizer(tokenizer_file)

        def apply(doc_ids, texts):
            out = {"doc_id": [], "start": [], "length": [], "ids_crc32": [], "doc_tokens": []}
            for doc_id, text in zip(doc_ids, texts):
                ids = coder.ids(words_of(text)) + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    out["doc_id"].append(doc_id)
                    out["start"].append(start)
                    out["length"].append(len(piece) // 4)
                    out["ids_crc32"].append(zlib.crc32(piece))
                    out["doc_tokens"].append(total)
            return out

        return apply

    return map_texts(docs, ["doc_id", "text"], make, PIECES)


def closest_fill(counts: dict[int, int], capacity: int) -> Counter:
    """The multiset of lengths whose sum comes closest to ``capacity`` without passing it.

    It holds the longest length at least once. ``reach[k]`` is the bitset of sums that the first k
    steps reach; a step offers one length a power-of-two number of times, as its count allows.
    """
    longest = max(counts)
    room = capacity - longest
    chosen = Counter({longest: 1})
    mask = (1 << (room + 1)) - 1
    reach, steps = [1], []
    for length in sorted((n for n in counts if n <= room), reverse=True):
        left = min(counts[length] - (length == longest), room // length)
        times = 1
        while left > 0 and not reach[-1] >> room & 1:
            take = min(times, left)
            reach.append((reach[-1] | reach[-1] << (length * take)) & mask)
            steps.append((length, take))
            left -= take
            times *= 2
    rest = reach[-1].bit_length() - 1
    for k in range(len(steps), 0, -1):
        length, take = steps[k - 1]
        if not reach[k - 1] >> rest & 1:
            chosen[length] += take
            rest -= length * take
    return chosen


def plan_windows(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, Counter]]:
    """Windows for all pieces: (how often, lengths in it), from the counts of the lengths."""
    left = {n: c for n, c in counts.items() if c}
    windows = []
    while left:
        chosen = closest_fill(left, capacity)
        times = min(left[n] // used for n, used in chosen.items())
        windows.append((times, chosen))
        for n, used in chosen.items():
            left[n] -= times * used
            if not left[n]:
                del left[n]
    return windows


def runs_by_length(windows: list[tuple[int, Counter]]) -> dict[int, np.ndarray]:
    """For each length: rows of (first rank, first window, pieces per window, offset of the first piece)."""
    runs: dict[int, list] = {}
    used_up: Counter = Counter()
    window = 0
    for times, chosen in windows:
        offset = 0
        for length in sorted(chosen, reverse=True):
            runs.setdefault(length, []).append((used_up[length], window, chosen[length], offset))
            used_up[length] += times * chosen[length]
            offset += length * chosen[length]
        window += times
    return {n: np.array(r, dtype=np.int64) for n, r in runs.items()}


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` ids.

    Returns one row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.
    A null or empty text is the end id alone; repeated rows are packed each; equal lengths go
    by ``doc_id`` and ``start``; an empty table gives no rows; other columns are ignored.
    """
    pieces = staged(cut_documents(docs, tokenizer_file, capacity, end_id), "pieces")
    # At most one row per possible length.
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = docs.sparkSession.sparkContext.broadcast(runs_by_length(plan_windows(counts, capacity)))
    ranked = with_rank(pieces, "length", ["doc_id", "start", "ids_crc32", "doc_tokens"])
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def place(batches):
        for batch in batches:
            lengths = batch.column(2).to_numpy()
            ranks = batch.column(5).to_numpy()
            sequence, offset = np.empty(len(ranks), np.int64), np.empty(len(ranks), np.int64)
            for length in np.unique(lengths):
                at = np.flatnonzero(lengths == length)
                of = runs.value[int(length)]
                run = of[np.searchsorted(of[:, 0], ranks[at], side="right") - 1]
                window, inside = np.divmod(ranks[at] - run[:, 0], run[:, 2])
                sequence[at] = run[:, 1] + window
                offset[at] = run[:, 3] + inside * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"]
            )

    return ranked.select(*columns, F.col("rank").cast("long")).mapInArrow(place, PACKED)
