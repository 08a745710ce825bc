"""Quality rules with a linear-chain conditional random field over lines.

Every line with a word is an element of a document's sequence, marked content or boilerplate. Its features
describe length, punctuation, case, symbols and repetition. The field is trained on the lines of a bounded sample of
labelled documents: lines of low-quality documents and lines that repeat an earlier line of their document are
boilerplate, the others content. Viterbi decoding marks the lines of every document, and the
share of words in content lines decides, after plain base rules, whether the document is kept.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthmill.llm.common import WORD, keep_rows, labelled_sample, map_texts, table

# Bounds of the training sample: labelled documents of each class, and lines of each document.
TRAINING_DOCUMENTS = 1500
TRAINING_LINES = 64

MIN_WORDS = 50
MAX_REPEATED_SHARE = 0.5
MIN_CONTENT_SHARE = 0.5
SYMBOLS = "#*$%&|<>"

FEATURES = 16
LETTERS = re.compile(r"[^\W\d_]")
CAPITALS = re.compile(r"[A-ZÀ-ÖØ-Þ]")
DIGITS = re.compile(r"[0-9]")

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, content_share double"
)


def line_features(line: str, words: list[str], repeats: bool, first: bool) -> list[float]:
    """What the field sees of one line; every value is between 0 and 1."""
    size, count = len(line), len(words)
    letters = max(1, len(LETTERS.findall(line)))
    symbols = sum(line.count(c) for c in SYMBOLS)
    distinct = len(set(words))
    last = line.rstrip()[-1:]
    return [
        1.0,
        count <= 3,
        count <= 8,
        count >= 20,
        last in ".?",
        last == "!",
        symbols > 0,
        min(1.0, 4 * symbols / size),
        len(CAPITALS.findall(line)) / letters,
        min(1.0, 4 * line.count("!") / count),
        min(1.0, 4 * len(DIGITS.findall(line)) / size),
        "http" in line or "@" in line or "www." in line,
        repeats,
        1 - distinct / count,
        letters / size,
        first,
    ]


def repeated_words(words: list[str]) -> int:
    """Words that stand in a three-word window found twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    # Two steps, so that no code exceeds the square of the number of words.
    pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
    _, which, times = np.unique(pairs[:-1] * len(numbers) + ids[2:], return_inverse=True, return_counts=True)
    again = times[which] > 1
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(covered.sum())


class LineField:
    """Linear-chain conditional random field with the states boilerplate (0) and content (1)."""

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.emit, self.move = emit, move

    def viterbi(self, features: np.ndarray) -> np.ndarray:
        """The likeliest states of one sequence."""
        scores = features @ self.emit
        n = len(scores)
        best, back = scores[0], np.zeros((n, 2), np.int8)
        for t in range(1, n):
            paths = best[:, None] + self.move
            back[t] = paths.argmax(0)
            best = paths.max(0) + scores[t]
        states = np.empty(n, np.int8)
        states[-1] = best.argmax()
        for t in range(n - 1, 0, -1):
            states[t - 1] = back[t, states[t]]
        return states

    @classmethod
    def train(cls, sequences: list[tuple[np.ndarray, np.ndarray]], rounds: int = 200, rate: float = 0.1, decay: float = 1e-3):
        """Maximum likelihood by full-batch Adam; sequences are (features, states)."""
        emit, move = np.zeros((FEATURES, 2)), np.zeros((2, 2))
        if not sequences:
            # Nothing to learn from: every line is content.
            emit[0, 1] = 1.0
            return cls(emit, move)
        longest = max(len(y) for _, y in sequences)
        x = np.zeros((len(sequences), longest, FEATURES))
        y = np.zeros((len(sequences), longest), int)
        for i, (features, states) in enumerate(sequences):
            x[i, : len(states)], y[i, : len(states)] = features, states
        lengths = np.array([len(s) for _, s in sequences])
        on = np.arange(longest) < lengths[:, None]
        moves_on = on[:, 1:]
        gold = np.eye(2)[y] * on[..., None]
        gold_moves = np.einsum("bti,btj->ij", gold[:, :-1] * moves_on[..., None], gold[:, 1:])
        mean = [np.zeros_like(emit), np.zeros_like(move)]
        square = [np.zeros_like(emit), np.zeros_like(move)]
        for step in range(1, rounds + 1):
            states, moves = _marginals(x @ emit, move, on)
            grads = (
                np.einsum("btf,bts->fs", x, gold - states) / len(y) - decay * emit,
                (gold_moves - moves) / len(y) - decay * move,
            )
            for value, grad, m, s in zip((emit, move), grads, mean, square):
                m += 0.1 * (grad - m)
                s += 0.01 * (grad * grad - s)
                value += rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-8)
        return cls(emit, move)


def _marginals(scores: np.ndarray, move: np.ndarray, on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State marginals per line and expected moves, by the forward-backward recursions in log space."""
    batch, longest, _ = scores.shape
    ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0]
    for t in range(1, longest):
        step = np.logaddexp.reduce(ahead[:, t - 1, :, None] + move, axis=1) + scores[:, t]
        ahead[:, t] = np.where(on[:, t, None], step, ahead[:, t - 1])
    for t in range(longest - 2, -1, -1):
        step = np.logaddexp.reduce(move + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
        behind[:, t] = np.where(on[:, t + 1, None], step, 0.0)
    norm = np.logaddexp.reduce(ahead[:, -1], axis=1)[:, None, None]
    states = np.exp(ahead + behind - norm) * on[..., None]
    pairs = ahead[:, :-1, :, None] + move + (scores[:, 1:] + behind[:, 1:])[:, :, None, :] - norm[..., None]
    return states, (np.exp(np.where(on[:, 1:, None, None], pairs, -np.inf))).sum((0, 1))


def split_lines(text: str) -> tuple[list[str], list[list[str]], list[bool]]:
    """Lines that hold a word, their words, and whether an earlier line is the same."""
    lines, words, repeats, seen = [], [], [], set()
    for line in text.split("\n"):
        found = WORD.findall(line)
        if found:
            lines.append(line)
            words.append(found)
            repeats.append(line in seen)
            seen.add(line)
    return lines, words, repeats


def sequence(lines: list[str], words: list[list[str]], repeats: list[bool]) -> np.ndarray:
    return np.array(
        [line_features(line, w, r, i == 0) for i, (line, w, r) in enumerate(zip(lines, words, repeats))], np.float64
    )


def judge(text: str, field: LineField) -> tuple[int, int, int, int, int, bool, bool, float]:
    """The output columns after ``doc_id`` for one whole text."""
    lines, words, repeats = split_lines(text)
    every = [w for of_line in words for w in of_line]
    n_words, again = len(every), repeated_words(every)
    failed = n_words < MIN_WORDS or again > MAX_REPEATED_SHARE * n_words
    share = 0.0
    if lines:
        content = field.viterbi(sequence(lines, words, repeats))
        share = sum(len(w) for w, s in zip(words, content) if s) / n_words
    symbols = sum(text.count(c) for c in SYMBOLS)
    kept = not failed and share >= MIN_CONTENT_SHARE
    return n_words, sum(map(len, every)), symbols, sum(repeats), again, failed, kept, share


def train_field(spark: SparkSession, docs: DataFrame, sf_dir: str) -> LineField:
    """Fit the field to ``TRAINING_DOCUMENTS`` labelled documents of each class at most.

    Only the features of at most ``TRAINING_LINES`` lines of each reach the driver. Without labelled documents
    every line counts as content.
    """
    sample = labelled_sample(spark, sf_dir, "quality", TRAINING_DOCUMENTS)
    # The sample is limited, so it is small enough to send to every task.
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi")
    # One text of each id, however many rows repeat it.
    chosen = chosen.groupBy("doc_id").agg(F.min("text").alias("text"))

    def make():
        def apply(ids, texts):
            out = {"doc_id": ids, "features": [], "repeats": []}
            for text in texts:
                lines, words, repeats = (part[:TRAINING_LINES] for part in split_lines(text))
                out["features"].append(sequence(lines, words, repeats).ravel().tolist())
                out["repeats"].append(repeats)
            return out

        return apply

    schema = "doc_id long, features array<double>, repeats array<boolean>"
    found = map_texts(chosen, ["doc_id", "text"], make, schema).collect()
    label = {r["doc_id"]: r["label"] for r in sample.collect()}
    sequences = []
    for row in sorted((r for r in found if r["repeats"]), key=lambda r: (r["doc_id"], len(r["repeats"]), r["features"])):
        states = np.where(np.array(row["repeats"]), 0, label[row["doc_id"]])
        sequences.append((np.array(row["features"]).reshape(-1, FEATURES), states))
    return LineField.train(sequences)


def judge_documents(docs: DataFrame, field: LineField) -> DataFrame:
    """Judge every whole text.

    Returns the base counts, ``base_failed``, ``kept`` and ``content_share``. A null, empty or blank text has no words and
    fails the base rules. Repeated rows are judged alike; an empty table gives no rows; other columns are ignored.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share"]

    def make():
        def apply(ids, texts):
            rows = [judge(t, field) for t in texts]
            return {"doc_id": ids} | {name: [r[k] for r in rows] for k, name in enumerate(names)}

        return apply

    return map_texts(docs, ["doc_id", "text"], make, SCHEMA)


def keep_quality(docs: DataFrame, field: LineField) -> DataFrame:
    """The documents that are kept, with all their columns."""
    return keep_rows(docs, lambda: lambda texts: [judge(t, field)[6] for t in texts])


def quality_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return judge_documents(docs, train_field(spark, docs, sf_dir))
