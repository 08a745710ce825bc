"""Toxicity by a bidirectional gated recurrent network with attention pooling.

Every word enters as the embedding of the word, where the training sample knows it, beside the mean embedding of
its character sequences. A forward and a backward recurrent network read windows of words that overlap; attention
pools their states into the logit of the window. A document is as toxic as its most toxic window. Trained in
numpy on whole texts of a bounded sample of labelled documents: in every round the network scores all their windows and learns
from the most toxic ones of each document beside some drawn at random. A document's probability
is that of any of these windows being toxic.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from itertools import chain
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthmill.llm.common import keep_rows, labelled_sample, map_texts, table

# Bound of the training sample: labelled documents of each class, with their whole texts.
TRAINING_DOCUMENTS = 1500
# Windows of a document that a round learns from: the most toxic of all its windows so far, and some at random.
HARD_WINDOWS = 2
RANDOM_WINDOWS = 40

WINDOW = 8
# Every window is scored.
STRIDE = 1
VOCABULARY = 8000
MIN_DOCUMENTS = 5
CHAR_BUCKETS = 1 << 15
DIM = 8
HIDDEN = 8
THRESHOLD = 0.3
# Weight of all toxic documents of the sample against all clean ones; the tables hold far fewer toxic ones.
TOXIC_WEIGHT = 0.3
# Small samples are gone through more often, to make this many steps.
LEAST_STEPS = 470

# Windows scored at once, words a task remembers, and words embedded at once.
WINDOWS_AT_ONCE = 1024
MEMORY_WORDS = 150_000
WORDS_AT_ONCE = 4096

LABEL_WORDS = re.compile(r"[^\W_]+")
SCHEMA = "doc_id long, score double, n_windows long"


def words_of(text: str) -> list[str]:
    return LABEL_WORDS.findall(text.lower())


def window_starts(count: int, stride: int = STRIDE) -> list[int]:
    """Starts of overlapping windows that cover all words; the last one ends with the last word."""
    if count <= WINDOW:
        return [0]
    return [*range(0, count - WINDOW, stride), count - WINDOW]


def char_grams(word: str) -> list[int]:
    """Buckets of the byte sequences of length 3 and 4 of a word with its ends marked."""
    raw = b"<" + word.encode("utf-8", "replace") + b">"
    return [crc32(raw[i : i + n]) % CHAR_BUCKETS for n in (3, 4) for i in range(max(1, len(raw) - n + 1))]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def sum_rows(at: np.ndarray, rows: np.ndarray, size: int) -> np.ndarray:
    """``out[at[i]] += rows[i]`` for all i, into ``size`` rows of zeros."""
    order = np.argsort(at, kind="stable")
    held, first = np.unique(at[order], return_index=True)
    out = np.zeros((size, rows.shape[1]), np.float32)
    out[held] = np.add.reduceat(rows[order], first, axis=0)
    return out


class WordInputs:
    """Numbers of words and of their character sequences."""

    def __init__(self, vocabulary: list[str]):
        # 0 is the padding, 1 any unknown word.
        self.numbers = {w: i + 2 for i, w in enumerate(vocabulary)}

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word numbers, all character buckets one after the other, and the first bucket of each word."""
        grams = [char_grams(w) if w else [0] for w in words]
        numbers = np.array([self.numbers.get(w, 1) if w else 0 for w in words], np.int64)
        starts = np.r_[0, np.cumsum([len(g) for g in grams])[:-1]].astype(np.int64)
        return numbers, np.fromiter(chain.from_iterable(grams), np.int64), starts


class Network:
    """Weights and the forward pass. Axis 0 of the recurrent weights is the direction."""

    def __init__(self, inputs: WordInputs, seed: int = 7):
        rng = np.random.default_rng(seed)
        size = 2 * DIM

        def small(*shape, scale=0.1):
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        self.inputs = inputs
        self.weights = {
            "word": small(len(inputs.numbers) + 2, DIM),
            "char": small(CHAR_BUCKETS, DIM, scale=0.3),
            "enter": small(2, size, 3 * HIDDEN, scale=size**-0.5),
            "bias": np.zeros((2, 1, 3 * HIDDEN), np.float32),
            "recur": small(2, HIDDEN, 3 * HIDDEN, scale=HIDDEN**-0.5),
            "look": small(2 * HIDDEN, HIDDEN, scale=0.3),
            "heed": small(HIDDEN, scale=0.3),
            "out": small(2 * HIDDEN, scale=0.3),
            "shift": np.array([-1.0], np.float32),
        }

    def embed(self, numbers, grams, starts) -> np.ndarray:
        counts = np.diff(np.r_[starts, len(grams)])[:, None]
        chars = np.add.reduceat(self.weights["char"][grams], starts, axis=0) / counts
        return np.concatenate([self.weights["word"][numbers], chars], axis=1).astype(np.float32)

    def enter(self, embedded: np.ndarray) -> np.ndarray:
        """What each word adds to the gates, per direction: (words, 2, 3 * HIDDEN)."""
        return (np.matmul(embedded[None], self.weights["enter"]) + self.weights["bias"]).transpose(1, 0, 2)

    def run(self, gates: np.ndarray, windows: np.ndarray, trace: list | None = None) -> tuple:
        """States of both directions for windows of word rows: (2, length, batch, HIDDEN)."""
        length, batch = windows.shape[1], len(windows)
        recur = self.weights["recur"]
        state = np.zeros((2, batch, HIDDEN), np.float32)
        states = np.empty((2, length, batch, HIDDEN), np.float32)
        two = 2 * HIDDEN
        for t in range(length):
            back = length - 1 - t
            x = np.stack([gates[windows[:, t], 0], gates[windows[:, back], 1]])
            from_state = np.matmul(state, recur)
            zr = sigmoid(x[..., :two] + from_state[..., :two])
            z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
            new = np.tanh(x[..., two:] + r * from_state[..., two:])
            if trace is not None:
                trace.append((state, z, r, new, from_state[..., two:]))
            state = new + z * (state - new)
            states[0, t], states[1, back] = state[0], state[1]
        return states

    def pool(self, states: np.ndarray, real: np.ndarray) -> tuple:
        """Logits, attention weights and what the attention saw; ``real`` marks words that are not padding."""
        joined = np.concatenate([states[0], states[1]], axis=2)
        seen = np.tanh(joined @ self.weights["look"])
        heed = np.where(real.T, seen @ self.weights["heed"], np.float32(-1e9))
        heed = np.exp(heed - heed.max(axis=0))
        heed /= heed.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", heed, joined)
        return pooled @ self.weights["out"] + self.weights["shift"], heed, seen, joined, pooled

    def logits(self, gates: np.ndarray, windows: np.ndarray, real: np.ndarray) -> np.ndarray:
        return self.pool(self.run(gates, windows), real)[0]

    def sliding(self, gates: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Logits of all windows of ``rows``, none of which is padding, the windows side by side in every step."""
        w, count = self.weights, len(rows) - WINDOW + 1
        enter = np.ascontiguousarray(gates[rows].transpose(1, 2, 0))
        # What attention sees of both states, and what they add to the logit.
        seen = np.zeros((WINDOW, HIDDEN + 1, count), np.float32)
        two, three = 2 * HIDDEN, 3 * HIDDEN
        # sigmoid(x) is half of tanh(x / 2), moved up by a half; the first halving is done once for all windows.
        enter[:, :two] *= 0.5
        for d, order in ((0, range(WINDOW)), (1, range(WINDOW - 1, -1, -1))):
            mine = slice(d * HIDDEN, (d + 1) * HIDDEN)
            step = np.concatenate([w["recur"][d].T, w["look"][mine].T, w["out"][None, mine]])
            step[:two] *= 0.5
            state, before = None, None
            for t in order:
                x = enter[d, :, t : t + count]
                if state is None:
                    # From a state of zeros only the word counts.
                    keep = 0.5 - 0.5 * np.tanh(x[:HIDDEN])
                    state = keep * np.tanh(x[two:])
                else:
                    from_state = step @ state
                    seen[before] += from_state[three:]
                    zr = x[:two] + from_state[:two]
                    np.tanh(zr, out=zr)
                    zr *= 0.5
                    zr += 0.5
                    new = from_state[two:three]
                    new *= zr[HIDDEN:]
                    new += x[two:]
                    np.tanh(new, out=new)
                    state -= new
                    state *= zr[:HIDDEN]
                    state += new
                before = t
            seen[before] += step[three:] @ state
        heed = np.stack([w["heed"] @ np.tanh(s[:HIDDEN]) for s in seen])
        heed = np.exp(heed - heed.max(axis=0))
        return (heed * seen[:, HIDDEN]).sum(axis=0) / heed.sum(axis=0) + w["shift"]

    def learn(
        self, words: list[str], windows: np.ndarray, owner: np.ndarray, labels: np.ndarray, weight: float = TOXIC_WEIGHT
    ) -> tuple[dict, float]:
        """Gradients for documents: ``windows`` holds rows of ``words`` (0 is the padding), ``owner`` their document."""
        w = self.weights
        numbers, grams, starts = self.inputs.of(words)
        embedded = self.embed(numbers, grams, starts)
        gates = self.enter(embedded)
        trace: list = []
        states = self.run(gates, windows, trace)
        logit, heed, seen, joined, pooled = self.pool(states, windows > 0)
        p = np.clip(sigmoid(logit), 1e-6, 1 - 1e-6)
        clean = np.clip(np.exp(np.bincount(owner, np.log1p(-p), len(labels))), 1e-6, 1 - 1e-6)
        loss = -np.mean(weight * labels * np.log(1 - clean) + (1 - labels) * np.log(clean))
        # A document is toxic unless all of its windows are clean.
        share = np.where(labels == 1, -weight * clean / (1 - clean), 1.0)
        d_logit = (share[owner] * p / len(labels)).astype(np.float32)

        grads = {k: np.zeros_like(v) for k, v in w.items() if k not in ("word", "char")}
        grads["out"], grads["shift"] = pooled.T @ d_logit, d_logit.sum(keepdims=True)
        d_pooled = d_logit[:, None] * w["out"]
        d_joined = heed[..., None] * d_pooled
        d_heed = np.einsum("tbh,bh->tb", joined, d_pooled)
        d_heed = heed * (d_heed - (heed * d_heed).sum(axis=0))
        grads["heed"] = np.einsum("tbk,tb->k", seen, d_heed)
        d_seen = d_heed[..., None] * w["heed"] * (1 - seen**2)
        grads["look"] = np.einsum("tbh,tbk->hk", joined, d_seen)
        d_joined += d_seen @ w["look"].T
        d_states = np.stack([d_joined[..., :HIDDEN], d_joined[..., HIDDEN:]])

        length, carried = windows.shape[1], np.zeros((2, len(windows), HIDDEN), np.float32)
        d_inputs = np.empty((2, length, len(windows), 3 * HIDDEN), np.float32)
        recur_t = w["recur"].transpose(0, 2, 1)
        for t in range(length - 1, -1, -1):
            back = length - 1 - t
            before, z, r, new, inner = trace[t]
            d = carried + np.stack([d_states[0, t], d_states[1, back]])
            d_new = d * (1 - z) * (1 - new**2)
            d_z = d * (before - new) * z * (1 - z)
            d_r = d_new * inner * r * (1 - r)
            d_x = np.concatenate([d_z, d_r, d_new], axis=2)
            d_from = np.concatenate([d_z, d_r, d_new * r], axis=2)
            grads["recur"] += np.matmul(before.transpose(0, 2, 1), d_from)
            carried = d * z + np.matmul(d_from, recur_t)
            d_inputs[0, t], d_inputs[1, back] = d_x[0], d_x[1]
        by_direction = np.stack([sum_rows(windows.T.ravel(), d.reshape(-1, d.shape[-1]), len(words)) for d in d_inputs])
        grads["enter"] = np.matmul(embedded.T[None], by_direction)
        grads["bias"] = by_direction.sum(axis=1, keepdims=True)
        d_embedded = np.matmul(by_direction, w["enter"].transpose(0, 2, 1)).sum(axis=0)
        grads["word"] = sum_rows(numbers, d_embedded[:, :DIM], len(w["word"]))
        counts = np.diff(np.r_[starts, len(grams)])
        grads["char"] = sum_rows(grams, np.repeat(d_embedded[:, DIM:] / counts[:, None], counts, axis=0), CHAR_BUCKETS)
        return grads, float(loss)


def chosen_windows(rng: np.random.Generator, logits: np.ndarray | None, count: int) -> np.ndarray:
    """Windows, out of ``count``, to learn from: those of greatest logit, once there are logits, and random ones."""
    some = rng.choice(count, min(count, RANDOM_WINDOWS if logits is not None else RANDOM_WINDOWS + HARD_WINDOWS), replace=False)
    if logits is None:
        return some
    hard = np.argpartition(-logits, HARD_WINDOWS)[:HARD_WINDOWS] if count > HARD_WINDOWS else np.arange(count)
    return np.union1d(some, hard)


def train(documents: list[tuple[list[str], int]], epochs: int = 5, batch: int = 32, rate: float = 0.01, seed: int = 7) -> Network:
    """Fit the network to documents given as (words, label), with Adam.

    All documents are gone through ``epochs`` times, and more often where that makes fewer than ``LEAST_STEPS`` steps. Before
    each round but the first all windows of all of them are scored, to find the ones to learn from.
    """
    toxic = sum(label for _, label in documents)
    weight = TOXIC_WEIGHT * (len(documents) - toxic) / max(1, toxic)
    steps = -(-len(documents) // batch)
    epochs = max(epochs, -(-LEAST_STEPS // steps)) if documents else 0
    found = Counter(w for words, _ in documents for w in set(words))
    known = sorted((w for w, n in found.items() if n >= MIN_DOCUMENTS), key=lambda w: (-found[w], w))[:VOCABULARY]
    network = Network(WordInputs(known), seed)
    rng = np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in network.weights.items()}
    square = {k: np.zeros_like(v) for k, v in network.weights.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(documents))
        logits = Scorer(network).logits([words for words, _ in documents]) if epoch else [None] * len(documents)
        for at in range(0, len(order), batch):
            chosen = []
            for i in order[at : at + batch]:
                text, label = documents[i]
                starts = window_starts(len(text))
                picked = chosen_windows(rng, logits[i], len(starts))
                chosen.append(([text[starts[k] : starts[k] + WINDOW] for k in picked], label))
            words = ["", *sorted({w for windows, _ in chosen for window in windows for w in window})]
            row = {w: i for i, w in enumerate(words)}
            owner = np.repeat(np.arange(len(chosen)), [len(windows) for windows, _ in chosen])
            rows = np.zeros((len(owner), WINDOW), np.int64)
            for i, window in enumerate(chain.from_iterable(windows for windows, _ in chosen)):
                rows[i, : len(window)] = [row[w] for w in window]
            # Unknown words must be met in training too.
            for w in rng.choice(known, min(len(known), 20), replace=False) if known else []:
                network.inputs.numbers.pop(str(w), None)
            grads, _ = network.learn(words, rows, owner, np.array([y for _, y in chosen], np.float64), weight)
            network.inputs.numbers = {w: i + 2 for i, w in enumerate(known)}
            step += 1
            slow = rate * (0.3 if epoch >= 0.6 * epochs else 1.0)
            for k, g in grads.items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                network.weights[k] -= slow * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-7)
    return network


class Scorer:
    """Scores texts with a network; remembers what known words add to the gates."""

    def __init__(self, network: Network):
        self.network = network
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {"": 0}
        self.gates = self._gates([""])

    def _gates(self, words: list[str]) -> np.ndarray:
        return self.network.enter(self.network.embed(*self.network.inputs.of(words)))

    def scores(self, texts: list[str]) -> tuple[np.ndarray, list[int]]:
        """Score and number of windows of each text."""
        logits = self.logits([words_of(t) for t in texts])
        return sigmoid(np.array([of.max() for of in logits])), [len(of) for of in logits]

    def logits(self, split: list[list[str]]) -> list[np.ndarray]:
        """Logits of all windows of each text, given as its words."""
        new = set(chain.from_iterable(split)).difference(self.rows)
        if len(self.rows) + len(new) > MEMORY_WORDS:
            self.forget()
            new = set(chain.from_iterable(split))
        if new:
            new = sorted(new)
            self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
            held = len(self.gates)
            gates = np.empty((len(self.rows), *self.gates.shape[1:]), np.float32)
            gates[:held] = self.gates
            for at in range(0, len(new), WORDS_AT_ONCE):
                some = new[at : at + WORDS_AT_ONCE]
                gates[held + at : held + at + len(some)] = self._gates(some)
            self.gates = gates
        counts = [len(window_starts(len(words))) for words in split]
        ids = [np.fromiter(map(self.rows.__getitem__, words), np.int32, len(words)) for words in split]
        out: list = [None] * len(split)
        short = [i for i, x in enumerate(ids) if len(x) < WINDOW]
        for at in range(0, len(short), WINDOWS_AT_ONCE):
            some = short[at : at + WINDOWS_AT_ONCE]
            rows = np.stack([np.pad(ids[i], (0, WINDOW - len(ids[i]))) for i in some])
            for i, logit in zip(some, self.network.logits(self.gates, rows, rows > 0)):
                out[i] = np.array([logit])
        long = [i for i, x in enumerate(ids) if len(x) >= WINDOW]
        if long:
            # One stream of all texts; windows across two of them are left out.
            stream = np.concatenate([ids[i] for i in long])
            windows = len(stream) - WINDOW + 1
            logits = np.concatenate(
                [self.network.sliding(self.gates, stream[at : at + WINDOWS_AT_ONCE + WINDOW - 1]) for at in range(0, windows, WINDOWS_AT_ONCE)]
            )
            first = np.cumsum([0, *(len(ids[i]) for i in long)])
            for i, start in zip(long, first):
                out[i] = logits[start : start + counts[i]]
        return out


def train_network(spark: SparkSession, docs: DataFrame, sf_dir: str, allowed=None) -> Network:
    """Fit to the whole texts of ``TRAINING_DOCUMENTS`` labelled documents of each class at most.

    ``allowed`` limits the labelled ids. Without labelled documents the network stays as initialised, near a score of 0.27.
    """
    sample = labelled_sample(spark, sf_dir, "toxic", TRAINING_DOCUMENTS, allowed)
    # The sample is limited, so it is small enough to send to every task.
    chosen = docs.select("doc_id", "text").join(F.broadcast(sample.select("doc_id")), "doc_id", "left_semi")
    # One text of each id, however many rows repeat it.
    chosen = chosen.groupBy("doc_id").agg(F.min("text").alias("text"))

    def make():
        return lambda ids, texts: {"doc_id": ids, "words": [" ".join(words_of(text)) for text in texts]}

    rows = map_texts(chosen, ["doc_id", "text"], make, "doc_id long, words string").collect()
    label = {r["doc_id"]: r["label"] for r in sample.collect()}
    rows.sort(key=lambda r: r["doc_id"])
    texts = shared_words(r["words"] for r in rows)
    return train([(words, label[r["doc_id"]]) for words, r in zip(texts, rows)])


def shared_words(lines: Iterable[str]) -> list[list[str]]:
    """The words of lines that ``words_of`` made, each distinct word held once for all of them."""
    held: dict[str, str] = {}
    return [[held.setdefault(w, w) for w in line.split()] for line in lines]


def score_documents(docs: DataFrame, network: Network) -> DataFrame:
    """``doc_id``, ``score`` and ``n_windows`` of every whole text.

    A null, empty or wordless text is one window of padding and gets the score of that. Repeated rows
    score alike; an empty table gives no rows; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def make():
        scorer = Scorer(sent.value)

        def apply(ids, texts):
            scores, counts = scorer.scores(texts)
            return {"doc_id": ids, "score": scores, "n_windows": counts}

        return apply

    return map_texts(docs, ["doc_id", "text"], make, SCHEMA)


def keep_clean(docs: DataFrame, network: Network, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(network)

    def make():
        scorer = Scorer(sent.value)
        return lambda texts: (scorer.scores(texts)[0] < threshold).tolist()

    return keep_rows(docs, make)


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def toxicity_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = train_network(spark, docs, sf_dir, ~held_out())
    return score_documents(docs, network).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_windows"
    )
