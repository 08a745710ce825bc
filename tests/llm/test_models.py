import itertools
import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from growthmill.llm import class_lm, quality_rules, toxicity
from growthmill.llm.common import WORD

from .conftest import GIVEN, low

SMALL = "/root/testdata/sf0.01"


# Quality rules


def test_base_counts_equal_brute_force(awkward, awkward_rows):
    field = quality_rules.LineField.train([])
    got = Counter(tuple(r)[:7] for r in quality_rules.judge_documents(awkward, field).collect())
    expected = Counter()
    for doc_id, text in awkward_rows:
        words = WORD.findall(text or "")
        windows = Counter(zip(words, words[1:], words[2:]))
        again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        row = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(again))
        expected[(doc_id, *row, len(words) < 50 or 100 * len(again) > 50 * len(words))] += 1
    assert got == expected


@pytest.mark.parametrize("seed", range(10))
def test_viterbi_finds_the_best_path(seed):
    rng = np.random.default_rng(seed)
    field = quality_rules.LineField(rng.standard_normal((quality_rules.FEATURES, 2)), rng.standard_normal((2, 2)))
    features = rng.random((7, quality_rules.FEATURES))
    scores = features @ field.emit

    def total(path):
        return sum(scores[t, s] for t, s in enumerate(path)) + sum(field.move[a, b] for a, b in zip(path, path[1:]))

    best = max(itertools.product((0, 1), repeat=7), key=total)
    assert tuple(field.viterbi(features)) == best


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    scores, move, on = rng.standard_normal((2, 4, 2)), rng.standard_normal((2, 2)), np.array([[1, 1, 1, 1], [1, 1, 0, 0]], bool)
    states, moves = quality_rules._marginals(scores, move, on)
    expected_states, expected_moves = np.zeros_like(states), np.zeros((2, 2))
    for b, length in enumerate((4, 2)):
        paths = list(itertools.product((0, 1), repeat=length))
        weights = np.array(
            [math.exp(sum(scores[b, t, s] for t, s in enumerate(p)) + sum(move[i, j] for i, j in zip(p, p[1:]))) for p in paths]
        )
        for p, w in zip(paths, weights / weights.sum()):
            for t, s in enumerate(p):
                expected_states[b, t, s] += w
            for i, j in zip(p, p[1:]):
                expected_moves[i, j] += w
    assert np.allclose(states, expected_states) and np.allclose(moves, expected_moves)


def test_quality_follows_the_labels(spark):
    rows = quality_rules.quality_of(spark, SMALL).select("doc_id", "base_failed", "kept")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality")
    found = rows.join(labels, "doc_id").where("not base_failed").collect()
    good = [r["kept"] for r in found if r["quality"] == 1]
    bad = [r["kept"] for r in found if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad)


# Class model


def test_base_score_and_counts_equal_brute_force(awkward, awkward_rows, monkeypatch):
    # A dictionary this small sends most words through the join.
    monkeypatch.setattr(class_lm, "DICTIONARY", 700)
    got = class_lm.score_documents(awkward).collect()
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 if d is not None else False for d, _ in awkward_rows}
    counts = Counter()
    for doc_id, text in awkward_rows:
        if not held[doc_id]:
            counts.update([*WORD.findall(low(text)), None])
    total, kinds = sum(counts.values()), len(counts)
    expected = Counter()
    for doc_id, text in awkward_rows:
        tokens = [*WORD.findall(low(text)), None]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in tokens)
        known = sum(counts[w] > 0 for w in tokens)
        expected[doc_id, held[doc_id], len(tokens), known, total, round(base, 5)] += 1
    assert Counter((r[0], r[1], r[2], r[3], r[4], round(r[5], 5)) for r in got) == expected
    assert all(r["score"] < 0 and math.isfinite(r["perplexity"]) for r in got)


def test_model_is_a_distribution():
    rng = np.random.default_rng(3)
    counts = {b"w%d" % i: 50 - i for i in range(40)}
    bigrams = np.zeros((class_lm.UNITS, class_lm.UNITS))
    used = [*range(40), class_lm.END]
    bigrams[np.ix_(used, used)] = rng.integers(0, 9, (41, 41))
    entered = bigrams.sum(0)
    counts = {w: int(entered[i]) for i, w in enumerate(counts)}
    kinds = np.zeros(class_lm.UNITS)
    kinds[used] = 1
    ends = int(entered[class_lm.END])
    model = class_lm.ClassModel(counts, int(bigrams.sum()), 41, ends, kinds, bigrams)
    assert np.allclose((10**model.move).sum(1), 1)
    for g in range(len(model.below)):
        inside = sum(10 ** model.log_count[i] for i in range(40) if model.classes[i] == g)
        inside += 10**model.end_log_count if model.end_class == g else 0
        # What is left is the share of words never seen.
        assert math.isclose((inside + class_lm.ADDED) / 10 ** model.below[g], 1, rel_tol=1e-9)


def test_exchange_never_loses_likelihood_and_finds_blocks():
    rng = np.random.default_rng(2)
    block = rng.integers(0, 4, 40)
    bigrams = np.where((block[:, None] + 1) % 4 == block[None, :], 60, 1) + rng.integers(0, 3, (40, 40))

    def likelihood(of):
        table = np.zeros((of.max() + 1,) * 2)
        np.add.at(table, (of[:, None], of[None, :]), bigrams)
        cell = table * np.log(np.maximum(table, 1e-12))
        side = [x * np.log(np.maximum(x, 1e-12)) for x in (table.sum(0), table.sum(1))]
        return cell.sum() - side[0].sum() - side[1].sum()

    before = class_lm.exchange(bigrams, 4, 0)
    scores = [likelihood(class_lm.exchange(bigrams, 4, sweeps)) for sweeps in range(5)]
    assert likelihood(before) == scores[0] and all(b >= a - 1e-6 for a, b in zip(scores, scores[1:]))
    assert math.isclose(max(scores), likelihood(block), rel_tol=1e-9)


def test_gains_equal_differences_of_likelihood():
    rng = np.random.default_rng(4)
    bigrams, of = rng.integers(0, 4, (12, 12)).astype(float), rng.integers(0, 3, 12)

    def likelihood(of):
        member = np.eye(3)[of]
        return class_lm.likelihood(member.T @ bigrams @ member)

    member = np.eye(3)[of]
    own = np.diagonal(bigrams)
    right, left = (x @ member - own[:, None] * member for x in (bigrams, bigrams.T))
    got = class_lm.gains(member.T @ bigrams @ member, of, right, left, own)
    for word in range(12):
        moved = [likelihood(np.where(np.arange(12) == word, g, of)) for g in range(3)]
        assert np.allclose(got[word] - got[word][of[word]], np.array(moved) - likelihood(of), atol=1e-6)


def test_words_beside_the_units_are_clustered_by_their_neighbours(spark):
    # Words of both kinds have the same ending, so that only their neighbours tell them apart.
    rng = random.Random(1)
    texts = []
    for i in range(300):
        kind, words = "ab"[i % 2], []
        for _ in range(40):
            words += [f"{kind}before{rng.randrange(150)}", f"{kind}{rng.randrange(500)}xyz", f"{kind}after{rng.randrange(150)}"]
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model, _ = class_lm.fit(docs)
    seen = Counter(w.encode() for t in texts for w in t.split())
    often = {w for w, n in seen.items() if n >= class_lm.MIN_COUNT}
    classes = [Counter(model.classes_of([b"%s%dxyz" % (k, i) for i in range(500) if b"%s%dxyz" % (k, i) in often]).tolist()) for k in (b"a", b"b")]
    mixed = sum(min(of[c] for of in classes) for c in range(class_lm.CLASSES))
    assert mixed < 0.05 * sum(sum(of.values()) for of in classes)
    words = [[class_lm.END, *(w.encode() for w in t.split()), class_lm.END] for t in texts]
    table = np.zeros((model.move.shape[0],) * 2)
    for line in words:
        classes = [model.end_class, *model.classes_of(line[1:-1]).tolist(), model.end_class]
        np.add.at(table, (classes[:-1], classes[1:]), 1)
    entered = table.sum(0)
    share = (entered + 1) / (entered.sum() + len(table))
    prior = class_lm.TRANSITION_PRIOR
    assert np.allclose(10**model.move, (table + prior * share) / (table.sum(1, keepdims=True) + prior))


def test_held_out_texts_gain_on_the_base(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    held = class_lm.score_documents(docs).where("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert held[0] > held[1]


def test_scores_do_not_depend_on_the_number_of_partitions(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "TASK_WORDS", 500)
    docs = spark.read.parquet(f"{GIVEN}/documents.parquet")
    before, got = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for parts in ("3", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got.append({r["doc_id"]: r["score"] for r in class_lm.score_documents(docs.repartition(int(parts))).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0].keys() == got[1].keys()
    assert all(math.isclose(s, got[1][d], rel_tol=1e-9) for d, s in got[0].items())


# Toxicity


def test_gradients_equal_differences():
    network = toxicity.Network(toxicity.WordInputs(["a", "c"]))
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    words, owner, labels = ["", "a", "bad", "c", "q", "x"], np.array([0, 0, 1]), np.array([1.0, 0.0])
    rows = np.array([[1, 2, 3, 0], [5, 0, 0, 0], [4, 3, 0, 0]])
    grads, _ = network.learn(words, rows, owner, labels)
    for name, weight in network.weights.items():
        at = np.unravel_index(np.argmax(abs(grads[name])), weight.shape)
        was = weight[at]
        weight[at] = was + 3e-3
        up = network.learn(words, rows, owner, labels)[1]
        weight[at] = was - 3e-3
        down = network.learn(words, rows, owner, labels)[1]
        weight[at] = was
        assert math.isclose(grads[name][at], (up - down) / 6e-3, rel_tol=1e-3, abs_tol=1e-6), name


def test_windows_overlap_and_cover_all_words():
    for count in (0, 1, 31, 32, 33, 56, 57, 1000):
        starts = toxicity.window_starts(count)
        covered = {i for s in starts for i in range(s, min(count, s + toxicity.WINDOW))}
        assert covered == set(range(count))
        assert all(b - a <= toxicity.STRIDE for a, b in zip(starts, starts[1:]))


def test_scores_equal_a_plain_network(awkward_rows):
    network = toxicity.Network(toxicity.WordInputs(["the", "and"]))
    w = network.weights

    def plain(words):
        padded = words + [""] * (toxicity.WINDOW - len(words))
        x = network.embed(*network.inputs.of(padded))
        outs = []
        for d, order in ((0, range(len(padded))), (1, range(len(padded) - 1, -1, -1))):
            h, states = np.zeros(toxicity.HIDDEN), [None] * len(padded)
            for t in order:
                gx, gh, n = x[t] @ w["enter"][d] + w["bias"][d, 0], h @ w["recur"][d], toxicity.HIDDEN
                z, r = 1 / (1 + np.exp(-(gx + gh)[:n])), 1 / (1 + np.exp(-(gx + gh)[n : 2 * n]))
                h = (1 - z) * np.tanh(gx[2 * n :] + r * gh[2 * n :]) + z * h
                states[t] = h
            outs.append(np.array(states))
        joined = np.concatenate(outs, axis=1)
        heed = np.tanh(joined @ w["look"]) @ w["heed"]
        heed[len(words) :] = -1e9
        heed = np.exp(heed - heed.max())
        return float((heed / heed.sum()) @ joined @ w["out"] + w["shift"][0])

    texts = [t or "" for _, t in awkward_rows][85:]
    scores, counts = toxicity.Scorer(network).scores(texts)
    for text, score, count in zip(texts, scores, counts):
        words = toxicity.words_of(text)
        logits = [plain(words[s : s + toxicity.WINDOW]) for s in toxicity.window_starts(len(words))]
        assert len(logits) == count
        assert math.isclose(score, 1 / (1 + math.exp(-max(logits))), rel_tol=1e-3)


def test_score_does_not_depend_on_where_a_passage_starts():
    network = toxicity.Network(toxicity.WordInputs(["clean"]))
    passage = [f"rude{i}" for i in range(toxicity.WINDOW)]
    alone = toxicity.Scorer(network).scores([" ".join(passage)])[0][0]
    for shift in range(0, 48, 5):
        score, counts = toxicity.Scorer(network).scores([" ".join(["clean"] * shift + passage + ["clean"] * 60)])
        assert counts == [shift + 61] and score[0] >= alone - 1e-5


def test_training_separates_held_out_texts():
    rng = random.Random(0)
    plain, rude = [f"w{i}" for i in range(60)], ["rudeword", "vilestuff", "vilething"]

    def document(label):
        words = [rng.choice(plain) for _ in range(rng.randint(20, 120))]
        if label:
            words[rng.randrange(len(words))] = rng.choice(rude)
        return words

    documents = [(document(i % 2), i % 2) for i in range(300)]
    scorer = toxicity.Scorer(toxicity.train(documents))
    test = [(document(i % 2), i % 2) for i in range(200)]
    scores, _ = scorer.scores([" ".join(w) for w, _ in test])
    right = sum((s >= toxicity.THRESHOLD) == bool(y) for s, (_, y) in zip(scores, test))
    assert right >= 190


def test_training_holds_words_once_and_embeds_them_in_parts():
    texts = ["Some words, some more words", "", "More_words"]
    lines = [" ".join(toxicity.words_of(t)) for t in texts]
    shared = toxicity.shared_words(lines)
    assert shared == [toxicity.words_of(t) for t in texts]
    assert shared[0][3] is shared[2][0] and shared[0][1] is shared[0][4]

    network = toxicity.Network(toxicity.WordInputs(["known"]))
    words = [f"averagelylongword{i}" for i in range(40_000)]
    scorer = toxicity.Scorer(network)
    tracemalloc.start()
    scorer.logits([words])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The gates of a word are 192 bytes.
    assert peak < 800 * len(words)
    expected = network.enter(network.embed(*network.inputs.of(words[4090:4100])))
    assert np.allclose(scorer.gates[[scorer.rows[w] for w in words[4090:4100]]], expected, atol=1e-6)


def test_windows_to_learn_from_are_the_most_toxic_and_random_ones():
    rng = np.random.default_rng(3)
    few = toxicity.HARD_WINDOWS + toxicity.RANDOM_WINDOWS
    assert sorted(toxicity.chosen_windows(rng, None, 3)) == [0, 1, 2]
    assert len(toxicity.chosen_windows(rng, None, 1000)) == few
    logits = np.zeros(1000)
    logits[[17, 998]] = 5.0
    picked = toxicity.chosen_windows(rng, logits, 1000)
    assert {17, 998} <= set(picked) and len(picked) <= few
    assert sorted(toxicity.chosen_windows(rng, logits[:2], 2)) == [0, 1]


def test_scores_of_awkward_rows(spark, awkward, awkward_rows, monkeypatch):
    monkeypatch.setattr(toxicity, "LEAST_STEPS", 20)
    network = toxicity.train_network(spark, awkward, GIVEN, ~toxicity.held_out())
    rows = toxicity.score_documents(awkward, network).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, _ in awkward_rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    stay = toxicity.keep_clean(awkward, network)
    assert stay.columns == awkward.columns
    assert Counter(r["doc_id"] for r in stay.select("doc_id").collect()) == Counter(
        r["doc_id"] for r in rows if r["score"] < toxicity.THRESHOLD
    )


def test_repeated_ids_are_learnt_from_once(spark, monkeypatch):
    docs = spark.read.parquet(f"{GIVEN}/documents.parquet").select("doc_id", "text")
    more = docs.unionAll(docs).unionAll(docs.selectExpr("doc_id", "concat(text, ' more') AS text"))
    monkeypatch.setattr(toxicity, "train", lambda documents: documents)
    monkeypatch.setattr(quality_rules.LineField, "train", lambda sequences: sequences)
    assert len(toxicity.train_network(spark, docs, GIVEN)) == len(toxicity.train_network(spark, more, GIVEN)) > 0
    assert len(quality_rules.train_field(spark, docs, GIVEN)) == len(quality_rules.train_field(spark, more, GIVEN)) > 0


def test_nothing(nothing):
    field = quality_rules.LineField.train([])
    network = toxicity.Network(toxicity.WordInputs([]))
    assert quality_rules.judge_documents(nothing, field).collect() == []
    assert quality_rules.keep_quality(nothing, field).collect() == []
    assert toxicity.score_documents(nothing, network).collect() == []
    assert class_lm.score_documents(nothing).collect() == []
