import random

import numpy as np
import pytest

from growthmill.llm import common, near_copies, simhash

from .conftest import low
from .test_near_duplicates import WORD, classes


def shingle_set(text):
    words = WORD.findall(low(text))
    return frozenset([tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else []))


def alike(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def expected_rows(rows):
    """What stays, by comparing all pairs of shingle sets."""
    sets = sorted({shingle_set(t) for _, t in rows}, key=lambda s: sorted(s))
    root = classes(range(len(sets)), [(i, j) for j in range(len(sets)) for i in range(j) if alike(sets[i], sets[j])])
    number = {s: i for i, s in enumerate(sets)}
    ids = {}
    for d, t in rows:
        ids.setdefault(root[number[shingle_set(t)]], set()).add(d)
    lead = {r: min((d for d in of if d is not None), default=None) for r, of in ids.items()}
    return root, number, lead


def edited(rng, words, share):
    return [f"new{rng.randrange(10**6)}" if rng.random() < share else w for w in words]


@pytest.mark.parametrize("tile", [2048, 15])
def test_near_copies_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(near_copies, "TILE", tile)
    rng = random.Random(5)
    rows = []
    for _ in range(25):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(6, 300))]
        for share in (0, 0, 0.002, 0.01, 0.02, 0.05, 0.3)[: rng.randint(1, 7)]:
            rows.append((len(rows), " ".join(edited(rng, words, share))))
    # A crowd of near copies of one text, all of them different.
    crowd = [f"c{rng.randrange(3000)}" for _ in range(400)]
    rows += [(1000 + i, " ".join([*crowd[:399], f"own{i}"])) for i in range(60)]
    rows += [(5000, None), (5001, ""), (5002, " \n"), (None, "lone words"), (None, None), (5003, "Lone WORDS"), (5004, "lone words two")]
    frame = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, place string").repartition(3)
    out = near_copies.one_of_each(frame)
    assert out.columns == frame.columns
    got = sorted(r["doc_id"] for r in out.collect())
    _, _, lead = expected_rows(rows)
    # A band may miss a pair at the border of the similarity, never join one beyond it.
    assert set(lead.values()) <= set(got) and len(got) <= len(lead) + 1
    assert len([d for d in got if 1000 <= d < 2000]) == 1


def test_shingles_are_stored_and_sent_only_for_documents_that_meet(spark, monkeypatch):
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(10**5)}" for _ in range(300)) for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, f"{t} end") for i, t in enumerate(texts[:5])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    stored, sent = {}, []

    def staged(df, label):
        stored[label] = df.columns
        return common.staged(df, label)

    def compare(rows):
        sent.extend(rows.select("node").distinct().collect())
        return compare_buckets(rows)

    compare_buckets = near_copies.compare_buckets
    monkeypatch.setattr(near_copies, "staged", staged)
    monkeypatch.setattr(near_copies, "compare_buckets", compare)
    assert sorted(r["doc_id"] for r in near_copies.one_of_each(frame).collect()) == list(range(200))
    assert len(sent) == 10
    assert [label for label, columns in stored.items() if "shingles" in columns] == []


def test_ids_that_are_null_or_used_twice(spark):
    rows = [(1, "same text of some words here"), (None, "same text of some words here"), (None, "a text alone"), (7, "one text"), (7, "another"), (7, "another")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"] or 0), r["text"]) for r in near_copies.one_of_each(frame).collect())
    assert got == [(0, "a text alone"), (1, "same text of some words here"), (7, "another"), (7, "another"), (7, "one text")]


def test_awkward_rows_and_nothing(awkward, awkward_rows, nothing):
    out = near_copies.one_of_each(awkward)
    assert out.columns == awkward.columns
    _, _, lead = expected_rows(awkward_rows)
    assert {r["doc_id"] for r in out.select("doc_id").collect()} == set(lead.values())
    assert near_copies.one_of_each(nothing).collect() == []


def test_close_pairs_equal_brute_force():
    rng = np.random.default_rng(2)
    for size, radius in ((1, 3), (63, 5), (65, 22), (200, 20)):
        values = rng.integers(0, 1 << 63, size).astype(np.uint64)
        values[size // 2 :] = values[: size - size // 2] ^ (rng.integers(0, 1 << 63, size - size // 2) & rng.integers(0, 1 << 63, size - size // 2)).astype(np.uint64)
        got = sorted((int(i), int(j)) for a, b in simhash.close_pairs(values, radius) for i, j in zip(a, b))
        assert got == [(i, j) for i in range(size) for j in range(i + 1, size) if int(values[i] ^ values[j]).bit_count() <= radius]
