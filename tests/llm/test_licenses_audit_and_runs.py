import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest

from growthmill.llm import filter_audit, license_index, periodic_runs
from growthmill.llm.common import WORD

from .conftest import low


def plain_runs(words, min_length=6, min_periods=4):
    """Every maximal stretch of every period, kept if no smaller period holds in all of it."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, length = i, j - i + q
            smaller = (all(words[k] == words[k + p] for k in range(start, start + length - p)) for p in range(1, q))
            if j > i and length >= max(min_length, min_periods * q) and not any(smaller):
                out.append((start, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def odd_words(rng):
    words = [rng.choice(rng.choice(["ab", "abc", "abcdefgh"])) for _ in range(rng.randint(0, 90))]
    for _ in range(rng.randint(0, 3)):
        if len(words) > 4:
            start, period = rng.randrange(len(words)), rng.randint(1, 12)
            for i in range(start + period, min(len(words), start + period + rng.randint(0, 70))):
                words[i] = words[i - period]
    return words


@pytest.mark.parametrize("seed", range(10))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(200):
        words = odd_words(rng)
        least, periods = rng.choice([(6, 4), (6, 4), (3, 3), (8, 5)])
        found = periodic_runs.RunFinder(least, periods).runs(words)
        assert sorted(found, key=lambda r: (r[0], r[2])) == plain_runs(words, least, periods)


def test_runs_of_very_repetitive_words():
    finder = periodic_runs.RunFinder()
    assert finder.runs(["a"] * 20_000) == [(0, 20_000, 1)]
    assert finder.runs(list("abc") * 7_000) == [(0, 21_000, 3)]
    nested = finder.runs((["a"] * 50 + ["b"]) * 200)
    assert len(nested) == 201 and (0, 10_200, 51) in nested
    with pytest.raises(ValueError):
        periodic_runs.RunFinder(6, 2)


def test_run_report_equals_brute_force(awkward, awkward_rows):
    expected = Counter()
    for doc_id, text in awkward_rows:
        words = re.findall("[^\x20\x09-\x0d]+", text or "")
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs = plain_runs(words) if n < 3000 else sorted(periodic_runs.RunFinder().runs(words), key=lambda r: (r[0], r[2]))
        dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
        best = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[0] if runs else (None, None, None)
        expected[
            doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in dropped).encode()).hexdigest(), n, n - len(dropped),
        ] += 1
    assert Counter(map(tuple, periodic_runs.run_report(awkward, periodic_runs.planted_repeats).collect())) == expected
    assert any(row[1] for row in expected)


def test_runs_and_collapsed_texts(spark):
    texts = [(1, "x  go go go\tgo go go y \n"), (2, None), (3, ""), (4, "a b c"), (None, "t " * 9)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert sorted(periodic_runs.find_runs(docs).collect(), key=str) == sorted([(1, 1, 6, 1), (None, 0, 9, 1)], key=str)
    assert [r["text"] for r in periodic_runs.collapse_runs(docs).collect()] == ["x  go y \n", None, "", "a b c", "t "]


def fails(text, is_copy):
    words = WORD.findall(text)
    capitals = sum("A" <= c <= "Z" for c in text)
    return (
        len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * capitals > 5 * len(text), bool(re.search("[#$%&*|]", text)), is_copy,
    )


def test_audit_equals_walking_every_order(spark, awkward_rows):
    rng = random.Random(4)
    rows = [(d, t, rng.choice(["a", "b", "", None]), 1) for d, t in awkward_rows] + [(7, None, "alone", 2)]
    marks = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d in range(40)] + [(3, 1, 1), (None, 1, 1), (5, 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, part int").repartition(3)
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    lowest = {}
    for d, t, *_ in rows:
        if d is not None:
            lowest[t or ""] = min(d, lowest.get(t or "", d))
    good = {d for d, q, _ in marks if q == 1 and d is not None}
    toxic = {d for d, _, x in marks if x == 1 and d is not None}
    parts = defaultdict(list)
    for d, t, source, _ in rows:
        failed = fails(t or "", d is not None and d > lowest[t or ""])
        parts[source or ""].append((failed, d in good, d in toxic))
    expected = {}
    for part, members in parts.items():
        shapley = Counter()
        for order in permutations(range(5)):
            left = members
            for step, f in enumerate(order, 1):
                gone = [m for m in left if m[0][f]]
                left = [m for m in left if not m[0][f]]
                shapley[f] += len(gone)
                unique = sum(m[0][f] and sum(m[0]) == 1 for m in members)
                failing = sum(m[0][f] for m in members)
                name = "".join("ABCDE"[i] for i in order)
                expected[part, name, step] = [
                    len(left), len(gone), failing - len(gone), unique, sum(m[1] for m in gone), sum(m[2] for m in gone), f,
                ]
        for key, values in expected.items():
            if key[0] == part:
                values[-1] = shapley[values[-1]]
    got = filter_audit.audit_filters(docs, labels).collect()
    assert len(got) == 600 * len(parts)
    assert {tuple(r)[:3]: list(r)[3:] for r in got} == expected


def test_walk_gives_the_survivors_of_every_subset():
    rng = np.random.default_rng(1)
    cells = rng.integers(0, 9, (3, 16, 2))
    states = filter_audit.walk_subsets(cells, 4)
    for subset in range(16):
        kept = [m for m in range(16) if not m & subset]
        assert (states[:, subset] == cells[:, kept].sum(axis=1)).all()


def test_license_base_equals_brute_force(awkward, awkward_rows):
    expected = Counter()
    for doc_id, text in awkward_rows:
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low(text))
        places, labels = [], []
        for phrase, label in license_index.BASE_PHRASES.items():
            want = phrase.split()
            at = [i for i in range(len(words)) if words[i : i + len(want)] == want]
            places += at
            labels += [label] * bool(at)
        expected[doc_id, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))] += 1
    rows = license_index.license_labels(awkward).collect()
    assert Counter(tuple(r)[:6] for r in rows) == expected
    assert any(r["n_base"] for r in rows)
    for r in rows:
        assert 0 <= r["score"] <= 1 and set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))


def test_every_notice_is_found_where_it_stands(spark):
    filler = "some words of prose about the use of a public version with other forms "
    rows, expected = [], {}
    for k, (label, text, _) in enumerate(license_index.NOTICES):
        rows.append((k, filler * (k + 1) + text.upper() + ". " + filler))
        expected[k] = (label, len(filler.split()) * (k + 1))
    rows += [(100, filler * 50), (101, None), (102, ""), (103, "MIT License"), (104, "/* " + " ".join(f"{w} //" for w in license_index.NOTICES[4][1].split()))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_index.scan_licenses(docs).collect()}
    for k, found in expected.items():
        assert any((m["label"], m["start"]) == found and m["score"] > 0.99 for m in got[k]["matches"]), license_index.NOTICES[k]
    assert [got[k]["matches"] for k in (100, 101, 102)] == [[], [], []]
    assert [m["label"] for k in (103, 104) for m in got[k]["matches"]] == ["mit", "bsd"]


def test_a_repeated_notice_is_found_at_every_place(spark):
    text = " and then ".join(["Licensed under the Apache License, Version 2.0"] * 300)
    row = license_index.scan_licenses(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert [m["start"] for m in row["matches"]] == [10 * k for k in range(300)]
    # The words of a notice, but not its mandatory phrase.
    loose = "apache version of a license under 2 the licensed 0"
    assert license_index.scan_licenses(spark.createDataFrame([(1, loose)], "doc_id long, text string")).first()["matches"] == []


def test_nothing(nothing, spark):
    assert license_index.license_labels(nothing).collect() == []
    assert periodic_runs.run_report(nothing).collect() == [] and periodic_runs.find_runs(nothing).collect() == []
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit_filters(nothing, labels).collect() == []
