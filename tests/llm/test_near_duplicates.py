import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from growthmill.llm import components, line_dedup, simhash

from .conftest import low

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_fingerprint(text):
    words = WORD.findall(low(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(items, linked):
    root = {i: i for i in items}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in items}


def test_simhash_equals_brute_force(awkward, awkward_rows):
    prints = [brute_fingerprint(t) for _, t in awkward_rows]
    distinct = sorted(set(prints))
    near = [(a, b) for a in distinct for b in distinct if a < b and bin(a ^ b).count("1") <= 3]
    root = classes(distinct, near)
    lowest = {}
    for (doc_id, _), p in zip(awkward_rows, prints):
        if doc_id is not None:
            lowest[root[p]] = min(doc_id, lowest.get(root[p], doc_id))
    expected = Counter((d, f"{p:016x}", lowest.get(root[p])) for (d, _), p in zip(awkward_rows, prints))
    got = simhash.simhash_components(awkward).collect()
    assert Counter(map(tuple, got)) == expected
    stay = simhash.one_of_each(awkward)
    assert stay.columns == awkward.columns
    assert {r["doc_id"] for r in stay.select("doc_id").collect()} == {d for d, _, c in expected if d == c}


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_slices_equal_brute_force(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**63, 3, dtype=np.uint64)
    groups, values = [], []
    for g, size in enumerate([1, 2, 63, 64, 65, 200, 400]):
        x = base[rng.integers(0, 3, size)]
        for _ in range(5):
            x = x ^ ((np.uint64(1) << rng.integers(0, 64, size).astype(np.uint64)) * (rng.random(size) < 0.6))
        x = np.unique(x)
        groups += [g] * len(x)
        values += x.tolist()
    links = [
        (i, j)
        for j in range(len(values))
        for i in range(j)
        if groups[i] == groups[j] and bin(values[i] ^ values[j]).count("1") <= radius
    ]
    root = classes(range(len(values)), links)
    low_ = simhash.linked(np.array(groups), np.array(values, np.uint64), radius)
    assert low_.tolist() == [root[i] for i in range(len(values))]


def test_hot_bucket_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 40)
    rng = random.Random(3)
    centre = rng.getrandbits(63)
    values = sorted({centre ^ (1 << rng.randrange(63)) ^ (1 << rng.randrange(63)) for _ in range(300)})
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    found = components.connected_components(simhash.near_edges(frame)).collect()
    near = [(a, b) for a in values for b in values if a < b and bin(a ^ b).count("1") <= 3]
    root = classes(values, near)
    assert {r["node"]: r["root"] for r in found} == {v: r for v, r in root.items() if v != r}


def test_components_of_long_paths_and_hubs(spark):
    rng = random.Random(4)
    path = [(i, i + 1) for i in range(0, 200)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    edges = path + hub + [(5000, 5000), (6001, 6000), (6000, 6001)]
    rng.shuffle(edges)
    names = list({x for e in edges for x in e})
    renamed = dict(zip(names, rng.sample(range(-10_000, 10_000), len(names))))
    edges = [(renamed[a], renamed[b]) for a, b in edges]
    root = classes([renamed[n] for n in names], edges)
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {n: r for n, r in root.items() if n != r}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def mutated(rng, text, edits, letters="abcdefgh "):
    out = list(text)
    for _ in range(edits):
        kind, i = rng.randrange(3), rng.randrange(len(out) + 1)
        if kind == 0:
            out.insert(i, rng.choice(letters))
        elif i < len(out):
            out[i : i + 1] = [] if kind == 1 else [rng.choice(letters)]
    return "".join(out)


def test_band_and_segments_equal_brute_force():
    rng, key_of = random.Random(3), line_dedup.hasher()
    for _ in range(15_000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 14)))
        b, edits = mutated(rng, a, rng.randint(0, 4), "abc"), rng.randint(0, 3)
        true = distance(a, b)
        assert line_dedup.within(a, b, edits) == (true <= edits)
        short, long = sorted((a, b), key=len)
        if true <= edits and len(short) > edits:
            assert line_dedup.shared_key(short, long, key_of, edits) is not None
        if len(a) > 1 and len(b) > 1:
            assert np.bitwise_count(line_dedup.signature(a) ^ line_dedup.signature(b)).sum() <= 4 * true


def brute_lines(documents):
    """First places, classes and links of all lines, by comparing all pairs."""
    first = {}
    for place, text in documents:
        for i, line in enumerate((text or "").split("\n")):
            if WORD.search(line):
                first[line] = min(first.get(line, (place, i)), (place, i))
    able = sorted(x for x in first if len(x) >= line_dedup.MIN_CHARS)
    links = [(a, b) for n, b in enumerate(able) for a in able[:n] if abs(len(a) - len(b)) <= 2 and line_dedup.within(a, b)]
    order = sorted(first, key=first.get)
    number = {x: i for i, x in enumerate(order)}
    root = classes(range(len(order)), [(number[a], number[b]) for a, b in links])
    return first, {x: order[root[number[x]]] for x in order}, Counter(x for pair in links for x in pair)


@pytest.mark.parametrize("tile", [2048, 20])
def test_lines_equal_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(line_dedup, "TILE", tile)
    rng = random.Random(9)
    seeds = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randint(24, 60))) for _ in range(20)]
    crowd = "the same passage with many small changes in it"
    documents = []
    for d in range(60):
        lines = [mutated(rng, rng.choice(seeds), rng.randint(0, 3)) for _ in range(4)] + [mutated(rng, crowd, 1), "short", "", " \t"]
        rng.shuffle(lines)
        documents.append((d, "\n".join(lines)))
    documents += [(60, None), (61, ""), (62, crowd), (63, seeds[0] * 300)]
    first, lead, degree = brute_lines(documents)
    frame = spark.createDataFrame([(d, t, "x") for d, t in documents], "doc_id long, text string, _decided string").repartition(3)
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(frame, figures=True).collect()}
    assert len(got) == len(documents)
    for d, text in documents:
        keep, near, links = [], 0, 0
        for i, line in enumerate((text or "").split("\n")):
            if not WORD.search(line):
                keep.append(line)
            elif first[line] == (d, i):
                links += degree[line]
                near += lead[line] != line
                keep += [line] * (lead[line] == line)
        assert got[d]["text"] == (None if text is None else "\n".join(keep))
        assert (got[d]["_lines"]["near"], got[d]["_lines"]["links"]) == (near, links)
        assert got[d]["_decided"] == "x"


def test_awkward_lines(awkward):
    out = line_dedup.dedup_lines(awkward)
    assert out.columns == awkward.columns and out.count() == awkward.count()
    lines = out.select(F.explode(F.split("text", "\n")).alias("line"), "doc_id").where(r"line rlike '[^\\x20\\x09-\\x0D]'")
    # Only the row that stands twice in the table may bring a line twice.
    assert lines.where("doc_id <> 1010").groupBy("line").count().where("count > 1").count() == 0


def test_nothing(nothing):
    assert simhash.simhash_components(nothing).collect() == []
    assert simhash.one_of_each(nothing).collect() == []
    assert line_dedup.dedup_lines(nothing).collect() == []
