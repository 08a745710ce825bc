import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from growthmill.llm import common, exact_copies, sharding

from .conftest import low


def test_shards_are_near_equal_and_keep_groups(awkward, awkward_rows):
    rows = sharding.shard_documents(awkward, 5).collect()
    expected = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in awkward_rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    shard_of = defaultdict(set)
    for r in rows:
        shard_of[r["text_crc32"], r["size"]].add(r["shard"])
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert all(len(s) == 1 for s in shard_of.values())
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) == set(range(5))


def test_capacity_form(awkward):
    rows = sharding.shard_documents(awkward, None, 60_000).collect()
    filled, texts = Counter(), defaultdict(Counter)
    for r in rows:
        filled[r["shard"]] += r["size"]
        texts[r["shard"]][r["text_crc32"]] += 1
    assert all(n <= 60_000 or len(texts[s]) == 1 for s, n in filled.items())
    assert sorted(filled) == list(range(len(filled)))


@pytest.mark.parametrize("seed", range(20))
def test_best_fit_equals_a_plain_one(seed):
    rng = random.Random(seed)
    sizes = sorted((rng.randint(1, 40) for _ in range(rng.randint(1, 60))), reverse=True)
    rooms = []
    for size in sizes:
        able = [(room, i) for i, room in enumerate(rooms) if room >= size]
        if able:
            rooms[min(able)[1]] -= size
        else:
            rooms.append(50 - size)
    bins, runs = sharding.best_fit(sorted(Counter(sizes).items(), reverse=True), 50)
    filled = Counter()
    for size, of in runs.items():
        ends = [*(r for r, _ in of[1:]), Counter(sizes)[size]]
        for (rank, at), end in zip(of, ends):
            filled[at] += size * (end - rank)
    assert bins == len(rooms)
    assert sorted(50 - room for room in rooms) == sorted(filled.values())


def test_room_tree_stays_balanced():
    tree, rng, held = sharding.RoomTree(), random.Random(2), set()
    for i in range(2000):
        if held and rng.random() < 0.4:
            gone = rng.choice(sorted(held))
            held.remove(gone)
            tree.remove(gone)
        else:
            held.add((rng.randint(0, 300), i))
            tree.add(max(held, key=lambda k: k[1]))
        if i % 50 == 0:
            size = rng.randint(0, 320)
            assert tree.tightest(size) == min((k for k in held if k[0] >= size), default=None)
    assert tree.root[3] <= 1.45 * len(held).bit_length() + 2


def test_one_group_above_an_equal_share():
    runs = sharding.fill_shards({1000: 1, 10: 60}, 4)
    filled = Counter()
    for size, of in runs.items():
        ends = [*(r for r, _ in of[1:]), {1000: 1, 10: 60}[size]]
        for (rank, at), end in zip(of, ends):
            filled[at] += size * (end - rank)
    assert sorted(filled.values()) == [200, 200, 200, 1000]


def test_copies_equal_brute_force(awkward, awkward_rows):
    groups = defaultdict(list)
    for doc_id, text in awkward_rows:
        groups[low(text)].append(doc_id)
    expected = Counter()
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        for doc_id in ids:
            expected[doc_id, keep, len(ids), doc_id == keep, digest] += 1
    # Small runs of bytes make for many rounds.
    for first, growth in ((256, 8), (3, 4)):
        got = exact_copies.exact_copies(awkward, first, growth).collect()
        assert Counter(map(tuple, got)) == expected


def test_rank_is_gapless_for_a_hot_key(spark):
    rows = spark.range(500).selectExpr("id", "if(id < 400, 'hot', if(id < 450, null, cast(id % 7 as string))) as k")
    ranks = defaultdict(list)
    for r in common.with_rank(rows, "k", ["id"]).collect():
        ranks[r["k"]].append(r["rank"])
    assert all(sorted(x) == list(range(len(x))) for x in ranks.values())
    assert sum(map(len, ranks.values())) == 500


def test_join_by_share_spreads_a_hot_key(spark):
    rows = spark.range(300).selectExpr("id", "if(id < 200, -1, id) as k")
    groups = rows.groupBy("k").count().selectExpr("k", "`count` as n").where("k <> 250")
    inner = common.join_by_share(rows, groups, ["k"], "n", ["id"])
    assert inner.count() == 299 and inner.select("id").distinct().count() == 299
    outer = common.join_by_share(rows, groups, ["k"], "n", ["id"], "left")
    assert outer.count() == 300 and outer.where("n is null").count() == 1


def test_nothing(nothing):
    assert sharding.shard_documents(nothing).collect() == []
    assert exact_copies.exact_copies(nothing).collect() == []
