import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from growthmill.llm import packing, sentence_pieces
from growthmill.llm.queries import vocabulary


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary("words"))


def test_pieces_equal_the_library(spark, awkward, awkward_rows):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary("pieces"))
    expected = Counter()
    for doc_id, text in awkward_rows:
        ids = model.encode(text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        expected[doc_id, len(ids), digest, hashlib.sha256(model.decode(ids).encode()).hexdigest(), True] += 1
    got = sentence_pieces.encode_documents(awkward, vocabulary("pieces")).collect()
    assert Counter(map(tuple, got)) == expected


def test_agenda_on_random_strings():
    codec = sentence_pieces.codec(vocabulary("pieces"))
    rng = random.Random(5)
    for _ in range(2000):
        text = "".join(rng.choice("aehinst  .▁\né🙂'") for _ in range(rng.randint(0, 30)))
        ids = codec.encode(text)
        assert ids == codec.library.encode(text)
        assert codec.decode(ids) == codec.library.decode(ids)


def test_memory_forgets_and_relearns(monkeypatch):
    monkeypatch.setattr(sentence_pieces, "MEMORY_WORDS", 50)
    codec = sentence_pieces.PieceCodec(vocabulary("pieces"))
    for n in range(0, 300, 10):
        text = " ".join(f"w{i}&&, x{i}." for i in range(n, n + 20))
        ids = codec.library.encode(text)
        count, digest, _ = codec.digests(codec.words(text))
        assert (count, digest) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert codec.disagreeing() == set()
        assert len(codec.memory) <= 52


def test_disagreement_is_told():
    codec = sentence_pieces.PieceCodec(vocabulary("pieces"))
    codec.digests(codec.words("some words, and others"))
    codec.memory.unchecked["▁words"] = [5]
    assert codec.disagreeing() == {"▁words"}


def test_word_ids_equal_the_library(library, awkward_rows):
    texts = [t or "" for _, t in awkward_rows] + [
        "don't 'S x's", "é ́a", "A B c\x1cd\x85e", "İstanbul ΣΑΣ", "ﬁ ①x²", "a'\ns b '́s", "École ÀÉ. ß. ŉ ǆ Ǆ ĳ ı. ª º x1. 12, é1",
        "K℀ ￼ ա́.", "<|ENDOFTEXT|> x<|endoftext|>, <|startoftext|>.", "a.b,c; (d) e%%% f!! g...",
    ]
    coder = packing.WordTokenizer(vocabulary("words"))
    for text in texts:
        ids = np.frombuffer(coder.ids(packing.WORD.findall(text)), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text[:60]


def test_every_id_lies_in_one_place(awkward, awkward_rows, library):
    rows = packing.pack_documents(awkward, vocabulary("words"), capacity=512).collect()
    by_sequence, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"], r["ids_crc32"]))
    for placed in by_sequence.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= 512
    expected = defaultdict(list)
    for doc_id, text in awkward_rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        for start in range(0, len(ids), 512):
            part = ids[start : start + 512]
            expected[doc_id, len(ids)].append((start, len(part), zlib.crc32(part.tobytes())))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in expected.items()}
    used = sum(r["length"] for r in rows)
    assert len(by_sequence) <= -(-used // 512) + 2


def brute_fill(counts, capacity):
    longest, best = max(counts), 0
    sums = {longest}
    for length, count in counts.items():
        more = set(sums)
        for k in range(1, count - (length == longest) + 1):
            more |= {s + k * length for s in sums if s + k * length <= capacity}
        sums = more
    best = max(sums)
    return best


@pytest.mark.parametrize("seed", range(30))
def test_fill_is_the_closest(seed):
    rng = random.Random(seed)
    capacity = rng.randint(5, 60)
    counts = {rng.randint(1, capacity): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}
    chosen = packing.closest_fill(counts, capacity)
    assert all(used <= counts[n] for n, used in chosen.items())
    assert sum(n * used for n, used in chosen.items()) == brute_fill(counts, capacity)
    windows = packing.plan_windows(counts, capacity)
    placed = Counter()
    for times, of in windows:
        assert sum(n * k for n, k in of.items()) <= capacity
        for n, k in of.items():
            placed[n] += times * k
    assert placed == Counter(counts)


def test_number_of_windows_plans_does_not_follow_the_counts():
    rng = random.Random(1)
    counts = {rng.randint(1, 4095): rng.randint(1, 30) for _ in range(400)}
    few = len(packing.plan_windows(counts))
    many = len(packing.plan_windows({n: c * 1_000_000 for n, c in counts.items()}))
    assert many <= max(4 * few, 2000)


def test_nothing(nothing):
    assert packing.pack_documents(nothing, vocabulary("words")).collect() == []
    assert sentence_pieces.encode_documents(nothing, vocabulary("pieces")).collect() == []


def test_word_ids_of_odd_texts_equal_the_library(library):
    coder, rng = packing.WordTokenizer(vocabulary("words")), random.Random(12)
    letters = "aAbzİıßÉéñ9٣字ㄅŉǰΐẖ’'\u0301\u0307" + packing.CLOSING + "([-_/<|> \n\t"
    for _ in range(20_000):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(1, 14)))
        ids = np.frombuffer(coder.ids(packing.WORD.findall(text)), "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids, text


def test_where_the_agenda_differs_the_library_decides(spark):
    path = vocabulary("pieces")
    texts = ["some words, and others", "other text", "and words!", None, "", "others"] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    assert all(r["agrees"] for r in sentence_pieces.encode_documents(docs, path).collect())
    codec = sentence_pieces.PieceCodec(path)
    merge = codec.merge
    codec.merge = lambda word: [5] if "words" in word else merge(word)
    for some in (texts[:3], texts[3:]):
        split = [codec.words(t or "") for t in some]
        for words in split:
            codec.digests(words)
        codec.disagreeing()
        assert [codec.touched(w) for w in split] == ["words" in (t or "") for t in some]
        for text, words in zip(some, split):
            ids = codec.library.encode(text or "")
            digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            assert codec.digests(words)[:2] == (len(ids), digest)


def test_long_words_are_encoded_and_not_remembered():
    word = "x" * 50 + "Q" * 5000 + ".%"
    codec = sentence_pieces.PieceCodec(vocabulary("pieces"))
    count, digest, _ = codec.digests(codec.words(f"a {word} b"))
    ids = codec.library.encode(f"a {word} b")
    assert (count, digest) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    assert max(map(len, codec.memory)) <= sentence_pieces.REMEMBERED_CHARS
