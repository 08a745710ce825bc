import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from growthmill.llm import queries, revisits, toxicity
from verification.compare import connect, duck_rows, spark_rows

GIVEN = "/root/testdata/sf0.001"
CAPTURE = (
    "record_id long, url string, fetched_at long, kind string, etag string, last_modified string, "
    "headers map<string,string>, payload_digest string, canonical_url string, part int, outcome string"
)


def brute(captures):
    out = {}
    for c in captures:
        earlier = [
            r for r in captures if r["kind"] == "response" and r["url"] == c["url"] and r["url"] is not None
            and (r["fetched_at"], r["record_id"]) < (c["fetched_at"], c["record_id"])
        ]
        last = max(earlier, key=lambda r: (r["fetched_at"], r["record_id"]), default=None)
        if c["kind"] != "revisit":
            out[c["record_id"]] = ("full" if c["kind"] == "response" else "ignored", None)
        elif last is None:
            out[c["record_id"]] = ("orphan", None)
        elif c["etag"] is not None:
            same = c["etag"].removeprefix("W/") == (last["etag"] or "").removeprefix("W/")
            out[c["record_id"]] = ("matched", last["record_id"]) if same else ("mismatched", None)
        elif c["last_modified"] is not None:
            same = c["last_modified"] == last["last_modified"]
            out[c["record_id"]] = ("matched", last["record_id"]) if same else ("mismatched", None)
        else:
            out[c["record_id"]] = ("unvalidated", last["record_id"])
    return out


def test_revisits_equal_brute_force_with_a_hot_url(spark):
    rng = random.Random(7)
    captures = []
    for i in range(600):
        kind = rng.choice(["response", "revisit", "revisit", "revisit", "request", None]) if i % 40 else "response"
        captures.append(
            {
                "record_id": i,
                "url": rng.choice(["h.example/a"] * 6 + ["h.example/b", "h.example/c", None]),
                "fetched_at": rng.randint(0, 200),
                "kind": kind,
                "etag": rng.choice([None, "x", "W/x", "y"]),
                "last_modified": rng.choice([None, "d1", "d2"]),
                "headers": rng.choice([None, {"date": str(i), "x-own": "1"}, {"content-type": "t", "vary": None}]),
                "payload_digest": f"p{i}",
                "canonical_url": "clash",
                "part": 3,
                "outcome": None,
            }
        )
    names = [f.split()[0] for f in CAPTURE.split(", ")]
    frame = spark.createDataFrame([tuple(c[n] for n in names) for c in captures], CAPTURE)
    got = {r["record_id"]: r for r in revisits.resolve_revisits(frame).collect()}
    assert {i: (r["outcome"], r["resolved_from"]) for i, r in got.items()} == brute(captures)
    by_id = {c["record_id"]: c for c in captures}
    for i, r in got.items():
        if r["resolved_from"] is not None:
            stored, own = by_id[r["resolved_from"]], by_id[i]
            updates = {k: v for k, v in (own["headers"] or {}).items() if k in revisits.UPDATED_HEADERS}
            assert r["headers"] == {**(stored["headers"] or {}), **updates}
            assert r["payload_digest"] == stored["payload_digest"]
    assert revisits.resolve_revisits(frame.limit(0)).collect() == []


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        ("http://WWW.Example.com:80/a/b/?b=2&utm_source=x&a=1#top", "example.com/a/b?a=1&b=2"),
        ("https://m.example.com", "m.example.com/"),
        ("example.com/?ref=x", "example.com/"),
        ("", "/"),
        (None, None),
    ],
)
def test_canonical_urls(spark, url, expected):
    frame = spark.createDataFrame([(url,)], "url string")
    assert frame.select(revisits.canonical_url(F.col("url"))).first()[0] == expected


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_query_gives_the_expected_rows(spark, name):
    frame = queries.QUERIES[name](spark, GIVEN)
    assert spark_rows(frame) == duck_rows(connect(GIVEN), queries.ORACLE_SQL[name])


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())


def test_stages_take_awkward_rows_and_nothing(spark, awkward, nothing, tmp_path, monkeypatch):
    monkeypatch.setattr(toxicity, "LEAST_STEPS", 20)
    docs, empty = awkward, nothing
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        last = name == corpus_pipeline.STAGES[-1][0]
        columns = docs.columns
        stage(spark, docs, GIVEN).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        empty = stage(spark, empty, GIVEN)
        assert empty.count() == 0
        assert last or (docs.columns == columns and docs.count() > 0 and empty.columns == columns)
    tokens = docs.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("all"))
    assert tokens.where("doc_id is not null and n % `all` <> 0").count() == 0


def test_pipeline_keeps_clean_documents(spark):
    base = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    labels = spark.read.parquet(f"{base}/labels.parquet")
    first = corpus_pipeline.drop_toxic(spark, docs, base).select("doc_id").join(labels, "doc_id").collect()
    clean = [r for r in first if r["toxic"] == 0]
    toxic = [r for r in first if r["toxic"] == 1]
    counts = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    assert len(clean) >= 0.98 * counts[0]
    # The table labels 51 toxic documents, a quarter of them held out.
    assert len(toxic) <= 0.2 * counts[1]
