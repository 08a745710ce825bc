"""Documents with all the awkward rows: nulls, empties, very long texts, ties, repeats and clashing columns."""

import pyarrow.parquet as pq
import pytest

GIVEN = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, shard int, slot string, kept boolean, "
    "score double, n long, key string, name string, _bucket int, _salt int, _decided int, root long, fp long"
)


@pytest.fixture(scope="session")
def awkward_rows():
    given = pq.read_table(f"{GIVEN}/documents.parquet").slice(0, 90).to_pylist()
    texts = [(r["doc_id"], r["text"]) for r in given]
    long = "\n".join(t for _, t in texts[:60]) + "\n" + "word " * 3000
    texts += [
        (1000, None), (1001, ""), (1002, " \n\t\n "), (1003, "\n\n"), (1004, "One"), (1005, "one"), (1006, long), (1007, long.upper()),
        (1008, texts[5][1]), (1009, texts[5][1].swapcase()), (1010, texts[5][1]), (1010, texts[5][1]), (1011, "É é"), (1012, "é É"),
        (None, "a text without a number"), (None, None), (1013, "x" * 9000), (1014, "日本語のテキスト 🙂 \x00 end"), (1015, None),
        (1016, texts[7][1] + "y"), (1017, texts[7][1][:-3] + "zz"), (1018, "<|endoftext|> it's 12% <s> </s>."),
    ]
    return texts


@pytest.fixture(scope="session")
def awkward(spark, awkward_rows):
    rows = [(d, t, None, "s", None, 1, "x", None, None, 7, None, "k", 3, 4, 5, None, 9) for d, t in awkward_rows]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
