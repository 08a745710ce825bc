"""A corpus pipeline: toxicity, quality rules, line dedup, SimHash near-duplicates, packing.

Each stage takes the documents that the stage before it returned and the folder of the tables, and returns
documents with the same columns; the last one returns packed pieces. Stages are written as Parquet in between.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthmill.llm import line_dedup, near_copies, packing, quality_rules, toxicity
from growthmill.llm.common import staged, table
from growthmill.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose most toxic window scores below the threshold."""
    return toxicity.keep_clean(docs, toxicity.train_network(spark, docs, sf_dir, ~toxicity.held_out()))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and consist mostly of content lines."""
    return quality_rules.keep_quality(docs, quality_rules.train_field(spark, docs, sf_dir))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with only the first line of each class; ``n_chars`` follows the text."""
    out = line_dedup.dedup_lines(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, a similarity of 0.8 or more."""
    return near_copies.one_of_each(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences."""
    return packing.pack_documents(docs, vocabulary("words"))


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", keep_quality),
    ("line_dedup", dedup_lines),
    ("simhash", drop_near_duplicates),
    ("packing", pack),
]

# Trained networks and fields, hashed fingerprints and tokenizers cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
