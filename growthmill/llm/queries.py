"""The registered queries of the training-data operators and the SQL that gives their rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from growthmill.llm import (
    class_lm, exact_copies, filter_audit, license_index, line_dedup, packing, periodic_runs, quality_rules, revisits, sentence_pieces,
    sharding, simhash, toxicity,
)
from growthmill.llm.common import table

VOCABULARIES = {"pieces": "piece_bpe_32k.model", "words": "word_bpe_49k.json"}


def vocabulary(kind: str) -> str:
    """Place of a public tokenizer's file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARIES[kind])


def op1_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 24)


def op2_line_dedup(spark, sf_dir):
    """One row per document: its lines with a word, those that stay, those near an earlier line, and their links."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), figures=True)
    figures = [F.col(f"_lines.{k}").alias(f"n_{k}") for k in ("lines", "kept", "near", "links")]
    return out.select("doc_id", *figures, F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op3_quality_rules(spark, sf_dir):
    return quality_rules.quality_of(spark, sf_dir)


def op4_class_lm(spark, sf_dir):
    return class_lm.score_documents(table(spark, sf_dir, "documents"))


def op5_toxicity(spark, sf_dir):
    return toxicity.toxicity_of(spark, sf_dir)


def op6_exact_copies(spark, sf_dir):
    return exact_copies.exact_copies(table(spark, sf_dir, "documents"))


def op7_revisits(spark, sf_dir):
    return revisits.revisits_of(spark, sf_dir)


def op8_simhash(spark, sf_dir):
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op9_sentence_pieces(spark, sf_dir):
    return sentence_pieces.encode_documents(table(spark, sf_dir, "documents"), vocabulary("pieces"))


def op10_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary("words"))


def op11_license_index(spark, sf_dir):
    return license_index.license_labels(table(spark, sf_dir, "documents"))


def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit_filters(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_periodic_runs(spark, sf_dir):
    return periodic_runs.run_report(table(spark, sf_dir, "documents"), periodic_runs.planted_repeats)


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_line_dedup": op2_line_dedup,
    "op3_quality_rules": op3_quality_rules,
    "op4_class_lm": op4_class_lm,
    "op5_toxicity": op5_toxicity,
    "op6_exact_copies": op6_exact_copies,
    "op7_revisits": op7_revisits,
    "op8_simhash": op8_simhash,
    "op9_sentence_pieces": op9_sentence_pieces,
    "op10_packing": op10_packing,
    "op11_license_index": op11_license_index,
    "op12_filter_audit": op12_filter_audit,
    "op13_periodic_runs": op13_periodic_runs,
}

# Of equal texts the row with the largest doc_id stays; A-Z alone are lower-cased.
EXACT_COPIES_SQL = """
WITH n AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
    FROM documents
), g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY body)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(n.body) AS text_sha256
FROM n JOIN g USING (body)
"""

ORACLE_SQL: dict[str, str] = {"op6_exact_copies": EXACT_COPIES_SQL, "op7_revisits": revisits.REVISITS_SQL, "op12_filter_audit": filter_audit.AUDIT_SQL}
