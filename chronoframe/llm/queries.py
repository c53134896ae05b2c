"""The registered queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoframe.llm import (
    byte_bpe,
    collocations,
    decontaminate,
    fingerprints,
    grammar_tokens,
    hard_negatives,
    jaccard_join,
    licenses,
    line_dedup,
    lm_scoring,
    packing,
    quality,
    token_counts,
)
from chronoframe.llm.common import table
from chronoframe.session import scratch_path

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
MULTI_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    text = F.coalesce("text", F.lit(""))
    return kept.select(
        "doc_id", F.size(F.split(text, "\n")).alias("n_kept"),
        F.coalesce(F.array_size("deleted_lines"), F.lit(0)).alias("n_deleted"),
        F.coalesce(F.array_join(F.col("deleted_lines").cast("array<string>"), ","), F.lit("")).alias("deleted_lines"),
        F.sha2(text, 256).alias("text_sha256"),
    )


def op2_grammar_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "llm-token-files")
    grammar_tokens.write_tokens(table(spark, sf_dir, "documents"), WORD_BPE, out)
    rows = grammar_tokens.decoded(spark, out)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), BYTE_BPE)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_BPE)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), MULTI_BPE, public_tokenizers.PATTERN)


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_grammar_tokens": op2_grammar_tokens,
    "op3_fingerprints": op3_fingerprints,
    "op4_decontaminate": op4_decontaminate,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_quality": op6_quality,
    "op7_token_counts": op7_token_counts,
    "op8_license_scan": op8_license_scan,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_lm_scoring": op10_lm_scoring,
    "op11_collocations": op11_collocations,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_byte_bpe": op13_byte_bpe,
}

#: Where SQL can express the result.
ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": line_dedup.oracle_sql(),
    "op4_decontaminate": decontaminate.oracle_sql(),
    "op5_jaccard_join": jaccard_join.oracle_sql(),
    "op8_license_scan": licenses.oracle_sql(),
    "op11_collocations": collocations.oracle_sql(),
    "op12_hard_negatives": hard_negatives.oracle_sql(),
}
