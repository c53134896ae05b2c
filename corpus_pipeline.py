"""The corpus pipeline: from raw documents to packed training sequences.

Every stage takes and returns whole rows of ``documents`` (the last one returns
the packed pieces) and works on all that the stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoframe.llm import decontaminate, jaccard_join, line_dedup, packing, quality
from chronoframe.llm.common import table, written
from chronoframe.llm.queries import WORD_BPE


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels")).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs go, and documents that were nothing
    else; ``n_chars`` follows the text."""
    kept = line_dedup.without_copies(docs)
    if "n_chars" in docs.columns:
        size = F.coalesce(F.length("text"), F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", size)
    return kept.select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return jaccard_join.one_of_each(docs).select(*docs.columns)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return decontaminate.uncontaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is packed into sequences."""
    return packing.pack(docs, WORD_BPE)


STAGES = [
    ("quality", classify_quality),
    ("line_dedup", dedup_lines),
    ("jaccard_join", dedup_documents),
    ("decontaminate", remove_benchmark),
    ("pack", pack),
]

#: Training and encoding are not expressible in SQL; the stages are tested
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
