"""Registered queries against their DuckDB equivalents and the pipeline."""

import duckdb
import pytest

import corpus_pipeline
from chronoframe.llm import decontaminate, jaccard_join, line_dedup, quality
from chronoframe.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def test_thirteen_queries():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
    assert set(ORACLE_SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    con.sql(ORACLE_SQL[name]).create_view("v")
    found = QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM v").fetchall()
    assert sorted(tuple(r) for r in found.select(*columns).collect()) == sorted(want)


def test_pipeline_stages(spark):
    """Each stage returns whole rows of what it was given, and its decisions
    are its operator's; the last packs all that is left."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "jaccard_join", "decontaminate", "pack"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.written(stage(spark, docs, SF), name)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        if name == "quality":
            want = {r.doc_id for r in quality.classify(docs, labels).filter("predicted = 1").collect()}
        elif name == "line_dedup":
            want = {r.doc_id for r in line_dedup.dedup_lines(docs).collect() if not r.deleted_lines or r.text.strip()}
        elif name == "jaccard_join":
            want = {r.doc_id for r in jaccard_join.jaccard_components(docs).collect() if r.component_id == r.doc_id or not r.n_shingles}
        else:
            want = {r.doc_id for r in decontaminate.decontaminate(docs, benchmark).collect() if not r.contaminated}
        assert ids == want and ids
        docs = out
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
