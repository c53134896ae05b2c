import os
import subprocess
import sys

import duckdb

import __spark_entry__ as entry
from chronoframe.plans.queries import ORACLE_SQL, SPARK_QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:2] == ["ID", "t"] and "24hour_mortality" in df.columns


def test_every_oracle_has_a_query():
    q, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(q)
    assert set(SPARK_QUERIES) <= set(q) and set(ORACLE_SQL) <= set(sql)
    assert set(SPARK_QUERIES) - set(ORACLE_SQL) == {"train_and_score", "search_params"}


def test_every_oracle_is_one_statement_that_a_view_can_hold():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    for name, sql in entry.oracle_sql().items():
        con.sql(sql).create_view(f"v_{name}")


def test_small_queries_run_at_smoke_scale(spark):
    q = entry.queries()
    for name in ("hourly_skeleton", "split_sizes", "auroc", "static_one_hot", "variable_prevalence"):
        assert q[name](spark, entry.SMOKE_DIR).count() >= 1


def test_core_queries_survive_a_missing_library_of_the_subpackage():
    code = """
import sys
sys.modules["xxhash"] = None
import __spark_entry__ as e
from chronoframe.plans.queries import ORACLE_SQL, SPARK_QUERIES
assert e.queries() == SPARK_QUERIES and e.oracle_sql() == ORACLE_SQL
"""
    subprocess.run([sys.executable, "-c", code], check=True, cwd=os.path.dirname(os.path.abspath(entry.__file__)))
