"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoframe.session import scratch_path

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from the path the driver uses."""
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *filter(None, paths)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone (null text: empty), so that extra or
    clashing columns of the input never meet an operator's own names."""
    ship(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write to the shared scratch folder and read back: computed once, and a
    lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.option("compression", "zstd").partitionBy(*partition_by or []).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(df: DataFrame) -> None:
    """Delete a table of :func:`written` that nothing reads any more."""
    path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._scratch)
    path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def partitions(df: DataFrame, bytes_each: int = 32 << 20) -> int:
    """Number of partitions for whole rows of ``df``, from the optimizer's size
    estimate: grows with the input, never under the session's setting. Data
    without an estimate (not from files) takes the session's setting."""
    spark = df.sparkSession
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    set_number = int(spark.conf.get("spark.sql.shuffle.partitions"))
    unknown = int(spark.conf.get("spark.sql.defaultSizeInBytes", str((1 << 63) - 1)))
    # a projection of unknown rows is estimated at a part of it
    return set_number if size >= unknown // 1000 else max(set_number, size // bytes_each)


#: A-Z to a-z and nothing else, as the contracts ask.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null ids count as 'null'."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % n
