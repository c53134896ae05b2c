"""Hive-partitioned Parquet datasets.

The reference streams record batches through one process; here every
operation is a distributed scan or write, and batching is Spark's file
splitting (``spark.sql.files.maxPartitionBytes``).
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chronoframe.functions import quote


def scan(spark: SparkSession, path: str, columns: list[str] | None = None, where: Column | str | None = None,
         echo_schema: bool = False) -> DataFrame:
    """Partition-discovering scan with predicate and projection.

    Filters on partition columns prune directories; others are pushed into the
    Parquet reader; only the requested columns are read.
    """
    df = spark.read.option("basePath", path).parquet(path)
    if echo_schema:
        df.printSchema()
    if where is not None:
        df = df.where(where)
    if columns:
        df = df.select(*columns)
    return df


def write_partitioned(df: DataFrame, path: str, partition: list[str] | None = None, mode: str = "append",
                      max_records_per_file: int | None = None) -> None:
    """Append (default) or overwrite a hive-partitioned dataset.

    Spark names every file uniquely per write job, so appends never clobber
    existing files. No shuffle by the partition columns: a partition value
    holding a third of the rows would make one task write all of it; each
    task instead writes its own file into each directory it touches
    (:func:`repack` compacts later).
    """
    partition = list(partition or [])
    w = df.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    if partition:
        w = w.partitionBy(*partition)
    w.parquet(path)


def copy_dataset(spark: SparkSession, src: str, dst: str, columns: list[str] | None = None,
                 where: Column | str | None = None, partition: list[str] | None = None,
                 mode: str = "append") -> DataFrame:
    """Filtered, projected copy into a (re)partitioned dataset.

    Partition columns are kept in the projection so the layout can be built.
    Returns the scan of the destination.
    """
    partition = list(partition or [])
    cols = None
    if columns:
        cols = list(columns) + [p for p in partition if p not in columns]
    write_partitioned(scan(spark, src, cols, where), dst, partition, mode)
    return scan(spark, dst)


def append_local(spark: SparkSession, pdf, path: str, schema: StructType | str | None = None,
                 partition: list[str] | None = None) -> None:
    """Append an in-memory pandas frame to a dataset (S11), via Arrow.

    Meant for frames that already live on the driver (small by nature); data
    derived from tables should stay a DataFrame and use
    :func:`write_partitioned`.
    """
    df = spark.createDataFrame(pdf, schema=schema) if schema is not None else spark.createDataFrame(pdf)
    write_partitioned(df, path, partition, "append")


def repack(spark: SparkSession, src: str, dst: str, partition: list[str] | None = None,
           files_per_partition: int | None = None, sort_by: list[str] | None = None,
           file_bytes: int = 256 << 20) -> DataFrame:
    """Compact a dataset: each partition value rewritten as a few larger files.

    Writes to a new path with dynamic partition overwrite, so only the
    partitions present are replaced and no row is lost. The rows of a partition
    value are spread over as many files as its share of the dataset's bytes asks
    for at ``file_bytes`` each, and over ``files_per_partition`` at least where
    that is given: one task writes a file, so no number of files is let grow one
    beyond ``file_bytes``. Without partition columns the same holds for the whole
    dataset.
    """
    partition = list(partition or [])
    df = spark.read.option("basePath", src).parquet(src)
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # the files' bytes
    least = files_per_partition or 1
    if not partition:
        df = df.repartition(max(least, -(-size // file_bytes)))
    else:
        # a row per partition value, as many as there are directories
        values = df.groupBy(*partition).agg(F.count(F.lit(1)).alias("_rows")).collect()
        total = max(1, sum(r["_rows"] for r in values))
        files = [max(least, math.ceil(r["_rows"] * size / total / file_bytes)) for r in values]
        first = [0, *accumulate(files)]
        types = ", ".join(f"_p{i} {df.schema[p].dataType.simpleString()}" for i, p in enumerate(partition))
        table = [(*r[:-1], first[i], files[i]) for i, r in enumerate(values)]
        numbers = spark.createDataFrame(table, f"{types}, _first int, _files int")
        same = [F.col(quote(p)).eqNullSafe(F.col(f"_p{i}")) for i, p in enumerate(partition)]
        # every file is a task of its own; equal rows are dealt by their place in the scan
        place = F.col("_first") + F.pmod(F.col("_at"), F.col("_files")).cast("int")
        columns = df.columns
        df = df.withColumn("_at", F.monotonically_increasing_id()).join(F.broadcast(numbers), same)
        df = df.repartitionById(max(1, first[-1]), place).select(*[F.col(quote(c)) for c in columns])
    if sort_by:
        # the writer's own order first, so that it need not sort again
        df = df.sortWithinPartitions(*partition, *sort_by)
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    if partition:
        w = w.partitionBy(*partition)
    w.parquet(dst)
    return spark.read.option("basePath", dst).parquet(dst)


def unique_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of one column (S13); partial distinct map-side."""
    return df.select(column).distinct()


def merge_datasets(left: DataFrame, right: DataFrame, how: str = "inner", on: list[str] | str | None = None,
                   left_on: list[str] | str | None = None, right_on: list[str] | str | None = None,
                   suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """pandas-style merge.

    ``on`` (or equal ``left_on``/``right_on`` names) keeps one key column; else
    both keys are kept. Other shared names get ``suffixes``. ``how`` is one of
    inner, left, right, outer, cross; cross is refused here (it emits all
    pairs) — use an equi-key. Null keys match each other, as in pandas.
    """
    how = {"outer": "full"}.get(how, how)
    if how == "cross":
        raise ValueError("cross merge emits all pairs; give join keys")
    if on is not None:
        left_on = right_on = on
    lk = [left_on] if isinstance(left_on, str) else list(left_on or [])
    rk = [right_on] if isinstance(right_on, str) else list(right_on or [])
    if not lk or len(lk) != len(rk):
        raise ValueError("merge needs matching left_on/right_on keys")
    same_keys = lk == rk
    shared = (set(left.columns) & set(right.columns)) - (set(lk) if same_keys else set())
    lsel = [F.col(c).alias(c + suffixes[0]) if c in shared else F.col(c) for c in left.columns]
    rsel = [F.col(c).alias(c + suffixes[1]) if c in shared else F.col(c) for c in right.columns]
    l2, r2 = left.select(*lsel), right.select(*rsel)
    if same_keys:
        # keys under names of their own on the right; null keys match, as in pandas
        r2 = r2.withColumnsRenamed({k: f"__right_{k}" for k in lk})
        joined = l2.join(r2, [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in lk], how)
        pick = {"right": lambda k: F.col(f"__right_{k}"), "full": lambda k: F.coalesce(F.col(k), F.col(f"__right_{k}"))}.get(how, F.col)
        rest = [c for c in r2.columns if not c.startswith("__right_")]
        return joined.select(*[pick(c).alias(c) if c in lk else F.col(c) for c in l2.columns], *[F.col(c) for c in rest])
    lk2 = [k + suffixes[0] if k in shared else k for k in lk]
    rk2 = [k + suffixes[1] if k in shared else k for k in rk]
    cond = None
    for a, b in zip(lk2, rk2):
        c = l2[a].eqNullSafe(r2[b])
        cond = c if cond is None else cond & c
    return l2.join(r2, cond, how)


def assert_unique_key(df: DataFrame, keys: list[str]) -> None:
    """Raise when a key occurs twice (guards the fan-out of left joins)."""
    dup = df.groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key {dup[0].asDict()} in {keys}")
