"""In-place compaction of a hive-partitioned dataset.

The plan comes from the files' own metadata (path and size, which a scan knows
without reading a column). Only directories with several small files are
rewritten; all others keep their files. The new files of a directory are written
beside the dataset first, in a hidden folder, and published by renames:

1. ``_compact-<id>/new`` gets the rewritten directories, committed as one job;
2. the list of directories is stored in ``_compact-<id>/plan``;
3. each live directory moves to ``_compact-<id>/old`` and its new one takes its
   place; then the hidden folder goes.

Every row is in a live or in a hidden directory at every moment, and
:func:`recover`, which each compaction runs first, ends or undoes what a broken
run has left: before the plan is stored nothing has moved, and after it each
directory is moved on from wherever it is. Writers must not append to the
directories meanwhile.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from itertools import accumulate
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class _Files:
    """The dataset's file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.root = self.path(path)
        self.fs = self.root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def at(self, *parts: str):
        return self.path("/".join([self.root.toString().rstrip("/"), *parts]))

    def names(self, at) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def move(self, src, dst) -> None:
        self.fs.mkdirs(dst.getParent())
        if not self.fs.rename(src, dst):
            raise OSError(f"cannot move {src} to {dst}")

    def delete(self, at) -> None:
        self.fs.delete(at, True)


def file_table(spark: SparkSession, path: str, partition: list[str]) -> DataFrame:
    """``dir, file, bytes`` of the dataset's files; no column is read."""
    levels = max(1, len(partition) + 1)
    rows = spark.read.option("basePath", path).parquet(path).select("_metadata.file_path", "_metadata.file_size").distinct()
    folder = F.substring_index(F.substring_index("file_path", "/", -levels), "/", levels - 1) if partition else F.lit("")
    return rows.select(folder.alias("dir"), F.col("file_path").alias("file"), F.col("file_size").alias("bytes"))


def small_directories(files: DataFrame, small_bytes: int, file_bytes: int) -> DataFrame:
    """``dir, files``: directories with two small files or more, and how many
    files of ``file_bytes`` they become."""
    return files.groupBy("dir").agg(
        F.sum((F.col("bytes") < small_bytes).cast("int")).alias("small"), F.ceil(F.sum("bytes") / file_bytes).cast("int").alias("files"),
        F.count("*").alias("now"),
    ).filter((F.col("small") > 1) & (F.col("files") < F.col("now"))).select("dir", F.greatest("files", F.lit(1)).alias("files"))


@contextmanager
def _one_writer(spark: SparkSession):
    """Tasks whose rows are of one directory write them as they come, instead of
    sorting them by directory first; others still sort."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def compact(spark: SparkSession, path: str, partition: list[str], small_bytes: int = 64 << 20, file_bytes: int = 256 << 20) -> list[str]:
    """Compact the dataset in place; the directories that were rewritten."""
    if not partition:
        raise ValueError("compaction replaces partition directories; the dataset needs partition columns")
    recover(spark, path)
    fs = _Files(spark, path)
    wanted = {r.dir: r.files for r in small_directories(file_table(spark, path, partition), small_bytes, file_bytes).collect()}
    if not wanted:
        return []
    run = f"_compact-{uuid.uuid4().hex}"
    # decoded names: a directory name is escaped as in a path
    folders = {d: unquote(d) for d in wanted}
    rows = spark.read.option("basePath", path).parquet(*[fs.at(d).toString() for d in folders.values()])
    levels = len(partition) + 1
    folder = F.substring_index(F.substring_index("_metadata.file_path", "/", -levels), "/", levels - 1)
    order = sorted(wanted)
    first = dict(zip(order, accumulate([0, *(wanted[d] for d in order)])))
    facts = F.create_map(*[x for d in order for x in (F.lit(d), F.array(F.lit(first[d]), F.lit(wanted[d])))])[folder]
    # rows of a directory are dealt by their place in the scan, so that equal rows part too;
    # every file is a task of its own
    part = facts[0] + F.pmod(F.monotonically_increasing_id(), facts[1]).cast("int")
    dealt = rows.withColumn("_part", part).repartitionById(sum(wanted.values()), "_part").drop("_part")
    new = fs.at(run, "new").toString()
    with _one_writer(spark):
        dealt.write.partitionBy(*partition).parquet(new)
    if sorted(_directories(fs, fs.at(run, "new"), len(partition))) != sorted(folders.values()):
        fs.delete(fs.at(run))
        raise OSError("the rewritten directories are not those that were planned")
    spark.createDataFrame([(d,) for d in folders.values()], "dir string").coalesce(1).write.json(fs.at(run, "plan").toString())
    _publish(spark, fs, run)
    return sorted(folders.values())


def _directories(fs: _Files, top, depth: int) -> list[str]:
    found = [""]
    for _ in range(depth):
        found = [f"{d}/{n}".lstrip("/") for d in found for n in fs.names(fs.path(f"{top.toString()}/{d}")) if "=" in n]
    return found


def _publish(spark: SparkSession, fs: _Files, run: str) -> None:
    """Put the new directories in place; also what is left of an earlier try."""
    for r in spark.read.schema("dir string").json(fs.at(run, "plan").toString()).collect():
        live, new, old = fs.at(r.dir), fs.at(run, "new", r.dir), fs.at(run, "old", r.dir)
        if not fs.fs.exists(new):
            continue  # in place already
        if not fs.fs.exists(old):
            fs.move(live, old)
        fs.move(new, live)
    fs.delete(fs.at(run))


def recover(spark: SparkSession, path: str) -> None:
    """End or undo the compactions that a broken run has left."""
    fs = _Files(spark, path)
    for run in [n for n in fs.names(fs.root) if n.startswith("_compact-")]:
        if fs.fs.exists(fs.at(run, "plan", "_SUCCESS")):
            _publish(spark, fs, run)
        else:
            fs.delete(fs.at(run))
