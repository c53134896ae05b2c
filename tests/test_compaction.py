"""In-place compaction: untouched directories, whole rows, broken runs."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from chronoframe.sources import compaction
from chronoframe.sources.compaction import compact, recover
from chronoframe.sources import scan, write_partitioned


def dataset(spark, path):
    """Directory p=1 in many small files, p=2 in one, a null and odd names."""
    n = F.col("id")
    rows = spark.range(3000).select(n, F.lit("same").alias("x"), F.when(n % 3 == 0, "a b/c").when(n % 3 == 1, "é%=").alias("p"), (n % 2).alias("q"))
    write_partitioned(rows.repartition(6), path, ["p", "q"])
    write_partitioned(rows.withColumn("p", F.lit("one")).coalesce(1), path, ["p", "q"])
    return rows


def content(spark, path):
    return sorted(map(tuple, scan(spark, path).select("id", "x", "p", "q").collect()), key=repr)


def files(path):
    return {f for f in glob.glob(path + "/**/*.parquet", recursive=True) if "/_" not in f}


def test_only_directories_with_small_files_are_rewritten(spark, tmp_out):
    path = tmp_out + "/ds"
    dataset(spark, path)
    before, rows = files(path), content(spark, path)
    done = compact(spark, path, ["p", "q"])
    assert len(done) == 6 and not any(d.startswith("p=one") for d in done)
    after = files(path)
    assert {f for f in before if "p=one" in f} == {f for f in after if "p=one" in f}
    assert len({f for f in after if "p=one" not in f}) == 6 and not (before & after - {f for f in before if "p=one" in f})
    assert content(spark, path) == rows
    assert [n for n in os.listdir(path) if n.startswith("_compact")] == []
    assert compact(spark, path, ["p", "q"]) == [] and files(path) == after


def test_large_directories_become_several_files(spark, tmp_out):
    path = tmp_out + "/ds"
    rows = spark.range(40_000).select("id", F.lit(1).alias("p"))
    write_partitioned(rows.repartition(20), path, ["p"])
    size = sum(map(os.path.getsize, files(path)))
    assert compact(spark, path, ["p"], small_bytes=size, file_bytes=size // 4) == ["p=1"]
    assert 3 <= len(files(path)) <= 5 and scan(spark, path).count() == 40_000
    with pytest.raises(ValueError):
        compact(spark, path, [])


@pytest.mark.parametrize("moves", [0, 1, 2, 5, 11])
def test_a_broken_run_loses_nothing(spark, tmp_out, monkeypatch, moves):
    """Stopped after any number of moves, the next run ends what was begun."""
    path = tmp_out + "/ds"
    dataset(spark, path)
    rows, real, left = content(spark, path), compaction._Files.move, [moves]

    def move(self, src, dst):
        if not left[0]:
            raise RuntimeError("executor and driver lost")
        left[0] -= 1
        real(self, src, dst)

    monkeypatch.setattr(compaction._Files, "move", move)
    with pytest.raises(RuntimeError):
        compact(spark, path, ["p", "q"])
    monkeypatch.setattr(compaction._Files, "move", real)
    recover(spark, path)
    assert content(spark, path) == rows
    assert [n for n in os.listdir(path) if n.startswith("_compact")] == []


def test_a_run_that_never_got_to_its_plan_is_undone(spark, tmp_out, monkeypatch):
    path = tmp_out + "/ds"
    dataset(spark, path)
    rows, before = content(spark, path), files(path)
    monkeypatch.setattr(compaction, "_directories", lambda *a: [])
    with pytest.raises(OSError):
        compact(spark, path, ["p", "q"])
    os.makedirs(path + "/_compact-left/new/p=x")
    recover(spark, path)
    assert files(path) == before and content(spark, path) == rows
    assert [n for n in os.listdir(path) if n.startswith("_compact")] == []


def test_every_file_is_a_task_and_is_written_unsorted(spark, tmp_out):
    """Files of one directory never share a task, and no task sorts by directory."""
    path, name = tmp_out + "/ds", "spark.sql.maxConcurrentOutputFileWriters"
    rows = spark.range(40_000).select("id", (F.col("id") % 3).alias("p"))
    write_partitioned(rows.repartition(20), path, ["p"])
    size, before = sum(map(os.path.getsize, files(path))), spark.conf.get(name)
    assert len(compact(spark, path, ["p"], small_bytes=size, file_bytes=size // 30)) == 3
    numbers = [len(glob.glob(f"{path}/p={p}/*.parquet")) for p in range(3)]
    assert all(n >= 10 for n in numbers) and scan(spark, path).count() == 40_000
    assert spark.conf.get(name) == before
    with compaction._one_writer(spark):
        assert spark.conf.get(name) == "1"
