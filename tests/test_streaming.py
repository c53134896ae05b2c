import pytest
from pyspark.sql import functions as F

from chronoframe.sources import write_partitioned
from chronoframe.streaming import stream_copy


def test_stream_copy_filters_projects_and_resumes(spark, tmp_out):
    src, dst, ckpt = tmp_out + "/src", tmp_out + "/dst", tmp_out + "/ckpt"
    df = spark.range(0, 300).select("id", (F.col("id") % 3).alias("p"), (F.col("id") * 0.5).alias("x"))
    write_partitioned(df.repartition(6), src, ["p"])
    out = stream_copy(spark, src, dst, ["id"], F.col("x") >= 10, ["p"], max_files_per_trigger=2, checkpoint=ckpt)
    assert sorted(out.columns) == ["id", "p"]
    assert out.count() == 280
    # a second run on the same checkpoint finds nothing new: no duplicates
    again = stream_copy(spark, src, dst, ["id"], F.col("x") >= 10, ["p"], max_files_per_trigger=2, checkpoint=ckpt)
    assert again.count() == 280
    # new input files are picked up incrementally
    write_partitioned(spark.range(300, 310).select("id", (F.col("id") % 3).alias("p"), (F.col("id") * 0.5).alias("x")),
                      src, ["p"])
    assert stream_copy(spark, src, dst, ["id"], F.col("x") >= 10, ["p"], checkpoint=ckpt).count() == 290


def test_a_second_source_is_refused_instead_of_losing_its_rows(spark, tmp_out):
    a, b, dst = tmp_out + "/a", tmp_out + "/b", tmp_out + "/dst"
    write_partitioned(spark.range(0, 100).toDF("id"), a)
    write_partitioned(spark.range(100, 200).toDF("id"), b)
    assert stream_copy(spark, a, dst).count() == 100
    with pytest.raises(ValueError, match="another source"):
        stream_copy(spark, b, dst)
    # the same source again goes on where it ended
    write_partitioned(spark.range(200, 210).toDF("id"), a)
    assert stream_copy(spark, a, dst).count() == 110


def test_the_tasks_that_write_the_source_follow_the_table(spark, tmp_out, monkeypatch):
    """A fixed number of writers would each sort a growing share of the rows."""
    import glob

    from chronoframe.plans import queries

    spark.range(6000).select(F.col("id").alias("l_orderkey"), F.lit("A").alias("l_returnflag")).write.parquet(tmp_out + "/lineitem.parquet")
    monkeypatch.setattr(queries, "_TASK_ROWS", 500)
    path = queries._lineitem_dataset(spark, tmp_out, files_per_task=4)
    assert len(glob.glob(path.removeprefix("file:") + "/l_returnflag=A/*.parquet")) == 12
