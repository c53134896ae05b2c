"""Segmented scans and block statistics equal the plain window routes."""

import random

import pytest
from pyspark.sql import functions as F

from chronoframe.operators.segments import rolling_features_blocks, segmented_count, segmented_fill, segmented_since
from chronoframe.operators.windows import cumulative_count, forward_fill, rolling_features_explode, time_since


def wide(spark, seed=3):
    rng = random.Random(seed)
    rows = []
    for entity in range(6):
        hours = range(-40, 260) if entity == 0 else sorted(rng.sample(range(-30, 120), rng.randrange(1, 60)))
        for t in hours:
            rows.append((entity, t, *[None if rng.random() < p else float(rng.randrange(2)) for p in (0.3, 0.9, 1.0)]))
    return spark.createDataFrame(rows, "ID long, t bigint, a double, `b c` double, never double").repartition(5)


def same(a, b):
    assert a.columns == b.columns and a.dtypes == b.dtypes
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


@pytest.mark.parametrize("hours", [1, 7, 100_000])
def test_segmented_scans_equal_the_entity_windows(spark, hours):
    df, cols = wide(spark), ["a", "b c", "never"]
    same(segmented_fill(df, hours=hours), forward_fill(df))
    same(segmented_fill(df, ["a"], hours=hours), forward_fill(df, ["a"]))
    same(segmented_count(df, cols, hours=hours), cumulative_count(df, cols))
    same(segmented_since(df, cols, hours=hours), time_since(df, cols))


def test_an_entity_with_most_rows_is_spread(spark):
    """No window or join holds one entity's rows, only its segments' totals."""
    n = F.col("id")
    df = spark.range(20_000).select((n % 50 == 0).cast("long").alias("ID"), n.alias("t"), F.when(n % 3 == 0, 1.0).alias("x"))
    out = segmented_count(df, ["x"], hours=500)
    sizes = [r.n for r in df.groupBy("ID", F.floor(F.col("t") / 500)).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 500 and out.count() == 20_000
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(ID" in plan and "_segment" in plan
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, cumulative_count(df, ["x"]).collect()))


@pytest.mark.parametrize("period", [1, 2, 12])
def test_block_statistics_equal_the_exploded_windows(spark, period):
    rng = random.Random(period)
    rows = [(e, v, t, rng.choice([None, -5.0, 1e6 + rng.random(), rng.random()]))
            for e in range(4) for v in ("a", "b c") for t in sorted(rng.sample(range(-30, 60), 25))]
    rows += [(9, "a", 5, 1.0), (9, "a", 5, 2.0), (9, "a", 6, 4.0)]  # two rows of one hour
    hourly = spark.createDataFrame(rows, "ID long, variable_name string, t int, variable_value double").repartition(3)
    names = ["a", "b c"]
    got = {(r[0], r[1]): r[2:] for r in rolling_features_blocks(hourly, names, period).collect()}
    want = {(r[0], r[1]): r[2:] for r in rolling_features_explode(hourly, names, period).collect()}
    want = {k: v for k, v in want.items() if any(x is not None for x in v)}
    assert got.keys() == want.keys()
    for k in want:
        assert [x is None for x in got[k]] == [x is None for x in want[k]], k
        assert [x or 0 for x in got[k]] == pytest.approx([x or 0 for x in want[k]], rel=1e-9, abs=1e-6), k
    assert rolling_features_blocks(hourly, [], period).columns == ["ID", "t"]
    assert rolling_features_blocks(hourly.limit(0), names, period).count() == 0
