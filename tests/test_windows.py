import math
import random

import pytest
from pyspark.sql import functions as F

from chronoframe.operators.grid import hourly_stats, pivot_hourly, reference_grid
from chronoframe.operators.windows import (
    classify_columns, cumulative_count, forward_fill, rolling_features, rolling_features_explode, time_since,
    window_features,
)


def _wide(spark, rows, cols="x double"):
    return spark.createDataFrame(rows, f"ID long, t bigint, {cols}")


def test_reference_grid(spark):
    hourly = spark.createDataFrame([(1, "a", 0, 1.0), (1, "b", 5, 2.0), (2, "a", 3, 3.0)],
                                   "ID long, variable_name string, t bigint, variable_value double")
    base = pivot_hourly(hourly, grid="reference")
    rows = sorted((r["ID"], r["t"], r["a"], r["b"]) for r in base.collect())
    assert rows == [(1, 0, 1.0, None), (1, 3, None, None), (1, 5, None, 2.0),
                    (2, 0, None, None), (2, 3, 3.0, None), (2, 5, None, None)]


def test_reference_grid_in_parts(spark):
    """All pairs, however the entities are dealt into parts."""
    hourly = spark.createDataFrame([(i, "a", (i * 7) % 23, 1.0) for i in range(60)] + [(None, "a", 3, 1.0)],
                                   "ID long, variable_name string, t bigint, variable_value double")
    hours = {(i * 7) % 23 for i in range(60)}
    want = sorted((repr(i), t) for i in [*range(60), None] for t in hours)
    for n in (None, 10, 4096 * 5):
        assert sorted((repr(r[0]), r[1]) for r in reference_grid(hourly, n_ids=n).collect()) == want


CASE = [(1, 0, None), (1, 1, 1.0), (1, 2, None), (1, 3, 0.0), (1, 4, 1.0), (1, 20, None)]


def test_cumulative_count_and_time_since(spark):
    df = _wide(spark, CASE)
    cum = [r["x_cumcount"] for r in cumulative_count(df, ["x"]).orderBy("t").collect()]
    assert cum == [None, 1.0, 1.0, 1.0, 2.0, 2.0]
    ts = time_since(df, ["x"]).orderBy("t").collect()
    assert [r["x_timesince"] for r in ts] == [None, 0.0, 1.0, 0.0, 0.0, 16.0]
    assert [r["x"] for r in ts] == [c[2] for c in CASE]


def test_rolling_12h(spark):
    df = _wide(spark, CASE)
    r = {row["t"]: row for row in rolling_features(df, ["x"]).collect()}
    assert r[1]["12i_mean_x"] == 1.0 and r[1]["12i_std_x"] is None
    assert r[3]["12i_mean_x"] == 0.5 and r[3]["12i_std_x"] == pytest.approx(0.7071, abs=1e-4)
    assert r[20]["12i_mean_x"] is None and r[20]["12i_max_x"] is None


def test_window_edge(spark):
    df = _wide(spark, [(1, 1, 5.0), (1, 12, None), (1, 13, 7.0)])
    r = {row["t"]: row for row in rolling_features(df, ["x"]).collect()}
    assert r[12]["12i_max_x"] == 5.0
    assert r[13]["12i_max_x"] == 7.0 and r[13]["12i_mean_x"] == 7.0


def test_binary_classification(spark):
    df = spark.createDataFrame(
        [(1, 0, 0.0, 1.0, 0.0, 0.0), (1, 1, 1.0, 1.0, 0.5, None), (1, 2, 1.0, 1.0, 1.0, 1.0)],
        "ID long, t bigint, a double, b double, c double, d double")
    binary, other = classify_columns(df)
    assert binary == ["a", "d"] and other == ["b", "c"]


def test_forward_fill(spark):
    df = _wide(spark, [(1, 0, None), (1, 1, 2.0), (1, 2, None), (2, 0, None), (2, 5, 3.0)])
    got = [(r["ID"], r["t"], r["x"]) for r in forward_fill(df).orderBy("ID", "t").collect()]
    assert got == [(1, 0, None), (1, 1, 2.0), (1, 2, 2.0), (2, 0, None), (2, 5, 3.0)]


def _random_hourly(spark, seed=3, n_ids=6, n_rows=150):
    rnd = random.Random(seed)
    seen, rows = set(), []
    for _ in range(n_rows):
        key = (rnd.randrange(n_ids), rnd.choice("pq"), rnd.randrange(60))
        if key in seen:
            continue
        seen.add(key)
        rows.append((key[0], key[1], key[2], round(rnd.uniform(-5, 5), 3)))
    return spark.createDataFrame(rows, "ID long, variable_name string, t bigint, variable_value double")


def test_explode_route_equals_window_route(spark):
    hourly = _random_hourly(spark)
    stats = hourly_stats(hourly)
    base = pivot_hourly(hourly, stats.names, hours=stats.hours)
    by_window = {(r["ID"], r["t"]): r.asDict() for r in rolling_features(base, stats.names).collect()}
    grid = reference_grid(hourly, hours=stats.hours)
    exploded = grid.join(rolling_features_explode(hourly, stats.names), ["ID", "t"], "left")
    by_explode = {(r["ID"], r["t"]): r.asDict() for r in exploded.collect()}
    assert by_window.keys() == by_explode.keys()
    for k, a in by_window.items():
        b = by_explode[k]
        for c, v in a.items():
            if v is None or b[c] is None:
                assert v is None and b[c] is None, (k, c)
            else:
                assert math.isclose(v, b[c], rel_tol=1e-9, abs_tol=1e-9), (k, c, v, b[c])


def test_window_features_empty_domain_returns_keys(spark):
    df = spark.createDataFrame([(1, 0)], "ID long, t bigint")
    assert window_features(df).columns == ["ID", "t"]


def test_reference_grid_is_spread_over_sized_partitions(spark, monkeypatch):
    """The entity list is tiny but the grid is |entities| x |hours| rows: the
    plan must spread the entities over an explicit, grid-sized partition count
    (a hash repartition on the id would merge into the distinct's exchange)."""
    import io
    import contextlib

    from chronoframe.operators import grid as grid_mod

    monkeypatch.setattr(grid_mod, "GRID_ROWS_PER_PARTITION", 10)
    hourly = spark.createDataFrame([(i, "a", t, 1.0) for i in range(40) for t in (0, 5, 9, 20, 30)],
                                   "ID long, variable_name string, t bigint, variable_value double")
    g = grid_mod.reference_grid(hourly, hours=[0, 5, 9, 20, 30], n_ids=40)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        g.explain()
    want = max(spark.sparkContext.defaultParallelism, 40 * 5 // 10)  # 20: sized by the grid
    assert f"RoundRobinPartitioning({want})" in buf.getvalue()
    assert g.count() == 200


def test_narrow_types_keeps_columns_with_nulls_floating(spark):
    from chronoframe.operators.grid import narrow_types

    df = spark.createDataFrame(
        [(1, 0, 1.0, None, 2.0**40, 0.5, 0.1), (1, 1, 2.0, 3.0, 5.0, 1.25, 0.3)],
        "ID long, t bigint, whole double, gap double, `big.one` double, half double, fine double",
    )
    assert dict(narrow_types(df, tolerance=1e-12).dtypes) == {
        "ID": "bigint", "t": "bigint", "whole": "int", "gap": "float", "big.one": "bigint", "half": "float", "fine": "double",
    }


def test_rolling_maps_send_no_copies_and_follow_the_rows(spark, monkeypatch):
    """Observations are dealt once, over as many tasks as their rows ask for,
    and copied to their hours there; windows that cross blocks are whole."""
    from chronoframe.operators import windows

    rng = random.Random(3)
    rows = [(e, "ab"[rng.random() < 0.5], t, float(rng.randint(0, 9))) for e in (1, 2, None) for t in rng.sample(range(-300, 800), 300)]
    hourly = spark.createDataFrame(rows, "ID long, variable_name string, t bigint, variable_value double")
    monkeypatch.setattr(windows, "DEALT_ROWS", 1000)
    maps = windows.rolling_maps(hourly)
    plan = maps._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan
    assert maps.rdd.getNumPartitions() == -(-len(rows) * 12 // 1000)
    want = {}
    for e, v, t, x in rows:
        for at in range(t, t + 12):
            want.setdefault((e, at), {}).setdefault(v, []).append(x)
    got = maps.collect()
    assert len(got) == len(want)
    for r in got:
        own = want[r.ID, r.t]
        assert {k: (m["mean"], m["max"]) for k, m in r._roll.items()} == {k: (pytest.approx(sum(v) / len(v)), max(v)) for k, v in own.items()}
