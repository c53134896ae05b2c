import math

from chronoframe.operators.events import distinct_entities, filter_prevalent, prepare_hourly, variable_prevalence
from chronoframe.plans import fixtures, stages


def test_cube_route_equals_row_filter_route(spark):
    """Hourly means read off the fused cube == filter rows first, then average."""
    sf = "/root/testdata/sf0.001"
    via_cube = stages.hourly_domains(spark, sf)
    direct = filter_prevalent(fixtures.domains(spark, sf), "LABEVENTS", 0.05)
    for d in ("LABEVENTS", "OUTPUTEVENTS"):
        a = {(r["ID"], r["variable_name"], r["t"]): r["variable_value"] for r in via_cube[d].collect()}
        b = {(r["ID"], r["variable_name"], r["t"]): r["variable_value"] for r in prepare_hourly(direct[d]).collect()}
        assert a.keys() == b.keys() and len(a) > 0
        assert all(math.isclose(a[k], b[k], rel_tol=1e-12, abs_tol=1e-12) for k in a)
    # at sf0.001 the rare variable passes the prevalence threshold (1 of 15 entities, FIXTURES.md);
    # its only row lies before the origin (t = -6 h), so neither route has an hourly value for it
    lab = fixtures.domains(spark, sf)["LABEVENTS"]
    prev = {r["variable_name"]: r["prevalence"] for r in variable_prevalence(lab, distinct_entities(lab)).collect()}
    assert prev["rare_test"] >= 0.05
    assert "rare_test" not in {k[1] for k in a}


def test_planning_keeps_every_prevalent_variable_beside_many_rare_ones(spark):
    """300,000 distinct interval starts and 200,000 rare variables change nothing."""
    from pyspark.sql import functions as F

    from chronoframe.operators.events import hourly_cube, hourly_long
    from chronoframe.operators.grid import plan_from_cube

    point = "ID", "CAST(1 AS DOUBLE) AS t", "variable_name", "'1.5' AS variable_value"
    hr = spark.range(20).selectExpr("id AS ID", "'hr' AS variable_name").selectExpr(*point)
    rare = spark.range(200_000).selectExpr("id % 20 AS ID", "concat('rare', id) AS variable_name").selectExpr(*point)
    drug = spark.range(300_000).selectExpr(
        "id % 20 AS ID", "id / 7.0D AS t_start", "id / 7.0D + 1 AS t_end", "'drug' AS variable_name", "'2' AS variable_value"
    )
    cube = hourly_cube({"LABEVENTS": hr.unionByName(rare), "INPUTEVENTS_MV": drug}, ["LABEVENTS", "INPUTEVENTS_MV"])
    kept, stats = plan_from_cube(cube, ["LABEVENTS", "INPUTEVENTS_MV"], "LABEVENTS", 0.1)
    assert stats["LABEVENTS"].names == ["hr"] and stats["INPUTEVENTS_MV"].names == ["drug"]
    rows = hourly_long(cube, kept).groupBy("domain").agg(F.count("*").alias("n")).collect()
    assert {r["domain"]: r["n"] for r in rows} == {"LABEVENTS": 20, "INPUTEVENTS_MV": 300_000}


def test_matrix_needs_its_domains_and_unique_stays(spark, monkeypatch):
    import pytest

    from chronoframe.operators.skeleton import build_skeleton

    monkeypatch.delitem(fixtures.FROM_EVENTS, "CHARTEVENTS")
    with pytest.raises(KeyError, match="CHARTEVENTS"):
        stages.matrix(spark, "/root/testdata/sf0.001")
    twice = spark.createDataFrame([(7, 2), (7, 2)], "ICUSTAY_ID long, cutoff_time long")
    with pytest.raises(ValueError, match="duplicate key"):
        build_skeleton(twice)


def test_matrix_plan_is_narrow(spark):
    """One scan of the events for the cube, and few exchanges in the matrix."""
    sf = "/root/testdata/sf0.001"
    cube = fixtures.cube_input(spark, sf, list(fixtures.FROM_EVENTS))._jdf.queryExecution().optimizedPlan().toString()
    assert cube.count("event_id") > 0 and cube.count("inline") == 1
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = stages.matrix(spark, sf)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange hashpartitioning") <= 18
