from datetime import datetime

from pyspark.sql import functions as F

from chronoframe.operators.cohort import build_cohort
from chronoframe.operators.events import (
    filter_prevalent, hourly_mean, prepare_hourly, to_point_events, variable_prevalence,
)

TS = "timestamp_ntz"


def _stays(spark, rows):
    return spark.createDataFrame(rows, f"SUBJECT_ID long, HADM_ID long, ICUSTAY_ID long, INTIME {TS}, OUTTIME {TS}, partition string")


def test_unrecorded_death_exclusion_keeps_null_dod(spark):
    t0, t1 = datetime(2024, 1, 1), datetime(2024, 1, 3)
    stays = _stays(spark, [(1, 11, 21, t0, t1, "train"), (2, 12, 22, t0, t1, "train"), (3, 13, 23, t0, t1, "train"),
                           (4, 14, 24, t0, t1, "train")])
    patients = spark.createDataFrame(
        [(1, datetime(1950, 1, 1), None), (2, datetime(1950, 1, 1), datetime(2024, 1, 4)),
         (3, datetime(1950, 1, 1), datetime(2024, 1, 4)), (4, datetime(1950, 1, 1), datetime(2024, 1, 9))],
        f"SUBJECT_ID long, DOB {TS}, DOD {TS}")
    adm = spark.createDataFrame(
        [(1, 11, None, 0), (2, 12, None, 0), (3, 13, datetime(2024, 1, 2), 1), (4, 14, None, 0)],
        f"SUBJECT_ID long, HADM_ID long, DEATHTIME {TS}, HOSPITAL_EXPIRE_FLAG int")
    out = {r["SUBJECT_ID"]: r for r in build_cohort(stays, patients, adm).collect()}
    # 1: null DOD kept; 2: DOD within stay+48h, no death time -> dropped;
    # 3: recorded death kept (HOD 24 h); 4: DOD after the grace window kept
    assert sorted(out) == [1, 3, 4]
    assert out[3]["HOUR_OF_DEATH"] == 24.0 and out[1]["HOUR_OF_DEATH"] is None


def test_prevalence_threshold_is_inclusive(spark):
    # 20 entities; variable "a" on exactly one of them -> prevalence 0.05, kept
    rows = [(i, 1.0, "b", "1") for i in range(20)] + [(0, 2.0, "a", "1")]
    lab = spark.createDataFrame(rows, "ID long, t double, variable_name string, variable_value string")
    prev = {r["variable_name"]: r["prevalence"] for r in variable_prevalence(lab, 20).collect()}
    assert prev == {"a": 0.05, "b": 1.0}
    kept = filter_prevalent({"LABEVENTS": lab}, threshold=0.05)["LABEVENTS"]
    assert sorted({r["variable_name"] for r in kept.collect()}) == ["a", "b"]


def test_origin_filter_and_point_hours(spark):
    pts = spark.createDataFrame([(1, -0.5, "a", "1"), (1, 0.0, "a", "2"), (1, 0.2, "a", "4"), (1, None, "a", "3")],
                                "ID long, t double, variable_name string, variable_value string")
    doms = filter_prevalent({"LABEVENTS": pts}, threshold=0.0)
    got = sorted((r["t"], r["variable_value"]) for r in doms["LABEVENTS"].collect())
    assert got == [(0.0, "2"), (0.2, "4")]
    hourly = {(r["t"], r["variable_value"]) for r in prepare_hourly(doms["LABEVENTS"]).collect()}
    assert hourly == {(0, 2.0), (1, 4.0)}


def test_interval_to_point_keeps_start(spark):
    iv = spark.createDataFrame([(1, 2.5, 3.0, "d", "x")],
                               "ID long, t_start double, t_end double, variable_name string, variable_value string")
    out = to_point_events(iv)
    assert out.columns == ["ID", "variable_name", "variable_value", "t"]
    assert out.first()["t"] == 2.5


def test_hourly_mean_drops_bad_text(spark):
    df = spark.createDataFrame([(1, 0.5, "a", "2"), (1, 0.7, "a", "n/a"), (1, 0.9, "a", "4")],
                               "ID long, t double, variable_name string, variable_value string")
    r = prepare_hourly(df).collect()
    assert [(x["t"], x["variable_value"]) for x in r] == [(1, 3.0)]
    assert hourly_mean(df.withColumn("variable_value", F.lit(1.0)).withColumn("t", F.lit(1))).count() == 1
