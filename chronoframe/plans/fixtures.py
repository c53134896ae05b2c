"""Driver tables → the input shapes the feature pipeline consumes.

The mapping (FIXTURES.md §2) is a deterministic relabelling of the whole
tables: every event becomes a measurement, every user a stay. Nothing is
sampled or dropped except where a domain is defined by a subset of event
types. Each builder has a twin SQL fragment in
:mod:`chronoframe.plans.oracle` so Spark and DuckDB share one definition.
Projections are written as SQL expressions (one JVM call each).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoframe.functions import parse_numeric
from chronoframe.session import read_table

# Fixed values of the fixture mapping (labels for the static attributes).
INSURANCE_VALUES = ["Medicare", "Private", "Medicaid"]
MARITAL_VALUES = ["MARRIED", "SINGLE", "WIDOWED", "DIVORCED"]
RELIGION_VALUES = ["CATHOLIC", "PROTESTANT", "JEWISH", "NOT SPECIFIED", "UNOBTAINABLE"]
STATIC_ATTRIBUTES = [
    "ADMISSION_LOCATION", "ADMISSION_TYPE", "AGE", "ETHNICITY", "GENDER",
    "INSURANCE", "LANGUAGE", "MARITAL_STATUS", "RELIGION",
]

HADM_OFFSET = 100000
STAY_OFFSET = 200000
_US_PER_HOUR = "3.6e9"


def _pick(key: str, values: list[str], mod: int) -> str:
    arms = " ".join(f"WHEN {key} % {mod} = {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {arms} END"


def _first_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts")
    return ev.groupBy("user_id").agg(F.min("ts").alias("m"))


def stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stay per user: INTIME = first event + 6 h, OUTTIME = first + 48..167 h."""
    return _first_event(spark, sf_dir).selectExpr(
        "user_id AS SUBJECT_ID",
        f"user_id + {HADM_OFFSET} AS HADM_ID",
        f"user_id + {STAY_OFFSET} AS ICUSTAY_ID",
        "m + make_dt_interval(0, 6) AS INTIME",
        "m + make_dt_interval(0, CAST(48 + user_id % 120 AS INT)) AS OUTTIME",
        "'train' AS partition",
    )


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS SUBJECT_ID",
        "CASE WHEN c_custkey % 50 = 0 THEN TIMESTAMP_NTZ '1700-01-01 00:00:00' "
        "ELSE TIMESTAMP_NTZ '1950-01-01 00:00:00' + make_dt_interval(CAST(c_custkey % 10000 AS INT)) END AS DOB",
        "CASE WHEN c_custkey % 10 = 0 THEN TIMESTAMP_NTZ '2024-01-03 00:00:00' "
        "WHEN c_custkey % 10 = 1 THEN TIMESTAMP_NTZ '2024-03-01 00:00:00' END AS DOD",
    )


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _first_event(spark, sf_dir).selectExpr(
        "user_id AS SUBJECT_ID",
        f"user_id + {HADM_OFFSET} AS HADM_ID",
        "CASE WHEN user_id % 4 = 0 THEN m + make_dt_interval(0, CAST(user_id % 90 AS INT), 30) END AS DEATHTIME",
        "CAST(CASE WHEN user_id % 4 = 0 THEN 1 ELSE 0 END AS INT) AS HOSPITAL_EXPIRE_FLAG",
    )


def labevents(spark: SparkSession, sf_dir: str, stays_df: DataFrame | None = None) -> DataFrame:
    """Point-form domain: ID, t (hours since INTIME), variable_name, variable_value."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    st = (stays_df if stays_df is not None else stays(spark, sf_dir)).selectExpr(
        "SUBJECT_ID AS user_id", "ICUSTAY_ID", "INTIME")
    return ev.join(st, "user_id").selectExpr(
        "ICUSTAY_ID AS ID",
        f"timestampdiff(MICROSECOND, INTIME, ts) / {_US_PER_HOUR} AS t",
        "CASE WHEN event_id % 2003 = 0 THEN 'rare_test' ELSE event_type END AS variable_name",
        "CASE WHEN event_id % 29 = 0 THEN 'n/a' ELSE CAST(value AS STRING) END AS variable_value",
    )


def time_invariant(spark: SparkSession, sf_dir: str, stays_df: DataFrame | None = None) -> DataFrame:
    """Long static attributes for every stay's subject (nine names)."""
    cust = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    users = (stays_df if stays_df is not None else stays(spark, sf_dir)).selectExpr("SUBJECT_ID AS c_custkey")
    k = "c_custkey"
    wide = (
        cust.join(users, "c_custkey", "left_semi")
        # 25 nations and 5 regions at every scale
        .join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey, "left")
        .join(F.broadcast(region), nation.n_regionkey == region.r_regionkey, "left")
        .selectExpr(
            f"{k} + {STAY_OFFSET} AS ID",
            "n_name AS ADMISSION_LOCATION",
            "c_mktsegment AS ADMISSION_TYPE",
            f"CAST(20 + {k} % 70 AS STRING) AS AGE",
            "r_name AS ETHNICITY",
            f"CASE WHEN {k} % 2 = 0 THEN 'M' ELSE 'F' END AS GENDER",
            f"{_pick(k, INSURANCE_VALUES, 3)} AS INSURANCE",
            f"CASE WHEN {k} % 7 = 0 THEN NULL WHEN {k} % 2 = 0 THEN 'ENGL' ELSE 'SPAN' END AS LANGUAGE",
            f"{_pick(k, MARITAL_VALUES, 4)} AS MARITAL_STATUS",
            f"{_pick(k, RELIGION_VALUES, 5)} AS RELIGION",
        )
    )
    # some stays carry a second, larger value of an attribute, which the pivot drops
    pairs = [f"struct('{a}' AS variable_name, {a} AS variable_value)" for a in STATIC_ATTRIBUTES]
    pairs.append("struct('GENDER' AS variable_name, CASE WHEN ID % 11 = 0 THEN 'UNKNOWN' END AS variable_value)")
    long = wide.selectExpr("ID", f"inline(array({', '.join(pairs)}))")
    return long.where(F.col("variable_value").isNotNull()).selectExpr(
        "ID", "CAST(NULL AS DOUBLE) AS t", "variable_name", "variable_value")


#: Domains made from the measurements: name → (rows taken, variable, value).
#: The interval domains carry t_start and t_end instead of t.
_HOUR = "CAST(ceil(t) AS BIGINT)"
FROM_EVENTS = {
    "LABEVENTS": ("true", "variable_name", "variable_value"),
    "OUTPUTEVENTS": (
        "variable_name IN ('purchase', 'signup', 'view')",
        "CASE WHEN variable_name IN ('purchase', 'signup') THEN concat('flag_', variable_name) ELSE 'vol_view' END",
        f"CASE WHEN variable_name IN ('purchase', 'signup') THEN CAST({_HOUR} % 2 AS STRING) ELSE variable_value END",
    ),
    "CHARTEVENTS": ("variable_name IN ('click', 'view')", "concat('hr_', variable_name)", "variable_value"),
    "DATETIMEEVENTS": ("variable_name = 'signup'", "'dt_line_change'", f"CAST(CAST({_HOUR} % 3 = 0 AS INT) AS STRING)"),
    "MICROBIOLOGYEVENTS": ("variable_name = 'purchase'", "'culture'", f"CAST(CAST({_HOUR} % 5 = 0 AS INT) AS STRING)"),
    "INPUTEVENTS_MV": ("variable_name = 'error'", "'drug_error'", "variable_value"),
    "PROCEDUREEVENTS_MV": ("variable_name = 'signup'", "'proc_signup'", "variable_value"),
}
INTERVAL_DOMAINS = ("INPUTEVENTS_MV", "PROCEDUREEVENTS_MV")


def event_domain(lab: DataFrame, name: str) -> DataFrame:
    """One domain of the measurements, in point or interval form."""
    rows, variable, value = FROM_EVENTS[name]
    times = ["t AS t_start", "t + 0.5D AS t_end"] if name in INTERVAL_DOMAINS else ["t"]
    return lab.where(rows).selectExpr("ID", *times, f"{variable} AS variable_name", f"{value} AS variable_value")


def cube_input(spark: SparkSession, sf_dir: str, names: list[str]) -> DataFrame:
    """The hourly cube's input for several domains from one scan of the
    events: every measurement is exploded to the domains it belongs to."""
    rows = [
        f"CASE WHEN {rows} THEN struct('{n}' AS domain, {variable} AS variable_name, {value} AS variable_value, "
        f"{'t' if n in INTERVAL_DOMAINS else f'CAST({_HOUR} AS DOUBLE)'} AS t) END"
        for n, (rows, variable, value) in FROM_EVENTS.items() if n in names
    ]
    each = labevents(spark, sf_dir).selectExpr("ID", "t >= 0 AS ok", f"inline(filter(array({', '.join(rows)}), x -> x IS NOT NULL))")
    return each.select("domain", "ID", "variable_name", "t", "ok", parse_numeric("variable_value").alias("v"))


def domains(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The event-domain dict the pipeline consumes (lazy DataFrames)."""
    st = stays(spark, sf_dir)
    lab = labevents(spark, sf_dir, st)
    return {n: event_domain(lab, n) for n in FROM_EVENTS} | {"TIME_INVARIANT": time_invariant(spark, sf_dir, st)}


def scored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, label, prediction) with naturally tied predictions."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return labels.join(docs, "doc_id").selectExpr(
        "doc_id", "CAST(quality AS INT) AS label", "least(n_chars / 20000.0D, 1.0D) AS prediction")
