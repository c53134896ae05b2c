"""Stage 1: cohort of stays with age and hour of death."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoframe.functions import age_years, hours_between, not_true, plus_hours

# The columns of the cohort table.
COHORT_COLUMNS = [
    "SUBJECT_ID", "HADM_ID", "ICUSTAY_ID", "INTIME", "OUTTIME", "partition",
    "DOB", "DEATHTIME", "HOSPITAL_EXPIRE_FLAG", "AGE", "HOUR_OF_DEATH",
]


def attach_patient_admission(stays: DataFrame, patients: DataFrame, admissions: DataFrame) -> DataFrame:
    """Stays ⟕ patients on SUBJECT_ID ⟕ admissions on (SUBJECT_ID, HADM_ID).

    Plain left equi-joins: a duplicated right key multiplies rows, as in the
    reference (see :func:`chronoframe.sources.assert_unique_key`).
    Sides are left to the planner: AQE turns a join into a broadcast only when
    the runtime size of a side is under the threshold.
    """
    p = patients.select("SUBJECT_ID", "DOB", "DOD")
    a = admissions.select("SUBJECT_ID", "HADM_ID", "DEATHTIME", "HOSPITAL_EXPIRE_FLAG")
    return stays.join(p, "SUBJECT_ID", "left").join(a, ["SUBJECT_ID", "HADM_ID"], "left")


def add_age_and_death_hour(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "AGE": age_years("DOB", "INTIME"),
            "HOUR_OF_DEATH": hours_between("INTIME", "DEATHTIME"),
        }
    )


def unrecorded_death(grace_hours: int = 48):
    """DOD within [INTIME, OUTTIME + grace] while no DEATHTIME is recorded."""
    return (
        (F.col("DOD") >= F.col("INTIME"))
        & (F.col("DOD") <= plus_hours("OUTTIME", grace_hours))
        & F.col("DEATHTIME").isNull()
    )


def exclude_unrecorded_deaths(df: DataFrame, grace_hours: int = 48) -> DataFrame:
    """Drop stays whose death date falls in the stay (+grace) with no death time.

    A null DOD makes the comparison null, which counts as "not flagged": the
    stay is kept (the naive ``filter(~cond)`` would drop it).
    """
    return df.where(not_true(unrecorded_death(grace_hours)))


def build_cohort(stays: DataFrame, patients: DataFrame, admissions: DataFrame,
                 grace_hours: int = 48) -> DataFrame:
    """The ``deathtime`` table: joined, enriched, filtered, projected."""
    df = add_age_and_death_hour(attach_patient_admission(stays, patients, admissions))
    return exclude_unrecorded_deaths(df, grace_hours).select(*COHORT_COLUMNS)
