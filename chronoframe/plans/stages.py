"""The feature pipeline wired end to end over the driver tables.

Every stage is lazy; callers decide where to materialise (the pipeline runner
writes the base features and the matrix). Functions here compose the
operators the way the reference's stage scripts chain them, with the Spark
rewrites of SURVEY §4 (no dense grid for the matrix, explode-based rolling,
one window pass per domain).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronoframe.operators.cohort import attach_patient_admission, add_age_and_death_hour, build_cohort
from chronoframe.operators.events import cube_of, filter_prevalent, hourly_from_cube, hourly_long
from chronoframe.operators.grid import HourlyStats, pivot_hourly, plan_from_cube
from chronoframe.operators.labels import add_lookahead_label
from chronoframe.operators.skeleton import add_static, build_outcome, build_skeleton, matrix_features
from chronoframe.operators.static import static_features
from chronoframe.operators.windows import window_features
from chronoframe.plans import fixtures
from chronoframe.session import materialize

# Domains skipped by the dynamic-feature stage.
DYNAMIC_EXCLUDED = ["TIME_INVARIANT", "INPUTEVENTS_MV", "PROCEDUREEVENTS_MV", "CHARTEVENTS"]
# Domains joined into the model matrix, in order; all are needed.
MATRIX_DOMAINS = ["CHARTEVENTS", "DATETIMEEVENTS", "LABEVENTS", "MICROBIOLOGYEVENTS", "OUTPUTEVENTS"]


def cohort_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    st = fixtures.stays(spark, sf_dir)
    return add_age_and_death_hour(
        attach_patient_admission(st, fixtures.patients(spark, sf_dir), fixtures.admissions(spark, sf_dir))
    )


def cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_cohort(fixtures.stays(spark, sf_dir), fixtures.patients(spark, sf_dir),
                        fixtures.admissions(spark, sf_dir))


def filtered_domains(spark: SparkSession, sf_dir: str, threshold: float = 0.05) -> dict[str, DataFrame]:
    return filter_prevalent(fixtures.domains(spark, sf_dir), "LABEVENTS", threshold)


def _hourly_plan(spark: SparkSession, sf_dir: str, names: list[str], threshold: float, denominator: str
                 ) -> tuple[DataFrame, DataFrame, dict[str, HourlyStats]]:
    """Stage 2 + the hourly means of stage 3 for the named domains.

    The raw rows are read once into the hourly cube (written to the shared
    checkpoint folder); prevalence and variable kinds are read off the cube,
    and the filter is applied to the cube, which equals filtering rows first
    and averaging after. Returns the cube, the kept variables and the facts.
    """
    wanted = list(dict.fromkeys([*names, denominator]))
    cube = materialize(cube_of(fixtures.cube_input(spark, sf_dir, wanted)), "hourly-cube")
    kept, stats = plan_from_cube(cube, names, denominator, threshold)
    return cube, kept, stats


def dynamic_domains(excluded=DYNAMIC_EXCLUDED) -> list[str]:
    return [d for d in fixtures.FROM_EVENTS if d not in excluded]


def hourly_with_stats(spark: SparkSession, sf_dir: str, domains: list[str], threshold: float = 0.05,
                      denominator: str = "LABEVENTS") -> dict[str, tuple[DataFrame, HourlyStats]]:
    """Hourly means and their planning facts, from one cube for all domains."""
    cube, kept, stats = _hourly_plan(spark, sf_dir, domains, threshold, denominator)
    return {
        d: (hourly_from_cube(cube, d, kept, point=d not in fixtures.INTERVAL_DOMAINS), stats[d]) for d in domains
    }


def hourly_domains(spark: SparkSession, sf_dir: str, excluded=DYNAMIC_EXCLUDED, threshold: float = 0.05,
                   denominator: str = "LABEVENTS") -> dict[str, DataFrame]:
    plan = hourly_with_stats(spark, sf_dir, dynamic_domains(excluded), threshold, denominator)
    return {d: h for d, (h, _) in plan.items()}


def base_from(hourly: DataFrame, stats: HourlyStats) -> DataFrame:
    return pivot_hourly(hourly, stats.names, grid="reference", hours=stats.hours, n_ids=stats.n_ids)


def base_features(spark: SparkSession, sf_dir: str, domain: str) -> DataFrame:
    """The reference's ``{domain}_base`` table: dense entity × hour grid."""
    hourly, stats = hourly_with_stats(spark, sf_dir, [domain])[domain]
    return base_from(hourly, stats)


def domain_window_table(spark: SparkSession, sf_dir: str, domain: str) -> DataFrame:
    """The reference's ``{domain}_window`` table over its base grid."""
    hourly, stats = hourly_with_stats(spark, sf_dir, [domain])[domain]
    return window_features(base_from(hourly, stats), stats.binary, stats.other)


def static_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return static_features(fixtures.time_invariant(spark, sf_dir))


def outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_outcome(cohort(spark, sf_dir))


def skeleton(spark: SparkSession, sf_dir: str, keep=()) -> DataFrame:
    return build_skeleton(outcome(spark, sf_dir), keep=keep)


def matrix(spark: SparkSession, sf_dir: str, with_hod: bool = False) -> DataFrame:
    """Skeleton + the window features of the five matrix domains + static (J3,
    J4); a domain that the data lacks raises."""
    missing = [d for d in MATRIX_DOMAINS if d not in fixtures.FROM_EVENTS]
    if missing:
        raise KeyError(f"domains the model matrix needs are missing: {missing}")
    keys = skeleton(spark, sf_dir, keep=("HOUR_OF_DEATH",) if with_hod else ()).drop("cutoff_time")
    cube, kept, stats = _hourly_plan(spark, sf_dir, MATRIX_DOMAINS, 0.05, "LABEVENTS")
    empty = [d for d in MATRIX_DOMAINS if not stats[d].n_ids]
    if empty:
        raise ValueError(f"domains the model matrix needs have no rows: {empty}")
    # read several times below: filtered once
    hourly = materialize(hourly_long(cube, kept), "hourly")
    rows = matrix_features(keys, hourly, stats)
    return add_static(rows, static_table(spark, sf_dir))


def labelled_matrix(spark: SparkSession, sf_dir: str, via_join: bool = False) -> DataFrame:
    """Matrix with HOUR_OF_DEATH and the label.

    Default: HOUR_OF_DEATH rides along from the skeleton (one row per stay),
    so the wide matrix is not reshuffled by ID for a join. ``via_join=True``
    is the reference's form (J5: left join of the distinct (ID, HOUR_OF_DEATH)
    pairs); both agree when stays are unique, which the skeleton requires.
    """
    if via_join:
        return add_lookahead_label(matrix(spark, sf_dir), outcome(spark, sf_dir))
    return add_lookahead_label(matrix(spark, sf_dir, with_hod=True))
