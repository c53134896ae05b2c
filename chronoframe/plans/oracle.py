"""DuckDB SQL oracles for the registered queries.

The fixture CTEs restate :mod:`chronoframe.plans.fixtures` in SQL. Feature
oracles are written in long form (grid ⋈ hourly rows by range, then one filtered
aggregate per column), a formulation independent of the Spark window / explode
routes. An oracle carries only the CTEs it uses and spells its columns out.
Doubles are rounded to 6 places on both sides (summation order differs).
"""

from __future__ import annotations

import re

from chronoframe.plans.fixtures import INSURANCE_VALUES, MARITAL_VALUES, RELIGION_VALUES

US_PER_HOUR = "3.6e9"
US_PER_YEAR = "31557600000000.0"


def _case(expr: str, values: list[str], mod: int) -> str:
    arms = " ".join(f"WHEN {expr} % {mod} = {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {arms} END"


def parse_numeric_sql(v: str) -> str:
    t = f"trim(CAST({v} AS VARCHAR))"
    return (
        f"CASE WHEN regexp_full_match({t}, '[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?') "
        f"OR regexp_full_match({t}, '[+-]?([iI][nN][fF]|[iI][nN][fF][iI][nN][iI][tT][yY])') "
        f"THEN TRY_CAST({t} AS DOUBLE) END"
    )


FIXTURE_CTES = f"""
first_ev AS (SELECT user_id, min(ts) AS m FROM events GROUP BY user_id),
stays AS (
  SELECT user_id AS SUBJECT_ID, user_id + 100000 AS HADM_ID, user_id + 200000 AS ICUSTAY_ID,
         m + INTERVAL 6 HOUR AS INTIME,
         m + to_hours(CAST(48 + user_id % 120 AS BIGINT)) AS OUTTIME,
         'train' AS "partition"
  FROM first_ev),
patients AS (
  SELECT c_custkey AS SUBJECT_ID,
    CASE WHEN c_custkey % 50 = 0 THEN TIMESTAMP '1700-01-01 00:00:00'
         ELSE TIMESTAMP '1950-01-01 00:00:00' + to_days(CAST(c_custkey % 10000 AS INTEGER)) END AS DOB,
    CASE WHEN c_custkey % 10 = 0 THEN TIMESTAMP '2024-01-03 00:00:00'
         WHEN c_custkey % 10 = 1 THEN TIMESTAMP '2024-03-01 00:00:00' END AS DOD
  FROM customer),
admissions AS (
  SELECT user_id AS SUBJECT_ID, user_id + 100000 AS HADM_ID,
    CASE WHEN user_id % 4 = 0 THEN m + to_hours(CAST(user_id % 90 AS BIGINT)) + INTERVAL 30 MINUTE END AS DEATHTIME,
    CAST(CASE WHEN user_id % 4 = 0 THEN 1 ELSE 0 END AS INTEGER) AS HOSPITAL_EXPIRE_FLAG
  FROM first_ev),
labevents AS (
  SELECT s.ICUSTAY_ID AS ID,
    (epoch_us(e.ts) - epoch_us(s.INTIME)) / {US_PER_HOUR} AS t,
    CASE WHEN e.event_id % 2003 = 0 THEN 'rare_test' ELSE e.event_type END AS variable_name,
    CASE WHEN e.event_id % 29 = 0 THEN 'n/a' ELSE CAST(e.value AS VARCHAR) END AS variable_value
  FROM events e JOIN stays s ON e.user_id = s.SUBJECT_ID),
outputevents AS (
  SELECT ID, t,
    CASE WHEN variable_name IN ('purchase', 'signup') THEN 'flag_' || variable_name ELSE 'vol_view' END AS variable_name,
    CASE WHEN variable_name IN ('purchase', 'signup') THEN CAST(CAST(ceil(t) AS BIGINT) % 2 AS VARCHAR)
         ELSE variable_value END AS variable_value
  FROM labevents WHERE variable_name IN ('purchase', 'signup', 'view')),
chartevents AS (
  SELECT ID, t, 'hr_' || variable_name AS variable_name, variable_value FROM labevents WHERE variable_name IN ('click', 'view')),
datetimeevents AS (
  SELECT ID, t, 'dt_line_change' AS variable_name, CASE WHEN CAST(ceil(t) AS BIGINT) % 3 = 0 THEN '1' ELSE '0' END AS variable_value
  FROM labevents WHERE variable_name = 'signup'),
microbiologyevents AS (
  SELECT ID, t, 'culture' AS variable_name, CASE WHEN CAST(ceil(t) AS BIGINT) % 5 = 0 THEN '1' ELSE '0' END AS variable_value
  FROM labevents WHERE variable_name = 'purchase'),
inputevents AS (
  SELECT ID, t AS t_start, t + 0.5 AS t_end, 'drug_error' AS variable_name, variable_value
  FROM labevents WHERE variable_name = 'error'),
ti_wide AS (
  SELECT c.c_custkey + 200000 AS ID,
    n.n_name AS ADMISSION_LOCATION, c.c_mktsegment AS ADMISSION_TYPE,
    CAST(20 + c.c_custkey % 70 AS VARCHAR) AS AGE, r.r_name AS ETHNICITY,
    CASE WHEN c.c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS GENDER,
    {_case('c.c_custkey', INSURANCE_VALUES, 3)} AS INSURANCE,
    CASE WHEN c.c_custkey % 7 = 0 THEN NULL WHEN c.c_custkey % 2 = 0 THEN 'ENGL' ELSE 'SPAN' END AS LANGUAGE,
    {_case('c.c_custkey', MARITAL_VALUES, 4)} AS MARITAL_STATUS,
    {_case('c.c_custkey', RELIGION_VALUES, 5)} AS RELIGION
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE c.c_custkey IN (SELECT SUBJECT_ID FROM stays)),
time_invariant AS (
  SELECT ID, CAST(NULL AS DOUBLE) AS t, variable_name, variable_value FROM (
    UNPIVOT ti_wide ON ADMISSION_LOCATION, ADMISSION_TYPE, AGE, ETHNICITY, GENDER, INSURANCE,
      LANGUAGE, MARITAL_STATUS, RELIGION INTO NAME variable_name VALUE variable_value)
  WHERE variable_value IS NOT NULL
  UNION ALL SELECT ID, NULL, 'GENDER', 'UNKNOWN' FROM ti_wide WHERE ID % 11 = 0),
cohort_full AS (
  SELECT s.*, p.DOB, p.DOD, a.DEATHTIME, a.HOSPITAL_EXPIRE_FLAG,
    (epoch_us(s.INTIME) - epoch_us(p.DOB)) / {US_PER_YEAR} AS AGE,
    (epoch_us(a.DEATHTIME) - epoch_us(s.INTIME)) / {US_PER_HOUR} AS HOUR_OF_DEATH
  FROM stays s
  LEFT JOIN patients p ON s.SUBJECT_ID = p.SUBJECT_ID
  LEFT JOIN admissions a ON s.SUBJECT_ID = a.SUBJECT_ID AND s.HADM_ID = a.HADM_ID),
cohort AS (
  SELECT SUBJECT_ID, HADM_ID, ICUSTAY_ID, INTIME, OUTTIME, "partition", DOB, DEATHTIME,
         HOSPITAL_EXPIRE_FLAG, AGE, HOUR_OF_DEATH
  FROM cohort_full
  WHERE NOT coalesce(DOD >= INTIME AND DOD <= OUTTIME + INTERVAL 48 HOUR AND DEATHTIME IS NULL, false)),
outcome AS (
  SELECT *, CAST(floor(least(HOUR_OF_DEATH, los)) AS BIGINT) AS cutoff_time FROM (
    SELECT *, (epoch_us(OUTTIME) - epoch_us(INTIME)) / {US_PER_HOUR} AS los FROM cohort
    WHERE HOUR_OF_DEATH > 0 OR HOUR_OF_DEATH IS NULL)),
skeleton AS (
  SELECT ICUSTAY_ID AS ID, cutoff_time, CAST(h.t AS BIGINT) AS t
  FROM outcome, LATERAL (SELECT unnest(range(1, cutoff_time + 1)) AS t) h
  WHERE cutoff_time >= 1),
lab_total AS (SELECT count(DISTINCT ID) AS n FROM labevents)"""


def domain_ctes(p: str, source: str, point: bool = True, threshold: float = 0.05) -> str:
    """Prevalence filter, hourly means, grid and long window features of one domain."""
    tcol = "t" if point else "t_start"
    hour = "CAST(ceil(t) AS BIGINT)" if point else "t_start"
    return f"""
{p}_prev AS (
  SELECT variable_name, count(*) AS n_ids, count(*) / (SELECT n FROM lab_total) AS prevalence
  FROM (SELECT DISTINCT ID, variable_name FROM {source} WHERE variable_name IS NOT NULL)
  GROUP BY variable_name),
{p}_f AS (
  SELECT * FROM {source}
  WHERE variable_name IN (SELECT variable_name FROM {p}_prev WHERE prevalence >= {threshold}) AND {tcol} >= 0),
{p}_pts AS (
  SELECT ID, {hour} AS t, variable_name, {parse_numeric_sql('variable_value')} AS variable_value FROM {p}_f),
{p}_hourly AS (
  SELECT ID, variable_name, t, avg(variable_value) AS variable_value FROM {p}_pts
  WHERE ID IS NOT NULL AND t IS NOT NULL AND variable_name IS NOT NULL AND variable_value IS NOT NULL
  GROUP BY ID, variable_name, t),
{p}_grid AS (
  SELECT i.ID, h.t FROM (SELECT DISTINCT ID FROM {p}_hourly) i, (SELECT DISTINCT t FROM {p}_hourly) h),
{p}_kind AS (
  SELECT variable_name,
    CASE WHEN min(variable_value) = 0 AND max(variable_value) = 1
          AND bool_and(variable_value IN (0, 1)) THEN 1 ELSE 0 END AS is_binary
  FROM {p}_hourly GROUP BY variable_name),
{p}_upto AS (
  SELECT g.ID, g.t, h.variable_name, k.is_binary,
    sum(h.variable_value) AS cum,
    g.t - max(h.t) AS since,
    max(CASE WHEN h.t = g.t THEN h.variable_value END) AS raw,
    avg(h.variable_value) FILTER (WHERE h.t > g.t - 12) AS r_mean,
    stddev_samp(h.variable_value) FILTER (WHERE h.t > g.t - 12) AS r_std,
    max(h.variable_value) FILTER (WHERE h.t > g.t - 12) AS r_max,
    count(*) FILTER (WHERE h.t > g.t - 12) AS r_n
  FROM {p}_grid g JOIN {p}_hourly h ON g.ID = h.ID AND h.t <= g.t
  JOIN {p}_kind k ON h.variable_name = k.variable_name
  GROUP BY g.ID, g.t, h.variable_name, k.is_binary),
{p}_feat_long AS (
  SELECT ID, t, variable_name || '_cumcount' AS f, round(cum, 6) AS v FROM {p}_upto WHERE is_binary = 1
  UNION ALL SELECT ID, t, variable_name, round(raw, 6) FROM {p}_upto WHERE is_binary = 1
  UNION ALL SELECT ID, t, variable_name || '_timesince', CAST(since AS DOUBLE) FROM {p}_upto WHERE is_binary = 1
  UNION ALL SELECT ID, t, '12i_mean_' || variable_name, round(r_mean, 6) FROM {p}_upto WHERE is_binary = 0 AND r_n > 0
  UNION ALL SELECT ID, t, '12i_std_' || variable_name, round(r_std, 6) FROM {p}_upto WHERE is_binary = 0 AND r_n > 0
  UNION ALL SELECT ID, t, '12i_max_' || variable_name, round(r_max, 6) FROM {p}_upto WHERE is_binary = 0 AND r_n > 0),
{p}_base_long AS (SELECT ID, t, variable_name AS f, round(variable_value, 6) AS v FROM {p}_hourly)"""


def _columns(names: list[str], value: str = "v") -> str:
    return ", ".join(f'max({value}) FILTER (WHERE f = \'{n}\') AS "{n}"' for n in names)


def window_names(binary: list[str], other: list[str]) -> list[str]:
    return [f"{v}{tail}" for v in binary for tail in ("_cumcount", "", "_timesince")] + [
        f"12i_{k}_{v}" for v in other for k in ("mean", "std", "max")
    ]


def domain_wide(p: str, binary: list[str], other: list[str]) -> str:
    """Wide tables of one domain, with its variables spelled out."""
    window, base = window_names(binary, other), binary + other
    return f"""
{p}_feat_wide AS (SELECT ID, t, {_columns(window)} FROM {p}_feat_long GROUP BY ID, t),
{p}_window AS (
  SELECT g.ID, g.t, {", ".join(f'w."{n}"' for n in window)}
  FROM {p}_grid g LEFT JOIN {p}_feat_wide w ON g.ID = w.ID AND g.t = w.t),
{p}_base_wide AS (SELECT ID, t, {_columns(base)} FROM {p}_base_long GROUP BY ID, t),
{p}_base AS (
  SELECT g.ID, g.t, {", ".join(f'w."{n}"' for n in base)}
  FROM {p}_grid g LEFT JOIN {p}_base_wide w ON g.ID = w.ID AND g.t = w.t)"""


#: Prefix, source and kind of each domain.
DOMAINS = [
    ("lab", "labevents", True), ("outev", "outputevents", True), ("chart", "chartevents", True),
    ("dt", "datetimeevents", True), ("micro", "microbiologyevents", True), ("inp", "inputevents", False),
]

STATIC_CTES = f"""
static_wide AS (
  SELECT ID,
    min(variable_value) FILTER (WHERE variable_name = 'ADMISSION_LOCATION') AS ADMISSION_LOCATION,
    min(variable_value) FILTER (WHERE variable_name = 'ADMISSION_TYPE') AS ADMISSION_TYPE,
    min(variable_value) FILTER (WHERE variable_name = 'AGE') AS AGE,
    min(variable_value) FILTER (WHERE variable_name = 'ETHNICITY') AS ETHNICITY,
    min(variable_value) FILTER (WHERE variable_name = 'GENDER') AS GENDER,
    min(variable_value) FILTER (WHERE variable_name = 'INSURANCE') AS INSURANCE,
    min(variable_value) FILTER (WHERE variable_name = 'LANGUAGE') AS LANGUAGE,
    min(variable_value) FILTER (WHERE variable_name = 'MARITAL_STATUS') AS MARITAL_STATUS,
    min(variable_value) FILTER (WHERE variable_name = 'RELIGION') AS RELIGION
  FROM time_invariant GROUP BY ID)"""

#: Variables of the fixture's domains that pass the prevalence threshold.
VARIABLES = {
    "lab": ([], ["click", "error", "purchase", "signup", "view"]),
    "outev": (["flag_purchase", "flag_signup"], ["vol_view"]),
    "chart": ([], ["hr_click", "hr_view"]),
    "dt": (["dt_line_change"], []),
    "micro": (["culture"], []),
}
#: Values of the encoded static attributes in the sf0.01 tables.
STATIC_VALUES = {
    "ADMISSION_LOCATION": [f"NATION_{i}" for i in range(25)],
    "ADMISSION_TYPE": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "ETHNICITY": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
    "GENDER": ["F", "M"],
    "INSURANCE": sorted(INSURANCE_VALUES),
    "LANGUAGE": ["ENGL", "SPAN"],
    "MARITAL_STATUS": sorted(MARITAL_VALUES),
    "RELIGION": sorted(RELIGION_VALUES),
}


def static_table() -> str:
    dummies = ", ".join(
        f'CAST(coalesce({attr} = \'{v}\', false) AS INTEGER) AS "{attr}_{v}"' for attr, values in STATIC_VALUES.items() for v in values
    )
    return f"""
static AS (SELECT ID, round({parse_numeric_sql('AGE')}, 6) AS AGE, {dummies} FROM static_wide)"""


def _parts(*texts: str) -> dict[str, str]:
    """CTE name to its text, in order; every CTE starts a line."""
    found: dict[str, str] = {}
    for text in texts:
        cuts = [*re.finditer(r"(?m)^(\w+) AS \(", text)]
        for m, end in zip(cuts, [*(x.start() for x in cuts[1:]), len(text)], strict=False):
            found[m[1]] = text[m.start(): end].strip().rstrip(",")
    return found


CTES = _parts(
    FIXTURE_CTES,
    *[domain_ctes(p, source, point) for p, source, point in DOMAINS],
    *[domain_wide(p, *variables) for p, variables in VARIABLES.items()],
    STATIC_CTES,
    static_table(),
)


def q(body: str, more: str = "") -> str:
    """``body`` with the CTEs that it uses, directly or through others."""
    known = CTES | _parts(more)
    wanted, todo = set(), [body]
    while todo:
        for name in set(re.findall(r"\w+", todo.pop())) & known.keys() - wanted:
            wanted.add(name)
            todo.append(known[name])
    return "WITH " + ",\n".join(text for name, text in known.items() if name in wanted) + "\n" + body
