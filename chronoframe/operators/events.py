"""Stage 2-3 row operators on long event domains.

A domain is a long DataFrame ``ID, t, variable_name, variable_value`` (point
form) or ``ID, t_start, t_end, variable_name, variable_value`` (interval
form).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoframe.functions import ceil_hour, parse_numeric

ID = "ID"
VAR = "variable_name"
VAL = "variable_value"

def time_column(df: DataFrame) -> str:
    """``t`` for point domains, ``t_start`` for interval domains."""
    if "t" in df.columns:
        return "t"
    if "t_start" in df.columns:
        return "t_start"
    raise ValueError(f"domain has neither t nor t_start: {df.columns}")


def distinct_entities(df: DataFrame, id_col: str = ID) -> int:
    """Number of distinct non-null entity ids (A1)."""
    return df.agg(F.countDistinct(id_col).alias("n")).first()["n"]


def variable_prevalence(df: DataFrame, total: int | None = None, id_col: str = ID) -> DataFrame:
    """Share of entities with at least one row of each variable (A2/A3).

    ``total`` is the denominator (distinct entities of the reference domain);
    ``None`` uses the domain's own distinct ids (A3). Distinct (id, variable)
    pairs are formed first, so the shuffle is keyed by the pair and a variable
    held by a third of all rows does not land in one task.
    """
    if total is None:
        total = distinct_entities(df, id_col)
    pairs = df.select(id_col, VAR).where(F.col(VAR).isNotNull()).distinct()
    counts = pairs.groupBy(VAR).agg(F.count(F.lit(1)).alias("n_ids"))
    return counts.select(
        VAR, "n_ids", (F.col("n_ids") / F.lit(float(total)) if total else F.lit(None).cast("double")).alias("prevalence")
    )


def keep_variables(df: DataFrame, names: DataFrame) -> DataFrame:
    """Membership filter on the variable name (P5): a semi join."""
    return df.join(names.select(VAR), VAR, "left_semi")


def filter_from_origin(df: DataFrame) -> DataFrame:
    """Rows at or after the time origin (P4); null times are dropped."""
    return df.where(F.col(time_column(df)) >= 0)


def filter_prevalent(domains: dict[str, DataFrame], denominator_domain: str = "LABEVENTS",
                     threshold: float = 0.05, domains_to_filter: list[str] | None = None,
                     id_col: str = ID) -> dict[str, DataFrame]:
    """Stage 2: keep frequent variables, then rows from the origin on.

    Prevalence uses the distinct entities of ``denominator_domain`` for every
    domain and is computed before the time filter. The kept names never leave
    Spark: the filter is a semi join with the prevalence table.
    Domains not listed in ``domains_to_filter`` (default: all but
    ``TIME_INVARIANT``) pass through.
    """
    if domains_to_filter is None:
        domains_to_filter = [d for d in domains if d != "TIME_INVARIANT"]
    total = distinct_entities(domains[denominator_domain], id_col)
    out = dict(domains)
    for name in domains_to_filter:
        kept = variable_prevalence(domains[name], total, id_col).where(F.col("prevalence") >= threshold)
        out[name] = filter_from_origin(keep_variables(domains[name], kept))
    return out


def cube_rows(df: DataFrame, name: str, id_col: str = ID) -> DataFrame:
    """A domain's rows as the cube reads them: hour, whether at or after the
    origin, and the number that the value holds."""
    tcol = time_column(df)
    hour = ceil_hour(tcol) if tcol == "t" else F.col(tcol)
    return df.select(F.lit(name).alias("domain"), F.col(id_col).alias(ID), VAR, hour.cast("double").alias("t"),
                     (F.col(tcol) >= 0).alias("ok"), parse_numeric(VAL).alias("v"))


def hourly_cube(domains: dict[str, DataFrame], names: list[str], id_col: str = ID) -> DataFrame:
    """:func:`cube_of` the union of several domains."""
    parts = [cube_rows(domains[n], n, id_col) for n in names]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return cube_of(u)


def cube_of(rows: DataFrame) -> DataFrame:
    """One pass over the raw rows of many domains (A1-A4 fused).

    Groups by (domain, id, variable, hour, t ≥ 0) with the sum and count of
    the parseable values. Prevalence (every row, any time, any value) and the
    hourly means (rows from the origin with a number) both come from this
    small table; map-side partial aggregation shrinks the shuffle. Hours are
    stored as double (exact for whole hours) so point and interval domains
    share a schema.
    """
    return rows.groupBy("domain", ID, VAR, "t", "ok").agg(F.sum("v").alias("s"), F.count("v").alias("n"))


def usable_cube_row():
    """A cube row from the origin on with every key and a value."""
    return (F.col("ok") & (F.col("n") > 0) & F.col(ID).isNotNull() & F.col("t").isNotNull() & F.col(VAR).isNotNull())


def hourly_long(cube: DataFrame, kept: DataFrame) -> DataFrame:
    """Hourly means of every domain in the cube, kept variables only: rows from
    the origin with a value; mean = sum / count (exactly Spark's ``avg``)."""
    c = cube.where(usable_cube_row()).join(kept, ["domain", VAR], "left_semi")
    return c.select("domain", ID, VAR, "t", (F.col("s") / F.col("n")).alias(VAL))


def hourly_from_cube(cube: DataFrame, domain: str, kept: DataFrame, point: bool = True, id_col: str = ID) -> DataFrame:
    """:func:`hourly_long` of one domain, hours whole in a point domain."""
    c = hourly_long(cube.where(F.col("domain") == domain), kept)
    t = F.col("t").cast("bigint") if point else F.col("t")
    return c.select(F.col(ID).alias(id_col), VAR, t.alias("t"), VAL)


def coerce_numeric(df: DataFrame, column: str = VAL) -> DataFrame:
    """Value text → double, unparseable → null."""
    return df.withColumn(column, parse_numeric(column))


def to_point_events(df: DataFrame) -> DataFrame:
    """Hour index of each row.

    Point form: ``t = ceil(t)``. Interval form: ``t = t_start`` unchanged (no
    ceiling), ``t_start``/``t_end`` dropped.
    """
    if "t" in df.columns:
        return df.withColumn("t", ceil_hour("t"))
    return df.withColumn("t", F.col("t_start")).drop("t_start", "t_end")


def hourly_mean(df: DataFrame, id_col: str = ID) -> DataFrame:
    """Mean value per (id, variable, hour) (A4); partial aggregation map-side."""
    return df.groupBy(id_col, VAR, "t").agg(F.avg(VAL).alias(VAL))


def prepare_hourly(df: DataFrame, id_col: str = ID) -> DataFrame:
    """to_point_events → coerce_numeric → drop rows with any null → hourly_mean."""
    pts = coerce_numeric(to_point_events(df)).select(id_col, "t", VAR, VAL)
    return hourly_mean(pts.na.drop("any"), id_col)
