"""Stage 5: outcome table, hourly skeleton, model matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoframe.functions import floor_hour, hours_between, quote
from chronoframe.operators.events import ID, VAL, VAR
from chronoframe.operators.grid import HourlyStats, by_name, hourly_stats
from chronoframe.operators.windows import ROLLING_STATS, dealt_parts, rolling_maps, rolling_name
from chronoframe.sources.dataset import assert_unique_key


def build_outcome(cohort: DataFrame) -> DataFrame:
    """Stays with a valid outcome (hour of death > 0 or none), plus ``los`` and
    ``cutoff_time`` = floor(min ignoring nulls(hour of death, los))."""
    hod = F.col("HOUR_OF_DEATH")
    df = cohort.where(hod.isNull() | (hod > 0))
    df = df.withColumn("los", hours_between("INTIME", "OUTTIME"))
    return df.withColumn("cutoff_time", floor_hour(F.least(hod, F.col("los"))))


def build_skeleton(outcome: DataFrame, id_col: str = "ICUSTAY_ID", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per stay and hour t = 1..cutoff (G1, W5); cutoff < 1 → no rows.

    A stay that occurs twice raises: its hours would fan out in every later
    join. A narrow explode: each stay yields at most its length of stay in hours.
    ``sequence(1, 0)`` would count down, hence the filter first.
    """
    assert_unique_key(outcome, [id_col])
    cutoff = F.col("cutoff_time")
    return outcome.where(cutoff >= 1).select(
        F.col(id_col).alias(ID),
        cutoff,
        *[F.col(c) for c in keep],
        F.explode(F.sequence(F.lit(1).cast("bigint"), cutoff.cast("bigint"))).alias("t"),
    )


def matrix_features(keys: DataFrame, hourly: DataFrame, stats: dict[str, HourlyStats], period: int = 12) -> DataFrame:
    """The window features of several domains at the (ID, t) rows of ``keys``.

    ``hourly`` is long (domain, ID, variable_name, t, variable_value). Rolling
    statistics of all domains become one map per (ID, t); binary variables one
    map per observed hour. Key rows, rolling rows and binary rows are unioned
    and split by ID once; a single window pass then brings the rolling map to
    its hour and runs counts and times over the binary values (range frames,
    so rows at one hour see each other in any order). A domain has features at
    (ID, t) only where ID is one of its entities and t one of its hours, as in
    the reference's grid; elsewhere its columns are null. The dense grid is
    never built. Other columns of ``keys`` come along.
    """
    names = [n for st in stats.values() for n in st.names]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"variables in more than one domain: {clash}")
    binary = [n for st in stats.values() for n in st.binary]
    rows = hourly.where(F.col("domain").isin(list(stats))).withColumn("t", F.col("t").cast("bigint"))
    hours = rows.groupBy("t").agg(F.collect_set("domain").alias("_hours"))
    entities = rows.groupBy(ID).agg(F.collect_set("domain").alias("_entities"))
    payload = [c for c in keys.columns if c not in (ID, "t")]
    at = keys.withColumn("t", F.col("t").cast("bigint")).join(hours, "t", "left")
    at = at.select(ID, "t", F.struct(F.lit(1).alias("_one"), *[F.col(quote(c)) for c in payload], "_hours").alias("_key"))
    # a number from the rows: the session's own need not grow with the data
    parts = dealt_parts(rows, period)
    rolled = rolling_maps(rows.where(~F.col(VAR).isin(binary)), period, parts=parts)
    seen = by_name(rows.where(F.col(VAR).isin(binary)), [ID, "t"], F.col(VAL), "_bin")
    u = at.unionByName(rolled, allowMissingColumns=True).unionByName(seen, allowMissingColumns=True).repartition(parts, ID)
    w = Window.partitionBy(ID).orderBy("t")
    upto, same = w.rangeBetween(Window.unboundedPreceding, 0), w.rangeBetween(0, 0)
    cols = [F.first("_roll", ignorenulls=True).over(same).alias("_roll")]
    for i, n in enumerate(binary):
        x = F.col("_bin")[F.lit(n)]
        cols += [
            F.sum(x).over(upto).alias(f"_c{i}"), F.max(x).over(same).alias(f"_x{i}"),
            (F.col("t") - F.max(F.when(x.isNotNull(), F.col("t"))).over(upto)).cast("double").alias(f"_s{i}"),
        ]
    # one split by ID: the entity join below reads it as it stands
    wide = u.select(ID, "t", "_key", *cols).where(F.col("_key").isNotNull()).join(entities, ID, "left")
    out = [F.col(ID), F.col("t"), *[F.col("_key")[c].alias(c) for c in payload]]
    for d, st in stats.items():
        here = F.array_contains("_entities", d) & F.array_contains("_key._hours", d)
        at_binary = [(n, binary.index(n)) for n in st.binary]
        out += [F.when(here, F.col(f"_c{i}")).alias(f"{n}_cumcount") for n, i in at_binary]
        out += [F.when(here, F.col(f"_x{i}")).alias(n) for n, i in at_binary]
        out += [F.when(here, F.col(f"_s{i}")).alias(f"{n}_timesince") for n, i in at_binary]
        out += [F.when(here, F.col("_roll")[F.lit(n)][k]).alias(rolling_name(k, n, period)) for k in ROLLING_STATS for n in st.other]
    return wide.select(*out)


def domain_features_at(hourly: DataFrame, keys: DataFrame, period: int = 12, id_col: str = ID,
                       stats: HourlyStats | None = None) -> DataFrame:
    """:func:`matrix_features` of one domain at the given (id, t) keys that lie
    on its grid."""
    stats = hourly_stats(hourly) if stats is None else stats
    long = hourly.select(F.lit("domain").alias("domain"), F.col(id_col).alias(ID), VAR, "t", VAL)
    on_grid = keys.select(id_col, F.col("t").cast("bigint").alias("t")).join(hourly.select(id_col).distinct(), id_col, "left_semi")
    on_grid = on_grid.join(hourly.select(F.col("t").cast("bigint").alias("t")).distinct(), "t", "left_semi")
    return matrix_features(on_grid.select(F.col(id_col).alias(ID), "t"), long, {"domain": stats}, period).withColumnRenamed(ID, id_col)


def add_static(rows: DataFrame, static: DataFrame, id_col: str = ID) -> DataFrame:
    """Rows ⟕ static on id (J3); the static side is unique on its key. A shared
    column name raises instead of pandas' suffixes."""
    clash = (set(static.columns) - {id_col}) & set(rows.columns)
    if clash:
        raise ValueError(f"static columns collide: {sorted(clash)}")
    return rows.join(static, id_col, "left")
