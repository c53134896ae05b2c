"""Hourly pivot onto an (entity, hour) grid."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoframe.functions import quote
from chronoframe.operators.events import ID, VAL, VAR, usable_cube_row

@dataclass
class HourlyStats:
    """What planning a domain needs on the driver: its variable names (one
    output column each) and their binary / non-binary kind. The distinct hours
    stay a table."""

    names: list
    binary: list
    other: list
    hours: DataFrame | None = None
    n_ids: int | None = None  # the domain's entities (sizes the grid)


def is_binary(value):
    """Aggregate: the distinct non-null values are exactly 0 and 1."""
    odd = F.max(F.when(value.isNotNull() & ~value.isin(0, 1), 1).otherwise(0))
    return F.coalesce((F.min(value) == 0) & (F.max(value) == 1) & (odd == 0), F.lit(False))


def hourly_stats(hourly: DataFrame) -> HourlyStats:
    """:class:`HourlyStats` of one domain's hourly means, in one aggregate
    (per variable this equals classifying the wide base table's column)."""
    seen = hourly.where(F.col(VAL).isNotNull() & F.col(VAR).isNotNull())
    facts = seen.groupBy(VAR).agg(is_binary(F.col(VAL)).alias("is_binary")).collect()
    names = sorted(r[VAR] for r in facts)
    binary = sorted(r[VAR] for r in facts if r["is_binary"])
    return HourlyStats(names, binary, [n for n in names if n not in binary], distinct_hours(hourly))


def plan_from_cube(cube: DataFrame, names: list[str], denominator: str = "LABEVENTS", threshold: float = 0.05
                   ) -> tuple[DataFrame, dict[str, HourlyStats]]:
    """Prevalence filter and planning facts of the domains in ``names``.

    Returns the kept (domain, variable) pairs as a table (for a semi join) and
    the facts of each domain. The threshold is applied in Spark; what reaches
    the driver is one row per domain and one per kept variable with a value
    from the origin on, each of which becomes a column of the result.
    """
    totals = {r["domain"]: r["n_ids"] for r in cube.groupBy("domain").agg(F.countDistinct(ID).alias("n_ids")).collect()}
    total = totals.get(denominator, 0)
    share = F.col("n_ids") / F.lit(float(total)) if total else F.lit(None).cast("double")
    pairs = cube.where(F.col(VAR).isNotNull()).select("domain", ID, VAR).distinct()
    kept = pairs.groupBy("domain", VAR).agg(F.count(F.lit(1)).alias("n_ids")).where(share >= threshold).select("domain", VAR)
    usable = cube.where(usable_cube_row() & F.col("domain").isin(names)).join(kept, ["domain", VAR], "left_semi")
    facts = usable.groupBy("domain", VAR).agg(is_binary(F.col("s") / F.col("n")).alias("is_binary")).collect()
    stats = {}
    for d in names:
        mine = [r for r in facts if r["domain"] == d]
        found = sorted(r[VAR] for r in mine)
        binary = sorted(r[VAR] for r in mine if r["is_binary"])
        stats[d] = HourlyStats(found, binary, [n for n in found if n not in binary], n_ids=totals.get(d, 0))
    return kept, stats


def variable_names(df: DataFrame) -> list[str]:
    """Sorted distinct variable names; each is one output column."""
    return sorted(r[VAR] for r in df.select(VAR).where(F.col(VAR).isNotNull()).distinct().collect())


def distinct_hours(df: DataFrame) -> DataFrame:
    """The domain's distinct hours, a table with column ``t``."""
    return df.select("t").where(F.col("t").isNotNull()).distinct()


# Target rows per grid partition when the dense grid is generated.
GRID_ROWS_PER_PARTITION = 1_000_000


# Buckets over which the grid deals the hours, and entities of one part.
GRID_BUCKETS, GRID_ENTITIES = 64, 4096


def reference_grid(hourly: DataFrame, id_col: str = ID, hours: DataFrame | list | None = None,
                   n_ids: int | None = None) -> DataFrame:
    """Every entity of the domain × every distinct hour of the domain.

    The result is all pairs by definition. Entities are dealt into parts of about
    ``GRID_ENTITIES`` (by their number ``n_ids`` if known), hours into buckets;
    both are copied to the (part, bucket) keys that they belong to and joined
    there, so neither list is held on the driver or in one task, and a key's rows
    stay the same however many entities there are. A short list
    of hours that the caller already has is exploded per entity instead, over
    an explicit number of partitions sized from the grid.
    """
    ids = hourly.select(id_col).distinct()
    if isinstance(hours, list):
        if not hours:
            return hourly.select(id_col, "t").limit(0)
        n_ids = ids.count() if n_ids is None else n_ids
        parts = max(hourly.sparkSession.sparkContext.defaultParallelism, -(-n_ids * len(hours) // GRID_ROWS_PER_PARTITION))
        listed = F.array(*[F.lit(h) for h in hours]).cast(f"array<{dict(hourly.dtypes)['t']}>")
        # round-robin: a hash repartition on the id would be merged into the
        # distinct's own exchange and then coalesced
        return ids.repartition(parts).select(id_col, F.explode(listed).alias("t"))
    hours = distinct_hours(hourly) if hours is None else hours
    bucket = F.pmod(F.xxhash64("t"), F.lit(GRID_BUCKETS)).cast("int").alias("_bucket")
    parts = 64 if n_ids is None else max(1, -(-n_ids // GRID_ENTITIES))
    part = F.pmod(F.xxhash64(id_col), F.lit(parts)).cast("int").alias("_part")
    spread = ids.select(id_col, part, F.explode(F.sequence(F.lit(0), F.lit(GRID_BUCKETS - 1))).alias("_bucket"))
    dealt = hours.select("t", bucket, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_part"))
    return spread.join(dealt, ["_part", "_bucket"]).select(id_col, "t")


def by_name(long: DataFrame, keys: list[str], value, name: str = "_m") -> DataFrame:
    """One row per key with a map from variable name to ``value``: a narrow
    aggregate, whose partial rows hold only the variables they saw."""
    return long.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.col(VAR), value))).alias(name))


def pivot_observed(hourly: DataFrame, names: list[str] | None = None, id_col: str = ID) -> DataFrame:
    """Wide (id, t) rows where at least one variable is observed; hourly rows
    are unique per (id, variable, t)."""
    if names is None:
        names = variable_names(hourly)
    if not names:
        return hourly.select(id_col, "t").distinct()
    maps = by_name(hourly.where(F.col(VAR).isin(names)), [id_col, "t"], F.col(VAL))
    return maps.select(id_col, "t", *[F.col("_m")[F.lit(n)].alias(n) for n in names])


def pivot_hourly(hourly: DataFrame, names: list[str] | None = None, grid: str | DataFrame = "reference",
                 id_col: str = ID, hours: DataFrame | list | None = None, n_ids: int | None = None) -> DataFrame:
    """Hourly long means → wide table, one double column per variable.

    ``grid="reference"`` reproduces the reference's dense entity × distinct
    hour product (unobserved cells null); ``"observed"`` keeps only observed
    rows; a DataFrame of keys left-joins the features onto those keys.
    """
    if names is None:
        names = variable_names(hourly)
    wide = pivot_observed(hourly, names, id_col)
    if isinstance(grid, DataFrame):
        keys = grid
    elif grid == "reference":
        keys = reference_grid(hourly, id_col, hours=hours, n_ids=n_ids)
    elif grid == "observed":
        return wide
    else:
        raise ValueError(f"unknown grid policy {grid!r}")
    return keys.select(id_col, "t").join(wide, [id_col, "t"], "left")


def narrow_types(df: DataFrame, keys: tuple[str, ...] = (ID, "t"), tolerance: float = 1e-6) -> DataFrame:
    """Optional storage narrowing (P11): integral columns without a null →
    int/bigint, others → float when float rounding stays within ``tolerance``.

    One aggregate pass computes every column's facts. Changes values within the
    tolerance, so it is never applied inside the pipeline.
    """
    kinds = dict(df.dtypes)
    cols = [c for c in df.columns if c not in keys and kinds[c] in ("double", "float")]
    if not cols:
        return df
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(quote(c))
        aggs += [
            F.min(x).alias(f"min{i}"),
            F.max(x).alias(f"max{i}"),
            F.bool_and(x.isNotNull() & (x == F.floor(x))).alias(f"int{i}"),
            F.max(F.abs(x - x.cast("float").cast("double"))).alias(f"err{i}"),
        ]
    facts = df.agg(*aggs).first()
    out = []
    for c in df.columns:
        x = F.col(quote(c))
        if c in cols:
            i = cols.index(c)
            lo, hi, err = facts[f"min{i}"], facts[f"max{i}"], facts[f"err{i}"]
            if facts[f"int{i}"] and -2**31 <= lo and hi < 2**31:
                x = x.cast("int")
            elif facts[f"int{i}"] and -2**63 <= lo and hi < 2**63:
                x = x.cast("bigint")
            elif err is None or err <= tolerance:
                x = x.cast("float")
        out.append(x.alias(c))
    return df.select(*out)
