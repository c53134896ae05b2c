"""Per-entity time features.

Two routes compute the 12-hour rolling statistics:

* ``rolling_features``: a range window ``(t-12, t]`` per entity over a grid;
  one sort per entity, output row per grid row.
* ``rolling_features_explode``: each hourly observation is copied to the
  hours t..t+11 it influences and the copies are grouped by (entity, hour).
  No per-entity sort, no shuffle of the copies, and an entity holding a
  third of the rows is spread over its hours. Output only where a window
  holds data; join it to the grid / skeleton you need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoframe.functions import quote
from chronoframe.operators.events import ID, VAL, VAR
from chronoframe.operators.grid import by_name, is_binary

ROLLING_STATS = ("mean", "std", "max")
#: Hours of a block that an entity's rows are dealt by; rows that a task aggregates.
BLOCK_HOURS, DEALT_ROWS = 240, 1_000_000


def _entity_window(id_col: str = ID):
    return Window.partitionBy(id_col).orderBy("t")


def _running(id_col: str = ID):
    return _entity_window(id_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def feature_columns(df: DataFrame, keys: tuple[str, ...] = (ID, "t")) -> list[str]:
    return [c for c in df.columns if c not in keys]


def classify_columns(df: DataFrame, keys: tuple[str, ...] = (ID, "t")) -> tuple[list[str], list[str]]:
    """Split feature columns into binary and non-binary.

    Binary means the sorted distinct non-null values are exactly [0, 1]: an
    all-0 or all-1 column is not binary, nor is one holding 0.5. One aggregate
    job answers it for every column.
    """
    cols = feature_columns(df, keys)
    if not cols:
        return [], []
    r = df.agg(*[is_binary(F.col(quote(c))).alias(f"b{i}") for i, c in enumerate(cols)]).first()
    binary = [c for i, c in enumerate(cols) if r[f"b{i}"]]
    return binary, [c for c in cols if c not in binary]


def forward_fill(df: DataFrame, cols: list[str] | None = None, id_col: str = ID) -> DataFrame:
    """Last non-null value so far within each entity, ordered by hour."""
    cols = feature_columns(df, (id_col, "t")) if cols is None else cols
    w = _running(id_col)
    return df.withColumns({c: F.last(F.col(quote(c)), ignorenulls=True).over(w) for c in cols})


def cumulative_count_columns(cols: list[str], id_col: str = ID) -> dict[str, object]:
    """Running sum of each binary column, null before its first observation.

    A running ``sum`` ignores nulls and carries the last total over gaps, which
    is the reference's cumsum followed by a forward fill.
    """
    w = _running(id_col)
    return {f"{c}_cumcount": F.sum(F.col(quote(c))).over(w) for c in cols}


def time_since_columns(cols: list[str], id_col: str = ID) -> dict[str, object]:
    """Hours since the last non-null observation of each column (W3); double,
    like every feature column (null before the first observation)."""
    w = _running(id_col)
    return {
        f"{c}_timesince": (
            F.col("t") - F.last(F.when(F.col(quote(c)).isNotNull(), F.col("t")), ignorenulls=True).over(w)
        ).cast("double")
        for c in cols
    }


def cumulative_count(df: DataFrame, cols: list[str], id_col: str = ID) -> DataFrame:
    return df.select(id_col, "t", *[e.alias(n) for n, e in cumulative_count_columns(cols, id_col).items()])


def time_since(df: DataFrame, cols: list[str], id_col: str = ID) -> DataFrame:
    """Keeps the raw columns, as the reference's time-since table does."""
    exprs = time_since_columns(cols, id_col)
    return df.select(id_col, "t", *[F.col(quote(c)) for c in cols], *[e.alias(n) for n, e in exprs.items()])


def rolling_name(stat: str, col: str, period: int = 12) -> str:
    return f"{period}i_{stat}_{col}"


def rolling_columns(cols: list[str], period: int = 12, id_col: str = ID) -> dict[str, object]:
    """Mean, sample std and max over the integer-hour window (t-period, t].

    Nulls are skipped; a window with one value has a null std. Ordered as all
    means, then all stds, then all maxes.
    """
    w = _entity_window(id_col).rangeBetween(-(period - 1), 0)
    fns = {"mean": F.avg, "std": F.stddev_samp, "max": F.max}
    out = {}
    for stat in ROLLING_STATS:
        for c in cols:
            out[rolling_name(stat, c, period)] = fns[stat](F.col(quote(c))).over(w)
    return out


def rolling_features(df: DataFrame, cols: list[str], period: int = 12, id_col: str = ID) -> DataFrame:
    """Window route over a wide grid; raw columns are not kept."""
    exprs = rolling_columns(cols, period, id_col)
    return df.select(id_col, "t", *[e.alias(n) for n, e in exprs.items()])


def dealt_parts(rows: DataFrame, copies: int = 1) -> int:
    """Number of partitions that holds the rows (each copied so often) at
    ``DEALT_ROWS`` apiece; few rows are dealt over the cores."""
    n = rows.count() * copies
    return max(1, -(-n // DEALT_ROWS), min(rows.sparkSession.sparkContext.defaultParallelism, n // 20_000))


def rolling_maps(hourly: DataFrame, period: int = 12, id_col: str = ID, parts: int | None = None) -> DataFrame:
    """Per (id, t) a map ``_roll`` from variable to its (mean, std, max) over
    the hours t-period+1..t; only integer hours are meaningful here.

    Rows are dealt by entity and block of hours, those that reach into the next
    block to both, and copied to their hours there: the copies are never sent,
    and a task's groups are bounded by ``parts`` (from the rows where not given).
    """
    parts = dealt_parts(hourly, period) if parts is None else parts
    size = max(BLOCK_HOURS, period)
    t = F.col("t").cast("bigint")
    start = lambda at: at - F.pmod(at, F.lit(size))
    blocks = F.sequence(start(t), start(t + (period - 1)), F.lit(size).cast("bigint"))
    dealt = hourly.select(id_col, VAR, VAL, t.alias("_t"), F.explode(blocks).alias("_block")).repartition(parts, id_col, "_block")
    first, last = F.greatest(F.col("_t"), F.col("_block")), F.least(F.col("_t") + (period - 1), F.col("_block") + (size - 1))
    shifted = dealt.select(id_col, "_block", VAR, VAL, F.explode(F.sequence(first, last)).alias("t"))
    stats = shifted.groupBy(id_col, "_block", "t", VAR).agg(
        F.avg(VAL).alias("mean"), F.stddev_samp(VAL).alias("std"), F.max(VAL).alias("max")
    )
    return by_name(stats, [id_col, "_block", "t"], F.struct(*ROLLING_STATS), "_roll").drop("_block")


def rolling_features_explode(hourly: DataFrame, names: list[str], period: int = 12,
                             id_col: str = ID) -> DataFrame:
    """Explode route from hourly long rows (id, variable, t, value)."""
    if not names:
        return hourly.select(id_col, F.col("t").cast("bigint").alias("t")).limit(0)
    maps = rolling_maps(hourly.where(F.col(VAR).isin(list(names))), period, id_col)
    return maps.select(id_col, "t", *[
        F.col("_roll")[F.lit(n)][stat].alias(rolling_name(stat, n, period)) for stat in ROLLING_STATS for n in names
    ])


def window_features(base: DataFrame, binary: list[str] | None = None, non_binary: list[str] | None = None,
                    period: int = 12, id_col: str = ID) -> DataFrame:
    """All window features of one domain in a single pass (J6 and J7 vanish).

    Binary columns → raw value, ``_cumcount``, ``_timesince``; the others →
    rolling mean/std/max. With no feature columns the keys are returned.
    """
    if binary is None or non_binary is None:
        binary, non_binary = classify_columns(base, (id_col, "t"))
    exprs: dict[str, object] = {}
    exprs.update(cumulative_count_columns(binary, id_col))
    raw = [F.col(quote(c)) for c in binary]
    exprs_ts = time_since_columns(binary, id_col)
    exprs_roll = rolling_columns(non_binary, period, id_col)
    return base.select(
        id_col,
        "t",
        *[e.alias(n) for n, e in exprs.items()],
        *raw,
        *[e.alias(n) for n, e in exprs_ts.items()],
        *[e.alias(n) for n, e in exprs_roll.items()],
    )
