"""Window features without a task per entity.

An entity's hours are cut into segments. Running values (``segmented_*``) are a
scan of each segment for itself, plus a carry: one row per segment with its
totals, run along the entity's few segments. Both the scan and the join with
the carry are split by (entity, segment), so an entity that holds a third of all
rows is spread over tasks, and only the segments' totals meet in one.

Rolling statistics (``rolling_block_maps``) cut the hours into blocks as long as
the window. The window that ends at an hour is the block's values up to it and
the block before's values after it: an observation is sent to two groups, its
own block and the next, instead of to every hour that its window reaches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoframe.functions import quote
from chronoframe.operators.events import ID, VAL, VAR
from chronoframe.operators.grid import by_name
from chronoframe.operators.windows import ROLLING_STATS, feature_columns, rolling_name

#: Hours of a segment.
SEGMENT = 1024


def _segmented(df: DataFrame, hours: int, id_col: str, local: dict[str, Column], totals: dict[str, Column], before: dict[str, Column]) -> DataFrame:
    """``df`` with the scan of each segment (``local``, over the window given to
    it) and the carry of the segments before (``before`` over ``totals``)."""
    rows = df.withColumn("_segment", F.floor(F.col("t") / hours))
    carry = rows.groupBy(id_col, "_segment").agg(*[c.alias(n) for n, c in totals.items()])
    carry = carry.select(id_col, "_segment", *[c.alias(n) for n, c in before.items()])
    rows = rows.select("*", *[c.alias(n) for n, c in local.items()])
    return rows.join(carry, [id_col, "_segment"])


def _upto(id_col: str):
    return Window.partitionBy(id_col, "_segment").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _earlier(id_col: str):
    return Window.partitionBy(id_col).orderBy("_segment").rowsBetween(Window.unboundedPreceding, -1)


def segmented_fill(df: DataFrame, cols: list[str] | None = None, id_col: str = ID, hours: int = SEGMENT) -> DataFrame:
    """Forward fill: equals :func:`windows.forward_fill` on rows unique in (id, t)."""
    cols = feature_columns(df, (id_col, "t")) if cols is None else cols
    at = list(enumerate(cols))
    x = [F.col(quote(c)) for c in cols]
    out = _segmented(
        df, hours, id_col,
        {f"_l{i}": F.last(x[i], ignorenulls=True).over(_upto(id_col)) for i, _ in at},
        {f"_t{i}": F.max_by(x[i], F.when(x[i].isNotNull(), F.col("t"))) for i, _ in at},
        {f"_c{i}": F.last(f"_t{i}", ignorenulls=True).over(_earlier(id_col)) for i, _ in at},
    )
    number = {c: i for i, c in at}
    return out.select(*[F.coalesce(f"_l{number[c]}", f"_c{number[c]}").alias(c) if c in number else F.col(quote(c)) for c in df.columns])


def segmented_count(df: DataFrame, cols: list[str], id_col: str = ID, hours: int = SEGMENT) -> DataFrame:
    """Running sums: equals :func:`windows.cumulative_count`."""
    at = list(enumerate(cols))
    x = [F.col(quote(c)) for c in cols]
    out = _segmented(
        df, hours, id_col,
        {f"_l{i}": F.sum(x[i]).over(_upto(id_col)) for i, _ in at},
        {f"_t{i}": F.sum(x[i]) for i, _ in at}, {f"_c{i}": F.sum(f"_t{i}").over(_earlier(id_col)) for i, _ in at},
    )
    total = [F.coalesce(F.col(f"_l{i}") + F.col(f"_c{i}"), F.col(f"_l{i}"), F.col(f"_c{i}")) for i, _ in at]
    return out.select(id_col, "t", *[total[i].alias(f"{c}_cumcount") for i, c in at])


def segmented_since(df: DataFrame, cols: list[str], id_col: str = ID, hours: int = SEGMENT) -> DataFrame:
    """Hours since the last value: equals :func:`windows.time_since`."""
    at = list(enumerate(cols))
    seen = [F.when(F.col(quote(c)).isNotNull(), F.col("t")) for c in cols]
    out = _segmented(
        df, hours, id_col,
        {f"_l{i}": F.max(seen[i]).over(_upto(id_col)) for i, _ in at},
        {f"_t{i}": F.max(seen[i]) for i, _ in at}, {f"_c{i}": F.max(f"_t{i}").over(_earlier(id_col)) for i, _ in at},
    )
    since = [(F.col("t") - F.coalesce(f"_l{i}", f"_c{i}")).cast("double") for i, _ in at]
    return out.select(id_col, "t", *[F.col(quote(c)) for c in cols], *[since[i].alias(f"{c}_timesince") for i, c in at])


def rolling_block_maps(hourly: DataFrame, period: int = 12, id_col: str = ID) -> DataFrame:
    """Per (id, t) a map ``_roll`` from variable to its (mean, std, max) over the
    hours t-period+1..t: as :func:`windows.rolling_maps`, from two copies of an
    observation instead of ``period``.

    A group has the values of its block and of the one before, a place each
    (rows of one hour are taken together first). The ends of the two are folded
    to running counts, means, squares and maxima once; an hour's window is one
    prefix and one suffix put together.
    """
    t = F.col("t").cast("bigint")
    block = F.floor(t / period)
    moments = [F.count(VAL).alias("n"), F.avg(VAL).alias("m"), (F.var_pop(VAL) * F.count(VAL)).alias("q"), F.max(VAL).alias("x")]
    at_hour = F.struct("k", "n", "m", "q", "x")
    copies = hourly.where(F.col(VAL).isNotNull()).select(
        id_col, VAR, VAL, F.explode(F.array(
            F.struct(block.alias("b"), (t - block * period + period).cast("int").alias("k")),
            F.struct((block + 1).alias("b"), (t - block * period).cast("int").alias("k")),
        )).alias("at"),
    ).select(id_col, VAR, VAL, "at.b", "at.k")
    hours = copies.groupBy(id_col, VAR, "b", "k").agg(*moments)
    groups = hours.groupBy(id_col, VAR, "b").agg(F.collect_list(at_hour).alias("v"))
    # the places 0 .. 2 period - 1 of two blocks; the window of place e has e - period + 1 .. e
    kind = "array<struct<n:bigint,m:double,q:double,x:double>>"
    none = "named_struct('n', 0L, 'm', 0D, 'q', 0D, 'x', CAST(NULL AS DOUBLE))"

    def joined(a: str, b: str) -> str:
        """Count, mean, squares about it and maximum of both parts."""
        n = f"({a}.n + {b}.n)"
        return (
            f"IF({a}.n = 0, {b}, IF({b}.n = 0, {a}, named_struct('n', {n}, 'm', {a}.m + ({b}.m - {a}.m) * {b}.n / {n}, "
            f"'q', {a}.q + {b}.q + ({b}.m - {a}.m) * ({b}.m - {a}.m) * {a}.n * {b}.n / {n}, 'x', greatest({a}.x, {b}.x))))"
        )

    def running(places: str) -> str:
        """What each of some places and all before it hold together."""
        merged = joined("element_at(acc, -1)", "coalesce(seen[k], none)")
        return f"slice(aggregate({places}, CAST(array(none) AS {kind}), (acc, k) -> concat(acc, array({merged}))), 2, {period})"

    spread = groups.selectExpr(
        f"`{id_col}`", VAR, "b", f"{none} AS none", "map_from_entries(transform(v, x -> struct(x.k, struct(x.n, x.m, x.q, x.x)))) AS seen"
    )
    ends = spread.selectExpr(
        f"`{id_col}`", VAR, "b", "none", f"{running(f'sequence({period}, {2 * period - 1})')} AS own",
        # from the end of the block before backwards
        f"{running(f'sequence({period - 1}, 0, -1)')} AS past",
    )
    at = ends.selectExpr(
        f"`{id_col}`", VAR, "b", f"posexplode(transform(own, (o, i) -> IF(i = {period - 1}, struct(o AS a, none AS b), struct(o AS a, past[{period - 2} - i] AS b)))) AS (i, w)"
    )
    stats = at.selectExpr(f"`{id_col}`", VAR, f"b * {period} + i AS t", f"{joined('w.a', 'w.b')} AS s").where("s.n > 0").selectExpr(
        f"`{id_col}`", VAR, "t", "s.m AS mean", "IF(s.n > 1, sqrt(s.q / (s.n - 1)), NULL) AS std", "s.x AS max"
    )
    return by_name(stats, [id_col, "t"], F.struct(*ROLLING_STATS), "_roll")


def rolling_features_blocks(hourly: DataFrame, names: list[str], period: int = 12, id_col: str = ID) -> DataFrame:
    """Block route from hourly long rows (id, variable, t, value)."""
    if not names:
        return hourly.select(id_col, F.col("t").cast("bigint").alias("t")).limit(0)
    maps = rolling_block_maps(hourly.where(F.col(VAR).isin(list(names))), period, id_col)
    return maps.select(id_col, "t", *[
        F.col("_roll")[F.lit(n)][stat].alias(rolling_name(stat, n, period)) for stat in ROLLING_STATS for n in names
    ])
