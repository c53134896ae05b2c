"""Scalar column expressions (all JVM-side, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_US_PER_HOUR = 3.6e9
_US_PER_YEAR = 1e6 * 3600 * 24 * 365.25


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hours_between(start, end) -> Column:
    """Fractional hours from ``start`` to ``end`` (negative when end < start).

    Microsecond difference, so 300-year spans do not overflow.
    """
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(_US_PER_HOUR)


def age_years(birth, at) -> Column:
    """Age in years of 365.25 days between two timestamps."""
    return F.timestamp_diff("MICROSECOND", _col(birth), _col(at)) / F.lit(_US_PER_YEAR)


def plus_hours(ts, hours: int) -> Column:
    """Timestamp shifted by a whole number of hours."""
    return _col(ts) + F.make_dt_interval(F.lit(0), F.lit(hours))


# Fixed grammar of numeric text (values that must parse like the reference's
# coercion): optional sign, digits with an optional fraction or a leading-dot
# fraction, optional exponent; or an infinity word. Everything else is null.
NUMBER_PATTERN = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"


def parse_numeric(c) -> Column:
    """Text → double with bad text as null (never throws under ANSI mode).

    Accepts surrounding blanks, decimal and exponent forms and ``inf``;
    rejects ``nan``, hex, digit separators and the ``1d``/``1f`` suffixes that
    Spark's own cast would accept. Numeric input columns pass through (NaN →
    null). One regex test per value.
    """
    c = _col(c)
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def floor_hour(c) -> Column:
    return F.floor(_col(c)).cast("bigint")


def ceil_hour(c) -> Column:
    return F.ceil(_col(c)).cast("bigint")


def not_true(cond: Column) -> Column:
    """Negation with pandas' null semantics: a null comparison counts as False,
    so its negation keeps the row."""
    return ~F.coalesce(cond, F.lit(False))
