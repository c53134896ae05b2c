from chronoframe.functions.expressions import (
    age_years,
    ceil_hour,
    floor_hour,
    hours_between,
    not_true,
    parse_numeric,
    plus_hours,
)
from chronoframe.functions.names import quote, sanitize_columns, sanitize_name

__all__ = [
    "age_years", "ceil_hour", "floor_hour", "hours_between",
    "not_true", "parse_numeric", "plus_hours", "quote", "sanitize_columns",
    "sanitize_name",
]
