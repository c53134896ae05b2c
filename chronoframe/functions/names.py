"""Column-name helpers."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def sanitize_name(name: str) -> str:
    """Every character other than a letter or digit becomes ``_``."""
    return re.sub(r"\W", "_", str(name))


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`sanitize_name`; raise on a collision."""
    new = [sanitize_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(f"columns {seen[n]!r} and {old!r} both sanitize to {n!r}")
        seen[n] = old
    return df.toDF(*new)


def quote(name: str) -> str:
    """Back-quote a column name for ``F.col`` / SQL use."""
    return "`" + name.replace("`", "``") + "`"
