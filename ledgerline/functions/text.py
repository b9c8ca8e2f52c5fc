"""String and arithmetic helpers (STR-01, MTH-01)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def join_names(*parts, sep: str = " ") -> Column:
    """Join strings with ``sep``, skipping NULL parts (no stray separators)."""
    return F.concat_ws(sep, *[_col(p) for p in parts])


def times(c, n) -> Column:
    """Column times a literal (ANSI: BIGINT overflow raises)."""
    return _col(c) * F.lit(n)
