"""Type conversions with explicit failure behaviour (TYP-01, FLT-04, ids).

Invoice ids are documented as strings holding digits.  Comparing or taking
the max of the raw string is lexicographic ('9999' > '10000'), and under ANSI
a plain cast raises on the first non-numeric id.  ``numeric_id`` uses
``try_cast``: a non-numeric id becomes NULL, drops out of the delta filter
and the mark, and can be listed by ``reject_non_numeric``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text the reference treats like a missing watermark.
NULL_TEXT = "null"

_INT_PATTERN = r"^\s*[+-]?[0-9]+\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_id(c) -> Column:
    """String id as BIGINT; NULL when it is not an integer."""
    return _col(c).try_cast("bigint")


def bool_text(c) -> Column:
    """Boolean as 'true' / 'false'; NULL stays NULL."""
    return _col(c).cast("string")


def clean_watermark(c) -> Column:
    """Stored watermark text to BIGINT: NULL or exactly 'null' give 0, digits
    (surrounding blanks allowed) parse, anything else raises (never 0, which
    would reload everything)."""
    v = _col(c)
    return (
        F.when(v.isNull() | (v == F.lit(NULL_TEXT)), F.lit(0).cast("bigint"))
        .when(v.rlike(_INT_PATTERN), F.trim(v).cast("bigint"))
        .otherwise(F.raise_error(F.concat(F.lit("non-numeric watermark: "), v)).cast("bigint"))
    )


def parse_watermark(value) -> int:
    """Driver-side twin of ``clean_watermark`` for the one collected control value."""
    if value is None or value == NULL_TEXT:
        return 0
    return int(str(value).strip())  # raises ValueError on anything non-numeric
