"""Epoch seconds to analyst-ready date text (DT-01, DT-02, DT-03).

The zone is an explicit argument.  ``from_unixtime`` reads the session zone
when the plan is analysed, so a DataFrame built before a ``spark.conf.set`` of
the zone silently keeps the old one; the zone-explicit recipe below never
depends on the session:

    epoch -> TIMESTAMP_NTZ wall clock in UTC -> convert_timezone(UTC, tz)
          -> date_format

Every step is a built-in expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Output format of every date column, and the default zone.
DATE_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
DEFAULT_TZ = "UTC"

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_utc_wall(epoch) -> Column:
    """Epoch seconds as a TIMESTAMP_NTZ holding the UTC wall clock."""
    return F.timestamp_add("SECOND", _col(epoch), F.expr(_EPOCH_NTZ))


def format_epoch(epoch, tz: str | None = DEFAULT_TZ, fmt: str = DATE_FORMAT) -> Column:
    """Format epoch seconds as text in zone ``tz``; NULL stays NULL.

    ``tz=None`` keeps the reference's behaviour: ``from_unixtime`` in the
    session zone.
    """
    if tz is None:
        return F.from_unixtime(_col(epoch), fmt)
    wall = epoch_to_utc_wall(epoch)
    if tz.upper() not in ("UTC", "Z", "+00:00", "GMT"):
        wall = F.convert_timezone(F.lit("UTC"), F.lit(tz), wall)
    return F.date_format(wall, fmt)


def run_timestamp(run_ts: int | None = None) -> Column:
    """Timestamp for a run row (DT-03): ``current_timestamp()``, or the given
    epoch seconds (tests and reproducible runs)."""
    if run_ts is None:
        return F.current_timestamp()
    return F.timestamp_seconds(F.lit(int(run_ts)))
