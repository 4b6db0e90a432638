"""String and time parsing helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the event-time text pattern of the web-traffic stream.
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def flag_contains(col: Column | str, needle: str) -> Column:
    """Substring flag with NULL text counted as false."""
    return F.coalesce(F.instr(_c(col), needle) > 0, F.lit(False))


def clock_to_minutes(col: Column | str) -> Column:
    """``"MM:SS"`` to minutes as double (F5).  Missing seconds count as 0;
    empty or malformed minutes give NULL instead of an error (V5)."""
    c = _c(col)
    mins = F.split_part(c, F.lit(":"), F.lit(1)).try_cast("double")
    secs = F.split_part(c, F.lit(":"), F.lit(2)).try_cast("double")
    return mins + F.coalesce(secs, F.lit(0.0)) / F.lit(60.0)


def parse_event_time(col: Column | str, pattern: str = EVENT_TIME_PATTERN) -> Column:
    """Event time from text (T2); malformed rows become NULL, not a failure."""
    return F.try_to_timestamp(_c(col), F.lit(pattern))


def json_long(col: Column | str, path: str) -> Column:
    """A long field from a JSON text column (``props`` in the event table)."""
    return F.get_json_object(_c(col), path).try_cast("long")
