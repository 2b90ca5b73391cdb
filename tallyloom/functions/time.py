"""Calendar arithmetic on wall-clock timestamps.

Spark's ``date_trunc`` and ``timestampdiff`` turn a ``timestamp_ntz`` into an instant of the session
time zone. Everything here goes through dates and intervals instead, so results do not depend on it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The units a load can be split by.
PERIOD_UNITS = ("day", "week", "month", "year")


def period_day(ts: Column, unit: str) -> Column:
    """First day (a date) of the day, ISO week, month or year that holds ``ts``."""
    if unit not in PERIOD_UNITS:
        raise ValueError(f"unknown period unit {unit!r}, expected one of {PERIOD_UNITS}")
    day = ts.cast("date")
    return day if unit == "day" else F.trunc(day, unit)


def period_start(ts: Column, unit: str) -> Column:
    """Midnight at which the period that holds ``ts`` begins."""
    return period_day(ts, unit).cast("timestamp_ntz")


def midnight(ts: Column) -> Column:
    return period_start(ts, "day")


def last_midnight_before(ts: Column) -> Column:
    """Date of the last midnight strictly before ``ts``."""
    return (ts - F.expr("INTERVAL '0.000001' SECOND")).cast("date")


def iso_dow(ts: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return (F.weekday(ts) + 1).cast("long")


def whole_seconds(later: Column, earlier: Column) -> Column:
    """Elapsed whole seconds, truncated toward zero."""
    return (later - earlier).cast("interval second").cast("long")


def whole_days(later: Column, earlier: Column) -> Column:
    """Elapsed whole 24-hour spans, truncated toward zero."""
    return (later - earlier).cast("interval day").cast("long")
