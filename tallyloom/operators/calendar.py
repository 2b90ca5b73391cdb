"""Calendars of days and load periods."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import PERIOD_UNITS, period_day

# First day of the calendar, end of a status that has no successor.
CALENDAR_START = date(2021, 2, 1)
OPEN_END = date(2099, 1, 1)


def week_end(day: date) -> date:
    """Sunday of the ISO week of ``day``."""
    return day + timedelta(days=6 - day.weekday())


@dataclass(frozen=True)
class Calendar:
    """All midnights from ``start`` to ``end``, both included."""

    start: date = CALENDAR_START
    end: date = CALENDAR_START

    def __post_init__(self) -> None:
        if self.end >= OPEN_END:
            raise ValueError(f"the calendar must end before {OPEN_END}, when open statuses end")

    @classmethod
    def upto(cls, as_of: datetime | date | None = None, start: date = CALENDAR_START) -> Calendar:
        """Calendar up to the Sunday of the current ISO week (UTC), or of the one of ``as_of``."""
        moment = as_of or datetime.now(timezone.utc)
        return cls(start, week_end(moment.date() if isinstance(moment, datetime) else moment))

    def days(self, spark: SparkSession) -> DataFrame:
        one = spark.range(1)
        return explode_days(one, F.lit(self.start), F.lit(self.end), "dt").select("dt")


def explode_days(df: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
    """One row per midnight from ``first`` to ``last`` (dates); none if they are NULL or reversed."""
    days = F.when(first <= last, F.sequence(first, last, F.expr("INTERVAL 1 DAY")))
    return df.withColumn(name, F.explode(days)).withColumn(name, F.col(name).cast("timestamp_ntz"))


def calendar_over(df: DataFrame, first: str, last: str) -> DataFrame:
    """Calendar from the earliest ``first`` to the Sunday of the week of the latest ``last``."""
    bounds = df.agg(
        F.min(first).cast("date").alias("lo"),
        F.date_add(period_day(F.max(last), "week"), 6).alias("hi"),
    )
    return explode_days(bounds, F.col("lo"), F.col("hi"), "dt").select("dt")


def periods_over(df: DataFrame, ts: str, units: Iterable[str] = PERIOD_UNITS) -> DataFrame:
    """Distinct ``(unit, period)`` that cover every day between the first and the last ``ts``."""
    bounds = df.agg(F.min(ts).cast("date").alias("lo"), F.max(ts).cast("date").alias("hi"))
    days = explode_days(bounds, F.col("lo"), F.col("hi"), "day")
    starts = [F.struct(F.lit(u).alias("unit"), period_day(F.col("day"), u).alias("period")) for u in units]
    return days.select(F.explode(F.array(*starts)).alias("p")).select("p.unit", "p.period").distinct()


def _as_day(value: int | str | date) -> date:
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return datetime.strptime(str(value), "%Y%m%d").date()


def resolve_interval(
    start: int | str | date | None = None,
    end: int | str | date | None = None,
    interval: int | None = None,
    today: date | None = None,
) -> tuple[date, date]:
    """First and last day to load; days are dates or ``yyyymmdd``.

    Both ends win over ``interval``; one end alone is completed with it (0 days by default); with
    neither the range ends yesterday.
    """
    span = timedelta(days=interval or 0)
    if start is not None and end is not None:
        return _as_day(start), _as_day(end)
    if start is not None:
        return _as_day(start), _as_day(start) + span
    last = _as_day(end) if end is not None else (today or date.today()) - timedelta(days=1)
    return last - span, last


def truncate_day(day: date, unit: str) -> date:
    if unit == "day":
        return day
    if unit == "week":
        return day - timedelta(days=day.weekday())
    if unit == "month":
        return day.replace(day=1)
    if unit == "year":
        return day.replace(month=1, day=1)
    raise ValueError(f"unknown period unit {unit!r}, expected one of {PERIOD_UNITS}")


def load_periods(start: date, end: date, unit: str = "day", anchor: str = "current") -> list[date]:
    """Distinct period starts of the days ``start`` .. ``end``, ascending.

    With ``anchor="previous"`` a day that is itself the first of a month or year counts for the month
    or year before, as an offset-based roll-back does.
    """
    if anchor not in ("current", "previous"):
        raise ValueError(f"unknown anchor {anchor!r}")
    found = set()
    for offset in range((end - start).days + 1):
        day = start + timedelta(days=offset)
        period = truncate_day(day, unit)
        if anchor == "previous" and unit in ("month", "year") and period == day:
            period = truncate_day(day - timedelta(days=1), unit)
        found.add(period)
    return sorted(found)


def next_period(period: date, unit: str) -> date:
    """Start of the period after the one that starts at ``period``."""
    longest = {"day": 1, "week": 7, "month": 31, "year": 366}[unit]
    return truncate_day(period + timedelta(days=longest), unit)
