"""Reading one batch of a source table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions import period_day
from tallyloom.operators.calendar import next_period, truncate_day
from tallyloom.operators.conform import LAUNCH_ID, SourceColumn, conform, source_columns

UPDATED_AT = "updated_at"


def split_table_name(name: str, dbname: str | None = None) -> tuple[str | None, str, str]:
    """``(catalog, schema, table)`` of ``schema.table`` or ``catalog.schema.table``."""
    parts = name.split(".")
    if len(parts) == 3:
        return parts[0], parts[1], parts[2]
    if len(parts) == 2:
        return dbname, parts[0], parts[1]
    raise ValueError(f"expected schema.table or catalog.schema.table, got {name!r}")


def period_ranges(periods: Sequence[date], unit: str) -> list[tuple[date, date]]:
    """Half-open day ranges covered by ``periods``, neighbours merged."""
    ranges: list[tuple[date, date]] = []
    for period in sorted(p for p in periods if truncate_day(p, unit) == p):
        if ranges and ranges[-1][1] == period:
            ranges[-1] = (ranges[-1][0], next_period(period, unit))
        else:
            ranges.append((period, next_period(period, unit)))
    return ranges


def in_periods(ts: Column, periods: Sequence[date], unit: str) -> Column:
    """``ts`` falls in one of the periods.

    Written as plain ranges, which reach the scan as pushed-down filters and prune row groups; a
    truncated timestamp would not. A day that starts no period matches nothing.
    """
    matches = F.lit(False)
    for n, (first, end) in enumerate(period_ranges(periods, unit)):
        inside = (ts >= F.lit(first).cast("timestamp_ntz")) & (ts < F.lit(end).cast("timestamp_ntz"))
        matches = inside if n == 0 else matches | inside
    return matches


def has_updates(columns: Sequence[SourceColumn]) -> bool:
    if not columns:
        raise ValueError("the source table has no columns")
    return any(c.name == UPDATED_AT for c in columns)


def changed_in(columns: Sequence[SourceColumn], field: str, periods: Sequence[date], unit: str) -> Column:
    """Rows created in the periods or, if the table has ``updated_at``, changed in them."""
    created = in_periods(F.col(field), periods, unit)
    return created | in_periods(F.col(UPDATED_AT), periods, unit) if has_updates(columns) else created


def extract(
    source: DataFrame,
    launch_id: str,
    columns: Sequence[SourceColumn] | None = None,
    field: str | None = None,
    period: date | None = None,
    unit: str = "day",
) -> DataFrame:
    """One batch: all columns conformed and cleaned, tagged; all rows, or those of one period."""
    columns = list(columns or source_columns(source))
    if period is not None:
        if field is None:
            raise ValueError("a period needs a partitioning field")
        source = source.where(changed_in(columns, field, [period], unit))
    return conform(source, columns, clean=True).withColumn(LAUNCH_ID, F.lit(launch_id))


def launch_table(spark: SparkSession, launches: dict[date, str]) -> DataFrame:
    """Launches with their period and their place in the order of periods."""
    periods = sorted(launches)
    columns = {
        "_period": pa.array(periods, pa.date32()),
        LAUNCH_ID: pa.array([launches[p] for p in periods], pa.string()),
        "_order": pa.array(range(len(periods)), pa.int32()),
    }
    return spark.createDataFrame(pa.table(columns))


def extract_periods(
    source: DataFrame,
    launches: dict[date, str],
    field: str,
    unit: str,
    columns: Sequence[SourceColumn] | None = None,
) -> DataFrame:
    """The batches of many periods in one scan, each row tagged with the launch of its period.

    A row created in one period and changed in another belongs to both. Launches are one row per
    period, so no more than the days of the requested range: that is what is broadcast.
    """
    columns = list(columns or source_columns(source))
    for period in launches:
        if truncate_day(period, unit) != period:
            raise ValueError(f"{period} does not start a {unit}")
    changed = source.where(changed_in(columns, field, list(launches), unit))
    period = period_day(F.col(field), unit)
    if has_updates(columns):
        period = F.explode(F.array_distinct(F.array(period, period_day(F.col(UPDATED_AT), unit))))
    tagged = changed.withColumn("_period", period)
    named = launch_table(source.sparkSession, launches).select("_period", LAUNCH_ID)
    staged = tagged.join(F.broadcast(named), "_period")
    tag = SourceColumn(LAUNCH_ID, "uuid", False)
    return conform(staged, [*columns, tag], clean=True).select(*sorted(c.name for c in columns), LAUNCH_ID)
