"""Status histories: event log to validity intervals, and the status on given days."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions import last_midnight_before, strict_greatest, strict_least, whole_seconds
from tallyloom.operators.calendar import OPEN_END, explode_days
from tallyloom.operators.skew import heavy_keys, is_heavy, skew_join

# The two statuses the shift mart looks at.
STATUS_OFF = 0
STATUS_ON = 10

PAIR = ["shift_id", "employee_id"]
# Copies of one event are written out this many per task.
COPIES_PER_BLOCK = 100_000


def status_events(history: DataFrame) -> DataFrame:
    """The history rows of the two known statuses. The filter comes before any window."""
    return history.where(F.col("type").isin(STATUS_OFF, STATUS_ON)).select(*PAIR, "created_at", "type")


def status_intervals(history: DataFrame, heavy: Sequence[Any] | None = None) -> DataFrame:
    """Each status with the instant the next one of that shift and employee begins.

    Order is by ``created_at``, NULLs first, then ``type``; the last status is open until ``OPEN_END``.
    Shift-employee pairs with very many rows are cut into minutes, so that no task sorts a whole one.
    """
    events = status_events(history)
    if heavy is None:
        heavy = heavy_keys(events, *PAIR)
    if not heavy:
        return _intervals(events)
    hot = is_heavy(F.xxhash64(*PAIR), heavy)
    return _intervals(events.where(~hot)).unionByName(_sliced_intervals(events.where(hot)))


def _open_end(events: DataFrame) -> str:
    return f"CAST('{OPEN_END}' AS {dict(events.dtypes)['created_at']})"


def _intervals(events: DataFrame) -> DataFrame:
    in_order = Window.partitionBy(*PAIR).orderBy(F.asc_nulls_first("created_at"), "type")
    return events.select(
        *PAIR,
        F.col("created_at").alias("status_dttm"),
        F.expr(f"lead(created_at, 1, {_open_end(events)})").over(in_order).alias("next_status_dttm"),
        "type",
    )


def _sliced_intervals(events: DataFrame) -> DataFrame:
    """``_intervals`` for pairs that are too long for one task.

    Equal events are counted first. Every minute of a pair then gets one more row, holding the first
    event after that minute, so the successor of each event is found within its minute.
    """
    epoch = F.lit("1970-01-01").cast(dict(events.dtypes)["created_at"])
    minute = F.floor(whole_seconds(F.col("created_at"), epoch) / 60).alias("minute")
    counted = events.groupBy(*PAIR, "created_at", "type").agg(F.count(F.lit(1)).alias("copies"))
    counted = counted.select("*", minute, F.lit(False).alias("is_end"))
    minutes = Window.partitionBy(*PAIR).orderBy(F.asc_nulls_first("minute"))
    ends = (
        counted.groupBy(*PAIR, "minute")
        .agg(F.min("created_at").alias("created_at"))
        .withColumn("created_at", F.expr(f"lead(created_at, 1, {_open_end(events)})").over(minutes))
        .withColumn("is_end", F.lit(True))
    )
    within = Window.partitionBy(*PAIR, "minute").orderBy("is_end", F.asc_nulls_first("created_at"), "type")
    followed = (
        counted.unionByName(ends, allowMissingColumns=True)
        .withColumn("following", F.lead("created_at").over(within))
        .where(~F.col("is_end"))
    )
    # All copies but the last are followed by an equal event.
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES_PER_BLOCK)))
    first = F.col("block") * COPIES_PER_BLOCK + 1
    last = F.least(first + (COPIES_PER_BLOCK - 1), F.col("copies"))
    return (
        followed.withColumn("block", block)
        .repartition(*PAIR, "created_at", "type", "block")
        .withColumn("copy", F.explode(F.sequence(first, last)))
        .select(
            *PAIR,
            F.col("created_at").alias("status_dttm"),
            F.when(F.col("copy") < F.col("copies"), F.col("created_at"))
            .otherwise(F.col("following"))
            .alias("next_status_dttm"),
            "type",
        )
    )


def status_days(intervals: DataFrame, spans: DataFrame, heavy: Sequence[Any] | None = None) -> DataFrame:
    """Status of each employee at every midnight of a shift's span.

    ``spans`` holds ``shift_id``, ``first_day`` and ``last_day``. An interval covers its start but not
    its end. Each interval meets its shift once and is then unrolled to just the days in both, instead
    of pairing all days of the shift with all its intervals and filtering.
    """
    if heavy is None:
        heavy = heavy_keys(intervals, "shift_id")
    covered = skew_join(intervals, spans.select("shift_id", "first_day", "last_day"), "shift_id", heavy)
    starts = F.col("status_dttm")
    begins_at_midnight = starts == starts.cast("date").cast("timestamp_ntz")
    first = F.when(begins_at_midnight, starts.cast("date")).otherwise(F.date_add(starts.cast("date"), 1))
    return explode_days(
        covered,
        strict_greatest(first, F.col("first_day")),
        strict_least(last_midnight_before(F.col("next_status_dttm")), F.col("last_day")),
        "dt",
    ).select(*PAIR, "dt", "type")
