"""The shift mart: planned shifts, head count on the days before, and hours worked."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import (
    clock,
    iso_dow,
    label,
    last_midnight_before,
    midnight,
    period_start,
    strict_greatest,
    strict_least,
    whole_seconds,
)
from tallyloom.operators.calendar import Calendar, explode_days
from tallyloom.operators.intervals import STATUS_OFF, STATUS_ON, status_events
from tallyloom.operators.skew import heavy_keys, is_heavy, skew_join

# The role the mart covers and the texts it prints.
COURIER_ROLE = 1
EMERGENCY, REGULAR = "Emergency", "Regular"
SHIFT_LEN_LABEL = ("Смена ", " ч.")
SHIFT_ID_LABEL = ", shift_id = "

# Head count columns by whole days between the midnight and the planned start.
HEAD_COUNTS = {0: "n_emp_count", 1: "nm1_emp_count", 2: "nm2_emp_count", 3: "nm3_emp_count"}
HOUR_SUMS = ["fact_sh", "trim_fact_sh", "early_start_sh", "late_start_sh", "early_end_sh", "late_end_sh"]


def shifts_base(shifts: DataFrame) -> DataFrame:
    start, end, created = F.col("start_date"), F.col("end_date"), F.col("created_at")
    shift_len = whole_seconds(end, start) / 3600
    day = midnight(start)
    return shifts.where(F.col("role_id") == COURIER_ROLE).select(
        F.col("id").alias("shift_id"),
        "warehouse_id",
        iso_dow(start).alias("shift_start_dow"),
        period_start(start, "week").alias("shift_start_week"),
        day.alias("shift_start_dt"),
        created.alias("shift_created_dttm"),
        start.alias("plan_shift_start"),
        end.alias("plan_shift_end"),
        "max_count",
        F.when(day == midnight(created), EMERGENCY).otherwise(REGULAR).alias("shift_type"),
        F.hour(start).cast("long").alias("start_hour"),
        shift_len.alias("shift_len"),
        label(SHIFT_LEN_LABEL[0], F.round(shift_len).cast("long"), SHIFT_LEN_LABEL[1]).alias("shift_len_label"),
        label(clock(start), " - ", clock(end), SHIFT_ID_LABEL, F.col("id").cast("long")).alias("shift_interval"),
        label(start.cast("date"), "__", F.col("warehouse_id")).alias("dt_wh_key"),
    )


def shift_spans(base: DataFrame, calendar: Calendar) -> DataFrame:
    """First and last calendar midnight after a shift was created and before it is planned to end."""
    created, end = F.col("shift_created_dttm"), F.col("plan_shift_end")
    return base.select(
        "*",
        strict_greatest(F.date_add(created.cast("date"), 1), F.lit(calendar.start)).alias("first_day"),
        strict_least(last_midnight_before(end), F.lit(calendar.end)).alias("last_day"),
    )


def shift_days(base: DataFrame, calendar: Calendar) -> DataFrame:
    """One row per shift and calendar midnight strictly between its creation and its planned end.

    Unrolled shift by shift, so it takes neither a join with the calendar nor a shuffle.
    """
    spans = shift_spans(base.select("shift_id", "shift_created_dttm", "plan_shift_start", "plan_shift_end"), calendar)
    return explode_days(spans, F.col("first_day"), F.col("last_day"), "dt").select(
        "shift_id", "shift_created_dttm", "plan_shift_start", "dt"
    )


def counted(base: DataFrame, *columns: str, repeated: Sequence[Any] = ()) -> DataFrame:
    """Distinct rows and how many shifts each stands for.

    An id may occur more than once; counting equal rows before a join keeps their copies from being
    paired with every row of that id. NULL ids meet nothing, so they are left out. Rows are dealt by
    id alone, which the join that follows can use as it is. Those of the ``repeated`` ids would meet in one
    task, so they are counted where they are read first and dealt by all columns.
    """

    def count(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("shifts"))

    base = base.where(F.col("shift_id").isNotNull())
    repeated = [k for k in repeated if k is not None]
    if not repeated:
        return count(base.repartition("shift_id"))
    hot = is_heavy(F.col("shift_id"), repeated)
    return count(base.where(~hot).repartition("shift_id")).unionByName(count(base.where(hot)))


def shift_dynamic(
    base: DataFrame,
    history: DataFrame,
    calendar: Calendar,
    heavy: Sequence[Any] | None = None,
    repeated: Sequence[Any] | None = None,
) -> DataFrame:
    """Employees on a shift at the midnights 0 to 3 whole days before its planned start.

    ``repeated`` names ids with very many rows in ``base``; those of ``heavy`` if not given.

    Whole days are truncated toward zero: a shift that starts after midnight has two midnights 0 days
    away, and an employee on it at both is counted twice. A shift is present if any employee has any
    status at any of its midnights.

    An employee is on the shift at a midnight if the latest "on" up to then is no earlier than the
    latest "off". Those are plain maxima, so neither the event log has to be ordered nor days and
    intervals be paired, and equal keys combine before the shuffle.
    """
    events = status_events(history)
    if heavy is None:
        heavy = heavy_keys(events, "shift_id")
    start_day = F.col("plan_shift_start").cast("date")
    kind = ["shift_id", "first_day", "last_day", "start_day", "after_midnight"]
    spans = counted(
        shift_spans(base, calendar)
        .where("first_day <= last_day")
        .withColumn("start_day", start_day)
        .withColumn("after_midnight", F.col("plan_shift_start") > start_day.cast("timestamp_ntz")),
        *kind,
        repeated=heavy if repeated is None else repeated,
    )
    midnights = {"next": F.date_add("start_day", 1), **{str(n): F.date_sub("start_day", n) for n in HEAD_COUNTS}}

    def latest(status: int, day: Column) -> Column:
        seen = (F.col("type") == status) & (F.col("created_at") <= day.cast("timestamp_ntz"))
        return F.max(F.when(seen, F.col("created_at")))

    def on_shift(name: str) -> Column:
        day = midnights[name]
        on, off = F.col(f"on_{name}"), F.col(f"off_{name}")
        is_on = on.isNotNull() & (off.isNull() | (on >= off)) & day.between(F.col("first_day"), F.col("last_day"))
        return F.when(is_on, 1).otherwise(0)

    def count_heads(joined: DataFrame) -> DataFrame:
        by_employee = joined.groupBy(*kind, "employee_id", "shifts").agg(
            *[latest(STATUS_ON, day).alias(f"on_{name}") for name, day in midnights.items()],
            *[latest(STATUS_OFF, day).alias(f"off_{name}") for name, day in midnights.items()],
        )
        heads = {n: on_shift(str(n)) for n in HEAD_COUNTS}
        heads[0] = heads[0] + F.when(F.col("after_midnight"), on_shift("next")).otherwise(0)
        return by_employee.groupBy("shift_id").agg(
            *[F.sum(F.col("shifts") * heads[n]).alias(name) for n, name in HEAD_COUNTS.items()]
        )

    def match(joined: DataFrame) -> DataFrame:
        return count_heads(joined.where(F.col("created_at") <= F.col("last_day").cast("timestamp_ntz")))

    return skew_join(events, spans, "shift_id", heavy, then=match)


def shift_stat(
    base: DataFrame, couriers: DataFrame, heavy: Sequence[Any] | None = None, repeated: Sequence[Any] | None = None
) -> DataFrame:
    """Hours and head counts per shift from the actual hours of each employee; ``repeated`` as in ``shift_dynamic``.

    Whole seconds are summed and divided once, so the sums do not depend on the order of rows.
    """
    if heavy is None:
        heavy = heavy_keys(couriers, "shift_id")
    plan_start, plan_end = F.col("plan_shift_start"), F.col("plan_shift_end")
    fact_start, fact_end = F.col("fact_shift_start"), F.col("fact_shift_end")
    spans = {
        "trim_fact_sh": (strict_least(fact_end, plan_end), strict_greatest(fact_start, plan_start)),
        "early_start_sh": (plan_start, strict_least(fact_start, plan_start)),
        "late_start_sh": (strict_greatest(fact_start, plan_start), plan_start),
        "early_end_sh": (plan_end, strict_least(fact_end, plan_end)),
        "late_end_sh": (strict_greatest(fact_end, plan_end), plan_end),
    }

    copies = F.col("shifts")

    def per_shift(joined: DataFrame) -> DataFrame:
        return joined.groupBy("shift_id", "max_count", "shift_len").agg(
            F.sum(F.col("paid_sh") * copies).alias("fact_sh"),
            *[(F.sum(whole_seconds(*span) * copies) / 3600).alias(name) for name, span in spans.items()],
            F.sum(copies).alias("assigned_emp_cnt"),
            F.sum(F.when(F.col("removed_dttm").isNull(), copies).otherwise(0)).alias("not_removed_cnt"),
            F.sum(F.when(F.col("paid_sh") > 0, copies).otherwise(0)).alias("working_cnt"),
        )

    kind = ("shift_id", "max_count", "shift_len", "plan_shift_start", "plan_shift_end")
    planned = counted(base, *kind, repeated=heavy if repeated is None else repeated)
    worked = couriers.select("shift_id", "paid_sh", "fact_shift_start", "fact_shift_end", "removed_dttm")
    return skew_join(worked, planned, "shift_id", heavy, then=per_shift).select(
        "shift_id",
        "max_count",
        "shift_len",
        (F.col("max_count") * F.col("shift_len")).alias("shift_sh_ttl"),
        *HOUR_SUMS,
        "assigned_emp_cnt",
        "not_removed_cnt",
        "working_cnt",
    )


def mv_shifts_agg(
    shifts: DataFrame,
    history: DataFrame,
    couriers: DataFrame,
    calendar: Calendar | None = None,
    heavy: Sequence[Any] | None = None,
) -> DataFrame:
    """The mart: every shift of the role, with head counts and hours where there are any.

    ``heavy`` names shift ids with very many history or courier rows; they are looked for if not given.
    """
    base = shifts_base(shifts)
    repeated = heavy_keys(base, "shift_id") if heavy is None else heavy
    dynamic = shift_dynamic(base, history, calendar or Calendar.upto(), heavy, repeated)
    stat = shift_stat(base, couriers, heavy, repeated)
    unfilled = F.col("max_count") - F.col("not_removed_cnt")
    skipped = F.col("not_removed_cnt") - F.col("working_cnt")
    return (
        skew_join(base, dynamic.join(stat.drop("max_count", "shift_len"), "shift_id", "full"), "shift_id", repeated, "left")
        .select(
            *base.columns,
            *[HEAD_COUNTS[n] for n in sorted(HEAD_COUNTS, reverse=True)],
            "shift_sh_ttl",
            *[F.coalesce(name, F.lit(0.0)).alias(name) for name in HOUR_SUMS],
            "assigned_emp_cnt",
            "not_removed_cnt",
            "working_cnt",
            (unfilled * F.col("shift_len")).alias("not_filled_sh"),
            (skipped * F.col("shift_len")).alias("skiped_sh"),
        )
    )


def reconcile_week(mart: DataFrame, shifts: DataFrame, couriers: DataFrame) -> DataFrame:
    """Mart against its inputs by week and warehouse: shifts, planned heads, paid hours.

    ``couriers`` must also carry ``warehouse_id``, ``role_id`` and ``plan_shift_start``. Each input is
    reduced to one row per week and warehouse before the joins.
    """
    key = ["_w", "warehouse_id"]

    def weekly(df: DataFrame, start: str, *aggregates: Column) -> DataFrame:
        week = period_start(F.col(start), "week").alias("_w")
        return df.groupBy(week, F.col("warehouse_id")).agg(*aggregates)

    one = F.count(F.lit(1))
    role = F.col("role_id") == COURIER_ROLE
    aggregated = weekly(
        mart,
        "plan_shift_start",
        one.alias("shift_cnt_agg"),
        F.sum("max_count").alias("max_count_agg"),
        F.sum("fact_sh").alias("fact_sh_agg"),
    )
    raw = weekly(
        shifts.where(role), "start_date", one.alias("shift_cnt_raw"), F.sum("max_count").alias("max_count_raw")
    )
    paid = weekly(couriers.where(role), "plan_shift_start", F.sum("paid_sh").alias("fact_sh_raw"))
    return (
        aggregated.join(raw, key)
        .join(paid, key)
        .select(
            *key,
            "shift_cnt_agg",
            "shift_cnt_raw",
            "max_count_agg",
            "max_count_raw",
            "fact_sh_agg",
            "fact_sh_raw",
        )
    )
