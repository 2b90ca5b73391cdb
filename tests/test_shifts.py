"""The mart's stages against a literal, row by row evaluation."""

import random
from collections import Counter, defaultdict
from datetime import date, datetime, timedelta

import pytest

from checks.queries import QUERIES
from tallyloom.operators.calendar import Calendar
from tallyloom.operators.intervals import status_days, status_intervals
from tallyloom.plans import shifts as sh

SHIFT_SCHEMA = (
    "id bigint, warehouse_id string, role_id int, start_date timestamp_ntz, end_date timestamp_ntz, "
    "max_count bigint, created_at timestamp_ntz"
)
HISTORY_SCHEMA = "shift_id bigint, employee_id bigint, created_at timestamp_ntz, type int"
COURIER_SCHEMA = (
    "shift_id bigint, employee_id bigint, paid_sh double, fact_shift_start timestamp_ntz, "
    "fact_shift_end timestamp_ntz, removed_dttm timestamp_ntz"
)
CALENDAR = Calendar(date(2024, 1, 3), date(2024, 1, 14))


def make_shifts(rng, n):
    """Starts on and off midnight, zero-length and reversed shifts, repeated ids, missing values."""
    rows = []
    for i in range(n):
        start = datetime(2024, 1, 1) + timedelta(hours=rng.randrange(0, 20 * 24, 6))
        end = start + timedelta(hours=rng.choice([-3, 0, 6, 9, 30]))
        created = start - timedelta(hours=rng.choice([0, 1, 24, 60, 100, 240]))
        row = [rng.randrange(n * 2 // 3), f"W{i % 3}", 1 if rng.random() < 0.9 else 2, start, end, i % 4, created]
        if rng.random() < 0.1:
            row[rng.choice([0, 1, 3, 4, 5, 6])] = None
        rows.append(tuple(row))
        if rng.random() < 0.2:
            rows.append(tuple(row))
    return rows


def make_history(rng, shifts):
    rows = []
    for shift in shifts:
        for _ in range(rng.randrange(6)):
            moment = datetime(2024, 1, 1) + timedelta(hours=rng.randrange(-100, 20 * 24, 4))
            moment = moment if rng.random() < 0.95 else None
            rows.append((shift[0], rng.randrange(3), moment, rng.choice([0, 5, 10, 10])))
    return rows


def intervals_of(history):
    pairs = defaultdict(list)
    for shift, employee, moment, kind in history:
        if kind in (0, 10):
            pairs[shift, employee].append((moment, kind))
    found = []
    for (shift, employee), events in pairs.items():
        events.sort(key=lambda e: (e[0] is not None, e[0] or datetime.min, e[1]))
        for n, (moment, kind) in enumerate(events):
            following = events[n + 1][0] if n + 1 < len(events) else datetime(2099, 1, 1)
            found.append((shift, employee, moment, following, kind))
    return found


def covered_days(shifts, history, calendar):
    """All (shift row, midnight, employee, status), by crossing everything with everything."""
    intervals = intervals_of(history)
    days = [datetime.combine(calendar.start, datetime.min.time()) + timedelta(days=n) for n in range(60)]
    days = [d for d in days if d.date() <= calendar.end]
    for shift_id, _, role, start, end, _, created in shifts:
        if role != 1 or shift_id is None or end is None or created is None:
            continue
        for day in days:
            if not created < day < end:
                continue
            for other, employee, since, until, kind in intervals:
                if other == shift_id and None not in (since, until) and since <= day < until:
                    yield shift_id, start, day, employee, kind


def dynamic_of(shifts, history, calendar):
    counts = {}
    for shift_id, start, day, _, kind in covered_days(shifts, history, calendar):
        row = counts.setdefault(shift_id, [0, 0, 0, 0])
        offset = int((day - start) / timedelta(days=1)) if start is not None else 99
        if kind == 10 and -3 <= offset <= 0:
            row[-offset] += 1
    return {(k, *v) for k, v in counts.items()}


@pytest.mark.parametrize("seed", range(3))
def test_dynamic_against_crossing_everything(spark, seed):
    rng = random.Random(seed)
    shifts = make_shifts(rng, 60)
    history = make_history(rng, shifts)
    base = sh.shifts_base(spark.createDataFrame(shifts, SHIFT_SCHEMA))
    log = spark.createDataFrame(history, HISTORY_SCHEMA)
    expected = dynamic_of(shifts, history, CALENDAR)
    assert any(row[1:] == (0, 0, 0, 0) for row in expected)
    heavy = [s[0] for s in shifts[:5]]
    for keys in ([], heavy):
        found = sh.shift_dynamic(base, log, CALENDAR, keys)
        rows = found.select("shift_id", "n_emp_count", "nm1_emp_count", "nm2_emp_count", "nm3_emp_count").collect()
        assert len(rows) == len(expected)
        assert {tuple(r) for r in rows} == expected


def test_days_against_crossing_everything(spark):
    rng = random.Random(11)
    shifts = make_shifts(rng, 40)
    history = make_history(rng, shifts)
    base = sh.shifts_base(spark.createDataFrame(shifts, SHIFT_SCHEMA))
    log = spark.createDataFrame(history, HISTORY_SCHEMA)
    found = status_days(status_intervals(log, []), sh.shift_spans(base, CALENDAR), [shifts[0][0]])
    rows = Counter(tuple(r) for r in found.select("shift_id", "employee_id", "dt", "type").collect())
    assert rows == Counter((s, e, d, k) for s, _, d, e, k in covered_days(shifts, history, CALENDAR))

    days = Counter(tuple(r) for r in sh.shift_days(base, CALENDAR).select("shift_id", "dt").collect())
    expected = Counter()
    for shift_id, _, role, _, end, _, created in shifts:
        for n in range((CALENDAR.end - CALENDAR.start).days + 1):
            day = datetime.combine(CALENDAR.start, datetime.min.time()) + timedelta(days=n)
            if role == 1 and end is not None and created is not None and created < day < end:
                expected[shift_id, day] += 1
    assert days == expected


def test_upcoming_shifts_count_zero_rather_than_nothing(spark):
    """Seen on a day of the calendar, though none of the four offsets lies in it."""
    start = datetime(2024, 1, 25, 10)
    shifts = [(1, "W", 1, start, start + timedelta(hours=5), 2, datetime(2024, 1, 5))]
    history = [(1, 9, datetime(2024, 1, 6), 10)]
    base = sh.shifts_base(spark.createDataFrame(shifts, SHIFT_SCHEMA))
    log = spark.createDataFrame(history, HISTORY_SCHEMA)
    [row] = sh.shift_dynamic(base, log, CALENDAR, []).collect()
    assert (row.n_emp_count, row.nm3_emp_count) == (0, 0)
    assert sh.shift_dynamic(base, log, Calendar(date(2024, 1, 3), date(2024, 1, 5)), []).count() == 0


def test_overnight_shift_counts_an_employee_twice_and_ties_go_to_on(spark):
    start = datetime(2024, 1, 10, 22)
    shifts = [(1, "W", 1, start, start + timedelta(hours=8), 2, datetime(2024, 1, 8, 5))]
    moment = datetime(2024, 1, 8, 6)
    history = [(1, 9, moment, 10), (1, 9, moment, 0)]
    base = sh.shifts_base(spark.createDataFrame(shifts, SHIFT_SCHEMA))
    [row] = sh.shift_dynamic(base, spark.createDataFrame(history, HISTORY_SCHEMA), CALENDAR, []).collect()
    assert (row.n_emp_count, row.nm1_emp_count, row.nm2_emp_count) == (2, 1, 0)


def test_base_columns(spark):
    start = datetime(2024, 1, 7, 9, 5)
    rows = [
        (4, "W1", 1, start, start + timedelta(hours=2, minutes=30), 3, datetime(2024, 1, 7)),
        (5, None, 1, start, None, 3, None),
        (6, "W1", 2, start, start, 3, start),
        (7, "W1", None, start, start, 3, start),
    ]
    first, second = sh.shifts_base(spark.createDataFrame(rows, SHIFT_SCHEMA)).orderBy("shift_id").collect()
    assert first.asDict() == {
        "shift_id": 4,
        "warehouse_id": "W1",
        "shift_start_dow": 7,
        "shift_start_week": datetime(2024, 1, 1),
        "shift_start_dt": datetime(2024, 1, 7),
        "shift_created_dttm": datetime(2024, 1, 7),
        "plan_shift_start": start,
        "plan_shift_end": start + timedelta(hours=2, minutes=30),
        "max_count": 3,
        "shift_type": "Emergency",
        "start_hour": 9,
        "shift_len": 2.5,
        "shift_len_label": "Смена 3 ч.",
        "shift_interval": "09:05 - 11:35, shift_id = 4",
        "dt_wh_key": "2024-01-07__W1",
    }
    assert (second.shift_type, second.shift_len, second.shift_len_label) == ("Regular", None, None)
    assert (second.shift_interval, second.dt_wh_key) == (None, None)


def test_stat_hours(spark):
    start, end = datetime(2024, 1, 7, 9), datetime(2024, 1, 7, 17)
    shifts = [(1, "W", 1, start, end, 3, start)]
    hour = timedelta(hours=1)
    couriers = [
        (1, 1, 8.0, start - hour, end + hour, None),
        (1, 2, 0.0, start + hour, end - 2 * hour, start),
        (1, 3, None, None, end, None),
        (1, 4, 1.5, end + hour, end + 2 * hour, None),
        (2, 5, 1.0, start, end, None),
    ]
    base = sh.shifts_base(spark.createDataFrame(shifts, SHIFT_SCHEMA))
    [row] = sh.shift_stat(base, spark.createDataFrame(couriers, COURIER_SCHEMA)).collect()
    assert row.asDict() == {
        "shift_id": 1,
        "max_count": 3,
        "shift_len": 8.0,
        "shift_sh_ttl": 24.0,
        "fact_sh": 9.5,
        "trim_fact_sh": 8.0 + 5.0 - 1.0,
        "early_start_sh": 1.0,
        "late_start_sh": 1.0 + 9.0,
        "early_end_sh": 2.0,
        "late_end_sh": 1.0 + 2.0,
        "assigned_emp_cnt": 4,
        "not_removed_cnt": 3,
        "working_cnt": 2,
    }


def test_mart_without_matches(spark):
    start = datetime(2024, 1, 7, 9)
    shifts = spark.createDataFrame([(1, "W", 1, start, start + timedelta(hours=8), 3, start)], SHIFT_SCHEMA)
    empty_history = spark.createDataFrame([], HISTORY_SCHEMA)
    empty_couriers = spark.createDataFrame([], COURIER_SCHEMA)
    mart = sh.mv_shifts_agg(shifts, empty_history, empty_couriers, CALENDAR)
    assert len(mart.columns) == 31
    [row] = mart.collect()
    assert [row[c] for c in sh.HOUR_SUMS] == [0.0] * 6
    unmatched = [*sh.HEAD_COUNTS.values(), "shift_sh_ttl", "assigned_emp_cnt", "not_filled_sh", "skiped_sh"]
    assert all(row[c] is None for c in unmatched)


def test_repeated_shift_ids_multiply_as_in_plain_joins(spark):
    start = datetime(2024, 1, 7, 9)
    shift = (1, "W", 1, start, start + timedelta(hours=8), 3, start - timedelta(days=3))
    shifts = spark.createDataFrame([shift, shift], SHIFT_SCHEMA)
    history = spark.createDataFrame([(1, 5, start - timedelta(days=3), 10)], HISTORY_SCHEMA)
    couriers = spark.createDataFrame([(1, 5, 8.0, start, start, None)], COURIER_SCHEMA)
    rows = sh.mv_shifts_agg(shifts, history, couriers, CALENDAR).collect()
    assert [(r.n_emp_count, r.assigned_emp_cnt, r.fact_sh) for r in rows] == [(2, 2, 16.0)] * 2


def plan_of(df):
    return df._jdf.queryExecution().toString()


def test_rows_of_a_repeated_id_are_counted_before_they_are_dealt(spark):
    base = spark.range(30_000).selectExpr(
        "case when id % 3 = 0 then 7 when id % 50 = 1 then null else id end as shift_id", "id % 2 as max_count"
    )
    plain = sh.counted(base, "shift_id", "max_count")
    split = sh.counted(base, "shift_id", "max_count", repeated=[7, None])
    # What is dealt of the id are its distinct rows per task, by all columns; the raw rows of the others go by id alone.
    dealt = [line for line in split._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning" in line]
    assert len(dealt) == 2 and sum("max_count" in line for line in dealt) == 1
    assert Counter(map(tuple, split.collect())) == Counter(map(tuple, plain.collect()))
    one_id = sh.counted(base.where("shift_id = 7").coalesce(4), "shift_id", "max_count", repeated=[7])
    assert sorted(r["shifts"] for r in one_id.collect()) == [5_000, 5_001]


def test_plans_have_no_nested_loops(spark, sample_dir):
    lazy = set(QUERIES) - {"load_full", "load_incremental", "materialised_mart", "delimited_text", "delimited_raw_text"}
    for name in sorted(lazy):
        plan = plan_of(QUERIES[name](spark, sample_dir))
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name


def test_each_large_input_is_shuffled_once(spark, tmp_path):
    """History and couriers are partitioned by shift for their join and aggregated as they lie."""
    rng = random.Random(3)
    shifts = make_shifts(rng, 30)
    tables = {
        "shifts": (shifts, SHIFT_SCHEMA),
        "history": (make_history(rng, shifts), HISTORY_SCHEMA),
        "couriers": ([(s[0], 1, 1.0, s[3], s[4], None) for s in shifts], COURIER_SCHEMA),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
    inputs = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in tables}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = sh.shifts_base(inputs["shifts"])
        dynamic = plan_of(sh.shift_dynamic(base, inputs["history"], CALENDAR, [])).split("Physical Plan")[1]
        stat = plan_of(sh.shift_stat(base, inputs["couriers"], [])).split("Physical Plan")[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # One for the big side, one for the narrow shifts, which are counted and joined on it.
    assert (dynamic.count("Exchange hash"), stat.count("Exchange hash")) == (2, 2)
