"""The same queries in SQL, written the plain way (cross joins, windows), to check against."""

from __future__ import annotations

SHIFTS = """
shifts as (
    select o_orderkey as id,
           'W' || cast(o_custkey % 25 as varchar) as warehouse_id,
           1 + cast(o_orderkey % 2 as int) as role_id,
           o_orderdate + interval 1 hour * (o_orderkey % 24) as start_date,
           o_orderdate + interval 1 hour * (o_orderkey % 24) + interval 1 hour * (4 + o_custkey % 9)
                       + interval 1 minute * (30 * (o_orderkey % 3)) as end_date,
           1 + o_custkey % 5 as max_count,
           o_orderdate - interval 1 hour * (24 * (o_orderkey % 7)) + interval 1 hour * (o_custkey % 4) as created_at
    from orders
)"""

HISTORY = """
history as (
    select l_orderkey as shift_id, l_suppkey as employee_id,
           o_orderdate - interval 1 hour * (24 * l_linenumber) + interval 1 hour * (l_partkey % 24) as created_at,
           case l_returnflag when 'A' then 10 when 'R' then 0 else 5 end as type
    from lineitem join orders on l_orderkey = o_orderkey
)"""

COURIERS = """
couriers as (
    select l_orderkey as shift_id, l_suppkey as employee_id,
           case when l_returnflag = 'R' then 0.0 else l_quantity / 10 end as paid_sh,
           case when l_returnflag = 'N' and l_linestatus = 'F' then null
                else start_date + interval 1 minute * (l_partkey % 121 - 60) end as fact_shift_start,
           case when l_returnflag = 'R' and l_linestatus = 'O' then null
                else end_date + interval 1 minute * (l_suppkey % 91 - 45) end as fact_shift_end,
           case when l_returnflag = 'R' then start_date end as removed_dttm,
           warehouse_id, role_id, start_date as plan_shift_start
    from lineitem join shifts on l_orderkey = id
)"""

BASE = """
base as (
    select id as shift_id,
           warehouse_id,
           cast(isodow(start_date) as bigint) as shift_start_dow,
           cast(date_trunc('week', start_date) as timestamp) as shift_start_week,
           cast(date_trunc('day', start_date) as timestamp) as shift_start_dt,
           created_at as shift_created_dttm,
           start_date as plan_shift_start,
           end_date as plan_shift_end,
           max_count,
           case when date_trunc('day', start_date) = date_trunc('day', created_at)
                then 'Emergency' else 'Regular' end as shift_type,
           cast(hour(start_date) as bigint) as start_hour,
           date_sub('second', start_date, end_date) / 3600 as shift_len,
           'Смена ' || cast(cast(round(date_sub('second', start_date, end_date) / 3600) as bigint) as varchar)
               || ' ч.' as shift_len_label,
           strftime(start_date, '%H:%M') || ' - ' || strftime(end_date, '%H:%M')
               || ', shift_id = ' || cast(id as varchar) as shift_interval,
           strftime(start_date, '%Y-%m-%d') || '__' || warehouse_id as dt_wh_key
    from shifts
    where role_id = 1
)"""

DAYS = """
days as (
    select shift_id, shift_created_dttm, plan_shift_start, dt
    from base
    cross join (select unnest(generate_series(timestamp '1995-01-01', timestamp '2001-12-30', interval 1 day)) as dt)
    where dt > shift_created_dttm and dt < plan_shift_end
)"""

INTERVALS = """
intervals as (
    select shift_id, employee_id, created_at as status_dttm,
           lead(created_at, 1, timestamp '2099-01-01') over (
               partition by shift_id, employee_id order by created_at nulls first, type) as next_status_dttm,
           type
    from history
    where type in (0, 10)
)"""

DYNAMIC = """
dynamic as (
    select d.shift_id,
           cast(count_if(date_sub('day', plan_shift_start, dt) = 0 and type = 10) as bigint) as n_emp_count,
           cast(count_if(date_sub('day', plan_shift_start, dt) = -1 and type = 10) as bigint) as nm1_emp_count,
           cast(count_if(date_sub('day', plan_shift_start, dt) = -2 and type = 10) as bigint) as nm2_emp_count,
           cast(count_if(date_sub('day', plan_shift_start, dt) = -3 and type = 10) as bigint) as nm3_emp_count
    from days as d
    join intervals as i on d.shift_id = i.shift_id and dt >= status_dttm and dt < next_status_dttm
    group by 1
)"""


def _hours(later: str, earlier: str) -> str:
    return f"cast(sum(date_sub('second', {earlier}, {later})) as bigint) / 3600"


def _strict(function: str, fact: str, plan: str) -> str:
    return f"case when {fact} is null or {plan} is null then null else {function}({fact}, {plan}) end"


_FIRST = _strict("least", "fact_shift_start", "plan_start")
_LATER = _strict("greatest", "fact_shift_start", "plan_start")
_EARLY_END = _strict("least", "fact_shift_end", "plan_end")
_LATE_END = _strict("greatest", "fact_shift_end", "plan_end")

STAT = f"""
stat as (
    select shift_id, max_count, shift_len, max_count * shift_len as shift_sh_ttl,
           round(sum(paid_sh), 4) as fact_sh,
           {_hours(_EARLY_END, _LATER)} as trim_fact_sh,
           {_hours("plan_start", _FIRST)} as early_start_sh,
           {_hours(_LATER, "plan_start")} as late_start_sh,
           {_hours("plan_end", _EARLY_END)} as early_end_sh,
           {_hours(_LATE_END, "plan_end")} as late_end_sh,
           count(*) as assigned_emp_cnt,
           cast(count_if(removed_dttm is null) as bigint) as not_removed_cnt,
           cast(count_if(paid_sh > 0) as bigint) as working_cnt
    from (
        select b.shift_id, max_count, shift_len, b.plan_shift_start as plan_start, plan_shift_end as plan_end,
               paid_sh, fact_shift_start, fact_shift_end, removed_dttm
        from base as b join couriers as c on b.shift_id = c.shift_id
    )
    group by 1, 2, 3, 4
)"""

MART = """
mart as (
    select b.*,
           nm3_emp_count, nm2_emp_count, nm1_emp_count, n_emp_count,
           shift_sh_ttl,
           coalesce(fact_sh, 0.0) as fact_sh,
           coalesce(trim_fact_sh, 0.0) as trim_fact_sh,
           coalesce(early_start_sh, 0.0) as early_start_sh,
           coalesce(late_start_sh, 0.0) as late_start_sh,
           coalesce(early_end_sh, 0.0) as early_end_sh,
           coalesce(late_end_sh, 0.0) as late_end_sh,
           assigned_emp_cnt, not_removed_cnt, working_cnt,
           (b.max_count - not_removed_cnt) * b.shift_len as not_filled_sh,
           (not_removed_cnt - working_cnt) * b.shift_len as skiped_sh
    from base as b
    left join dynamic as d on b.shift_id = d.shift_id
    left join stat as s on b.shift_id = s.shift_id
)"""

ALL_MART = [SHIFTS, HISTORY, COURIERS, BASE, DAYS, INTERVALS, DYNAMIC, STAT, MART]

SOURCE = """
source as (
    select *, o_orderdate as created_at,
           case when o_orderkey % 5 <> 0 then o_orderdate + interval 1 day * (o_orderkey % 5) end as updated_at
    from orders
)"""

OLD = """
old as (
    select created_at, o_custkey, o_orderdate, o_orderkey, o_orderpriority, o_orderstatus, o_totalprice, updated_at,
           'L0' as launch_id
    from source
    where created_at < timestamp '2000-01-01'
)"""


def _staged(unit: str, first: str, last: str) -> str:
    """Every period in turn takes the rows created or updated in it."""
    return f"""
staged as (
    select created_at, o_custkey, o_orderdate, o_orderkey, o_orderpriority, o_orderstatus, o_totalprice, updated_at,
           'L-' || strftime(period, '%Y-%m-%d') as launch_id
    from source
    join (
        select distinct date_trunc('{unit}', day) as period
        from (select unnest(generate_series(timestamp '{first}', timestamp '{last}', interval 1 day)) as day)
    ) on date_trunc('{unit}', created_at) = period or date_trunc('{unit}', updated_at) = period
)"""


LOADED = """
loaded as (
    select * from old where o_orderkey not in (select o_orderkey from staged)
    union all
    select * from staged
    where launch_id = (select max(s.launch_id) from staged as s where s.o_orderkey = staged.o_orderkey)
)"""

WEEKLY = [SOURCE, OLD, _staged("week", "1999-12-27", "2000-01-09"), LOADED]
MONTHLY = [SOURCE, OLD, _staged("month", "1999-11-15", "2000-02-15"), LOADED]


def _with(parts: list[str], query: str) -> str:
    return "with " + ",".join(parts) + "\n" + query


# Text columns of the profiled tables.
TEXT_COLUMNS = {
    "customer": ["c_name", "c_mktsegment"],
    "documents": ["text", "lang", "source"],
    "lineitem": ["l_returnflag", "l_linestatus"],
    "orders": ["o_orderstatus", "o_orderpriority"],
    "pages": ["url", "html"],
}
PROFILE = "\nunion all ".join(
    f"select '{name}' as table_name, '{column}' as column_name, max(length({column})) as max_size from {name}"
    for name, columns in TEXT_COLUMNS.items()
    for column in columns
)

CLEAN_DOCUMENTS = r"""
select doc_id,
       regexp_replace(text, '[\n\r]+', ' ', 'g') as text,
       regexp_replace(lang, '[\n\r]+', ' ', 'g') as lang,
       regexp_replace(source, '[\n\r]+', ' ', 'g') as source,
       n_chars
from documents"""

ORDERS_BATCH = """
select o_custkey, o_orderdate, o_orderkey, o_orderpriority, o_orderstatus, o_totalprice, 'L1' as launch_id
from orders"""

SOURCE_BATCH = """
select created_at, o_custkey, o_orderdate, o_orderkey, o_orderpriority, o_orderstatus, o_totalprice, updated_at,
       'L1' as launch_id
from source
where date_trunc('week', created_at) = timestamp '1999-12-27'
   or date_trunc('week', updated_at) = timestamp '1999-12-27'"""

# Orders and the same orders with a few other prices: every row counts for the one and against the other.
RETOLD = [
    SOURCE,
    """retold as (select * replace (case when o_orderkey % 9973 = 7 then o_totalprice + 1 else o_totalprice end as o_totalprice)
       from source)""",
    """apart as (
       select created_at, o_custkey, o_orderdate, o_orderkey, o_orderpriority, o_orderstatus, o_totalprice, updated_at,
              cast(sum(here) as bigint) as in_source, cast(sum(there) as bigint) as in_target
       from (select *, 1 as here, 0 as there from source union all select *, 0, 1 from retold)
       group by 1, 2, 3, 4, 5, 6, 7, 8 having sum(here) <> sum(there))""",
]

CALENDAR_OF_SHIFTS = _with(
    [SHIFTS],
    """select unnest(generate_series(cast(cast(min(created_at) as date) as timestamp),
           cast(date_trunc('week', max(end_date)) as timestamp) + interval 6 day, interval 1 day)) as dt
       from shifts""",
)
PERIODS_OF_ORDERS = """
    select distinct unit, cast(date_trunc(unit, day) as date) as period
    from (select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as day from orders)
    cross join (values ('day'), ('week'), ('month'), ('year')) as units(unit)"""

ORACLE: dict[str, str] = {
    "calendar": CALENDAR_OF_SHIFTS,
    "calendar_days": CALENDAR_OF_SHIFTS,
    "load_periods": PERIODS_OF_ORDERS,
    "load_period_list": PERIODS_OF_ORDERS,
    "shifts_base": _with([SHIFTS, BASE], "select * from base"),
    "shift_days": _with([SHIFTS, BASE, DAYS], "select * from days"),
    "status_intervals": _with([HISTORY, INTERVALS], "select * from intervals"),
    "status_days": _with(
        [SHIFTS, HISTORY, BASE, DAYS, INTERVALS],
        """select d.shift_id, employee_id, dt, type
           from days as d
           join intervals as i on d.shift_id = i.shift_id and dt >= status_dttm and dt < next_status_dttm""",
    ),
    "status_asof": _with([SHIFTS, HISTORY, BASE, DAYS, INTERVALS, DYNAMIC], "select * from dynamic"),
    "shift_stat": _with([SHIFTS, COURIERS, BASE, STAT], "select * from stat"),
    "mv_shifts_agg": _with(ALL_MART, "select * from mart"),
    "materialised_mart": _with(ALL_MART, "select * from mart"),
    "reconcile_week": _with(
        ALL_MART,
        """select a._w, a.warehouse_id, shift_cnt_agg, shift_cnt_raw, max_count_agg, max_count_raw,
                  fact_sh_agg, fact_sh_raw
           from (select cast(date_trunc('week', plan_shift_start) as timestamp) as _w, warehouse_id,
                        count(*) as shift_cnt_agg, cast(sum(max_count) as bigint) as max_count_agg,
                        round(sum(fact_sh), 4) as fact_sh_agg
                 from mart group by 1, 2) as a
           join (select cast(date_trunc('week', start_date) as timestamp) as _w, warehouse_id,
                        count(*) as shift_cnt_raw, cast(sum(max_count) as bigint) as max_count_raw
                 from shifts where role_id = 1 group by 1, 2) as r
             on a.warehouse_id = r.warehouse_id and a._w = r._w
           join (select cast(date_trunc('week', plan_shift_start) as timestamp) as _w, warehouse_id,
                        round(sum(paid_sh), 4) as fact_sh_raw
                 from couriers where role_id = 1 group by 1, 2) as p
             on a.warehouse_id = p.warehouse_id and a._w = p._w""",
    ),
    "extract_full": ORDERS_BATCH,
    "extract_period": f"{ORDERS_BATCH} where date_trunc('week', o_orderdate) = timestamp '1999-12-27'",
    "extract_period_updated": _with([SOURCE], SOURCE_BATCH),
    "extract_periods": _with(MONTHLY[:3], "select * from staged"),
    "clean_newlines": CLEAN_DOCUMENTS,
    "string_profile": PROFILE,
    "string_bounds": f"""
        select *, cast(case when max_size <= 1 then 1 else 1 << length(bin(max_size - 1)) end as bigint) as max_length
        from ({PROFILE})""",
    "conform": """
        select l_discount, l_extendedprice, cast(l_linenumber as bigint) as l_linenumber, l_linestatus, l_orderkey,
               l_partkey, l_quantity, l_returnflag, l_shipdate, l_suppkey, l_tax
        from lineitem""",
    "violations": """
        with labelled as (
            select doc_id, text, lang, source, quality from documents left join labels using (doc_id)
        ), counts as (
            select count_if(doc_id is null) as a, count_if(text is null) as b, count_if(length(text) > 4096) as c,
                   count_if(lang is null) as d, count_if(length(lang) > 2) as e, count_if(length(source) > 8) as f,
                   count_if(quality is null) as g, count(doc_id) - count(distinct doc_id) as h
            from labelled
        )
        select 'doc_id' as column_name, 'required' as rule, cast(a as bigint) as violations from counts
        union all select 'text', 'required', cast(b as bigint) from counts
        union all select 'text', 'max_length 4096', cast(c as bigint) from counts
        union all select 'lang', 'required', cast(d as bigint) from counts
        union all select 'lang', 'max_length 2', cast(e as bigint) from counts
        union all select 'source', 'max_length 8', cast(f as bigint) from counts
        union all select 'quality', 'required', cast(g as bigint) from counts
        union all select 'doc_id', 'unique', cast(h as bigint) from counts""",
    "upsert_snapshot": _with(
        [SOURCE, OLD, f"batch as (select * replace (o_totalprice + 1 as o_totalprice) from ({SOURCE_BATCH}))"],
        """select * from old where o_orderkey not in (select o_orderkey from batch)
           union all select * from batch""",
    ),
    "incremental_snapshot": _with(MONTHLY, "select * from loaded"),
    "load_incremental": _with(WEEKLY, "select * from loaded"),
    "load_resumed": _with(WEEKLY, "select * from loaded"),
    "vacuumed_snapshot": _with(WEEKLY, "select * from loaded"),
    "load_full": _with(
        [SOURCE],
        """select created_at, o_custkey, o_orderdate, o_orderkey, o_orderpriority, o_orderstatus, o_totalprice,
                  updated_at, 'L0' as launch_id
           from source""",
    ),
    "load_shifts": _with(
        [SHIFTS],
        """select created_at, end_date, id, max_count, role_id, start_date, warehouse_id,
                  'L-' || strftime(created_at, '%Y-%m-%d') as launch_id
           from shifts where created_at >= timestamp '1999-12-27' and created_at < timestamp '2000-01-04'""",
    ),
    "load_with_new_column": _with(
        WEEKLY,
        "select * replace (case when launch_id <> 'L0' then o_orderpriority end as o_orderpriority) from loaded",
    ),
    "launch_log": _with(
        [SOURCE],
        """select 'L0' as launch_id, count(*) as staged from source where created_at < timestamp '2000-01-01'
           union all
           select 'L-' || strftime(week, '%Y-%m-%d'), count(*)
           from source, (values (timestamp '1999-12-27'), (timestamp '2000-01-03')) as weeks(week)
           where date_trunc('week', created_at) = week or date_trunc('week', updated_at) = week
           group by week""",
    ),
    "materialised_file": """
        select o_orderpriority, count(*) as orders, max(o_orderdate) as last_order from orders group by 1""",
    "completeness": _with(
        WEEKLY,
        """select period, coalesce(source_rows, 0) as source_rows, coalesce(target_rows, 0) as target_rows,
                  coalesce(source_rows, 0) = coalesce(target_rows, 0) as complete
           from (select cast(date_trunc('month', created_at) as date) as period, count(*) as source_rows
                 from source group by 1)
           full join (select cast(date_trunc('month', created_at) as date) as period, count(*) as target_rows
                      from loaded group by 1) using (period)""",
    ),
    "same_content": _with(
        RETOLD,
        """select period, source_rows, source_rows as target_rows, true as complete,
                  period not in (select cast(date_trunc('month', created_at) as date) from apart) as same
           from (select cast(date_trunc('month', created_at) as date) as period, count(*) as source_rows from source group by 1)""",
    ),
    "row_differences": _with(RETOLD, "select * from apart"),
    "delimited_text": f"""
        select *, case doc_id % 3 when 0 then '' when 1 then lang end as note from ({CLEAN_DOCUMENTS})""",
    "delimited_raw_text": "select * from documents",
}
