"""One query per operator over the sample tables. Each takes a session and the folder of the tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views
from checks.views import table
from tallyloom.functions import PERIOD_UNITS
from tallyloom.operators import calendar as cal
from tallyloom.operators import conform as con
from tallyloom.operators import extract as ext
from tallyloom.operators import intervals, quality, skew, upsert
from tallyloom.plans import load, shifts
from tallyloom.session import fresh_dir
from tallyloom.sources import delimited, snapshot, tables

# The sample orders run from 1995-01-01 to 2001-08-01.
CALENDAR = cal.Calendar.upto(date(2001, 12, 28), start=date(1995, 1, 1))
CUT = date(2000, 1, 1)
WEEKS = cal.load_periods(date(1999, 12, 27), date(2000, 1, 9), "week")
MONTHS = cal.load_periods(date(1999, 11, 15), date(2000, 2, 15), "month")
# The samples hold a handful of orders per day, too few for a file of their own.
SPEC = load.LoadSpec(
    "public.orders",
    "orders",
    partitioning_field="created_at",
    clustering_field="o_orderkey",
    date_trunc="week",
    key="o_orderkey",
    partition_unit="month",
)

LINEITEM_COLUMNS = [
    con.SourceColumn("l_orderkey", "bigint"),
    con.SourceColumn("l_partkey", "bigint"),
    con.SourceColumn("l_suppkey", "bigint"),
    con.SourceColumn("l_linenumber", "integer"),
    con.SourceColumn("l_quantity", "numeric"),
    con.SourceColumn("l_extendedprice", "numeric"),
    con.SourceColumn("l_discount", "double precision"),
    con.SourceColumn("l_tax", "real"),
    con.SourceColumn("l_returnflag", "character varying"),
    con.SourceColumn("l_linestatus", "character varying"),
    con.SourceColumn("l_shipdate", "timestamp without time zone"),
]
DOCUMENT_COLUMNS = [
    con.SourceColumn("doc_id", "bigint", False),
    con.SourceColumn("text", "text", False, 4000),
    con.SourceColumn("lang", "character varying", False, 2),
    con.SourceColumn("source", "character varying", True, 7),
    con.SourceColumn("quality", "integer", False),
]


def _name_launch(period: date | None) -> str:
    return f"L-{period}" if period else "L0"


def _mart_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, list[Any]]:
    orders, lineitem = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    # Both views keep the order key of every line as their shift id, so one look at it serves them all.
    heavy = skew.heavy_keys(lineitem, "l_orderkey")
    return (
        views.shifts(orders),
        views.history(lineitem, orders, heavy),
        views.couriers(lineitem, orders, heavy),
        heavy,
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.calendar_over(views.shifts(table(spark, sf_dir, "orders")), "created_at", "end_date")


def load_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cal.periods_over(table(spark, sf_dir, "orders"), "o_orderdate")


def calendar_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar that the mart takes, up to the week of a moment that is a parameter; here that of the last shift."""
    span = views.shifts(table(spark, sf_dir, "orders")).agg(F.min("created_at"), F.max("end_date")).first()
    return cal.Calendar.upto(span[1], start=span[0].date()).days(spark)


def load_period_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periods that a loader goes through from the first to the last order."""
    span = table(spark, sf_dir, "orders").agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    first, last = cal.resolve_interval(*span)
    rows = [(unit, period) for unit in PERIOD_UNITS for period in cal.load_periods(first, last, unit)]
    return spark.createDataFrame(rows, "unit string, period date")


def shifts_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shifts.shifts_base(views.shifts(table(spark, sf_dir, "orders")))


def shift_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shifts.shift_days(shifts_base(spark, sf_dir), CALENDAR)


def _intervals(spark: SparkSession, sf_dir: str, history: DataFrame, heavy: list[Any]) -> DataFrame:
    # A pair has no more rows than its shift, so only with a heavy shift can there be a heavy pair.
    lines = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey as shift_id", "l_suppkey as employee_id")
    return intervals.status_intervals(history, skew.heavy_keys(lines, *intervals.PAIR) if heavy else [])


def status_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, history, _, heavy = _mart_inputs(spark, sf_dir)
    return _intervals(spark, sf_dir, history, heavy)


def status_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    shift_rows, history, _, heavy = _mart_inputs(spark, sf_dir)
    spans = shifts.shift_spans(shifts.shifts_base(shift_rows), CALENDAR)
    return intervals.status_days(_intervals(spark, sf_dir, history, heavy), spans, heavy)


def status_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    shift_rows, history, _, heavy = _mart_inputs(spark, sf_dir)
    return shifts.shift_dynamic(shifts.shifts_base(shift_rows), history, CALENDAR, heavy)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """Sums of doubles depend on the order of rows in the last places."""
    return df.withColumns({n: F.round(n, 4) for n in names})


def shift_stat(spark: SparkSession, sf_dir: str) -> DataFrame:
    shift_rows, _, couriers, heavy = _mart_inputs(spark, sf_dir)
    return _rounded(shifts.shift_stat(shifts.shifts_base(shift_rows), couriers, heavy), "fact_sh")


def _mart(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    shift_rows, history, couriers, heavy = _mart_inputs(spark, sf_dir)
    return shifts.mv_shifts_agg(shift_rows, history, couriers, CALENDAR, heavy), shift_rows, couriers


def mv_shifts_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(_mart(spark, sf_dir)[0], "fact_sh")


def materialised_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = tables.Layers(fresh_dir(spark, "mart")).create(spark)
    name = f"mv_shifts_agg_{uuid.uuid4().hex}"
    tables.materialise(spark, layers, name, lambda: mv_shifts_agg(spark, sf_dir))
    return spark.table(f"{layers.analytics}.{name}")


def reconcile_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(shifts.reconcile_week(*_mart(spark, sf_dir)), "fact_sh_agg", "fact_sh_raw")


def _source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a creation and, for four of five, a later update."""
    return table(spark, sf_dir, "orders").selectExpr(
        "*",
        "o_orderdate as created_at",
        "if(o_orderkey % 5 = 0, null, o_orderdate + interval 1 day * (o_orderkey % 5)) as updated_at",
    )


def _old_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = _source(spark, sf_dir)
    return ext.extract(source.where(F.col("created_at") < F.lit(CUT).cast("timestamp_ntz")), "L0")


def extract_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ext.extract(table(spark, sf_dir, "orders"), "L1")


def extract_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ext.extract(table(spark, sf_dir, "orders"), "L1", field="o_orderdate", period=WEEKS[0], unit="week")


def extract_period_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ext.extract(_source(spark, sf_dir), "L1", field="created_at", period=WEEKS[0], unit="week")


def extract_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    launches = load.name_launches(MONTHS, _name_launch)
    return ext.extract_periods(_source(spark, sf_dir), launches, "created_at", "month")


def clean_newlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return con.clean_text(table(spark, sf_dir, "documents"))


def string_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = [
        con.string_profile(table(spark, sf_dir, name)).select(F.lit(name).alias("table_name"), "*")
        for name in ("customer", "documents", "lineitem", "orders", "pages")
    ]
    return reduce(DataFrame.unionByName, profiles)


def string_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return con.string_bounds(string_profile(spark, sf_dir))


def conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return con.conform(table(spark, sf_dir, "lineitem"), LINEITEM_COLUMNS)


def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labelled = documents.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return quality.violations(labelled, DOCUMENT_COLUMNS, key="doc_id")


def upsert_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = ext.extract(_source(spark, sf_dir), "L1", field="created_at", period=WEEKS[0], unit="week")
    batch = batch.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    heavy = skew.heavy_keys(table(spark, sf_dir, "orders"), "o_orderkey")
    return upsert.upsert(_old_snapshot(spark, sf_dir), batch, "o_orderkey", heavy)


def _incremental(spark: SparkSession, sf_dir: str, periods: list[date], unit: str) -> DataFrame:
    launches = load.name_launches(periods, _name_launch)
    heavy = skew.heavy_keys(table(spark, sf_dir, "orders"), "o_orderkey")
    old, source = _old_snapshot(spark, sf_dir), _source(spark, sf_dir)
    return load.incremental_snapshot(old, source, launches, "created_at", unit, "o_orderkey", heavy=heavy)


def incremental_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _incremental(spark, sf_dir, MONTHS, "month")


def _loader(spark: SparkSession) -> tuple[load.Loader, load.LoadSpec]:
    """Loader into tables of this run alone."""
    layers = tables.Layers(fresh_dir(spark, "load"))
    return load.Loader(spark, layers, _name_launch), replace(SPEC, target_table=f"orders_{uuid.uuid4().hex}")


def load_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    loader, spec = _loader(spark)
    loader.load(replace(spec, date_trunc=None), _source(spark, sf_dir))
    return spark.table(f"{loader.layers.snapshot}.{spec.target_table}").drop(tables.PART)


def load_shifts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight days of shifts by the spec that comes with the package."""
    loader, _ = _loader(spark)
    spec = replace(load.SHIFTS, target_table=f"shifts_{uuid.uuid4().hex}")
    loader.load(spec, views.shifts(table(spark, sf_dir, "orders")), start=WEEKS[0], end=WEEKS[-1])
    return spark.table(f"{loader.layers.snapshot}.{spec.target_table}").drop(tables.PART)


def load_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    loader, spec = _loader(spark)
    source = _source(spark, sf_dir)
    loader.load_full(spec, source.where(F.col("created_at") < F.lit(CUT).cast("timestamp_ntz")))
    loader.load(spec, source, start=WEEKS[0], end=WEEKS[-1])
    return spark.table(f"{loader.layers.snapshot}.{spec.target_table}").drop(tables.PART)


def load_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second load ends when its rows are staged; another loader carries it on from the journal."""
    loader, spec = _loader(spark)
    source = _source(spark, sf_dir)
    loader.load_full(spec, source.where(F.col("created_at") < F.lit(CUT).cast("timestamp_ntz")))
    loader.load(spec, source, start=WEEKS[0], end=WEEKS[-1], apply=False)
    load.Loader(spark, loader.layers).resume(spec)
    return spark.table(f"{loader.layers.snapshot}.{spec.target_table}").drop(tables.PART)


def vacuumed_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot of an incremental load when all that only its former state needs is removed."""
    loader, spec = _loader(spark)
    source = _source(spark, sf_dir)
    loader.load_full(spec, source.where(F.col("created_at") < F.lit(CUT).cast("timestamp_ntz")))
    loader.load(spec, source, start=WEEKS[0], end=WEEKS[-1])
    found = snapshot.SnapshotTable(
        spark, loader.layers, spec.target_table, spec.partitioning_field, spec.key, spec.partition_unit, spec.clustering_field
    )
    found.vacuum(keep=1)
    return found.read()


def load_with_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first load comes before the source has its priority column; the second brings it."""
    loader, spec = _loader(spark)
    source = _source(spark, sf_dir)
    before = source.where(F.col("created_at") < F.lit(CUT).cast("timestamp_ntz"))
    loader.load_full(spec, before.drop("o_orderpriority"))
    loader.on_new_columns = "add"
    loader.load(spec, source, start=WEEKS[0], end=WEEKS[-1])
    return spark.table(f"{loader.layers.snapshot}.{spec.target_table}").drop(tables.PART)


def launch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logged launches of a full and an incremental load, with the rows that each staged."""
    layers = tables.Layers(fresh_dir(spark, "load"), log=f"engine_{uuid.uuid4().hex}")
    loader = load.Loader(spark, layers, _name_launch)
    spec = replace(SPEC, target_table=f"orders_{uuid.uuid4().hex}")
    source = _source(spark, sf_dir)
    loader.load_full(spec, source.where(F.col("created_at") < F.lit(CUT).cast("timestamp_ntz")))
    loader.load(spec, source, start="19991227", interval=13)
    staged = spark.table(f"{layers.staging}.{spec.target_table}").groupBy(con.LAUNCH_ID).agg(F.count(F.lit(1)).alias("staged"))
    logged = spark.table(f"{layers.log}.launch_log").where("log_dtime is not null")
    return logged.join(staged, con.LAUNCH_ID, "left").select(con.LAUNCH_ID, "staged")


def materialised_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = tables.Layers(fresh_dir(spark, "mart")).create(spark)
    name = f"orders_by_priority_{uuid.uuid4().hex}"
    table(spark, sf_dir, "orders").createOrReplaceTempView("sample_orders")
    tables.materialise(spark, layers, name, Path(__file__).with_name("orders_by_priority.sql"))
    return spark.table(f"{layers.analytics}.{name}")


def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = _incremental(spark, sf_dir, WEEKS, "week")
    return quality.completeness(_source(spark, sf_dir), loaded, "created_at", "month")


def _retold(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders, and as many orders with a few other prices."""
    source = _source(spark, sf_dir)
    price = F.when(F.col("o_orderkey") % 9973 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return source, source.withColumn("o_totalprice", price)


def same_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.same_content(*_retold(spark, sf_dir), "created_at", "month")


def row_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.differences(*_retold(spark, sf_dir), "created_at", "month")


def delimited_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    note = F.expr("case doc_id % 3 when 0 then '' when 1 then lang end")
    cleaned = con.clean_text(table(spark, sf_dir, "documents")).withColumn("note", note)
    path = fresh_dir(spark, "text")
    delimited.write_delimited(cleaned, path)
    return delimited.read_delimited(spark, path, cleaned.schema, multi_line=False)


def delimited_raw_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "documents")
    path = fresh_dir(spark, "raw_text")
    delimited.write_delimited(raw, path)
    return delimited.read_delimited(spark, path, raw.schema)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        calendar,
        load_periods,
        calendar_days,
        load_period_list,
        shifts_base,
        shift_days,
        status_intervals,
        status_days,
        status_asof,
        shift_stat,
        mv_shifts_agg,
        materialised_mart,
        reconcile_week,
        extract_full,
        extract_period,
        extract_period_updated,
        extract_periods,
        clean_newlines,
        string_profile,
        string_bounds,
        conform,
        violations,
        upsert_snapshot,
        incremental_snapshot,
        load_incremental,
        load_full,
        load_shifts,
        load_resumed,
        vacuumed_snapshot,
        load_with_new_column,
        launch_log,
        materialised_file,
        completeness,
        same_content,
        row_differences,
        delimited_text,
        delimited_raw_text,
    )
}
