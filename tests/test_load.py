"""The loader: batches, upserts, tables."""

import logging
import random
import uuid
from collections import Counter
from dataclasses import replace
from datetime import date, datetime, time, timedelta

import pandas as pd
import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyloom.operators import calendar as cal
from tallyloom.operators import conform as con
from tallyloom.operators import extract as ext
from tallyloom.operators import quality, skew
from tallyloom.operators import upsert as upsert_module
from tallyloom.operators.conform import SourceColumn, measure, source_columns
from tallyloom.operators.upsert import latest_launches, upsert
from tallyloom.plans import load
from tallyloom.sources import delimited, jdbc, snapshot, tables

SCHEMA = "id bigint, name string, created_at timestamp_ntz, updated_at timestamp_ntz"
SPEC = load.LoadSpec("public.things", "things", None, "created_at", "id", "day")


def bag(df, *columns):
    return Counter(tuple(r) for r in df.select(*(columns or sorted(df.columns))).collect())


def make_rows(rng, n, ids=None):
    rows = []
    for i in range(n):
        created = datetime(2024, 1, 1) + timedelta(hours=rng.randrange(0, 30 * 24))
        updated = created + timedelta(hours=rng.randrange(0, 12 * 24)) if rng.random() < 0.7 else None
        key = i if ids is None else rng.choice(ids)
        rows.append((key, f"name {i}", created if rng.random() < 0.95 else None, updated))
    return rows


def one_after_the_other(snapshot, rows, launches, unit):
    """Literal evaluation: for each period delete the batch's ids, then insert the batch."""
    staged = []
    for period, launch in sorted(launches.items()):
        batch = [
            (*row, launch)
            for row in rows
            if any(t is not None and cal.truncate_day(t.date(), unit) == period for t in row[2:4])
        ]
        ids = {row[0] for row in batch if row[0] is not None}
        snapshot = [row for row in snapshot if row[0] not in ids] + batch
        staged += batch
    return staged, snapshot


@pytest.mark.parametrize("unit", ["day", "week", "month"])
@pytest.mark.parametrize("ids", [None, [*range(40), None]])
def test_all_periods_at_once_equal_one_after_the_other(spark, unit, ids):
    rng = random.Random(5)
    rows = make_rows(rng, 200, ids)
    old = [(*row, "L0") for row in make_rows(rng, 60, ids)]
    launches = load.name_launches(cal.load_periods(date(2024, 1, 10), date(2024, 2, 3), unit), lambda p: f"L-{p}")
    source = spark.createDataFrame(rows, SCHEMA)
    snapshot = spark.createDataFrame(old, f"{SCHEMA}, launch_id string")
    columns = ["id", "name", "created_at", "updated_at", "launch_id"]
    expected_staged, expected = one_after_the_other(old, rows, launches, unit)
    staged = ext.extract_periods(source, launches, "created_at", unit)
    assert bag(staged, *columns) == Counter(expected_staged)
    for heavy in ([], [3, None]):
        found = load.incremental_snapshot(snapshot, source, launches, "created_at", unit, heavy=heavy)
        assert bag(found, *columns) == Counter(expected)


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "b2")], "id bigint, v string")
    batch = spark.createDataFrame([(2, "new"), (2, "new too"), (3, "d"), (None, "e")], "id bigint, v string")
    expected = Counter([(1, "a"), (None, "c"), (2, "new"), (2, "new too"), (3, "d"), (None, "e")])
    once = upsert(old, batch)
    assert bag(once, "id", "v") == expected
    again = upsert(once, batch.where("id is not null"))
    assert bag(again, "id", "v") == expected


def test_period_filter_reaches_the_scan(spark, sample_dir):
    orders = spark.read.parquet(f"{sample_dir}/orders.parquet")
    batch = ext.extract(orders, "L", field="o_orderdate", period=date(1999, 12, 27), unit="week")
    with_limit = "spark.sql.maxMetadataStringLength"
    spark.conf.set(with_limit, "1000")
    plan = batch._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset(with_limit)
    assert "GreaterThanOrEqual(o_orderdate,1999-12-27" in plan and "LessThan(o_orderdate,2000-01-03" in plan


def test_a_day_that_starts_no_period_matches_nothing(spark):
    source = spark.createDataFrame([(1, "a", datetime(2024, 1, 3), None)], SCHEMA)
    assert ext.extract(source, "L", field="created_at", period=date(2024, 1, 3), unit="week").count() == 0
    assert ext.extract(source, "L", field="created_at", period=date(2024, 1, 1), unit="week").count() == 1
    with pytest.raises(ValueError, match="does not start"):
        ext.extract_periods(source, {date(2024, 1, 3): "L"}, "created_at", "week")


def test_rows_without_a_date(spark):
    rows = [(1, "never", None, None), (2, "by update", None, datetime(2024, 1, 3, 5))]
    source = spark.createDataFrame(rows, SCHEMA)
    batch = ext.extract(source, "L", field="created_at", period=date(2024, 1, 3))
    assert [r.id for r in batch.collect()] == [2]
    batch = ext.extract(source.drop("updated_at"), "L", field="created_at", period=date(2024, 1, 3))
    assert batch.count() == 0
    assert ext.extract(source, "L").count() == 2


def test_source_names():
    assert ext.split_table_name("public.shifts", "db") == ("db", "public", "shifts")
    assert ext.split_table_name("cat.public.shifts") == ("cat", "public", "shifts")
    for bad in ("shifts", "a.b.c.d"):
        with pytest.raises(ValueError, match="schema.table"):
            ext.split_table_name(bad)
    with pytest.raises(ValueError, match="no columns"):
        ext.has_updates([])


def test_conform(spark):
    df = spark.sql(
        """select 'x\\ny' as b, 7S as a, 1.5BD as d, array(1, null) as c, true as e, timestamp_ntz'2024-01-01' as f,
                  'p\\r\\nq' as g, '10:11:12' as h"""
    )
    columns = [
        con.SourceColumn("b", "CHARACTER VARYING"),
        con.SourceColumn("a", "smallint"),
        con.SourceColumn("d", "numeric"),
        con.SourceColumn("c", "array"),
        con.SourceColumn("e", "boolean"),
        con.SourceColumn("f", "timestamp without time zone"),
        con.SourceColumn("g", "json"),
        con.SourceColumn("h", "time without time zone"),
    ]
    conformed = con.conform(df, columns, clean=True)
    assert conformed.dtypes == [
        ("a", "bigint"),
        ("b", "string"),
        ("c", "string"),
        ("d", "double"),
        ("e", "boolean"),
        ("f", "timestamp_ntz"),
        ("g", "string"),
        ("h", "string"),
    ]
    row = conformed.first()
    assert (row.b, row.c, row.g) == ("x y", "[1,null]", "p\r\nq")


@pytest.mark.parametrize("enabled, expected", [("false", "10:11:12"), ("true", time(10, 11, 12))])
def test_times_of_day(spark, enabled, expected):
    spark.conf.set("spark.sql.timeType.enabled", enabled)
    try:
        df = spark.sql("select '10:11:12' as a, timestamp_ntz'1970-01-01 10:11:12' as b, cast(null as string) as c")
        columns = [con.SourceColumn(n, "time without time zone") for n in df.columns]
        assert tuple(con.conform(df, columns).first()) == (expected, expected, None)
    finally:
        spark.conf.unset("spark.sql.timeType.enabled")


def test_unsupported_types_name_the_column(spark):
    with pytest.raises(ValueError, match="moment.*timestamp with time zone"):
        con.conform(spark.sql("select timestamp'2024-01-01 00:00:00' as moment"))
    assert len(con.TYPE_MAP) == 17


def test_profile_and_bounds(spark):
    rows = [("", "é" * 5, None), ("a", "xy", None), (None, "abcd", None)]
    df = spark.createDataFrame(rows, "one string, five string, none string").withColumn("n", F.lit(1))
    bounds = {r.column_name: (r.max_size, r.max_length) for r in con.string_bounds(con.string_profile(df)).collect()}
    assert bounds == {"one": (1, 1), "five": (5, 8), "none": (None, None)}
    measured = con.measure(df, con.source_columns(df))
    assert [(c.name, c.bound) for c in measured] == [("five", 8), ("n", None), ("none", None), ("one", 1)]
    assert con.string_profile(df.select("n")).count() == 0
    assert con.SourceColumn("x", "text", max_size=0).bound == 1


def test_catalogue_columns(spark):
    rows = [
        ("db", "public", "shifts", "role_id", "YES", "Integer"),
        ("db", "public", "shifts", "id", "NO", "bigint"),
        ("db", "other", "shifts", "x", "NO", "bigint"),
        ("other", "public", "shifts", "y", "NO", "bigint"),
    ]
    names = ["table_catalog", "table_schema", "table_name", "column_name", "is_nullable", "data_type"]
    catalogue = spark.createDataFrame(rows, names)
    found = con.catalogue_columns(catalogue, "public", "shifts", "db")
    assert found == [con.SourceColumn("id", "bigint", False), con.SourceColumn("role_id", "integer", True)]


def test_violations(spark):
    df = spark.createDataFrame([(1, "abc"), (1, "abcde"), (2, None), (None, "")], "id bigint, name string")
    columns = [con.SourceColumn("id", "bigint", False), con.SourceColumn("name", "text", False, 3)]
    found = {(r.column_name, r.rule): r.violations for r in quality.violations(df, columns, "id").collect()}
    assert found == {
        ("id", "required"): 1,
        ("name", "required"): 1,
        ("name", "max_length 4"): 1,
        ("id", "unique"): 1,
    }
    assert quality.violations(df, [con.SourceColumn("name", "text")]).count() == 0
    assert [r.violations for r in quality.violations(df.where("id > 5"), columns, "id").collect()] == [0] * 4


def test_enforce(spark):
    columns = [con.SourceColumn("id", "bigint", False), con.SourceColumn("name", "text", True, 4)]
    good = spark.createDataFrame([(1, "abcd"), (2, None)], "id bigint, name string")
    checked = quality.enforce(good, columns)
    assert checked.dtypes == good.dtypes and checked.count() == 2
    assert bag(checked) == bag(good)
    for bad, message in [((None, "a"), "id: NULL"), ((1, "abcde"), "name: text longer than 4")]:
        with pytest.raises(PySparkException, match=message):
            quality.enforce(spark.createDataFrame([bad], "id bigint, name string"), columns).collect()


def test_completeness(spark):
    schema = "ts timestamp_ntz"
    source = spark.createDataFrame([(datetime(2024, 1, 1, 5),), (datetime(2024, 1, 2),), (None,)], schema)
    target = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 3),), (None,)], schema)
    found = quality.completeness(source, target, "ts")
    assert bag(found, "period", "source_rows", "target_rows", "complete") == Counter(
        [
            (date(2024, 1, 1), 1, 1, True),
            (date(2024, 1, 2), 1, 0, False),
            (date(2024, 1, 3), 0, 1, False),
            (None, 1, 1, True),
        ]
    )


def test_content(spark):
    schema = "ts timestamp_ntz, a string, b double"
    day = lambda d: datetime(2024, 1, d, 5)
    source = [(day(1), "x", 1.0), (day(1), "x", 1.0), (day(1), "y", None), (day(2), "a", None), (day(3), None, 2.0), (None, "n", 1.0)]
    cases = {
        "copies": [(day(1), "x", 1.0), (day(1), "y", None), (day(1), "y", None), *source[3:]],
        "cell": [*source[:3], (day(1) + timedelta(days=1), "A", None), *source[4:]],
        "null": [*source[:4], (day(3), "", 2.0), source[5]],
        "no date": [*source[:5], (None, "n", 1.5)],
        "order": source[::-1],
    }
    differing = {"copies": {date(2024, 1, 1)}, "cell": {date(2024, 1, 2)}, "null": {date(2024, 1, 3)}, "no date": {None}, "order": set()}
    left = spark.createDataFrame(source, schema)
    for name, rows in cases.items():
        right = spark.createDataFrame(rows, schema).withColumn("launch_id", F.lit("L"))
        found = quality.same_content(left, right, "ts").collect()
        assert {r["period"] for r in found if not r["same"]} == differing[name]
        assert all(r["complete"] for r in found) and len(found) == 4
        apart = {(r["ts"], r["a"], r["b"]): r["in_source"] - r["in_target"] for r in quality.differences(left, right, "ts").collect()}
        plain = Counter(source)
        plain.subtract(Counter(rows))
        assert apart == {k: v for k, v in plain.items() if v}
    missing = quality.same_content(left, left.where("a <> 'a'"), "ts").where("not same").collect()
    assert {r["period"]: (r["source_rows"], r["target_rows"]) for r in missing} == {date(2024, 1, 2): (1, 0), date(2024, 1, 3): (1, 0)}
    with pytest.raises(ValueError, match="differ in"):
        quality.same_content(left, left.withColumn("b", F.lit(1)), "ts")


def test_differing_rows_are_dealt_to_parts_of_a_fixed_size(spark, monkeypatch):
    """However few shuffle partitions there are, so that a task's memory does not grow with the tables."""
    monkeypatch.setattr(quality, "PART_ROWS", 1000, raising=False)
    left = spark.range(20_000).selectExpr("id", "'x' as name", "timestamp_ntz'2024-01-01 05:00:00' as ts")
    found = quality.differences(left, left.withColumn("name", F.expr("if(id = 0, 'x', 'y')")), "ts", "month")
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 2 * 19_999
    assert max(sizes) < 2000


@pytest.mark.parametrize("part_rows", [20, 100_000])
@pytest.mark.parametrize("cell_rows", [1, 50])
def test_differences_of_many_copies(spark, monkeypatch, part_rows, cell_rows):
    monkeypatch.setattr(quality, "PART_ROWS", part_rows, raising=False)
    monkeypatch.setattr(quality, "CELL_ROWS", cell_rows, raising=False)
    rng = random.Random(part_rows + cell_rows)
    days = [None, datetime(2024, 1, 1), datetime(2024, 1, 2), datetime(2024, 2, 1)]
    rows = [(rng.choice(days), rng.choice([None, "", "a", "b"]), rng.choice([None, 0.0, float("inf")])) for _ in range(60)]
    rows += [(days[1], "often", 1.0)] * 90
    others = [*rows[5:], (days[1], "often", 1.0), (days[3], "new", None)]
    left, right = (spark.createDataFrame(r, "ts timestamp_ntz, a string, b double").repartition(3) for r in (rows, others))
    found = quality.differences(left, right, "ts", "month").collect()
    plain, plain_others = Counter(rows), Counter(others)
    expected = {k: (plain[k], plain_others[k]) for k in plain | plain_others if plain[k] != plain_others[k]}
    assert {(r["ts"], r["a"], r["b"]): (r["in_source"], r["in_target"]) for r in found} == expected
    assert len(found) == len(expected)


def test_differences_within_lists(spark, monkeypatch):
    """Lists that differ only in the place of a null have the same hash."""
    monkeypatch.setattr(quality, "CELL_ROWS", 1, raising=False)
    day = datetime(2024, 1, 1)
    rows = [(day, ["a", None]), (day, ["x", "y"]), *[(day, [str(n)]) for n in range(50)]]
    others = [(day, [None, "a"]), (day, ["x", "z"]), *rows[2:]]
    left, right = (spark.createDataFrame(r, "ts timestamp_ntz, a array<string>") for r in (rows, others))
    found = {tuple(r["a"]): (r["in_source"], r["in_target"]) for r in quality.differences(left, right, "ts").collect()}
    assert found == {("a", None): (1, 0), ("x", "y"): (1, 0), (None, "a"): (0, 1), ("x", "z"): (0, 1)}


@pytest.fixture
def layers(spark, tmp_path):
    tag = uuid.uuid4().hex[:8]
    names = {n: f"{n}_{tag}" for n in ("staging", "snapshot", "analytics", "log")}
    return tables.Layers(str(tmp_path), **names).create(spark)


def snapshot_of(spark, layers, table="things"):
    return spark.table(f"{layers.snapshot}.{table}").drop(tables.PART)


@pytest.mark.parametrize("least", [skew.MIN_HEAVY_ROWS, 1])
def test_daily_loads_equal_one_long_load(spark, tmp_path, monkeypatch, least):
    """Also with a key and missing keys that count as heavy: a third of the rows each."""
    for module in (snapshot, upsert_module):
        monkeypatch.setattr(module, "heavy_keys", lambda df, *keys: skew.heavy_keys(df, *keys, min_rows=least))
    rng = random.Random(9)
    rows = make_rows(rng, 80, [*range(10), *[3] * 10, *[None] * 10])
    source = spark.createDataFrame(rows, SCHEMA)
    results = []
    for ranges in ([(20240101, 20240120)], [(20240101, 20240109), (20240110, 20240120)]):
        tag = uuid.uuid4().hex[:8]
        layers = tables.Layers(f"{tmp_path}/{tag}", f"saa{tag}", f"snp{tag}", f"analytics{tag}", f"engine{tag}")
        loader = load.Loader(spark, layers)
        for start, end in ranges:
            loader.load(SPEC, source, start, end)
        results.append(bag(snapshot_of(spark, layers).drop("launch_id")))
        launches = spark.table(f"{layers.log}.launch_log")
        assert launches.count() == 20 == launches.select("launch_id").distinct().count()
    launches = {p: str(p) for p in cal.load_periods(date(2024, 1, 1), date(2024, 1, 20))}
    _, expected = one_after_the_other([], rows, launches, "day")
    # Columns in name order, as the snapshot has them.
    assert results[0] == results[1] == Counter((r[2], r[0], r[1], r[3]) for r in expected)


def test_reload_and_moved_rows(spark, layers):
    """A row that moves to another day leaves no stale copy, even where its day becomes empty."""
    loader = load.Loader(spark, layers)
    spec = replace(SPEC, date_trunc=None)
    first = [(1, "a", datetime(2024, 1, 1, 5), None), (2, "b", datetime(2024, 1, 2), None), (None, "n", None, None)]
    result = loader.load(spec, spark.createDataFrame(first, SCHEMA))
    assert result.rewritten == ["2024-01-01", "2024-01-02", tables.NO_DATE]
    assert list(result.launches) == [None]
    moved = [(1, "z", datetime(2024, 1, 3), None)]
    result = loader.load(spec, spark.createDataFrame(moved, SCHEMA))
    assert result.rewritten == ["2024-01-01", "2024-01-03"]
    after = snapshot_of(spark, layers)
    assert bag(after, "id", "name") == Counter([(1, "z"), (2, "b"), (None, "n")])
    days = {r["part"] for r in spark.table(f"{layers.snapshot}.things__manifest").collect()}
    assert days == {"2024-01-02", "2024-01-03", tables.NO_DATE}
    loader.load(spec, spark.createDataFrame(moved, SCHEMA))
    assert bag(snapshot_of(spark, layers), "id", "name") == Counter([(1, "z"), (2, "b"), (None, "n")])
    assert spark.table(f"{layers.staging}.things").count() == 5


def test_loads_that_break_the_schema_fail_and_leave_the_snapshot(spark, layers):
    loader = load.Loader(spark, layers)
    spec = replace(SPEC, date_trunc=None)
    columns = [
        con.SourceColumn("id", "bigint", False),
        con.SourceColumn("name", "character varying"),
        con.SourceColumn("created_at", "timestamp without time zone"),
        con.SourceColumn("updated_at", "timestamp without time zone"),
    ]
    loader.load(spec, spark.createDataFrame([(1, "abc", None, None)], SCHEMA), columns=columns)
    for bad in [(2, "abcde", None, None), (None, "a", None, None)]:
        with pytest.raises(PySparkException):
            loader.load(spec, spark.createDataFrame([bad], SCHEMA), columns=columns)
    assert bag(snapshot_of(spark, layers), "id", "name") == Counter([(1, "abc")])
    assert spark.table(f"{layers.staging}.things").count() == 1


def test_nothing_to_load(spark, layers):
    loader = load.Loader(spark, layers)
    source = spark.createDataFrame([(1, "a", datetime(2024, 1, 1), None)], SCHEMA)
    result = loader.load(SPEC, source, 20240105)
    assert result.rewritten == [] and len(result.launches) == 1
    assert loader.load(SPEC, source, 20240105, 20240104) == load.LoadResult({}, [])
    assert snapshot_of(spark, layers).count() == 0
    with pytest.raises(ValueError, match="partitioning field"):
        loader.load(replace(SPEC, partitioning_field=None), source, 20240105)


def test_latest_of_a_single_launch_is_the_launch(spark):
    staged = spark.createDataFrame([(1, "L")], "id bigint, launch_id string")
    assert latest_launches(staged, {date(2024, 1, 1): "L"}) is staged


def test_shipped_specs():
    for spec in (load.BRANDS, load.SHIFTS, load.SHIFT_REASONS):
        assert spec.source_table == f"public.{spec.target_table}"
        assert (spec.partitioning_field, spec.clustering_field, spec.date_trunc, spec.key) == (
            "created_at",
            "id",
            "day",
            "id",
        )


def test_create_table_conflicts(spark, layers):
    name, location = f"{layers.analytics}.t", layers.location(layers.analytics, "t")
    tables.create_table(spark, name, "a BIGINT", location)
    spark.sql(f"INSERT INTO {name} VALUES (1)")
    with pytest.raises(PySparkException, match="TABLE_OR_VIEW_ALREADY_EXISTS"):
        tables.create_table(spark, name, "a BIGINT", location)
    tables.create_table(spark, name, "a BIGINT", location, if_exists="KEEP")
    assert spark.table(name).count() == 1
    tables.create_table(spark, name, "b STRING", location, if_exists="REPLACE")
    assert spark.table(name).columns == ["b"] and spark.table(name).count() == 0
    with pytest.raises(ValueError, match="MAYBE"):
        tables.create_table(spark, name, "a BIGINT", location, if_exists="MAYBE")


def test_a_table_that_cannot_be_replaced_stays(spark, layers, monkeypatch):
    name, location = f"{layers.analytics}.kept", layers.location(layers.analytics, "kept")
    tables.create_table(spark, name, "a BIGINT, b VARCHAR(3)", location)
    spark.sql(f"INSERT INTO {name} VALUES (1, 'x')")
    with pytest.raises(PySparkException):
        tables.create_table(spark, name, "a NO_SUCH_TYPE", location, if_exists="REPLACE")
    assert spark.table(name).count() == 1

    said = []
    plain = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: said.append(text) or plain(self, text, *a, **k))
    tables.create_table(spark, name, "a BIGINT, b VARCHAR(3)", location, if_exists="REPLACE")
    assert spark.table(name).count() == 0 and f"DROP TABLE {name}" not in said
    # Other lengths and partitions are other tables.
    for ddl, by in (("a BIGINT, b VARCHAR(5)", None), ("a BIGINT, b VARCHAR(5)", "a"), ("a BIGINT, b VARCHAR(5)", "a")):
        said.clear()
        tables.create_table(spark, name, ddl, location, by, if_exists="REPLACE")
        assert spark.table(name).count() == 0 and said.index(f"DROP TABLE {name}") > 0
        assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ([by] if by else [])


def test_materialise(spark, layers, tmp_path, caplog):
    caplog.set_level(logging.INFO, logger=tables.__name__)
    name = f"{layers.analytics}.totals"
    tables.materialise(spark, layers, "totals", spark.range(3))
    tables.materialise(spark, layers, "totals", lambda: spark.table(name).selectExpr("sum(id) as id"))
    assert [r.id for r in spark.table(name).collect()] == [3]
    query = tmp_path / "totals.sql"
    query.write_text(f"select id + 1 as id, 'й' as c from {name}", encoding="utf-8")
    assert tables.materialise(spark, layers, "totals", query) >= 0
    assert [tuple(r) for r in spark.table(name).collect()] == [(4, "й")]
    assert caplog.text.count("started at") == caplog.text.count("finished in") == 3
    with pytest.raises(PySparkException):
        tables.materialise(spark, layers, "totals", spark.range(1).select(F.raise_error(F.lit("no")).alias("x")))
    assert spark.table(name).count() == 1


@pytest.mark.parametrize("multi_line", [True, False])
def test_delimited_text_keeps_null_and_empty_apart(spark, tmp_path, multi_line):
    rows = [(1, "", 1.5), (2, None, None), (None, " a ", 0.0), (4, '"', None), (5, ";", 2.0), (6, '""', 1.0), (None, None, None)]
    df = spark.createDataFrame(rows, "id bigint, name string, x double")
    path = str(tmp_path / "text")
    delimited.write_delimited(df, path)
    assert bag(delimited.read_delimited(spark, path, df.schema, multi_line)) == bag(df)


def test_delimited_text(spark, tmp_path):
    rows = [(1, 'say "hi"; bye', 1.5), (2, None, None), (3, "line\nbreak", 0.0), (4, "back\\slash", -2.0)]
    df = spark.createDataFrame(rows, "id bigint, name string, x double")
    path = f"{tmp_path}/text"
    delimited.write_delimited(df, path)
    assert bag(delimited.read_delimited(spark, path, df.schema)) == bag(df)
    raw = "\n".join(r.value for r in spark.read.text(path).collect())
    assert '1;"say ""hi""; bye";1.5' in raw and "2;;" in raw
    with pytest.raises(PySparkException):
        delimited.write_delimited(df, path)
    with pytest.raises(Py4JJavaError, match="FAILFAST"):
        delimited.read_delimited(spark, path, "id bigint, name int, x double").collect()


AWKWARD = [
    "plain", "two\nlines", "\n", "\n\n\n", '"\n"', 'say "a\nb"', '""\n', "a;\n;b", "\r", "a\r\nb", "\r\n", "x\r", " \n ", "", None, '"', '\n"',
    "é\nй", "back\\slash\n", "long\n" * 200, '"quoted"\n' * 90,
]


@pytest.mark.parametrize("size", [1, 7, 64, 1000, 1 << 27])
def test_files_with_line_breaks_may_be_cut_anywhere(spark, tmp_path, size):
    rows = [(n, AWKWARD[n % len(AWKWARD)], AWKWARD[n // 3 % len(AWKWARD)]) for n in range(24 if size == 64 else 64)]
    df = spark.createDataFrame(rows, "id int, `a name` string, b string")
    path = str(tmp_path / "text")
    delimited.write_delimited(df.repartition(2), path)
    if size < 64:  # thousands of ranges: of few and short rows
        path = str(tmp_path / "few")
        df = spark.createDataFrame([(n, AWKWARD[n % 17], None) for n in range(18 if size > 1 else 6)], df.schema)
        delimited.write_delimited(df.coalesce(1), path)
    settings = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": 1}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = bag(delimited.read_delimited(spark, path, df.schema))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == bag(df)


def test_line_states_do_not_depend_on_batches():
    lines = pd.DataFrame({"file": ["f"] * 9 + ["g"] * 3, "begin": [0] * 5 + [40] * 4 + [0] * 3, "length": 40,
                          "quotes": [0, 1, 0, 2, 1, 3, 0, 1, 0, 0, 1, 1]})
    whole = pd.concat(delimited.placed_lines(iter([lines])))
    pieces = pd.concat(delimited.placed_lines(iter([lines[:2], lines[2:2], lines[2:7], lines[7:]])))
    assert whole.to_dict("list") == pieces.to_dict("list")
    assert whole["turned"].tolist() == [0, 0, 1, 1, 1, 0, 1, 1, 0, 0, 0, 1]
    totals = pd.concat(delimited.range_totals(iter([lines[:3], lines[3:]])))
    assert totals[["begin", "turned", "last0", "last1"]].values.tolist() == [[0, 0, 1, 4], [40, 0, 3, 2], [0, 0, 1, 2]]


def test_a_file_that_ends_inside_a_text_fails(spark, tmp_path):
    spark.createDataFrame([('1;"open',), ("2;b",)], "value string").coalesce(1).write.text(str(tmp_path / "text"))
    with pytest.raises(PySparkException, match="not closed"):
        delimited.read_delimited(spark, str(tmp_path / "text"), "id int, name string").collect()


def test_no_files_no_rows(spark, tmp_path):
    df = spark.createDataFrame([], "id int, name string")
    delimited.write_delimited(df, str(tmp_path / "text"))
    assert delimited.read_delimited(spark, str(tmp_path / "text"), df.schema).collect() == []


def test_jdbc_options():
    assert jdbc.jdbc_options("jdbc:postgresql://db/x", "public.shifts", user="u") == {
        "url": "jdbc:postgresql://db/x",
        "dbtable": "public.shifts",
        "fetchsize": "10000",
        "preferTimestampNTZ": "true",
        "user": "u",
    }


def test_period_predicates_share_out_the_rows(duck):
    rng = random.Random(4)
    moment = lambda: rng.choice([None, datetime(2024, 1, 1) + timedelta(hours=rng.randrange(-50, 24 * 20))])
    rows = [(i, moment(), moment()) for i in range(600)]
    duck.execute("create or replace table dated (id bigint, created_at timestamp, updated_at timestamp)")
    duck.executemany("insert into dated values (?, ?, ?)", rows)
    spans = [(date(2024, 1, 1), date(2024, 1, 4)), (date(2024, 1, 8), date(2024, 1, 15))]
    inside = lambda t: t is not None and any(a <= t.date() < b for a, b in spans)
    for fields in (["created_at"], ["created_at", "updated_at"]):
        for parts in (1, 7, 64):
            predicates = jdbc.span_predicates(fields, spans, parts)
            assert len(predicates) >= parts
            found = [r[0] for p in predicates for r in duck.execute(f"select id from dated where {p}").fetchall()]
            wanted = [i for i, c, u in rows if inside(c) or (len(fields) == 2 and inside(u))]
            assert sorted(found) == wanted
    with pytest.raises(ValueError):
        jdbc.span_predicates(["created_at"], spans, 0)


def test_a_skewed_day_is_cut_into_even_parts(duck):
    rng = random.Random(9)
    busy = lambda: datetime(2024, 1, 9, 12) + timedelta(seconds=rng.randrange(600))
    calm = lambda: datetime(2024, 1, 1) + timedelta(hours=rng.randrange(-50, 24 * 20))
    rows = [(i, rng.choice([busy, calm, lambda: None])(), rng.choice([busy, calm])()) for i in range(3_000)]
    duck.execute("create or replace table skewed (id bigint, created_at timestamp, updated_at timestamp)")
    duck.executemany("insert into skewed values (?, ?, ?)", rows)
    spans = [(date(2024, 1, 8), date(2024, 1, 15)), (date(2024, 1, 1), date(2024, 1, 4))]
    inside = lambda t: t is not None and any(a <= t.date() < b for a, b in spans)
    for fields in (["created_at"], ["created_at", "updated_at"]):
        wanted = [i for i, c, u in rows if inside(c) or (len(fields) == 2 and inside(u))]
        query = jdbc.cuts_query("skewed", fields, spans, 16)
        cuts = duck.execute(f"select field, start from {query}").fetchall()
        assert len(cuts) <= 16 + len(fields)
        predicates = jdbc.span_predicates(fields, spans, 16, cuts)
        parts = [[r[0] for r in duck.execute(f"select id from skewed where {p}").fetchall()] for p in predicates]
        assert sorted(i for part in parts for i in part) == wanted
        # One second holds a few rows, which stay together.
        assert max(map(len, parts)) < 1.3 * len(wanted) / 16
        even = jdbc.span_predicates(fields, spans, 16)
        sizes = [duck.execute(f"select count(*) from skewed where {p}").fetchone()[0] for p in even]
        assert max(sizes) > 4 * max(map(len, parts))


def test_rows_that_come_after_the_cuts_are_read_too(duck):
    spans = [(date(2024, 1, 1), date(2024, 1, 4))]
    for cuts in ([], [(0, datetime(2024, 1, 1))], [(0, datetime(2024, 1, 2, 3, 4, 5, 678)), (0, datetime(2030, 1, 1)), (1, datetime(2024, 1, 3))]):
        predicates = jdbc.span_predicates(["created_at"], spans, 4, cuts)
        for moment in (datetime(2024, 1, 1), datetime(2024, 1, 2, 3, 4, 5, 678), datetime(2024, 1, 3, 23, 59, 59, 999_999)):
            hits = [duck.execute(f"select {p} from (select timestamp '{moment}' as created_at)").fetchone()[0] for p in predicates]
            assert hits.count(True) == 1
    assert jdbc.span_predicates(["created_at"], [(date(2024, 1, 1), date(2024, 1, 1))], 4) == []


def test_spans_are_read_by_the_cuts_of_the_database(spark, monkeypatch):
    asked = []

    class Answers(jdbc.Database):
        def _load(self, table):
            asked.append(table)
            return spark.createDataFrame([(0, datetime(2024, 1, 1)), (0, datetime(2024, 1, 2, 12))], "field int, start timestamp_ntz")

        def _load_parts(self, table, predicates):
            return predicates

    database = Answers(spark, "jdbc:none", 2)
    spans = [(date(2024, 1, 1), date(2024, 1, 4))]
    assert database.read_spans("t", ["c"], spans) == jdbc.span_predicates(["c"], spans, 2, [(0, datetime(2024, 1, 2, 12))])
    assert asked == [jdbc.cuts_query("t", ["c"], spans, 2)]
    assert database.read_spans("t", ["c"], []) == ["1 = 0"]


def test_key_predicates_take_any_key():
    assert jdbc.key_predicates("id", 2) == [
        "MOD(ABS(HASHTEXT(CAST(\"id\" AS text))::bigint), 2) = 0 OR \"id\" IS NULL",
        "MOD(ABS(HASHTEXT(CAST(\"id\" AS text))::bigint), 2) = 1",
    ]


def test_lengths_are_asked_in_one_query(duck):
    columns = [SourceColumn("a", "text"), SourceColumn("b", "uuid"), SourceColumn('c"d', "jsonb")]
    query = jdbc.length_query("texts", columns)
    duck.execute("create or replace table texts (a varchar, b varchar, \"c\"\"d\" varchar)")
    duck.execute("insert into texts values ('abc', 'abcdef', null), (null, 'x', '{}')")
    assert duck.execute(f"select * from {query}").fetchall() == [(3, 2)]
    assert jdbc.length_query("texts", [SourceColumn("n", "bigint")]) is None


class StubDatabase:
    """Hands out a DataFrame and notes what it was asked for."""

    def __init__(self, rows):
        self.rows, self.asked = rows, []

    def columns(self, table, dbname):
        self.asked.append(("columns", table, dbname))
        return source_columns(self.rows)

    def measured(self, table, columns):
        self.asked.append(("measured", table))
        return measure(self.rows, columns)

    def read(self, table, key):
        self.asked.append(("read", table, key))
        return self.rows

    def read_spans(self, table, fields, spans):
        self.asked.append(("read_spans", table, tuple(fields), tuple(spans)))
        return self.rows

    def read_passes(self, table, fields, spans, changed):
        yield self.read_spans(table, fields, spans)


def test_a_spec_drives_its_load(spark, tmp_path):
    spec = replace(SPEC, dbname="shop", target_table="driven", clustering_field="name")
    loader = load.Loader(spark, tables.Layers(str(tmp_path)))
    source = StubDatabase(spark.createDataFrame(make_rows(random.Random(5), 80), SCHEMA))
    loader.run(spec, source, start=20240105, end=20240107)
    assert source.asked == [
        ("columns", "public.things", "shop"),
        ("measured", "public.things"),
        ("read_spans", "public.things", ("created_at", "updated_at"), ((date(2024, 1, 5), date(2024, 1, 8)),)),
    ]
    loader.run(replace(spec, date_trunc=None), source)
    assert source.asked[3:] == [("columns", "public.things", "shop"), ("read", "public.things", "id")]
    assert spark.table("snp.driven").count() == 80


class MovingDatabase(jdbc.Database):
    """DuckDB as a source whose rows change between any two of the queries that read them."""

    def _duck(self):
        return self.properties["duck"]

    def _frame(self, found):
        return self.spark.createDataFrame([tuple(r) for r in found], SCHEMA)

    def columns(self, table, dbname=None):
        return source_columns(self._frame([]))

    def measured(self, table, columns):
        return [replace(c, max_size=20) if c.name == "name" else c for c in columns]

    def _load(self, query):
        found = self._duck().execute(f"select * from {query}")
        names = [d[0] for d in found.description]
        return self.spark.createDataFrame(pd.DataFrame(found.fetchall(), columns=names)) if names != ["field", "start"] else Cuts(
            [dict(zip(names, r)) for r in found.fetchall()]
        )

    def _load_parts(self, table, predicates):
        out = []
        for n, predicate in enumerate(predicates):
            if n:
                self.change()
            out += self._duck().execute(f"select id, name, created_at, updated_at from {table} where {predicate}").fetchall()
        # A last query is one state, which may be left by the time it is loaded; then the next load brings the rest.
        self.properties["reads"].append(out)
        return self._frame(out)

    def change(self):
        """Rows are changed and come in; times of change are up to 5 seconds older than their commit."""
        duck, rng = self._duck(), self.properties["rng"]
        duck.execute("update clock set now = now + interval 7 second")
        for _ in range(6):
            late = rng.randrange(0, 6)
            duck.execute(
                f"update moving set name = name || '+', updated_at = (select now from clock) - interval {late} second where id = ?",
                [rng.randrange(0, 60)],
            )
        duck.execute("insert into moving select (select max(id) + 1 from moving), 'new', now, now from clock")


class Cuts(list):
    def collect(self):
        return self


@pytest.mark.parametrize("one_statement", [0, 1000])
def test_rows_that_change_while_they_are_read_are_neither_lost_nor_doubled(spark, duck, tmp_path, one_statement):
    start = datetime(2024, 1, 5, 12)
    duck.execute("create or replace table clock as select ?::timestamp as now", [start])
    duck.execute(
        "create or replace table moving as select i as id, 'n' as name, ?::timestamp - to_minutes((i * 7)::int) as created_at, "
        "case when i % 3 > 0 then ?::timestamp - to_minutes((i * 5)::int) end as updated_at from range(60) t(i)",
        [start, start],
    )
    shared = {"duck": duck, "rng": random.Random(11), "reads": []}
    database = MovingDatabase(
        spark, "duck", 6, shared, clock="(SELECT now FROM clock)", settle=timedelta(seconds=10), one_statement=one_statement
    )
    spec = replace(SPEC, source_table="moving", target_table=f"moving_{one_statement}")
    result = load.Loader(spark, tables.Layers(str(tmp_path))).run(spec, database, start=20240105, end=20240106)
    # Passes: the first, with more to come if all that changed must not be left to one query, and the last.
    assert len(result.later) == (jdbc.MOST_PASSES if one_statement == 0 else 1)
    for read in shared["reads"]:
        assert max(Counter(r[0] for r in read).values(), default=0) <= 1
    assert any("+" in r[1] for read in shared["reads"][1:] for r in read)
    now = duck.execute("select id, name, created_at, updated_at from moving").fetchall()
    assert bag(spark.table(f"snp.moving_{one_statement}"), "id", "name", "created_at", "updated_at") == Counter(now)

    # Without passes the same source loses or doubles rows, so the test above could have failed.
    spans = [(date(2024, 1, 5), date(2024, 1, 7))]
    database._load_parts("moving", jdbc.span_predicates(["updated_at", "created_at"], spans, 6))
    plain = [r[0] for r in shared["reads"][-1]]
    ids = {r[0] for r in duck.execute("select id from moving").fetchall()}
    assert len(plain) > len(set(plain)) or set(plain) < ids


def test_a_source_that_stands_still_is_read_in_one_pass(spark, duck, tmp_path):
    duck.execute("create or replace table clock as select timestamp '2024-02-01' as now")
    duck.execute(
        "create or replace table moving as select i as id, 'n' as name, timestamp '2024-01-05' as created_at, null::timestamp as updated_at "
        "from range(9) t(i)"
    )
    shared = {"duck": duck, "rng": random.Random(1), "reads": []}
    database = MovingDatabase(spark, "duck", 1, shared, clock="(SELECT now FROM clock)")
    spans = [(date(2024, 1, 5), date(2024, 1, 6))]
    for parts, changed in ((1, "updated_at"), (4, None)):
        assert [d.count() for d in replace(database, parts=parts).read_passes("moving", ["created_at"], spans, changed)] == [9]
    assert [d.count() for d in replace(database, parts=4).read_passes("moving", ["created_at"], spans, "updated_at")] == [9]
    assert [d.count() for d in replace(database, parts=4).read_passes("moving", ["created_at"], [], "updated_at")] == [0]


DRIFTS = {
    "new": ("*", "1 as extra", "extra"),
    "missing": ("id", "created_at", "updated_at", "name"),
    "wider": ("id", "cast(amount as double) as amount", "name", "created_at", "updated_at", "amount"),
    "nested": ("id", "array(1) as amount", "name", "created_at", "updated_at", "amount"),
}


@pytest.mark.parametrize("kind", DRIFTS)
def test_drift_is_an_error_and_changes_nothing(spark, tmp_path, kind):
    *columns, named = DRIFTS[kind]
    spec = replace(SPEC, target_table=f"drift_{kind}")
    loader = load.Loader(spark, tables.Layers(str(tmp_path)))
    rows = spark.createDataFrame(make_rows(random.Random(6), 40), SCHEMA).withColumn("amount", F.lit(7))
    loader.load_full(spec, rows)
    state = lambda: [bag(spark.table(t)) for t in (f"saa.drift_{kind}", f"snp.drift_{kind}", "engine.launch_log")]
    before = state()
    changed = rows.drop("name") if kind == "missing" else rows.selectExpr(*columns)
    for attempt in (lambda: loader.load_full(spec, changed), lambda: loader.load(spec, changed, start=20240105)):
        with pytest.raises(tables.SchemaDrift, match=named):
            attempt()
    assert state() == before


def test_new_columns_are_added_on_demand(spark, tmp_path):
    spec = replace(SPEC, target_table="grown")
    layers = tables.Layers(str(tmp_path))
    rows = spark.createDataFrame(make_rows(random.Random(7), 60), SCHEMA)
    load.Loader(spark, layers).load_full(spec, rows)
    load.Loader(spark, layers, on_new_columns="add").load(spec, rows.withColumn("extra", F.col("id") * 2), start=20240105)
    snapshot = spark.table("snp.grown")
    day = "created_at >= '2024-01-05' and created_at < '2024-01-06' or updated_at >= '2024-01-05' and updated_at < '2024-01-06'"
    assert snapshot.count() == 60
    assert snapshot.where(f"coalesce({day}, false) and (extra is null or extra <> id * 2)").count() == 0
    assert snapshot.where(f"not coalesce({day}, false) and extra is not null").count() == 0
    with pytest.raises(ValueError, match="on_new_columns"):
        load.Loader(spark, layers, on_new_columns="drop").load_full(spec, rows)


def test_a_table_of_the_same_shape_is_never_missing(spark, tmp_path, monkeypatch):
    layers = tables.Layers(str(tmp_path)).create(spark)
    tables.materialise(spark, layers, "steady", spark.range(3))
    statements = []
    plain = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **k: statements.append(text) or plain(self, text, *a, **k))
    tables.materialise(spark, layers, "steady", spark.range(5))
    assert not [t for t in statements if "DROP" in t] and spark.table("analytics.steady").count() == 5
    tables.materialise(spark, layers, "steady", spark.range(4).withColumn("x", F.lit("a")))
    assert spark.table("analytics.steady").columns == ["id", "x"]
