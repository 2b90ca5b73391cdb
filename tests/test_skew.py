"""Heavy keys are found, and results are the same whichever way they are treated."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from checks import views
from checks.queries import CALENDAR
from tallyloom.operators import intervals as iv
from tallyloom.operators.skew import heavy_keys, is_heavy, skew_join
from tallyloom.operators.upsert import upsert
from tallyloom.plans import shifts as sh


def bag(df):
    columns = sorted(df.columns)
    return Counter(tuple(r) for r in df.select(columns).collect())


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows: a third have key 7, a third have none."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, F.col("id") + 100)
    return spark.range(3000).select(key.alias("k"), (F.col("id") % 11).alias("v"))


def test_heavy_keys(spark, skewed):
    assert set(heavy_keys(skewed, "k", min_rows=500)) == {7, None}
    assert heavy_keys(skewed, "k") == []
    assert heavy_keys(skewed.where("v < 0"), "k", min_rows=1) == []
    [pair] = heavy_keys(skewed.where("k is not null").withColumn("v", F.lit(1)), "k", "v", min_rows=500)
    assert skewed.where((F.xxhash64("k", F.lit(1)) == pair) & F.col("k").isNotNull()).count() == 1000


def test_is_heavy_is_never_null(spark, skewed):
    flags = skewed.select(is_heavy(F.col("k"), [7]).alias("a"), is_heavy(F.col("k"), [7, None]).alias("b"))
    assert flags.where("a is null or b is null").count() == 0
    assert (flags.where("a").count(), flags.where("b").count()) == (1000, 2000)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("heavy", [[7], [7, None], [None], [-1]])
def test_skew_join_is_a_join(spark, skewed, how, heavy):
    small = spark.createDataFrame([(7, "a"), (101, "b"), (101, "c"), (None, "d"), (5, "e")], "k bigint, name string")
    expected = skewed.join(small, "k", how)
    assert bag(skew_join(skewed, small, "k", heavy, how)) == bag(expected)
    if how == "left_anti":
        assert expected.where("k is null").count() == 1000


def test_skew_join_rejects_outer_joins(skewed):
    with pytest.raises(ValueError, match="full"):
        skew_join(skewed, skewed, "k", [], "full")


def test_upsert_with_heavy_keys(spark, skewed):
    batch = spark.createDataFrame([(7, 1), (101, 2), (None, 3)], "k bigint, v bigint")
    assert bag(upsert(skewed, batch, "k", [7, None])) == bag(upsert(skewed, batch, "k", []))


@pytest.fixture(scope="module")
def skewed_mart(spark, sample_dir):
    """The sample with copies of two shifts' lines, so that each has a third of them."""
    orders, lineitem = (views.table(spark, sample_dir, n) for n in ("orders", "lineitem"))
    lines = lineitem.select("*", F.col("l_suppkey").alias("seq"))
    lots = spark.range(12000).withColumnRenamed("id", "seq").repartition(4)
    template = lineitem.where("l_orderkey = 5")
    copies = (
        lots.select("*", *[F.lit(v).alias(c) for c, v in template.first().asDict().items()])
        .withColumn("l_orderkey", F.when(F.col("seq") % 2 == 0, 5).otherwise(7).cast("long"))
        .withColumn("l_suppkey", F.col("seq") % 50)
        .withColumn("l_partkey", F.col("seq") % 241)
        .withColumn("l_linenumber", (F.col("seq") % 9).cast("int"))
        .withColumn("l_returnflag", F.expr("substr('ARN', seq % 3 + 1, 1)"))
    )
    return orders, lines.unionByName(copies).drop("seq")


def test_mart_does_not_depend_on_heavy_keys(spark, skewed_mart):
    orders, lines = skewed_mart
    heavy = heavy_keys(lines, "l_orderkey", min_rows=500)
    assert {5, 7} <= set(heavy)

    def mart(keys):
        shifts = views.shifts(orders)
        history, couriers = views.history(lines, orders, keys), views.couriers(lines, orders, keys)
        found = sh.mv_shifts_agg(shifts, history, couriers, CALENDAR, keys)
        return found.withColumn("fact_sh", F.round("fact_sh", 4))

    assert bag(mart(heavy)) == bag(mart([]))


def brute_intervals(rows):
    pairs = {}
    for row in rows:
        if row[3] in (0, 10):
            pairs.setdefault(row[:2], []).append(row)
    found = Counter()
    for events in pairs.values():
        events.sort(key=lambda r: (r[2] is not None, r[2] or datetime.min, r[3]))
        following = [r[2] for r in events[1:]] + [datetime(2099, 1, 1)]
        for event, following_at in zip(events, following):
            found[(event[0], event[1], event[2], following_at, event[3])] += 1
    return found


def test_intervals_of_long_pairs_are_cut_without_a_trace(spark, monkeypatch):
    monkeypatch.setattr(iv, "COPIES_PER_BLOCK", 3)
    rng = random.Random(1)
    start = datetime(2024, 1, 1)
    rows = []
    for _ in range(1500):
        moment = None if rng.random() < 0.05 else start + timedelta(seconds=rng.choice([0, 1, 59, 60, 61, 3600, 86400]))
        shift = rng.choice([1, 1, 1, 2, 3, None])
        rows.append((shift, rng.choice([1, 2]), moment, rng.choice([0, 5, 10])))
    history = spark.createDataFrame(rows, "shift_id bigint, employee_id bigint, created_at timestamp_ntz, type int")
    events = iv.status_events(history)
    heavy = heavy_keys(events, *iv.PAIR, min_rows=100)
    everything = [r.h for r in events.select(F.xxhash64(*iv.PAIR).alias("h")).distinct().collect()]
    assert heavy and len(heavy) < len(everything)
    columns = ["shift_id", "employee_id", "status_dttm", "next_status_dttm", "type"]
    for keys in ([], heavy, everything):
        found = Counter(tuple(r) for r in iv.status_intervals(history, keys).select(columns).collect())
        assert found == brute_intervals(rows)
