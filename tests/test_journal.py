"""Loads that are cut off and carried on."""

import uuid
from collections import Counter
from dataclasses import replace
from datetime import datetime, timedelta

import pytest

from tallyloom.plans import load
from tallyloom.plans.journal import APPLIED, DROPPED, Journal
from tallyloom.sources import snapshot as snap
from tallyloom.sources import tables

SCHEMA = "id bigint, name string, created_at timestamp_ntz, updated_at timestamp_ntz"
SPEC = load.LoadSpec("public.things", "things", None, "created_at", "id", "day")


@pytest.fixture
def layers(spark, tmp_path):
    tag = uuid.uuid4().hex[:8]
    return tables.Layers(str(tmp_path), **{n: f"{n}_{tag}" for n in ("staging", "snapshot", "analytics", "log")}).create(spark)


def source(spark, name, days=range(4)):
    rows = [(10 * d + i, name, datetime(2024, 1, 1) + timedelta(days=d), None) for d in days for i in range(3)]
    return spark.createDataFrame(rows, SCHEMA)


def state(spark, layers):
    """Rows of the snapshot and of staging, and how often each launch is logged."""
    snapshot = Counter((r["id"], r["name"]) for r in spark.table(f"{layers.snapshot}.things").collect())
    staged = Counter((r["id"], r["name"], r["launch_id"]) for r in spark.table(f"{layers.staging}.things").collect())
    logged = Counter(r["launch_id"] for r in spark.table(f"{layers.log}.launch_log").collect())
    return snapshot, staged, logged


STEPS = {
    "logging": (load, "log_launches"),
    "staging": (tables.StagingTable, "append"),
    "after staging": (tables.StagingTable, "append"),
    "index": (snap.SnapshotTable, "_index"),
    "switch": (snap.SnapshotTable, "_switch"),
    "after the switch": (snap.SnapshotTable, "_switch"),
}


@pytest.mark.parametrize("step", STEPS)
def test_a_load_that_is_cut_off_can_be_carried_on(spark, layers, monkeypatch, step):
    names = iter(range(100))
    loader = load.Loader(spark, layers, lambda period: f"L{next(names)}")
    loader.load_full(SPEC, source(spark, "old"))
    old = state(spark, layers)
    new = source(spark, "new", range(1, 6))
    place, name = STEPS[step]
    plain = getattr(place, name)

    def fails(*a, **k):
        if step.startswith("after"):
            plain(*a, **k)
        raise OSError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(place, name, fails)
        with pytest.raises(OSError):
            loader.load(SPEC, new, 20240102, 20240104)
    if step != "after the switch":
        assert state(spark, layers)[0] == old[0]
    again = load.Loader(spark, layers)
    if step in ("logging", "staging", "after staging"):
        with pytest.raises(ValueError, match="source is needed"):
            again.resume(SPEC)
        results = again.resume(SPEC, new)
    else:
        results = again.resume(SPEC)
    assert [list(r.launches.values()) for r in results] == [["L1", "L2", "L3"]]
    assert results[0].rewritten == ["2024-01-02", "2024-01-03", "2024-01-04"]
    snapshot, staged, logged = state(spark, layers)
    changed = {10 * d + i for d in (1, 2, 3) for i in range(3)}
    assert snapshot == Counter([(i, "old") for i, _ in old[0] if i not in changed] + [(i, "new") for i in changed])
    # Nothing is staged or logged twice.
    assert staged == old[1] + Counter((i, "new", f"L{i // 10}") for i in changed)
    assert logged == Counter(["L0", "L1", "L2", "L3"])
    assert again.resume(SPEC) == [] and Journal(spark, layers).unfinished("things") == []


def test_a_later_load_applies_what_is_staged_and_drops_what_is_not(spark, layers, monkeypatch):
    loader = load.Loader(spark, layers)
    loader.load_full(SPEC, source(spark, "first"))
    for place, name in (STEPS["staging"], STEPS["switch"]):
        with monkeypatch.context() as m:
            m.setattr(place, name, lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                loader.load(SPEC, source(spark, name), 20240101, 20240102)
    assert [x.state for x in loader.journal.unfinished("things")] == ["staged"]
    loader.load(SPEC, source(spark, "last"), 20240102)
    by_name = Counter(n for _, n in state(spark, layers)[0])
    assert by_name == Counter({"_switch": 3, "last": 3, "first": 6})
    ends = Counter(r["state"] for r in spark.table(loader.journal.name).collect())
    assert ends[APPLIED] == 3 and ends[DROPPED] == 1 and loader.resume(SPEC) == []


def test_loads_of_other_tables_are_left_alone(spark, layers, monkeypatch):
    loader = load.Loader(spark, layers)
    with monkeypatch.context() as m:
        m.setattr(*STEPS["index"], lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            loader.load_full(SPEC, source(spark, "x"))
    loader.load_full(replace(SPEC, target_table="others"), source(spark, "y"))
    assert len(loader.journal.unfinished("things")) == 1
    loader.resume(SPEC)
    assert sum(state(spark, layers)[0].values()) == 12
