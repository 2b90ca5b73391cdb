"""Loading a source table into staging and from there into its snapshot."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field, replace
from datetime import date
from typing import Any, Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.calendar import load_periods, resolve_interval
from tallyloom.operators.conform import LAUNCH_ID, SourceColumn, measure, source_columns
from tallyloom.operators.extract import UPDATED_AT, extract, extract_periods, has_updates, period_ranges
from tallyloom.operators.skew import heavy_keys
from tallyloom.operators.upsert import latest_launches, upsert
from tallyloom.plans.journal import APPLIED, DROPPED, NAMED, STAGED, Journal, Load
from tallyloom.sources.snapshot import SnapshotTable
from tallyloom.sources.tables import Layers, StagingTable, log_launches, new_launch_id


@dataclass(frozen=True)
class LoadSpec:
    """What to load and how. Without ``date_trunc`` every load takes the whole table.

    ``partition_unit`` is how the snapshot is laid out; a day suits tables with many rows per day.
    """

    source_table: str
    target_table: str
    dbname: str | None = None
    partitioning_field: str | None = None
    clustering_field: str | None = None
    date_trunc: str | None = None
    key: str = "id"
    partition_unit: str = "day"


# The tables that come with the package.
BRANDS = LoadSpec("public.brands", "brands", None, "created_at", "id", "day")
SHIFTS = LoadSpec("public.shifts", "shifts", None, "created_at", "id", "day")
SHIFT_REASONS = LoadSpec("public.shift_reasons", "shift_reasons", None, "created_at", "id", "day")


@dataclass(frozen=True)
class LoadResult:
    """Launches by period and partitions that were rewritten; ``later`` are the passes over what changed meanwhile."""

    launches: dict[date | None, str]
    rewritten: list[str]
    later: list[LoadResult] = field(default_factory=list)


class Database(Protocol):
    """Where a spec's table is read from; ``sources.jdbc.Database`` is one."""

    def columns(self, table: str, dbname: str | None) -> list[SourceColumn]: ...

    def measured(self, table: str, columns: Sequence[SourceColumn]) -> list[SourceColumn]: ...

    def read(self, table: str, key: str) -> DataFrame: ...

    def read_passes(
        self, table: str, fields: Sequence[str], spans: Sequence[tuple[date, date]], changed: str | None
    ) -> Iterable[DataFrame]: ...


def name_launches(
    periods: Sequence[date], new_id: Callable[[date | None], str] | None = None
) -> dict[date, str]:
    return {p: new_id(p) if new_id else new_launch_id() for p in periods}


def incremental_snapshot(
    snapshot: DataFrame,
    source: DataFrame,
    launches: dict[date, str],
    field: str,
    unit: str,
    key: str = "id",
    columns: Sequence[SourceColumn] | None = None,
    heavy: Sequence[Any] | None = None,
) -> DataFrame:
    """Snapshot after loading the periods one after the other, as one query."""
    if heavy is None:
        heavy = list({*heavy_keys(source, key), *heavy_keys(snapshot, key)})
    staged = extract_periods(source, launches, field, unit, columns)
    return upsert(snapshot, latest_launches(staged, launches, key, heavy), key, heavy, staged)


class Loader:
    """Runs load specs against the tables of ``layers``.

    ``new_id`` names the launch of a period (``None`` for a full load); by default it is a new UUID.

    A source with a column less or of another type than its tables is an error, and nothing is written or
    logged. So is one with a new column, unless ``on_new_columns`` is ``add``: then the tables get it too, NULL in older rows.

    Every load is noted in a journal. One that was cut off is carried on by ``resume``. A later load of the same table
    first applies what is staged, and drops a load that isn't.
    """

    def __init__(
        self,
        spark: SparkSession,
        layers: Layers,
        new_id: Callable[[date | None], str] | None = None,
        on_new_columns: str = "error",
    ):
        self.spark = spark
        self.on_new_columns = on_new_columns
        self.layers = layers.create(spark)
        self.journal = Journal(spark, layers).create()
        self.new_id = new_id

    def _tables(self, spec: LoadSpec) -> tuple[StagingTable, SnapshotTable]:
        snapshot = SnapshotTable(
            self.spark, self.layers, spec.target_table, spec.partitioning_field, spec.key, spec.partition_unit,
            spec.clustering_field,
        )
        return StagingTable(self.spark, self.layers, spec.target_table), snapshot

    def _prepare(
        self, spec: LoadSpec, source: DataFrame, columns: Sequence[SourceColumn] | None
    ) -> tuple[list[SourceColumn], StagingTable, SnapshotTable]:
        found = list(columns or source_columns(source))
        has_updates(found)
        staging, snapshot = self._tables(spec)
        # Text lengths decide only how the staging table is created, so a table that exists is not measured, nor is
        # one whose columns come with their lengths.
        if not self.spark.catalog.tableExists(staging.name):
            found = found if any(c.max_size is not None for c in found) else measure(source, found)
            staging.create(found)
        snapshot.create(found)
        # Both are checked before either is changed, and before anything is written or logged.
        for table in (staging, snapshot):
            table.check(found, self.on_new_columns)
        for table in (staging, snapshot):
            table.fit(found, self.on_new_columns)
        return found, staging, snapshot

    def run(
        self,
        spec: LoadSpec,
        database: Database,
        start: int | str | date | None = None,
        end: int | str | date | None = None,
        interval: int | None = None,
        anchor: str = "current",
    ) -> LoadResult:
        """Load a spec from the database that it names, reading only the periods asked for.

        Text lengths are measured by the database, and only while there is no staging table yet.

        A table that tells when its rows changed is read in passes, so that rows which change while they are read are neither lost
        nor doubled. Each pass is a load of its own, with launches of its own, applied before the next begins.
        """
        columns = database.columns(spec.source_table, spec.dbname)
        if not self.spark.catalog.tableExists(StagingTable(self.spark, self.layers, spec.target_table).name):
            columns = database.measured(spec.source_table, columns)
        if spec.date_trunc is None or spec.partitioning_field is None:
            return self.load(spec, database.read(spec.source_table, spec.key), start, end, interval, columns, anchor)
        first, last = resolve_interval(start, end, interval)
        spans = period_ranges(load_periods(first, last, spec.date_trunc, anchor), spec.date_trunc)
        changed = UPDATED_AT if has_updates(columns) else None
        fields = [spec.partitioning_field, *([changed] if changed else [])]
        passes = database.read_passes(spec.source_table, fields, spans, changed)
        # One after the other: a pass is asked for when the one before is in the snapshot.
        done = [self.load(spec, source, first, last, None, columns, anchor) for source in passes]
        return replace(done[0], later=done[1:])

    def load(
        self,
        spec: LoadSpec,
        source: DataFrame,
        start: int | str | date | None = None,
        end: int | str | date | None = None,
        interval: int | None = None,
        columns: Sequence[SourceColumn] | None = None,
        anchor: str = "current",
        apply: bool = True,
    ) -> LoadResult:
        """Incremental load of the periods between two days, or a full load if the spec has no period.

        All periods are staged in one scan of the source and one write, each under its own launch id,
        and upserted in one rewrite of the partitions concerned. Without ``apply`` the rows are staged only, for ``resume`` to apply.
        """
        if spec.date_trunc is None:
            return self.load_full(spec, source, columns, apply)
        if spec.partitioning_field is None:
            raise ValueError("an incremental load needs a partitioning field")
        periods = load_periods(*resolve_interval(start, end, interval), spec.date_trunc, anchor)
        launches = name_launches(periods, self.new_id)
        return self._begin(spec, source, launches, columns, apply)

    def load_full(
        self, spec: LoadSpec, source: DataFrame, columns: Sequence[SourceColumn] | None = None, apply: bool = True
    ) -> LoadResult:
        """One batch of the whole table under one launch id."""
        launch_id = self.new_id(None) if self.new_id else new_launch_id()
        return self._begin(spec, source, {None: launch_id}, columns, apply)

    def _begin(
        self,
        spec: LoadSpec,
        source: DataFrame,
        launches: dict[date | None, str],
        columns: Sequence[SourceColumn] | None,
        apply: bool,
    ) -> LoadResult:
        found, staging, snapshot = self._prepare(spec, source, columns)
        if not launches:
            return LoadResult({}, [])
        for left in self.journal.unfinished(spec.target_table):
            # What is staged comes first, as it is older; of what isn't, nothing can be told from the new source.
            if left.state == STAGED:
                self._apply(spec, left, staging, snapshot)
            else:
                staging.clear(list(left.launches.values()))
                self.journal.note(left, DROPPED)
        load = self.journal.note(Load(new_launch_id(), spec.target_table, launches, NAMED), NAMED)
        log_launches(self.spark, self.layers, list(launches.values()))
        load = self._stage(spec, load, source, found, staging)
        return self._apply(spec, load, staging, snapshot) if apply else LoadResult(dict(launches), [])

    def _stage(
        self, spec: LoadSpec, load: Load, source: DataFrame, found: list[SourceColumn], staging: StagingTable
    ) -> Load:
        if list(load.launches) == [None]:
            batch = extract(source, load.launches[None], found)
        else:
            batch = extract_periods(source, load.launches, spec.partitioning_field, spec.date_trunc, found)
        staging.append(batch, found, len(load.launches), spec.clustering_field)
        return self.journal.note(load, STAGED)

    def _apply(self, spec: LoadSpec, load: Load, staging: StagingTable, snapshot: SnapshotTable) -> LoadResult:
        staged = staging.read(list(load.launches.values()))
        latest = latest_launches(staged, load.launches, spec.key)
        rewritten = snapshot.upsert(latest, load.load_id, staged)
        self.journal.note(load, APPLIED)
        return LoadResult(dict(load.launches), rewritten)

    def resume(
        self, spec: LoadSpec, source: DataFrame | None = None, columns: Sequence[SourceColumn] | None = None
    ) -> list[LoadResult]:
        """Carry on the loads of a spec that were cut off, in the order they began, under the launches they had.

        Loads that are staged need no source. For one that isn't, whatever it left in staging is taken out and staged
        anew from ``source``. A change that the snapshot shows already is not made twice.
        """
        results = []
        for load in self.journal.unfinished(spec.target_table):
            if load.state == STAGED:
                staging, snapshot = self._tables(spec)
            elif source is None:
                raise ValueError(f"load {load.load_id} of {spec.target_table} was cut off before it was staged: a source is needed")
            else:
                found, staging, snapshot = self._prepare(spec, source, columns)
                staging.clear(list(load.launches.values()))
                self._log_missing(load)
                load = self._stage(spec, load, source, found, staging)
            results.append(self._apply(spec, load, staging, snapshot))
        return results

    def _log_missing(self, load: Load) -> None:
        ids = list(load.launches.values())
        name = f"{self.layers.log}.launch_log"
        logged: set[str] = set()
        if self.spark.catalog.tableExists(name):
            logged = {r[0] for r in self.spark.table(name).where(F.col(LAUNCH_ID).isin(ids)).select(LAUNCH_ID).collect()}
        if len(logged) < len(ids):
            log_launches(self.spark, self.layers, [i for i in ids if i not in logged])
