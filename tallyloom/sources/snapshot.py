"""Snapshot tables: the latest version of every row, switched from one state to the next by one statement.

A snapshot is a view over three external tables beside it:

* ``<name>__files`` holds the rows, by the version that wrote them and by day (or a longer unit). Files are never changed.
* ``<name>__manifest`` has one row per day: the version that is valid for it. Each upsert writes a new manifest next to the last and then
  points the table at it. The view shows the rows whose version and day are in the manifest, so it shows all of the old rows or all
  of the new ones, and a query that has begun keeps the manifest it found. Spark prunes the other partitions by the broadcast manifest,
  which has at most one short row per day.
* ``<name>__keys`` has bitmaps of the keys of each day, by version and written with it. An upsert intersects them with the bitmap
  of its batch and opens only the days that may hold one of its keys. Whole numbers are mapped to slots of 64 neighbours, as
  identifiers mostly ascend with time; others by a hash. Slots wrap around, so the index of a day is 2 MB at most. A day opened in vain changes nothing.

``vacuum`` removes what neither the manifest nor the ones kept before it can reach.
"""

from __future__ import annotations

import json
import time
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, IntegerType, LongType, ShortType

from tallyloom.functions import period_day
from tallyloom.operators.conform import LAUNCH_COLUMN, LAUNCH_ID, SourceColumn, spark_type
from tallyloom.operators.skew import heavy_keys, skew_join
from tallyloom.operators.upsert import upsert
from tallyloom.sources.tables import (
    NO_DATE,
    PART,
    PARTITIONS_PER_STATEMENT,
    Layers,
    SchemaDrift,
    check_new,
    create_table,
    folders,
    loaded_types,
    location_of,
    remove,
    write_lines,
)

VERSION = "_version"
#: Neighbouring whole numbers of one slot, as a power of two, and slots of an index.
NEIGHBOURS = 6
SLOTS = 1 << 24
WHOLE = (ByteType, ShortType, IntegerType, LongType)
MANIFEST = "part STRING, version STRING"


# index of keys


def slot(key: str, kind: DataType) -> Column:
    """Place of a key in the index, from 1."""
    whole = F.shiftright(F.col(key).cast("bigint"), NEIGHBOURS) if isinstance(kind, WHOLE) else F.xxhash64(F.col(key).cast("string"))
    return F.pmod(whole, F.lit(SLOTS)) + 1


def key_bitmaps(rows: DataFrame, key: str, *by: str) -> DataFrame:
    """(by, bucket, bitmap): the slots of all keys, in bitmaps of 4 KB each."""
    place = slot(key, rows.schema[key].dataType)
    return (
        rows.where(F.col(key).isNotNull())
        .select(*by, place.alias("slot"))
        .groupBy(*by, F.bitmap_bucket_number("slot").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bitmap"))
    )


def meeting(index: DataFrame, wanted: DataFrame, by: str) -> DataFrame:
    """Values of ``by`` whose bitmaps share a slot with those of ``wanted`` (bucket, bitmap), which has a bounded number of rows."""
    other = F.broadcast(wanted.select("bucket", F.col("bitmap").alias("other")))
    pairs = index.join(other, "bucket").select(by, "bucket", F.explode(F.array("bitmap", "other")).alias("b"))
    shared = pairs.groupBy(by, "bucket").agg(F.bitmap_and_agg("b").alias("b"))
    return shared.where(F.bitmap_count("b") > 0).select(by).distinct()


@dataclass(frozen=True)
class SnapshotTable:
    """Latest version of every row, by day (or a longer ``unit``) and sorted by key within it.

    An upsert rewrites only the days that lose or gain rows.
    """

    spark: SparkSession
    layers: Layers
    table: str
    field: str | None = None
    key: str = "id"
    unit: str = "day"
    cluster_by: str | None = None

    @property
    def name(self) -> str:
        return f"{self.layers.snapshot}.{self.table}"

    @property
    def root(self) -> str:
        return self.layers.location(self.layers.snapshot, self.table)

    def part_of(self, what: str) -> str:
        """Name of one of the tables behind the view."""
        return f"{self.layers.snapshot}.{self.table}__{what}"

    # shape

    def create(self, columns: Sequence[SourceColumn]) -> None:
        ddl = ", ".join(f"`{c.name}` {spark_type(self.spark, c).upper()}" for c in [*columns, LAUNCH_COLUMN])
        parts = f"`{VERSION}` STRING, `{PART}` STRING"
        by = (VERSION, PART)
        create_table(self.spark, self.part_of("files"), f"{ddl}, {parts}", f"{self.root}/files", by, "KEEP")
        index = f"`{PART}` STRING, bucket BIGINT, bitmap BINARY, `{VERSION}` STRING"
        create_table(self.spark, self.part_of("keys"), index, f"{self.root}/keys", VERSION, "KEEP")
        create_table(self.spark, self.part_of("manifest"), MANIFEST, f"{self.root}/manifest/{0:012d}-", None, "KEEP", "json")
        if not self.spark.catalog.tableExists(self.name):
            self._show()

    def _show(self) -> None:
        """(Re)define the view over the columns that the files have by now."""
        shown = [f"f.`{c}`" for c in self.spark.table(self.part_of("files")).columns if c != VERSION]
        # The condition on m alone lets Spark prune partitions by what the manifest holds.
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name} AS SELECT /*+ BROADCAST(m) */ {', '.join(shown)} FROM {self.part_of('files')} f "
            f"LEFT SEMI JOIN {self.part_of('manifest')} m ON f.`{PART}` = m.part AND f.`{VERSION}` = m.version AND m.version >= ''"
        )

    def check(self, columns: Sequence[SourceColumn], on_new_columns: str = "error") -> None:
        check_new(self.spark, self.name, columns, (PART, LAUNCH_ID), on_new_columns)

    def fit(self, columns: Sequence[SourceColumn], on_new_columns: str = "error") -> None:
        """Check the snapshot and give it the columns it lacks, which are NULL in all rows that are there already."""
        new = check_new(self.spark, self.name, columns, (PART, LAUNCH_ID), on_new_columns)
        if new:
            types = loaded_types(self.spark, columns)
            ddl = ", ".join(f"`{name}` {types[name].upper()}" for name in new)
            self.spark.sql(f"ALTER TABLE {self.part_of('files')} ADD COLUMNS ({ddl})")
            self._show()

    # state

    def read(self) -> DataFrame:
        return self.spark.table(self.name).drop(PART)

    def manifest(self) -> dict[str, str]:
        """Version of every day: at most one short entry per calendar day."""
        return {r["part"]: r["version"] for r in self.spark.table(self.part_of("manifest")).collect()}

    def state(self) -> tuple[int, str]:
        """Number of the manifest that is valid, and the version it came with."""
        number, version = location_of(self.spark, self.part_of("manifest")).rstrip("/").rsplit("/", 1)[1].split("-", 1)
        return int(number), version

    def possible(self, keys: DataFrame) -> list[str]:
        """Days that may hold one of the keys, by the index alone."""
        live = self.spark.table(self.part_of("manifest")).where("version >= ''")
        index = self.spark.table(self.part_of("keys")).join(
            F.broadcast(live), (F.col(PART) == F.col("part")) & (F.col(VERSION) == F.col("version")), "left_semi"
        )
        return sorted(r[0] for r in meeting(index, key_bitmaps(keys, self.key), PART).collect())

    def _with_part(self, df: DataFrame) -> DataFrame:
        if self.field is None:
            return df.withColumn(PART, F.lit(NO_DATE))
        return df.withColumn(PART, F.coalesce(period_day(F.col(self.field), self.unit).cast("string"), F.lit(NO_DATE)))

    # change

    def upsert(self, batch: DataFrame, version: str, staged: DataFrame | None = None) -> list[str]:
        """Replace the rows of all keys in ``batch``; returns the days that were rewritten.

        ``batch`` should come from a table that has been written (staged launches): it is read more than
        once. ``staged`` are the rows it was picked from, with the same keys.

        ``version`` names the change. One that has been applied last is not applied again; one that failed before the switch
        is done anew, over whatever it left behind.
        """
        current = self.spark.table(self.name)
        batch = self._with_part(batch)
        types = lambda df: sorted((f.name, f.dataType.simpleString()) for f in df.schema)
        if types(batch) != types(current):
            odd = ", ".join(f"{n} {t}" for n, t in sorted(set(types(batch)) ^ set(types(current))))
            raise SchemaDrift(f"{self.name}: batch and table differ in {odd}")
        known = self.manifest()
        number, last = self.state()
        if last == version:
            return sorted(part for part, of in known.items() if of == version)
        batch = batch.select(*current.columns)
        keys = (batch if staged is None else staged).select(self.key).distinct()
        merged, changed = batch, []
        if known:
            changes, heavy = batch.select(PART), []
            opened = self.possible(keys)
            if opened:
                held = current.where(F.col(PART).isin(opened))
                heavy = heavy_keys(held, self.key)
                changes = changes.unionByName(skew_join(held.select(self.key, PART), keys, self.key, heavy, how="left_semi").select(PART))
            changed = sorted(r[0] for r in changes.distinct().collect())
            if not changed:
                return []
            if set(changed) & known.keys():
                merged = upsert(current.where(F.col(PART).isin(changed)), batch, self.key, heavy, staged)
        path = f"{self.root}/files/{VERSION}={version}"
        (
            merged.hint("rebalance", PART)
            .sortWithinPartitions(PART, self.cluster_by or self.key)
            .write.mode("overwrite")
            .partitionBy(PART)
            .parquet(path)
        )
        self._index(path, version)
        # Days that only lost rows may have none left; the write made folders for the others.
        filled = [name.split("=", 1)[1] for name, _ in folders(self.spark, path) if name.startswith(f"{PART}=")]
        self._register("files", [f"({VERSION} = '{version}', {PART} = '{p}') LOCATION '{path}/{PART}={p}'" for p in filled])
        self._register("keys", [f"({VERSION} = '{version}') LOCATION '{self.root}/keys/{VERSION}={version}'"])
        kept = [(part, of) for part, of in known.items() if part not in changed]
        self._switch(f"{number + 1:012d}-{version}", [*kept, *[(part, version) for part in filled]])
        return changed or sorted(filled)

    def _index(self, path: str, version: str) -> None:
        """Write the index of new files, reading only their keys."""
        kind = self.spark.table(self.name).schema[self.key].dataType.simpleString()
        written = self.spark.read.schema(f"`{self.key}` {kind}, `{PART}` STRING").parquet(path)
        at = f"{self.root}/keys/{VERSION}={version}"
        key_bitmaps(written, self.key, PART).sortWithinPartitions(PART).write.mode("overwrite").parquet(at)

    def _register(self, what: str, partitions: Sequence[str]) -> None:
        """Tell the catalogue of new partitions, which nothing shows before the switch."""
        for n in range(0, len(partitions), PARTITIONS_PER_STATEMENT):
            some = " ".join(f"PARTITION {p}" for p in partitions[n : n + PARTITIONS_PER_STATEMENT])
            self.spark.sql(f"ALTER TABLE {self.part_of(what)} ADD IF NOT EXISTS {some}")

    def _forget(self, what: str, partitions: Sequence[str]) -> None:
        for n in range(0, len(partitions), PARTITIONS_PER_STATEMENT):
            some = ", ".join(f"PARTITION {p}" for p in partitions[n : n + PARTITIONS_PER_STATEMENT])
            self.spark.sql(f"ALTER TABLE {self.part_of(what)} DROP IF EXISTS {some}")

    def _switch(self, name: str, rows: Sequence[tuple[str, str]]) -> None:
        at = f"{self.root}/manifest/{name}"
        write_lines(self.spark, f"{at}/days.json", [json.dumps({"part": part, "version": version}) for part, version in rows])
        self.spark.sql(f"ALTER TABLE {self.part_of('manifest')} SET LOCATION '{at}'")
        self.spark.catalog.refreshTable(self.part_of("manifest"))

    # removal

    def vacuum(self, keep: int = 2, min_age: timedelta = timedelta(days=1)) -> list[str]:
        """Remove files that the last ``keep`` manifests don't reach; returns the folders removed.

        With 2, a query that began before the last switch still finds its files. Folders of versions that were never switched to
        are left of failed loads or belong to one that is under way: they go once they are older than ``min_age``.
        """
        if keep < 1:
            raise ValueError("the manifest that is valid must be kept")
        number, _ = self.state()
        manifests = [name for name, _ in folders(self.spark, f"{self.root}/manifest") if int(name.split("-", 1)[0]) <= number]
        kept, dropped = manifests[-keep:], manifests[:-keep]
        reachable = set()
        for name in kept:
            rows = self.spark.read.schema(MANIFEST).json(f"{self.root}/manifest/{name}").collect()
            reachable |= {(r["version"], r["part"]) for r in rows}
        switched = {name.split("-", 1)[1] for name in manifests}
        live = {version for version, _ in reachable}
        now, gone = time.time(), []
        lost: list[str] = []
        for folder, changed in folders(self.spark, f"{self.root}/files"):
            version = folder.split("=", 1)[1]
            if version not in switched and now - changed < min_age.total_seconds():
                continue
            parts = [name.split("=", 1)[1] for name, _ in folders(self.spark, f"{self.root}/files/{folder}")]
            out = [part for part in parts if (version, part) not in reachable]
            lost += [f"({VERSION} = '{version}', {PART} = '{part}')" for part in out]
            gone += [f"files/{folder}/{PART}={part}" for part in out] if version in live else [f"files/{folder}"]
        indexes = [
            folder
            for folder, changed in folders(self.spark, f"{self.root}/keys")
            if folder.split("=", 1)[1] not in live
            and (folder.split("=", 1)[1] in switched or now - changed >= min_age.total_seconds())
        ]
        self._forget("files", lost)
        self._forget("keys", [f"({VERSION} = '{folder.split('=', 1)[1]}')" for folder in indexes])
        gone += [f"keys/{folder}" for folder in indexes]
        gone += [f"manifest/{name}" for name in dropped]
        for folder in gone:
            remove(self.spark, f"{self.root}/{folder}")
        return gone


def vacuum_materialised(
    spark: SparkSession, layers: Layers, table: str, keep: int = 2, min_age: timedelta = timedelta(days=1), database: str | None = None
) -> list[str]:
    """Remove the files of a materialised table's former states: all but its own and the ``keep`` - 1 written last, if old enough."""
    at = layers.location(database or layers.analytics, table)
    own = location_of(spark, f"{database or layers.analytics}.{table}").rstrip("/").rsplit("/", 1)[1]
    others = sorted((changed, name) for name, changed in folders(spark, at) if name.startswith("v=") and name != own)
    now = time.time()
    gone = [name for changed, name in others[: len(others) - (keep - 1)] if now - changed >= min_age.total_seconds()]
    for name in gone:
        remove(spark, f"{at}/{name}")
    return gone
