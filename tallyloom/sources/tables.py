"""Tables of the staging, analytics and log layers, and what snapshots share with them.

All are external parquet tables in the session catalogue. A table or partition is rewritten by writing
new files next to the old ones and then pointing the catalogue at them: a job that fails leaves the
table as it was, and queries that have begun keep their files.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.conform import LAUNCH_COLUMN, LAUNCH_ID, SourceColumn, spark_type
from tallyloom.operators.quality import enforce

log = logging.getLogger(__name__)

# Partition column of a snapshot table: the first day of a period; rows without a date go to NO_DATE.
PART = "_part"
NO_DATE = "none"
# Catalogue statements name at most this many partitions each.
PARTITIONS_PER_STATEMENT = 500


@dataclass(frozen=True)
class Layers:
    """Names of the databases the layers live in, and the folder they are kept under."""

    root: str
    staging: str = "saa"
    snapshot: str = "snp"
    analytics: str = "analytics"
    log: str = "engine"

    def create(self, spark: SparkSession) -> Layers:
        for name in (self.staging, self.snapshot, self.analytics, self.log):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{self.root}/{name}'")
        return self

    def location(self, database: str, table: str) -> str:
        return f"{self.root}/{database}/{table}"


class SchemaDrift(ValueError):
    """A source no longer fits the table it is loaded into."""


def loaded_types(spark: SparkSession, columns: Sequence[SourceColumn]) -> dict[str, str]:
    return {c.name: spark_type(spark, c).lower() for c in columns}


def check_drift(spark: SparkSession, table: str, columns: Sequence[SourceColumn], own: Sequence[str]) -> list[str]:
    """Columns that ``table`` lacks. A missing column or a type that is not the table's is an error.

    ``own`` are columns that the table has of itself. Texts of any length are one type here; nested values are loaded as
    JSON text, so what they hold may change.
    """
    has = {f.name: f.dataType.simpleString() for f in spark.table(table).schema if f.name not in own}
    wanted = loaded_types(spark, columns)
    gone = sorted(has.keys() - wanted.keys())
    if gone:
        raise SchemaDrift(f"{table}: the source has no column {', '.join(gone)} any more")
    for name in sorted(has.keys() & wanted.keys()):
        if has[name] != wanted[name]:
            raise SchemaDrift(f"{table}: column {name} is {has[name]}, but would now be {wanted[name]}")
    return sorted(wanted.keys() - has.keys())


def check_new(
    spark: SparkSession, table: str, columns: Sequence[SourceColumn], own: Sequence[str], on_new_columns: str
) -> list[str]:
    """Columns to add to ``table`` so that nothing of the source is lost; an error unless that is asked for by ``add``."""
    if on_new_columns not in ("error", "add"):
        raise ValueError(f"unknown on_new_columns {on_new_columns!r}")
    new = check_drift(spark, table, columns, own)
    if new and on_new_columns == "error":
        raise SchemaDrift(f"{table}: the source has the new column {', '.join(new)}")
    return new


def fit_columns(
    spark: SparkSession, table: str, columns: Sequence[SourceColumn], own: Sequence[str], on_new_columns: str
) -> None:
    """Check ``table`` and give it the columns it lacks, which are NULL in all rows that are there already."""
    new = check_new(spark, table, columns, own, on_new_columns)
    if new:
        types = loaded_types(spark, columns)
        ddl = ", ".join(f"`{name}` {types[name].upper()}" for name in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({ddl})")


def file_system(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """Hadoop's file system and path object of a path."""
    sc = spark.sparkContext
    found = sc._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(sc._jsc.hadoopConfiguration()), found


def folders(spark: SparkSession, path: str) -> list[tuple[str, float]]:
    """Name and time of change of the folders below a path."""
    fs, at = file_system(spark, path)
    if not fs.exists(at):
        return []
    return sorted((s.getPath().getName(), s.getModificationTime() / 1000) for s in fs.listStatus(at) if s.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    fs, at = file_system(spark, path)
    fs.delete(at, True)


def write_lines(spark: SparkSession, path: str, lines: Sequence[str]) -> None:
    """A small text file, without a job."""
    fs, at = file_system(spark, path)
    out = fs.create(at, True)
    out.write("".join(f"{line}\n" for line in lines).encode())
    out.close()


def location_of(spark: SparkSession, table: str, partition: str = "") -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {partition}").where("col_name = 'Location'").collect()
    return rows[-1]["data_type"]


def new_launch_id() -> str:
    return str(uuid.uuid1())


def log_launches(spark: SparkSession, layers: Layers, launch_ids: Sequence[str], now: datetime | None = None) -> None:
    """Append the launches of one load to the launch log, in one write."""
    moment = now or datetime.now()
    rows = spark.createDataFrame([(i, moment) for i in launch_ids], f"{LAUNCH_ID} string, log_dtime timestamp_ntz")
    create_table(
        spark,
        f"{layers.log}.launch_log",
        f"{LAUNCH_ID} STRING, log_dtime TIMESTAMP_NTZ",
        layers.location(layers.log, "launch_log"),
        if_exists="KEEP",
    )
    rows.coalesce(1).write.insertInto(f"{layers.log}.launch_log")


def column_ddl(spark: SparkSession, columns: Sequence[SourceColumn]) -> str:
    """Column list of a table; texts with a measured length become ``VARCHAR(n)``."""

    def ddl(c: SourceColumn) -> str:
        kind = f"VARCHAR({c.bound})" if c.bound is not None else spark_type(spark, c).upper()
        return f"`{c.name}` {kind}"

    return ", ".join(ddl(c) for c in columns)


def layout(spark: SparkSession, table: str) -> tuple[str, list[tuple[str, str]]]:
    """Format of a table, and its columns as declared, followed by those that partition it."""
    rows = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()]
    end = next(n for n, (name, _) in enumerate(rows) if name.startswith("# Detailed"))
    return dict(rows[end:])["Provider"].lower(), [r for r in rows[:end] if r[0]]


def replace_table(spark: SparkSession, name: str, next_name: str) -> None:
    """Let ``name`` show the files of the external table ``next_name``, which is gone afterwards."""
    shape = layout(spark, name)
    if shape == layout(spark, next_name) and not any(column.startswith("# Partition") for column, _ in shape[1]):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location_of(spark, next_name)}'")
        spark.catalog.refreshTable(name)
        spark.sql(f"DROP TABLE {next_name}")
    else:
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {next_name} RENAME TO {name}")


def create_table(
    spark: SparkSession,
    name: str,
    ddl: str,
    location: str,
    partition_by: str | Sequence[str] | None = None,
    if_exists: str | None = None,
    using: str = "parquet",
) -> None:
    """Create an external table. A conflict is an error unless ``if_exists`` is ``KEEP`` or ``REPLACE``.

    ``REPLACE`` makes the new table first, so whatever fails leaves the old one. An unpartitioned table of the same columns
    and format is emptied by one statement; else the old table is missing for the moment of the rename.
    """
    if if_exists not in (None, "KEEP", "REPLACE"):
        raise ValueError(f"unknown if_exists {if_exists!r}")
    if if_exists == "REPLACE":
        location = f"{location}/v={uuid.uuid4().hex}"
        if spark.catalog.tableExists(name):
            next_name = f"{name}_{uuid.uuid4().hex}"
            create_table(spark, next_name, ddl, location, partition_by, using=using)
            replace_table(spark, name, next_name)
            return
    guard = "IF NOT EXISTS " if if_exists == "KEEP" else ""
    by = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    partitioned = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in by)})" if by else ""
    spark.sql(f"CREATE TABLE {guard}{name} ({ddl}) USING {using}{partitioned} LOCATION '{location}'")


@dataclass(frozen=True)
class StagingTable:
    """Append-only batches, one partition per launch."""

    spark: SparkSession
    layers: Layers
    table: str

    @property
    def name(self) -> str:
        return f"{self.layers.staging}.{self.table}"

    def create(self, columns: Sequence[SourceColumn]) -> None:
        create_table(
            self.spark,
            self.name,
            f"{column_ddl(self.spark, columns)}, `{LAUNCH_ID}` STRING",
            self.layers.location(self.layers.staging, self.table),
            partition_by=LAUNCH_ID,
            if_exists="KEEP",
        )

    def check(self, columns: Sequence[SourceColumn], on_new_columns: str = "error") -> None:
        check_new(self.spark, self.name, columns, (LAUNCH_ID,), on_new_columns)

    def fit(self, columns: Sequence[SourceColumn], on_new_columns: str = "error") -> None:
        fit_columns(self.spark, self.name, columns, (LAUNCH_ID,), on_new_columns)

    def append(
        self, batch: DataFrame, columns: Sequence[SourceColumn], launches: int, cluster_by: str | None = None
    ) -> None:
        """Add tagged rows. Required columns and text lengths are checked as the rows are written.

        A single launch is written as it is read, without a shuffle. Several are rebalanced first, so
        that each gets few files and a big one is still written by many tasks.
        """
        self.fit(columns)
        rows = enforce(batch, [*columns, LAUNCH_COLUMN])
        if launches > 1:
            rows = rows.hint("rebalance", LAUNCH_ID)
        rows = rows.sortWithinPartitions(LAUNCH_ID, *([cluster_by] if cluster_by else []))
        rows.select(*self.spark.table(self.name).columns).write.insertInto(self.name)

    def clear(self, launch_ids: Sequence[str]) -> None:
        """Take out what a load that was cut off left of its launches, rows and files."""
        for launch in launch_ids:
            spec = f"PARTITION (`{LAUNCH_ID}` = '{launch}')"
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS {spec}")
            # Files may lie there without the catalogue knowing of them.
            remove(self.spark, f"{self.layers.location(self.layers.staging, self.table)}/{LAUNCH_ID}={launch}")

    def read(self, launch_ids: Sequence[str]) -> DataFrame:
        """The rows of some launches; other partitions are not read."""
        return self.spark.table(self.name).where(F.col(LAUNCH_ID).isin(list(launch_ids)))


def repoint(spark: SparkSession, name: str, path: str) -> None:
    """Let an unpartitioned table show the files at ``path``, creating it if need be.

    With the same columns that is one statement, so a reader finds the old rows or the new ones. Otherwise the new
    table is made under another name first and takes the name of the old one, which is missing for the moment of the rename.
    """
    shape = lambda df: [(f.name, f.dataType) for f in df.schema]
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{path}'")
    elif shape(spark.table(name)) == shape(spark.read.parquet(path)):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        next_name = f"{name}_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {next_name} USING parquet LOCATION '{path}'")
        spark.sql(f"DROP TABLE {name}")
        spark.sql(f"ALTER TABLE {next_name} RENAME TO {name}")


def materialise(
    spark: SparkSession,
    layers: Layers,
    table: str,
    query: DataFrame | Callable[[], DataFrame] | str | Path,
    database: str | None = None,
) -> float:
    """Create or replace a table from a DataFrame, a function that builds one, or a file with a query.

    The table is repointed only when the new rows are written, so it may be read by the query itself.
    Logs when it began and how long it took; returns the seconds.
    """
    name = f"{database or layers.analytics}.{table}"
    began = time.monotonic()
    log.info("%s started at %s", name, datetime.now().strftime("%Y-%m-%d %H:%M:%S"))
    if isinstance(query, (str, Path)):
        result = spark.sql(Path(query).read_text(encoding="utf-8"))
    else:
        result = query() if callable(query) else query
    path = f"{layers.location(database or layers.analytics, table)}/v={uuid.uuid4().hex}"
    result.write.mode("errorifexists").parquet(path)
    repoint(spark, name, path)
    seconds = time.monotonic() - began
    log.info("%s finished in %d seconds", name, seconds)
    return seconds
