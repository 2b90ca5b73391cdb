"""Journal of loads, so that one that was cut off can be carried on.

A load goes through the states ``named`` (its launches have their names), ``staged`` (their rows are in staging) and ``applied`` (the snapshot
shows them); one that later loads have overtaken ends as ``dropped``. Every state is one line in the table ``load_journal`` of the
log layer, written when the step is done.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import date

from pyspark.sql import SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.sources.tables import Layers, create_table

NAMED, STAGED, APPLIED, DROPPED = "named", "staged", "applied", "dropped"
COLUMNS = "load_id STRING, target STRING, state STRING, launches STRING, changed_at TIMESTAMP_NTZ"


@dataclass(frozen=True)
class Load:
    """A load of a target table: its launches by period, None for the whole table."""

    load_id: str
    target: str
    launches: dict[date | None, str]
    state: str


def as_text(launches: dict[date | None, str]) -> str:
    return json.dumps([[period.isoformat() if period else None, launch] for period, launch in launches.items()])


def from_text(text: str) -> dict[date | None, str]:
    return {date.fromisoformat(period) if period else None: launch for period, launch in json.loads(text)}


@dataclass(frozen=True)
class Journal:
    spark: SparkSession
    layers: Layers

    @property
    def name(self) -> str:
        return f"{self.layers.log}.load_journal"

    def create(self) -> Journal:
        create_table(self.spark, self.name, COLUMNS, self.layers.location(self.layers.log, "load_journal"), if_exists="KEEP")
        return self

    def note(self, load: Load, state: str) -> Load:
        """The load in its new state, once that is written."""
        self.spark.sql(
            f"INSERT INTO {self.name} VALUES (:load_id, :target, :state, :launches, localtimestamp())",
            args={"load_id": load.load_id, "target": load.target, "state": state, "launches": as_text(load.launches)},
        )
        return Load(load.load_id, load.target, load.launches, state)

    def unfinished(self, target: str) -> list[Load]:
        """Loads of a table that are neither applied nor dropped, in the order they began. There are only as many as were cut off."""
        of_load = Window.partitionBy("load_id")
        began = self.spark.table(self.name).where(F.col("target") == target).withColumn("began", F.min("changed_at").over(of_load))
        ended = F.max(F.col("state").isin(APPLIED, DROPPED)).over(of_load)
        open_loads = began.withColumn("ended", ended).where("not ended")
        latest = open_loads.groupBy("load_id").agg(F.min("began").alias("began"), F.max_by("state", F.when(F.col("state") == STAGED, 1).otherwise(0)).alias("state"), F.first("launches").alias("launches"))
        return [Load(r["load_id"], target, from_text(r["launches"]), r["state"]) for r in latest.orderBy("began", "load_id").collect()]
