"""Keeping the latest version of every row of a table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.conform import LAUNCH_ID
from tallyloom.operators.extract import launch_table
from tallyloom.operators.skew import heavy_keys, skew_join


def without_keys(rows: DataFrame, batch: DataFrame, key: str, heavy: Sequence[Any] | None = None) -> DataFrame:
    """``rows`` whose key does not occur in ``batch``. Rows with a NULL key stay."""
    if heavy is None:
        heavy = heavy_keys(rows, key)
    return skew_join(rows, batch.select(key).distinct(), key, heavy, how="left_anti")


def upsert(
    snapshot: DataFrame,
    batch: DataFrame,
    key: str = "id",
    heavy: Sequence[Any] | None = None,
    staged: DataFrame | None = None,
) -> DataFrame:
    """``snapshot`` with the rows of all keys in ``batch`` replaced by those of ``batch``.

    All rows of the batch go in, also several of one key or with a NULL key; keys that the batch does
    not mention are left alone. If ``batch`` was picked from ``staged`` rows with the same set of keys,
    the keys are read from there, without doing the picking twice.
    """
    return without_keys(snapshot, batch if staged is None else staged, key, heavy).unionByName(batch)


def latest_launches(
    staged: DataFrame, launches: dict[date, str], key: str = "id", heavy: Sequence[Any] | None = None
) -> DataFrame:
    """What is left of ``staged`` once its launches have been upserted one after the other.

    A row is dropped if its key was staged again by a later launch; a NULL key never is. So every key
    of ``staged`` is still there. Each key's first and last launch are plain extremes, which combine before the shuffle;
    only the (usually few) keys that two launches have are joined back, so the staged rows need no ordering.
    """
    if len(launches) < 2:
        return staged
    if heavy is None:
        heavy = heavy_keys(staged, key)
    order = launch_table(staged.sparkSession, launches).select(LAUNCH_ID, "_order")
    ordered = staged.join(F.broadcast(order), LAUNCH_ID)
    ends = ordered.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("_order").alias("_first"), F.max("_order").alias("_last"))
    overtaken = ends.where(F.col("_first") < F.col("_last")).select(key, "_last")
    found = skew_join(ordered, overtaken, key, heavy, how="left")
    return found.where(F.col("_last").isNull() | (F.col("_order") >= F.col("_last"))).select(*staged.columns)
