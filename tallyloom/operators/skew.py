"""Joins on keys of which a few may hold a large share of the rows.

``heavy_keys`` finds those keys in one narrow scan with a bounded sketch. ``join_parts`` then splits a
join in two: the ordinary keys take the plain shuffle join (after which aggregations by that key need
no further shuffle), and the rows of the heavy keys are spread over many tasks. With no heavy key, which
is the usual case, the plan is just the plain join. The result never depends on which keys were found.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT = "_salt"
# Keys that are looked for at least; no more keys than there are partitions can each hold more than one of them.
LEAST_KEYS = 2048
# The largest sketch that Spark makes.
MAX_SKETCH_ITEMS = 1_000_000
# A key with fewer rows than this never overloads a task.
MIN_HEAVY_ROWS = 1_000_000


def key_column(keys: Sequence[str]) -> Column:
    """The key itself, or a hash that stands for a compound key."""
    return F.col(keys[0]) if len(keys) == 1 else F.xxhash64(*keys)


def heavy_keys(df: DataFrame, *keys: str, min_rows: int = MIN_HEAVY_ROWS) -> list[Any]:
    """Keys that hold more rows than an average shuffle partition.

    Sketches of a fixed size are merged in two steps, so neither a task nor the driver ever sees
    more than that. NULL is reported as ``None``; compound keys are reported by their hash.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = max(LEAST_KEYS, partitions)
    items = min(MAX_SKETCH_ITEMS, 8 * wanted)
    sketches = (
        df.select(
            key_column(keys).alias("k"),
            F.pmod(F.spark_partition_id(), F.lit(64)).alias("part"),
        )
        .groupBy("part")
        .agg(
            F.expr(f"approx_top_k_accumulate(k, {items})").alias("sketch"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    # Grouped, as an empty table has no sketch to merge.
    merged = sketches.groupBy(F.lit("all")).agg(
        F.expr(f"approx_top_k_combine(sketch, {items})").alias("sketch"), F.sum("n").alias("n")
    )
    found = merged.select("n", F.expr(f"approx_top_k_estimate(sketch, {wanted})").alias("top")).first()
    if found is None:
        return []
    floor = max(min_rows, found["n"] // partitions)
    return [entry["item"] for entry in found["top"] if entry["count"] >= floor]


def is_heavy(key: Column, heavy: Sequence[Any]) -> Column:
    """TRUE or FALSE, never NULL."""
    hit = F.coalesce(key.isin([k for k in heavy if k is not None]), F.lit(False))
    return hit | key.isNull() if None in heavy else hit


def join_parts(
    big: DataFrame, small: DataFrame, key: str, heavy: Sequence[Any]
) -> list[tuple[DataFrame, DataFrame, list[str]]]:
    """``(big, small, join columns)`` triples whose joins together make the join on ``key``.

    The rows of a heavy key get a salt from the task that reads them (the same one if the task is run
    again, and different for equal rows in different files) and meet one copy of the small side's
    rows per salt. Those copies number one per shuffle partition and row of a heavy key. Nothing is
    broadcast by hint: Spark does that itself where it measures the side to be small.
    """
    if not heavy:
        return [(big, small, [key])]
    salts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = is_heavy(F.col(key), heavy)
    salted_big = big.where(hot).withColumn(SALT, F.pmod(F.spark_partition_id(), F.lit(salts)))
    salted_small = small.where(hot).withColumn(SALT, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return [(big.where(~hot), small.where(~hot), [key]), (salted_big, salted_small, [key, SALT])]


def skew_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    heavy: Sequence[Any] = (),
    how: str = "inner",
    also: Sequence[str] = (),
    then: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Inner, left, left semi or left anti join of a possibly skewed ``big`` with ``small``.

    NULL keys match nothing. Inner and semi joins drop them before the shuffle, the others pass their rows round the
    join, so that however many there are, they never meet in one task.

    Joined on ``key``, which ``heavy`` is about, and on the further columns ``also``. ``then`` is applied
    to each part before they are put together. It must treat every key on its own, such as an aggregation
    by ``key``: the parts share no key.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"skew_join does not do {how!r} joins")
    parts = []
    no_key = big.where(F.col(key).isNull())
    big, small = big.where(F.col(key).isNotNull()), small.where(F.col(key).isNotNull())
    heavy = [k for k in heavy if k is not None]
    for big_part, small_part, on in join_parts(big, small, key, heavy):
        joined = big_part.join(small_part, [*on, *also], how).drop(SALT)
        parts.append(then(joined) if then else joined)
    if how in ("left", "left_anti"):
        added = [c for c in small.columns if c != key and c not in also] if how == "left" else []
        kinds = {f.name: f.dataType for f in small.schema}
        passed = no_key.select(
            *[key, *also, *[c for c in no_key.columns if c != key and c not in also]],
            *[F.lit(None).cast(kinds[c]).alias(c) for c in added],
        )
        parts.append(then(passed) if then else passed)
    return reduce(DataFrame.unionByName, parts)
