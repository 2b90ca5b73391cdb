"""Connected components of a large set of links, by alternating star contractions.

Each round replaces links by links to the smallest neighbour: first every larger neighbour of a node is
linked to its smallest one, then the smaller neighbours are. The links end as one star per
component, after a number of rounds that grows with the logarithm of the component, not with its length. Only
counts reach the driver; every round is written to the shared folder, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import keep


def _smallest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """``links`` point from the larger node ``u`` to the smaller ``v``."""
    least = _smallest(links)
    moved = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in ``links`` (columns ``u``, ``v``) that is not itself the smallest of its component."""
    links = keep(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
    )
    before = None
    while True:
        links = keep(small_star(large_star(links)), "links")
        # Stars are stable: as many links, and the same sum over nodes and roots, as a round before.
        state = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
