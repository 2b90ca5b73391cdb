"""Merkle manifest of a dataset: a content-addressed DAG, and proofs found by descending it.

Every row is a leaf, the hash of its fields. Per source, leaves stand in the order of their ids, and 16 neighbours at a time are
hashed into a parent until one node is left, the source's subroot; the subroots are put together likewise into the root.

*Order.* Rows are sorted across partitions and numbered by the rows that partitions before theirs hold, so a source
that has a third of all rows is spread over a third of the partitions. Only counts per partition are put in order in one place.
The driver learns the bounds of the partitions from a sample that grows with their number; it is kept small.

*Store.* For each level there are records from a node's digest to its children's digests, one per distinct digest: equal subtrees
share their record. The roots are written to a table of their own, as all levels of the descent and of the tree above read them.

*Descent.* Requests name a leaf by source and rank. From the root downwards, requests that share a prefix of digits (base 16) go
together: their node's digest is looked up in the store, the next digit selects a child, and its siblings to the left and right are
collected as a segment of the path. Above the lowest level there are never more rows than nodes, and no node
has more than 16 requests to answer at the lowest, so nothing piles up on the root. Reversed segments are the proof, leaf first.
Neighbours' paths are all but equal and are stored in a fraction of their size, so the size of their files must not have them
broadcast: nodes are the left side of left joins, of which only the right can be. Every node has its record, so none is added.

Defined cases: null fields hash as ``-``; a null source is a source of its own and comes first; null ids come first in their source.
Rows with equal ids stand in the order of their leaves, and equal rows get the proofs of neighbouring places. A source with one
row has its leaf as subroot, and a table of one row its leaf as root, with nothing to prove. Texts are hashed whole. Further
columns take no part. An empty table gives an empty result.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import keep

FANOUT = 16
#: Hexadecimal digits of a digest.
WIDTH = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# monotonically_increasing_id has the partition above, and the row's place in it below, this bit.
PLACE_BITS = 33
#: Rows sampled per partition of a sort: Spark takes three times as many to the driver, for bounds that are mostly off by a tenth or two.
SAMPLED = 20
#: 16 to this power is beyond any count of rows.
MOST_LEVELS = 15


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def encoded(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(*fields: Column) -> Column:
    return digest(*[encoded(f) for f in fields])


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def height_of(leaves: Column) -> Column:
    """Levels above the leaves of a tree: each puts 16 nodes together, until one is left."""
    height = F.lit(None)
    for level in range(MOST_LEVELS, -1, -1):
        height = F.when(leaves <= FANOUT**level, level).otherwise(height)
    return height


# order


@contextmanager
def small_sample(spark: SparkSession) -> Iterator[None]:
    """Bounds of partitions are found from ``SAMPLED`` rows each in here, as all those rows meet on the driver."""
    name = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(SAMPLED, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def in_order(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` sorted, with ``part``, the partition a row was sorted in, and ``place``, the number of rows before it in there."""
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    with small_sample(df.sparkSession):
        rows = keep(placed, name)
    place = F.col("at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return rows.withColumns({"part": F.shiftright("at", PLACE_BITS), "place": place}).drop("at")


def offsets(counts: DataFrame) -> DataFrame:
    """(part, offset), the rows in the partitions before, of (part, rows); for a broadcast, as there is one row per partition."""
    totals = counts.groupBy("part").agg(F.sum("rows").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.broadcast(totals.select("part", (F.sum("rows").over(before) - F.col("rows")).alias("offset")))


def numbered(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` with ``pos``, the number of rows that come before, and ``part``, the partition a row was sorted in."""
    rows = in_order(df, order, name)
    counts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    return rows.join(offsets(counts), "part").withColumn("pos", F.col("offset") + F.col("place")).drop("place", "offset")


def by_source(leaves: DataFrame) -> DataFrame:
    """Leaves with the number of their source (``tree``), their rank in it, and the source's height."""
    # The row's number parts rows that are equal in all else, so that any number of them can be spread.
    tied = leaves.withColumn("tie", F.monotonically_increasing_id())
    rows = in_order(tied, ["source", "key", "leaf", "tie"], "leaves").drop("tie")
    # Kept, so that all that follows from the counts takes one pass over the rows.
    counted = rows.groupBy("part", "source").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    stretches = keep(counted, "stretches")
    stretches = stretches.join(offsets(stretches.select("part", "rows")), "part")
    first = F.min(F.col("offset") + F.col("first"))
    whole = stretches.groupBy("source").agg(first.alias("start"), F.sum("rows").alias("n"))
    sources = numbered(whole, ["start"], "sources").select(
        F.col("source").alias("s"), F.col("pos").alias("tree"), "start", height_of(F.col("n")).alias("height")
    )
    # A partition holds few rows of few sources or many of one: joined by both, no key has more rows than a partition.
    placed = stretches.join(sources, F.col("source").eqNullSafe(F.col("s"))).select(
        F.col("part").alias("p"), "s", "tree", (F.col("offset") - F.col("start")).alias("shift"), "height"
    )
    # Every row has its stretch; in a left join the rows can't be broadcast, though equal ones have small files.
    joined = rows.join(placed, (F.col("part") == F.col("p")) & F.col("source").eqNullSafe(F.col("s")), "left")
    return joined.withColumn("rank", F.col("place") + F.col("shift")).drop("part", "p", "s", "source", "shift", "place")


# store


@dataclass
class Forest:
    """Trees built level by level: ``levels[k - 1]`` has the nodes k levels above the leaves, with their children's digests
    side by side, and ``roots`` (tree, height, digest)."""

    levels: list[DataFrame]
    roots: DataFrame

    def records(self, level: int) -> DataFrame:
        return self.levels[level - 1].select("digest", "children").dropDuplicates(["digest"])


def build_trees(leaves: DataFrame) -> Forest:
    """Trees over (tree, height, rank, digest)."""
    highest = leaves.agg(F.max("height")).first()[0] or 0
    levels: list[DataFrame] = []
    below = leaves
    roots = leaves.where("height = 0").select("tree", "height", "digest")
    for level in range(1, highest + 1):
        run = F.sort_array(F.collect_list(F.struct("rank", "digest")))["digest"]
        nodes = (
            below.where(F.col("height") >= level)
            .groupBy("tree", "height", F.expr(f"rank div {FANOUT}").alias("up"))
            .agg(F.concat_ws("", run).alias("children"))
            .select("tree", "height", F.col("up").alias("rank"), digest(F.col("children")).alias("digest"), "children")
        )
        below = keep(nodes, f"level{level}")
        levels.append(below)
        roots = roots.unionByName(below.where(F.col("height") == level).select("tree", "height", "digest"))
    return Forest(levels, keep(roots, "roots"))


@dataclass
class Manifest:
    """``rows``: (key, leaf, tree, rank, height, and what is carried); ``sources``: the trees of the sources; ``top``: that over their subroots."""

    rows: DataFrame
    sources: Forest
    top: Forest


def build(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    key: str = "doc_id",
    source: str = "source",
    carry: Mapping[str, Column] | None = None,
) -> Manifest:
    """Manifest of ``docs``. ``carry`` names further columns that rows keep, for use beside their proofs."""
    carried = [c.alias(f"carry_{n}") for n, c in (carry or {}).items()]
    leaves = docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), leaf_of(*[F.col(f) for f in fields]).alias("leaf"), *carried
    )
    # Kept first: the sort reads its input twice, and texts should be hashed once.
    rows = keep(by_source(keep(leaves, "hashed")), "ranked")
    sources = build_trees(rows.select("tree", "height", "rank", F.col("leaf").alias("digest")))
    subroots = sources.roots.select("tree", "digest")
    count = height_of(F.lit(subroots.count())).alias("height")
    top = build_trees(subroots.select(F.lit(0).cast("long").alias("tree"), count, F.col("tree").alias("rank"), "digest"))
    return Manifest(rows, sources, top)


# descent


def step(node: Column, digit: Column) -> Column:
    """Segment of a path: the digests to the left and to the right of the child that a digit selects."""
    return F.struct(
        F.substr(node, F.lit(1), digit * WIDTH).alias("left"),
        F.substr(node, (digit + 1) * WIDTH + 1, F.lit(FANOUT * WIDTH)).alias("right"),
    )


def child(node: Column, digit: Column) -> Column:
    return F.substr(node, digit * WIDTH + 1, F.lit(WIDTH))


def wanted_at(wanted: DataFrame | None, level: int) -> DataFrame | None:
    """The nodes of a level that have a wanted leaf below."""
    if wanted is None:
        return None
    return wanted.select("tree", F.expr(f"rank div {FANOUT**level}L").alias("rank")).distinct()


def looked_up(starts: DataFrame, forest: Forest, wanted: DataFrame | None, lowest: int) -> DataFrame:
    """From the roots in ``starts`` (tree, height, digest, path, ...) down to the nodes of level ``lowest`` (0: the leaves), each with its path.

    Trees lower than ``lowest`` stay out.
    """
    active = None
    for level in range(len(forest.levels), lowest - 1, -1):
        entering = starts.where(F.col("height") == level).withColumn("rank", F.lit(0).cast("long"))
        active = entering if active is None else active.unionByName(entering)
        if level == lowest:
            break
        met = active.join(forest.records(level), "digest", "left")
        size = F.length("children") / WIDTH
        each = met.withColumn("digit", F.explode(F.sequence(F.lit(0), size.cast("int") - 1)))
        active = each.select(
            *[c for c in active.columns if c not in ("rank", "digest", "path")],
            (F.col("rank") * FANOUT + F.col("digit")).alias("rank"),
            child(F.col("children"), F.col("digit")).alias("digest"),
            F.concat("path", F.array(step(F.col("children"), F.col("digit")))).alias("path"),
        )
        below = wanted_at(wanted, level - 1)
        if below is not None:
            active = active.join(below, ["tree", "rank"], "left_semi")
    return starts.withColumn("rank", F.lit(0).cast("long")).where("false") if active is None else active


def prove(manifest: Manifest, wanted: DataFrame | None = None, key: str = "doc_id") -> DataFrame:
    """(key, leaf, subroot, root, steps, and what is carried) of all rows, or of those whose (tree, rank) are in ``wanted``.

    ``steps`` has the siblings to the left and right on each level, from the leaf upwards.
    """
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    starts = manifest.top.roots.withColumn("path", no_path).withColumn("root", F.col("digest"))
    trees = None if wanted is None else wanted.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank")).distinct()
    subroots = looked_up(starts, manifest.top, trees, 0).select(F.col("rank").alias("tree"), "digest", "path", "root")
    heights = manifest.sources.roots.select("tree", "height")
    inner = keep(subroots.join(heights, "tree", "left").withColumn("subroot", F.col("digest")), "subroots")

    lowest = looked_up(inner, manifest.sources, wanted, 1).drop("height")
    if manifest.sources.levels:
        lowest = lowest.join(manifest.sources.records(1), "digest", "left")
    else:
        lowest = lowest.withColumn("children", F.lit(None).cast("string"))
    alone = inner.where("height = 0").drop("height").withColumn("rank", F.lit(0).cast("long"))
    lowest = lowest.unionByName(alone.withColumn("children", F.lit(None).cast("string"))).withColumnRenamed("rank", "block")

    rows = manifest.rows if wanted is None else manifest.rows.join(wanted.select("tree", "rank").distinct(), ["tree", "rank"], "left_semi")
    asked = rows.drop("leaf").withColumn("block", F.expr(f"rank div {FANOUT}"))
    # Neither side is small because its files are: ranks are stored as tightly as paths.
    met = asked.hint("merge").join(lowest, ["tree", "block"])
    digit = (F.col("rank") % FANOUT).cast("int")
    has_run = F.col("children").isNotNull()
    path = F.when(has_run, F.concat("path", F.array(step(F.col("children"), digit)))).otherwise(F.col("path"))
    return met.select(
        F.col("key").alias(key),
        F.when(has_run, child(F.col("children"), digit)).otherwise(F.col("subroot")).alias("leaf"),
        "subroot",
        "root",
        F.reverse(path).alias("steps"),
        "tree",
        "rank",
        *[F.col(c).alias(c.removeprefix("carry_")) for c in rows.columns if c.startswith("carry_")],
    )


def proof_text(steps: Column) -> Column:
    """All siblings from the leaf upwards, left to right."""
    return F.concat_ws("", F.transform(steps, lambda s: F.concat(s["left"], s["right"])))


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(steps, leaf, lambda node, s: digest(s["left"], node, s["right"]))


def tampered_leaf(fields: Sequence[str] = FIELDS, text: str = "text") -> Column:
    """Leaf of a row whose text was put in small letters."""
    return leaf_of(*[lower_ascii(F.col(f)) if f == text else F.col(f) for f in fields])


# SQL


def _sql() -> str:
    """Both trees unrolled for five levels each (a million rows a source, a million sources); finished trees are passed on."""
    levels = 5
    enc = lambda c: f"coalesce(strlen({c}::varchar)::varchar || ':' || {c}::varchar, '-')"
    leaf = lambda text: "sha256(" + " || ".join(text if f == "text" else enc(f) for f in FIELDS) + ")"
    small = f"coalesce(strlen(text)::varchar || ':' || translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '-')"
    bits = "list_transform(range(8 * length(d)), lambda i: (ascii(substr(d, (i // 8 + 1)::int, 1)) >> (i % 8)::int) & 1)"
    crc = f"xor(list_reduce(list_concat([4294967295::bigint], {bits}), lambda a, b: xor(a >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295)"

    def tree(of: str, to: str) -> list[str]:
        out = []
        for k in range(1, levels + 1):
            below = of if k == 1 else f"{to}{k - 1}"
            out.append(
                f"""{to}{k} as (select tree, rank // {FANOUT} as rank, (max(n) + {FANOUT - 1}) // {FANOUT} as n,
  case when max(n) > 1 then string_agg(digest, '' order by rank) end as children,
  case when max(n) > 1 then sha256(string_agg(digest, '' order by rank)) else min(digest) end as digest
  from {below} group by tree, rank // {FANOUT})"""
            )
        return out

    parts, joins = [], []
    for to, on, rank in (("a", "r.tree", "r.rank"), ("b", "0", "r.tree")):
        for k in range(1, levels + 1):
            node, digit = f"{to}{k}", f"(({rank} // {FANOUT ** (k - 1)}) % {FANOUT})"
            joins.append(f"join {node} on {node}.tree = {on} and {node}.rank = {rank} // {FANOUT**k}")
            left = f"substr({node}.children, 1, {WIDTH} * {digit})"
            parts.append(f"coalesce({left} || substr({node}.children, {WIDTH} * {digit} + {WIDTH + 1}), '')")
    # One column per level, as each fold names the one before twice.
    folds, before = [], "start"
    for to, rank in (("a", "r.rank"), ("b", "r.tree")):
        for k in range(1, levels + 1):
            digit = f"(({rank.removeprefix('r.')} // {FANOUT ** (k - 1)}) % {FANOUT})"
            c = f"{to}{k}c"
            folds.append(
                f"f_{to}{k} as (select *, case when {c} is null then {before} else sha256(substr({c}, 1, {WIDTH} * {digit}) || {before} || "
                f"substr({c}, {WIDTH} * {digit} + {WIDTH + 1})) end as v_{to}{k} from {folds[-1].split(' ')[0] if folds else 'met'})"
            )
            before = f"v_{to}{k}"
    children = ", ".join(f"{to}{k}.children as {to}{k}c" for to in "ab" for k in range(1, levels + 1))
    return f"""
with hashed as (
  select doc_id, source, {leaf(enc('text'))} as leaf, {leaf(small)} as small, doc_id::varchar as d from documents
), crcs as (select *, case when d is null then null else {crc} end as crc from hashed),
r as (
  select doc_id, leaf, case when crc % 5 = 0 then small else leaf end as start,
    dense_rank() over (order by source nulls first) - 1 as tree,
    row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as rank,
    count(*) over (partition by source) as n
  from crcs
), leaves as (select tree, rank, n, leaf as digest from r),
{", ".join(tree("leaves", "a"))},
tops as (select 0 as tree, tree as rank, count(*) over () as n, digest from a{levels}),
{", ".join(tree("tops", "b"))},
met as (
  select r.doc_id, r.leaf, r.start, r.tree, r.rank, a{levels}.digest as subroot, b{levels}.digest as root,
    sha256({" || ".join(parts)}) as proof_sha256, {children}
  from r {" ".join(joins)}
), {", ".join(folds)}
select doc_id, leaf, subroot, root, proof_sha256, {before} as folded_root, {before} = root as verified
from f_b{levels}
"""


ORACLE_SQL = _sql()
