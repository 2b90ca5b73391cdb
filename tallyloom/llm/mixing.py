"""Mixing sources to target weights by entropy balancing.

Targets. Sources in code point order (null last) weigh 1, 2, 3, and so on in turn, and share the size of the
corpus by weight. A target stops at ``MOST`` times its source's size, and the excess is shared again by weight until
no target is above that.

Rates. Among all document rates between 0 and ``MOST`` copies that meet the token constraint of their source,
those of least relative entropy to one copy each are an exponential tilt, ``MOST * e^x / (MOST - 1 + e^x)`` with
``x = multiplier * size / mean size of the source``. The multipliers solve the convex dual. Each Newton iteration is one Spark
aggregation of the gradient and curvature per source; a bracket around each root takes over where a step leaves it.
A target at its limit has rate ``MOST`` for all, one at zero has rate 0.

Copies. Documents of one source and size have one rate, so all sums run over cells (source, size, block), a block
being a bounded share of the cell by a hash of the id. Cells are rounded from the longest documents down, in words: each takes
what the source's target leaves after the longer ones, less what the rates give the shorter ones, and never so much or so
little that the shorter ones can't make up for it. Where one document is more than ``1 / LARGE`` of what is left of its source,
the rates of the shorter ones are then solved again. So a source misses its target by at most half a document that is
longer than ``MOST`` times all shorter ones together. Cells deal their copies to their documents in hash order. Nothing is drawn
at random, so reruns agree.

Rows of one id, source and size take each other's place. Where an id stands in so many rows that its block would overload a task, they
are a cell of their own, whose copies are shared out among parts by row number: each row gets the cell's whole copies, and the
parts their share of those left over.

Defined cases: a null or empty text has size 0, and its rate does not matter: it is taken once, as 0 words.
An empty table, or one without words, gives targets of 0. Null ids and equal rows are documents of their own;
which of several equal rows gets an extra copy is open, but the rows that come out are the same.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import keep, new_name
from tallyloom.operators.skew import heavy_keys, is_heavy

WORD = r"[^\x20\x09-\x0D]+"
MOST = 3
WEIGHTS = 3
#: Documents of one cell at most, about; larger ones are cut into blocks.
BLOCK_DOCS = 512
#: Rows of one id from which on they may be a cell of their own.
REPEATED_ROWS = 1_000_000
MAX_ROUNDS = 60
#: A source is done when its expected words are this close to its target, as a share of its size.
CLOSE = 1e-7
STEEPEST = 700.0
#: A document of more than this part of what is left of its source has the rates of the rest solved again.
LARGE = 64
HALVINGS = 100


def size_of(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    The level at which targets fill up is found by repeated sums, of which only totals reach the driver.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode(F.col("source"), "utf-8"))
    ranked = keep(sizes.withColumn("weight", (F.row_number().over(order) - 1) % WEIGHTS + 1), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, limit = 0.0, MOST * F.col("source_size")
    while True:
        # Sources that the level fills up stand at their limit; the others share what is left by weight.
        full = (F.col("weight") * F.lit(level) >= limit) & F.lit(level > 0) | (F.col("source_size") == 0)
        fixed, weight = ranked.agg(
            F.sum(F.when(full, limit).otherwise(0)), F.sum(F.when(full, 0).otherwise(F.col("weight")))
        ).first()
        if not weight:
            break
        higher = (total - fixed) / weight
        if higher <= level:
            break
        level = higher
    target = F.least(limit.cast("double"), F.col("weight") * F.lit(float(level)))
    return ranked.select("source", "source_size", target.alias("target"))


def rate(x: Column) -> Column:
    tilt = F.exp(F.least(F.greatest(x, F.lit(-STEEPEST)), F.lit(STEEPEST)))
    return F.when(x > 30, MOST - MOST * (MOST - 1) / (MOST - 1 + tilt)).otherwise(MOST * tilt / (MOST - 1 + tilt))


def multipliers(cells: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source, mean, multiplier) that make the expected words of every source its target.

    ``cells`` has (source, size, docs), ``wanted`` (source, source_size, target, n). A multiplier of null stands
    for a target that all or none of the source meets.
    """
    edge = (F.col("target") >= MOST * F.col("source_size")) | (F.col("target") <= 0)
    state = keep(
        wanted.select(
            "source",
            "source_size",
            "target",
            (F.col("source_size") / F.col("n")).alias("mean"),
            F.when(edge, None).otherwise(F.lit(0.0)).alias("multiplier"),
            F.lit(None).cast("double").alias("low"),
            F.lit(None).cast("double").alias("high"),
            edge.alias("done"),
        ),
        "dual",
    )
    for _ in range(MAX_ROUNDS):
        # Large sources keep their cells spread: the join splits them and the sums combine before the shuffle.
        todo = state.where(~F.col("done"))
        x = F.col("multiplier") * F.col("size") / F.col("mean")
        w = rate(x)
        sums = (
            cells.join(todo.select(F.col("source").alias("s"), "multiplier", "mean"), F.expr("source <=> s"))
            .groupBy("s")
            .agg(
                F.sum(w * F.col("size") * F.col("docs")).alias("words"),
                F.sum(w * (1 - w / MOST) * F.col("size") * F.col("size") / F.col("mean") * F.col("docs")).alias("slope"),
            )
        )
        joined = state.join(sums, F.expr("source <=> s"), "left")
        off = F.col("words") - F.col("target")
        close = F.abs(off) <= CLOSE * F.col("source_size")
        low = F.when(off < 0, F.col("multiplier")).otherwise(F.col("low"))
        high = F.when(off > 0, F.col("multiplier")).otherwise(F.col("high"))
        newton = F.col("multiplier") - off / F.col("slope")
        # Without a bracket yet, a step goes no further than twice the way so far.
        reach = 2 * F.abs(F.col("multiplier")) + 1
        step = F.least(F.greatest(newton, F.col("multiplier") - reach), F.col("multiplier") + reach)
        inside = (low.isNull() | (step > low)) & (high.isNull() | (step < high)) & step.isNotNull() & ~F.isnan(step)
        middle = F.coalesce((low + high) / 2, F.when(off < 0, F.col("multiplier") + reach).otherwise(F.col("multiplier") - reach))
        done = F.col("done") | F.coalesce(close, F.lit(False))
        state = keep(
            joined.select(
                "source",
                "source_size",
                "target",
                "mean",
                F.when(done, F.col("multiplier")).otherwise(F.when(inside, step).otherwise(middle)).alias("multiplier"),
                low.alias("low"),
                high.alias("high"),
                done.alias("done"),
            ),
            "dual",
        )
        if not state.where(~F.col("done")).limit(1).count():
            break
    return state


def rest_rates(sizes: np.ndarray, docs: np.ndarray, target: float) -> np.ndarray:
    """The tilted rates of the given cells that make ``target`` words, as near as rates from 0 to ``MOST`` can."""
    words = sizes * docs
    if target <= 0 or target >= MOST * words.sum():
        return np.where(sizes > 0, 0.0 if target <= 0 else float(MOST), 1.0)
    scale = sizes / (words.sum() / docs.sum())

    def rates(multiplier: float) -> np.ndarray:
        return MOST / (1 + (MOST - 1) * np.exp(-np.clip(multiplier * scale, -STEEPEST, STEEPEST)))

    low, high = -1.0, 1.0
    furthest = STEEPEST / scale[sizes > 0].min()
    while rates(low) @ words > target and -low < furthest:
        low *= 2
    while rates(high) @ words < target and high < furthest:
        high *= 2
    for _ in range(HALVINGS):
        middle = (low + high) / 2
        low, high = (middle, high) if rates(middle) @ words < target else (low, middle)
    return rates(high)


def whole_copies(sizes: np.ndarray, docs: np.ndarray, rates: np.ndarray, target: float) -> np.ndarray:
    """Copies that the cells of one source take together; cells go down in size."""
    out, words = docs.copy(), sizes * docs
    rest = np.append(np.cumsum(words[::-1])[::-1], 0)
    later = np.append(np.cumsum((rates * words)[::-1])[::-1], 0)
    left = float(target)
    for i in np.flatnonzero(sizes):
        size, n = float(sizes[i]), int(docs[i])
        # Copies that leave the rest between nothing and MOST times its words; if there are none, the nearest ones.
        most = min(max(left / size, 0.0), MOST * n)
        least = min(max((left - MOST * float(rest[i + 1])) / size, 0.0), most)
        low, high = math.ceil(least), math.floor(most)
        if low <= high:
            out[i] = min(max(math.floor((left - float(later[i + 1])) / size + 0.5), low), high)
        else:
            out[i] = high if least - high <= low - most else low
        left -= size * float(out[i])
        if size * LARGE > rest[i] and rest[i + 1]:
            again = rest_rates(sizes[i + 1 :], docs[i + 1 :], left) * words[i + 1 :]
            later[i + 1 : -1] = np.cumsum(again[::-1])[::-1]
    return out


def dealt_copies(cells: pd.DataFrame) -> pd.DataFrame:
    """(s, z, b, n, total): the documents and copies of each cell of one source."""
    cells = cells.sort_values(["size", "block"], ascending=[False, True])
    sizes, docs = cells["size"].to_numpy(np.int64), cells["docs"].to_numpy(np.int64)
    total = whole_copies(sizes, docs, cells["rate"].to_numpy(float), float(cells["target"].iloc[0]))
    return pd.DataFrame({"s": cells["source"], "z": sizes, "b": cells["block"], "n": docs, "total": total})


def mix(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """(key, size, source_size, target, copies, taken) of every document."""
    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(source).cast("string").alias("source"),
        size_of(F.col(text)).alias("size"),
    )
    return row_mix(numbered).select(F.col("key").alias(key), "size", "source_size", "target", "copies", "taken")


def with_copies(docs: DataFrame, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``copies`` and ``taken``; columns of these names are replaced."""
    row = new_name("_row", docs.columns)
    # Rows get their number once, as the texts are read a second time for the join.
    known = keep(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    numbered = known.select(
        F.col(row).alias("row"), F.col(key).alias("key"), F.col(source).cast("string").alias("source"), size_of(F.col(text)).alias("size")
    )
    new = ("size", "source_size", "target", "copies", "taken")
    mixed = row_mix(numbered).select(F.col("row").alias(row), *new)
    kept = [c for c in known.columns if c.lower() not in new]
    return known.select(*kept).join(mixed, row).drop(row)


def row_mix(numbered: DataFrame) -> DataFrame:
    """The mix of (row, key, source, size), row by row."""
    sized = keep(numbered.withColumn("draw", F.xxhash64(F.lit("mixing"), F.col("key").cast("string"))), "sizes")
    counted = keep(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("docs")), "cells")
    by_source = counted.groupBy("source").agg(
        F.sum(F.col("size") * F.col("docs")).alias("source_size"), F.sum("docs").alias("n")
    )
    goal = targets(by_source.select("source", "source_size"))
    wanted = keep(
        by_source.select(F.col("source").alias("s"), "n").join(goal, F.expr("source <=> s")).drop("s"), "targets"
    )
    state = multipliers(counted, wanted).select(F.col("source").alias("s"), "source_size", "target", "mean", "multiplier")
    flat = F.when(F.col("target") > 0, F.lit(float(MOST))).otherwise(F.lit(0.0))
    w = F.when(F.col("multiplier").isNull(), flat).otherwise(rate(F.col("multiplier") * F.col("size") / F.col("mean")))
    rates = counted.join(state, F.expr("source <=> s")).select(
        "source", "size", "source_size", "target", F.when(F.col("size") == 0, F.lit(1.0)).otherwise(w).alias("rate"),
        F.ceil(F.col("docs") / BLOCK_DOCS).cast("int").alias("blocks"),
    )
    rates = keep(rates, "rates").select(F.col("source").alias("s"), F.col("size").alias("z"), "source_size", "target", "rate", "blocks")
    same = F.expr("source <=> s and size = z")
    repeated = heavy_keys(sized, "draw", min_rows=REPEATED_ROWS)
    placed = sized.join(rates, same).drop("s", "z").withColumn("block", block_of(repeated)).withColumn("part", part_of(sized, repeated))
    cell = ["source", "size", "block"]
    per_part = placed.groupBy(*cell, "part").agg(
        F.count(F.lit(1)).alias("docs"), F.first("rate").alias("rate"), F.first("target").alias("target")
    )
    if repeated:
        per_part = keep(per_part, "parts")
    per_cell = per_part.groupBy(*cell).agg(
        F.sum("docs").alias("docs"), F.first("rate").alias("rate"), F.first("target").alias("target")
    )
    dealt = per_cell.groupBy("source").applyInPandas(dealt_copies, "s string, z long, b int, n long, total long")
    dealt = dealt.withColumn("each", F.floor(F.col("total") / F.col("n"))).withColumn("over", F.expr("total - each * n"))
    shares = shared_out(dealt, per_part) if repeated else dealt.select("s", "z", "b", F.lit(0).alias("p"), "each", "over")
    rank = F.row_number().over(Window.partitionBy(*cell, "part").orderBy(F.hash("draw"), "draw", "key"))
    ranked = placed.withColumn("rank", rank)
    copies = (F.col("each") + F.when(F.col("rank") <= F.col("over"), 1).otherwise(0)).cast("long")
    return ranked.join(shares, F.expr("source <=> s and size = z and block = b and part = p")).select(
        "row", "key", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


def block_of(repeated: Sequence[int]) -> Column:
    """Block of a row in its source and size: by its id, or a negative number that stands for a very frequent id."""
    block = F.pmod("draw", "blocks").cast("int")
    if not repeated:
        return block
    place = F.array_position(F.array(*map(F.lit, sorted(repeated))), F.col("draw")).cast("int")
    return F.when(is_heavy(F.col("draw"), repeated), -place).otherwise(block)


def part_of(rows: DataFrame, repeated: Sequence[int]) -> Column:
    """Part of a row in its block: 0, or by its number if its id is very frequent."""
    if not repeated:
        return F.lit(0)
    parts = F.lit(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return F.when(is_heavy(F.col("draw"), repeated), F.pmod(F.xxhash64("row"), parts).cast("int")).otherwise(0)


def shared_out(dealt: DataFrame, per_part: DataFrame) -> DataFrame:
    """(s, z, b, p, each, over): the copies left over in each cell, shared out among its parts by their documents."""
    parts = per_part.join(dealt, F.expr("source <=> s and size = z and block = b"))
    upto = F.sum("docs").over(Window.partitionBy("s", "z", "b").orderBy("part"))
    # In whole numbers, as the shares must add up.
    share = lambda docs: F.expr(f"cast(over as decimal(38, 0)) * ({docs}) div n")
    return parts.withColumn("upto", upto).select(
        "s", "z", "b", F.col("part").alias("p"), "each", (share("upto") - share("upto - docs")).alias("over")
    )
