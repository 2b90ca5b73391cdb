"""Checks on loaded tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from tallyloom.functions import period_day
from tallyloom.operators.conform import SourceColumn, spark_type

# Rows that one task compares.
PART_ROWS = 100_000
# Rows of a cell, and cells at most: a task holds so many short rows of sums, and so many numbers are broadcast.
CELL_ROWS = 256
MOST_CELLS = 1 << 18


def violations(df: DataFrame, columns: Sequence[SourceColumn], key: str | None = None) -> DataFrame:
    """``(column_name, rule, violations)``: NULLs in required columns, too long texts, surplus key copies.

    All but the key check are counted in one pass. Copies are counted per key before they are compared,
    so a key with many rows costs one row per task.
    """
    rules: list[tuple[str, str, Column]] = []
    for c in columns:
        if not c.nullable:
            rules.append((c.name, "required", F.col(c.name).isNull()))
        if c.bound is not None:
            rules.append((c.name, f"max_length {c.bound}", F.length(c.name) > c.bound))
    found = None
    if rules:
        counts = df.agg(*[F.count_if(broken).alias(f"rule_{n}") for n, (_, _, broken) in enumerate(rules)])
        names = [(F.lit(name).alias("column_name"), F.lit(rule).alias("rule")) for name, rule, _ in rules]
        rows = [F.struct(*named, F.col(f"rule_{n}").alias("violations")) for n, named in enumerate(names)]
        found = counts.select(F.inline(F.array(*rows)))
    if key is not None:
        copies = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        surplus = copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"))
        unique = surplus.select(F.lit(key).alias("column_name"), F.lit("unique").alias("rule"), "violations")
        found = unique if found is None else found.unionByName(unique)
    if found is None:
        return df.sparkSession.createDataFrame([], "column_name string, rule string, violations bigint")
    return found


def enforce(df: DataFrame, columns: Sequence[SourceColumn]) -> DataFrame:
    """``df``, failing the job that reads it at the first NULL in a required column or too long text.

    Checked row by row while the data is written, without a pass of its own.
    """
    by_name = {c.name: c for c in columns}

    def checked(name: str) -> Column:
        value, column = F.col(name), by_name.get(name)
        if column is None:
            return value
        if column.bound is not None:
            too_long = F.raise_error(F.lit(f"column {name}: text longer than {column.bound}"))
            value = F.when(F.length(name) > column.bound, too_long).otherwise(value)
        if not column.nullable:
            missing = F.raise_error(F.lit(f"column {name}: NULL in a required column"))
            value = F.when(F.col(name).isNull(), missing).otherwise(value)
        return value.cast(spark_type(df.sparkSession, column)).alias(name)

    return df.select(*[checked(name) for name in df.columns])


def completeness(source: DataFrame, target: DataFrame, field: str, unit: str = "day") -> DataFrame:
    """Rows per period in both tables and whether they agree; a period missing in one counts 0."""

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(period_day(F.col(field), unit).alias("period")).agg(F.count(F.lit(1)).alias(name))

    # Tagged and added up rather than joined, so rows without a date are compared as well.
    both = counted(source, "source_rows").unionByName(counted(target, "target_rows"), allowMissingColumns=True)
    totals = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in ("source_rows", "target_rows")]
    return both.groupBy("period").agg(*totals).withColumn("complete", F.col("source_rows") == F.col("target_rows"))


def row_hashes(columns: Sequence[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row."""
    # Which columns are null is hashed too, as hashes pass over nulls; texts and numbers are never mixed up, as types agree.
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    values = [F.col(c) for c in columns]
    return F.xxhash64(nulls, *values), F.xxhash64(F.lit(1), *reversed(values), nulls)


def content(df: DataFrame, columns: Sequence[str], field: str, unit: str, name: str) -> DataFrame:
    """Rows per period, and two sums of row hashes that don't depend on the order of rows but on how often each stands there."""
    one, two = row_hashes(columns)
    # As decimals, sums of 64-bit hashes can't overflow.
    total = lambda h: F.sum(h.cast("decimal(20,0)"))
    return df.groupBy(period_day(F.col(field), unit).alias("period")).agg(
        F.count(F.lit(1)).alias(f"{name}_rows"), total(one).alias(f"{name}_one"), total(two).alias(f"{name}_two")
    )


def same_content(
    source: DataFrame, target: DataFrame, field: str, unit: str = "day", columns: Sequence[str] | None = None
) -> DataFrame:
    """``completeness`` that also compares the rows themselves: ``same`` is whether both tables hold the same rows, equally often.

    Rows are compared in ``columns``, by default all that the source has. Each table is read once, and one
    short row per period and task is shuffled. Columns must have the same types in both.
    """
    names = sorted(columns or source.columns)
    kinds = lambda df: {f.name: f.dataType.simpleString() for f in df.schema if f.name in names}
    if kinds(source) != kinds(target) or len(kinds(source)) < len(names):
        odd = sorted(set(kinds(source).items()) ^ set(kinds(target).items()))
        raise ValueError(f"the tables can't be compared, they differ in {odd or names}")
    both = content(source, names, field, unit, "source").unionByName(
        content(target, names, field, unit, "target"), allowMissingColumns=True
    )
    rows = [F.coalesce(F.sum(f"{side}_rows"), F.lit(0)).alias(f"{side}_rows") for side in ("source", "target")]
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("source_one", "target_one", "source_two", "target_two")]
    found = both.groupBy("period").agg(*rows, *sums)
    complete = F.col("source_rows") == F.col("target_rows")
    same = complete & (F.col("source_one") == F.col("target_one")) & (F.col("source_two") == F.col("target_two"))
    return found.select("period", "source_rows", "target_rows", complete.alias("complete"), same.alias("same"))


def _differing_cells(both: DataFrame, columns: Sequence[str], rows: int) -> tuple[DataFrame, int, int]:
    """The rows whose cell, by their hash, is not the same in both tables; how many they are, and those of the largest cell."""
    one, two = row_hashes(columns)
    celled = both.withColumn("_cell", F.pmod(one, F.lit(min(rows // CELL_ROWS + 1, MOST_CELLS))))
    of_source = F.col("in_source") > 0

    def apart(h: Column) -> Column:
        h = h.cast("decimal(20,0)")
        return F.sum(F.when(of_source, h).otherwise(-h))

    sums = celled.groupBy("_cell").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum(F.col("in_source") - F.col("in_target")).alias("_surplus"),
        apart(one).alias("_one"),
        apart(two).alias("_two"),
    )
    found = sums.where("_surplus <> 0 or _one <> 0 or _two <> 0").select("_cell", "_rows").toArrow()
    cells = both.sparkSession.createDataFrame(found.select(["_cell"]))
    chosen = celled.join(F.broadcast(cells), "_cell", "left_semi").drop("_cell")
    return chosen, pc.sum(found["_rows"]).as_py() or 0, pc.max(found["_rows"]).as_py() or 0


def differences(
    source: DataFrame, target: DataFrame, field: str, unit: str = "day", columns: Sequence[str] | None = None
) -> DataFrame:
    """The rows that one table holds more often than the other, with how often each does; only periods that differ are compared row by row.

    In those, rows are first summed in cells as in ``same_content``, and only those of cells that differ are
    dealt out, to parts of ``PART_ROWS`` rows whatever the number of shuffle partitions. Both steps run at once,
    as the parts are counted by them; the driver gets the periods and the numbers of the cells.
    """
    names = sorted(columns or source.columns)
    sides = ["in_source", "in_target"]
    differing = same_content(source, target, field, unit, names).where("not same")
    found = differing.select(F.col("period").alias("_differing"), (F.col("source_rows") + F.col("target_rows")).alias("n")).toArrow()
    periods = source.sparkSession.createDataFrame(found.select(["_differing"]))
    rows = most = pc.sum(found["n"]).as_py() or 0

    def marked(df: DataFrame, side: str) -> DataFrame:
        marks = [F.lit(int(s == side)).cast("long").alias(s) for s in sides]
        return df.select(*names, *marks, period_day(F.col(field), unit).alias("_period"))

    both = marked(source, sides[0]).unionByName(marked(target, sides[1]))
    both = both.join(F.broadcast(periods), F.col("_period").eqNullSafe(F.col("_differing")), "left_semi").drop("_period")
    # Hashes of nested values pass over nulls in them, so these are all compared themselves.
    if all(isinstance(source.schema[c].dataType, AtomicType) for c in names):
        both, rows, most = _differing_cells(both, names, rows)

    parts = rows // PART_ROWS + 1
    totals = [F.sum(c).alias(c) for c in sides]
    if most > PART_ROWS:
        # Copies of a row that may be that frequent are first counted apart, by the task that read them.
        read = both.withColumn("_reader", F.spark_partition_id()).repartition(parts, *names, "_reader")
        both = read.groupBy(*names, "_reader").agg(*totals)
    return both.repartition(parts, *names).groupBy(*names).agg(*totals).where("in_source <> in_target")
