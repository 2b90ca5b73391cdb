"""Delimited text for exchange with other systems: ``;`` between fields, ``"`` around them, no header.

NULL is an empty field, an empty string an empty quoted one. Spark's reader takes both for NULL by default; told that
NULL is a character that no text holds, it keeps them apart.

Files whose texts hold line breaks are read by many tasks each, too. Every byte range of a file counts its quotes; their
sums over the ranges before tell whether a range begins inside a text. Lines that are rows by themselves are
parsed where they are read, and only the lines of broken ones are brought together, one short group per row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The text format.
TEXT_FORMAT = {"sep": ";", "quote": '"', "escape": '"', "header": "false"}
# Spaces around a text are part of it.
KEEP_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# A character that text in these files can't hold, so that only an unquoted empty field is NULL.
NO_TEXT = "\u0000"


def write_delimited(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.options(**TEXT_FORMAT, **KEEP_SPACES, emptyValue='""').mode(mode).csv(path)


def read_delimited(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = True) -> DataFrame:
    """Fields are taken by position. A row that does not fit the schema fails the job.

    ``multi_line`` is needed where a field may hold a line break. It reads the files three times; turn it off
    for text that has been cleaned. Empty lines outside of texts are passed over either way. Where the files
    are cut anew between two of its scans (another number of cores, say), or a file ends inside a text, the job fails.
    """
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    options = {**TEXT_FORMAT, **KEEP_SPACES, "mode": "FAILFAST", "nullValue": NO_TEXT}
    if not multi_line:
        return spark.read.schema(schema).options(**options, multiLine="false").csv(path)
    # Names by position, so that any name of a column will do.
    kinds = ", ".join(f"c{n} {f.dataType.simpleString()}" for n, f in enumerate(schema))
    parsed = F.from_csv("record", kinds, {**options, "multiLine": "true"})
    rows = records(spark, path).where("record != ''").select(parsed.alias("row"))
    return rows.select(*[F.col(f"row.c{n}").alias(f.name) for n, f in enumerate(schema)])


# A byte range of a file, and where a line stands in it.
RANGE = ["file", "begin", "length"]
RANGE_SCHEMA = "file string, begin long, length long"


class LineState:
    """What a range's lines so far amount to, carried from batch to batch.

    Whether a line begins inside a text is known only as against the begin of its range. So the latest lines
    of both kinds are kept: ``last[0]`` begins like the range itself, ``last[1]`` the other way; -1 is none.
    """

    def __init__(self, key: tuple) -> None:
        self.key, self.lines, self.turned, self.last = key, 0, 0, [-1, -1]

    def take(self, quotes: np.ndarray) -> dict[str, np.ndarray]:
        at = self.lines + np.arange(len(quotes))
        sums = self.turned + np.cumsum(quotes)
        turned = (sums - quotes) & 1
        last = [np.maximum.accumulate(np.where(turned == kind, at, self.last[kind])) for kind in (0, 1)]
        self.lines, self.turned, self.last = int(at[-1]) + 1, int(sums[-1]) & 1, [int(x[-1]) for x in last]
        return {"at": at, "turned": turned, "last0": last[0], "last1": last[1]}


def _stretches(rows: pd.DataFrame, state: LineState | None) -> Iterator[tuple[int, int, LineState]]:
    """Stretches of a batch that lie in one range, each with the range's state."""
    changed = (rows["file"] != rows["file"].shift()) | (rows["begin"] != rows["begin"].shift())
    edges = [*np.flatnonzero(changed.to_numpy()).tolist(), len(rows)]
    for a, b in zip(edges, edges[1:]):
        key = (rows["file"].iloc[a], int(rows["begin"].iloc[a]), int(rows["length"].iloc[a]))
        if state is None or state.key != key:
            state = LineState(key)
        yield a, b, state


def range_totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per range, from its lines in order."""
    state = None

    def total(of: LineState) -> pd.DataFrame:
        return pd.DataFrame([(*of.key, of.turned, *of.last)], columns=[*RANGE, "turned", "last0", "last1"])

    for rows in batches:
        quotes = rows["quotes"].to_numpy(np.int64)
        for a, b, found in _stretches(rows, state):
            if state is not None and found is not state:
                yield total(state)
            state = found
            state.take(quotes[a:b])
    if state is not None:
        yield total(state)


def placed_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The lines of each range with their places."""
    state = None
    for rows in batches:
        quotes, parts = rows["quotes"].to_numpy(np.int64), []
        for a, b, state in _stretches(rows, state):
            parts.append(pd.DataFrame(state.take(quotes[a:b])))
        if parts:
            yield pd.concat([rows.reset_index(drop=True), pd.concat(parts, ignore_index=True)], axis=1)


def records(spark: SparkSession, path: str) -> DataFrame:
    """The texts (``record``) of the rows of delimited files, line breaks inside of quotes included."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("begin"),
        F.col("_metadata.file_block_length").alias("length"),
        "value",
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).cast("long").alias("quotes"),
    )
    totals = lines.drop("value").mapInPandas(range_totals, f"{RANGE_SCHEMA}, turned long, last0 long, last1 long")
    ordered = Window.partitionBy("file").orderBy("begin")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    opened = totals.withColumns({
        "inside": F.coalesce(F.sum("turned").over(before), F.lit(0)) % 2,
        "all": F.sum("turned").over(Window.partitionBy("file")) % 2,
    })
    # The row that is still open where a range begins: the last one begun in a range before.
    own = F.when(F.col("inside") == 0, F.col("last0")).otherwise(F.col("last1"))
    begun = F.when(own >= 0, F.struct(F.col("begin").alias("owner"), own.alias("head")))
    ranges = opened.withColumn("open", F.last(begun, ignorenulls=True).over(before)).select(
        *RANGE, "open",
        F.when(F.col("all") == 0, F.col("inside")).otherwise(
            F.raise_error(F.concat(F.lit("quotes are not closed in "), "file")).cast("long")
        ).alias("inside"),
    )
    placed = lines.mapInPandas(
        placed_lines, f"{RANGE_SCHEMA}, value string, quotes long, at long, turned long, last0 long, last1 long"
    )
    known = placed.join(ranges, RANGE, "left").withColumn(
        "inside",
        F.coalesce("inside", F.raise_error(F.lit("the files were cut anew between two scans")).cast("long")),
    )
    # Last line up to this one that begins outside of texts.
    own = F.when(F.col("inside") == 0, F.col("last0")).otherwise(F.col("last1"))
    alone = (F.col("turned") == F.col("inside")) & (F.col("quotes") % 2 == 0)
    row = F.when(own >= 0, F.struct(F.col("begin").alias("owner"), own.alias("head"))).otherwise(F.col("open"))
    broken = (
        known.where(~alone)
        .groupBy("file", row.alias("row"))
        .agg(F.array_sort(F.collect_list(F.struct("begin", "at", "value"))).alias("lines"))
        .select(F.array_join(F.col("lines.value"), "\n").alias("record"))
    )
    return known.where(alone).select(F.col("value").alias("record")).unionByName(broken)
