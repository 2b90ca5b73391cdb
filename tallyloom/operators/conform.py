"""Source columns, their types, and bringing a table into the loaded form."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions import clean_newlines, next_pow2

# Source type -> loaded type.
TYPE_MAP = {
    "character varying": "string",
    "uuid": "string",
    "text": "string",
    "jsonb": "string",
    "json": "string",
    "array": "string",
    "user-defined": "string",
    "timestamp without time zone": "timestamp_ntz",
    "time without time zone": "time",
    "date": "date",
    "bigint": "bigint",
    "smallint": "bigint",
    "integer": "bigint",
    "boolean": "boolean",
    "real": "double",
    "double precision": "double",
    "numeric": "double",
}
# Types whose text length is measured, types whose newlines are cleaned.
MEASURED_TYPES = ("character varying", "jsonb", "json", "array", "text")
CLEANED_TYPES = ("character varying", "text")
LAUNCH_ID = "launch_id"
LAUNCH_ID_SIZE = 64


@dataclass(frozen=True)
class SourceColumn:
    name: str
    data_type: str
    nullable: bool = True
    max_size: int | None = None

    @property
    def bound(self) -> int | None:
        """Longest text the loaded column takes: ``max_size`` rounded up to a power of two."""
        if self.max_size is None or loaded_type(self) != "string":
            return None
        return 1 << max(0, self.max_size - 1).bit_length()


LAUNCH_COLUMN = SourceColumn(LAUNCH_ID, "character varying", False, LAUNCH_ID_SIZE)


def loaded_type(column: SourceColumn) -> str:
    try:
        return TYPE_MAP[column.data_type.lower()]
    except KeyError:
        raise ValueError(f"column {column.name!r} has the unsupported type {column.data_type!r}") from None


def spark_type(spark: SparkSession, column: SourceColumn) -> str:
    """Spark type of the loaded column; times of day are ``HH:mm:ss`` text unless Spark's time type is on."""
    name = loaded_type(column)
    if name == "time" and spark.conf.get("spark.sql.timeType.enabled", "false").lower() != "true":
        return "string"
    return name


def _source_type(field: T.StructField) -> str:
    by_type = {
        T.StringType: "text",
        T.VarcharType: "character varying",
        T.CharType: "character varying",
        T.LongType: "bigint",
        T.IntegerType: "integer",
        T.ShortType: "smallint",
        T.DoubleType: "double precision",
        T.FloatType: "real",
        T.DecimalType: "numeric",
        T.BooleanType: "boolean",
        T.DateType: "date",
        T.TimestampNTZType: "timestamp without time zone",
        T.TimestampType: "timestamp with time zone",
        T.ArrayType: "array",
        T.StructType: "user-defined",
    }
    return by_type.get(type(field.dataType), field.dataType.typeName())


def source_columns(df: DataFrame) -> list[SourceColumn]:
    """Columns of a Spark table, sorted by name."""
    return sorted((SourceColumn(f.name, _source_type(f), f.nullable) for f in df.schema), key=lambda c: c.name)


def catalogue_columns(catalogue: DataFrame, schema: str, table: str, catalog: str | None = None) -> list[SourceColumn]:
    """Columns of one table from ``information_schema.columns`` rows, sorted by name.

    Filtered before it is fetched, so what reaches the driver is one row per column.
    """
    wanted = (F.col("table_schema") == schema) & (F.col("table_name") == table)
    if catalog is not None:
        wanted &= F.col("table_catalog") == catalog
    rows = catalogue.where(wanted).select("column_name", "is_nullable", "data_type").collect()
    found = [SourceColumn(r["column_name"], r["data_type"].lower(), r["is_nullable"] == "YES") for r in rows]
    return sorted(found, key=lambda c: c.name)


def _measured(columns: Iterable[SourceColumn]) -> list[SourceColumn]:
    return [c for c in columns if c.data_type.lower() in MEASURED_TYPES]


def as_text(df: DataFrame, name: str) -> Column:
    """Text of a column; arrays and structs become JSON."""
    nested = isinstance(df.schema[name].dataType, (T.ArrayType, T.StructType, T.MapType))
    return F.to_json(name) if nested else F.col(name).cast("string")


def as_time(df: DataFrame, name: str) -> Column:
    """``HH:mm:ss`` of a time of day, which a database may hand over as a timestamp."""
    text = F.col(name).cast("string")
    is_timestamp = isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType))
    return F.substring(text, len("yyyy-mm-dd ") + 1, len("HH:mm:ss")) if is_timestamp else text


def string_profile(df: DataFrame, columns: Sequence[SourceColumn] | None = None) -> DataFrame:
    """``(column_name, max_size)`` for every text column, all measured in one pass."""
    measured = _measured(columns or source_columns(df))
    if not measured:
        return df.sparkSession.createDataFrame([], "column_name string, max_size bigint")
    sizes = df.agg(*[F.max(F.length(as_text(df, c.name))).cast("long").alias(c.name) for c in measured])
    rows = F.array(*[F.struct(F.lit(c.name).alias("column_name"), F.col(c.name).alias("max_size")) for c in measured])
    return sizes.select(F.explode(rows).alias("r")).select("r.column_name", "r.max_size")


def string_bounds(profile: DataFrame) -> DataFrame:
    """The profile with the text bound of each column (NULL for a column of NULLs)."""
    return profile.withColumn("max_length", next_pow2(F.col("max_size")))


def measure(df: DataFrame, columns: Sequence[SourceColumn]) -> list[SourceColumn]:
    """``columns`` with the text lengths found in ``df`` filled in: one row is fetched."""
    sizes = {r["column_name"]: r["max_size"] for r in string_profile(df, columns).collect()}
    return [replace(c, max_size=sizes.get(c.name, c.max_size)) for c in columns]


def conform(df: DataFrame, columns: Sequence[SourceColumn] | None = None, clean: bool = False) -> DataFrame:
    """Columns in name order, cast by ``TYPE_MAP``; with ``clean``, newlines in plain text replaced."""
    selected = []
    for column in sorted(columns or source_columns(df), key=lambda c: c.name):
        target = spark_type(df.sparkSession, column)
        if loaded_type(column) == "time":
            value = as_time(df, column.name).cast(target)
        else:
            value = as_text(df, column.name) if target == "string" else F.col(column.name).cast(target)
        if clean and column.data_type.lower() in CLEANED_TYPES:
            value = clean_newlines(value)
        selected.append(value.alias(column.name))
    return df.select(*selected)


def clean_text(df: DataFrame, columns: Sequence[SourceColumn] | None = None) -> DataFrame:
    """All columns in their order, newlines cleaned in those of a plain text type."""
    cleaned = {c.name for c in (columns or source_columns(df)) if c.data_type.lower() in CLEANED_TYPES}
    return df.select(*[clean_newlines(F.col(n)).alias(n) if n in cleaned else F.col(n) for n in df.columns])
