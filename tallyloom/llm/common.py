"""Small helpers that several operators share."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tallyloom.session import fresh_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_name(wish: str, taken: Iterable[str]) -> str:
    """``wish``, or that with underscores in front where a column of any case already has the name."""
    used = {c.lower() for c in taken}
    while wish.lower() in used:
        wish = f"_{wish}"
    return wish


def keep(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back, which cuts the lineage.

    A lost executor then costs a read of files that all others reach, and rows that were numbered
    or drawn once stay as they are.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def one_thread() -> None:
    """Spark already runs one Python worker per core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ.setdefault("OMP_NUM_THREADS", "1")
    os.environ.setdefault("OPENBLAS_NUM_THREADS", "1")


def crc32_of_id(doc_id: int | None) -> int | None:
    return None if doc_id is None else zlib.crc32(str(doc_id).encode())
