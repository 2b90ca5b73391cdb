"""The corpus pipeline: documents in, a mixed training corpus out.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet to the shared folder and read
again as the next stage's documents. Stages keep all columns of the documents; the last adds what the mix takes.
Each works on whatever its predecessor kept, and its decisions take effect. ``run`` gives the last stage's table, one row per
document; ``corpus`` gives the corpus itself, in which every document stands as often as the mix takes it.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyloom.llm import decontaminate, mixing, simhash, substrings, toxicity  # noqa: E402
from tallyloom.llm.common import keep, new_name, read_table  # noqa: E402
from tallyloom.llm.registry import CATEGORIES  # noqa: E402


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not take for toxic; those without text stay."""
    chain = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), CATEGORIES)
    mark = new_name("_toxic", docs.columns)
    return docs.withColumn(mark, toxicity.is_category(docs, chain, "toxic")).where(~F.col(mark)).drop(mark)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that of the smallest id."""
    return simhash.keep_one(docs)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 20 words or more that stand earlier in the corpus."""
    return substrings.dedup(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with the size, target and copies of the mix; documents of which it takes none stay, with 0 copies."""
    return mixing.with_copies(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("substring_dedup", remove_repeated_passages),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

#: Trained models, fingerprints and Newton steps are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs


def repeated(mixed: DataFrame) -> DataFrame:
    """Each row of the mix as often as its ``copies`` say, not at all for 0; all columns as they are."""
    at = new_name("_copy", mixed.columns)
    return mixed.withColumn(at, F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).drop(at)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows to train on."""
    return repeated(run(spark, sf_dir))
