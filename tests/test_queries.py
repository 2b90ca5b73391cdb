"""Every registered query against the same question in SQL."""

import math
import subprocess
import sys
from pathlib import Path

import pytest

from checks.oracle import ORACLE
from checks.queries import QUERIES


def plain(value):
    """Comparable form of a value."""
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return None if value is None else str(value)


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    found = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(found, key=lambda row: tuple((v is None, v or "") for v in row))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def check(spark, duck, sample_dir, name):
    result = QUERIES[name](spark, sample_dir)
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(result.columns) == sorted(columns)
    expected = rows_by_name(columns, cursor.fetchall())
    found = rows_by_name(result.columns, [tuple(r) for r in result.collect()])
    assert len(found) == len(expected)
    assert found == expected
    assert found


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sample_dir, name):
    check(spark, duck, sample_dir, name)


@pytest.mark.parametrize("name", ["calendar", "load_periods", "mv_shifts_agg", "status_days", "extract_period_updated"])
def test_query_in_another_time_zone(spark, duck, sample_dir, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        check(spark, duck, sample_dir, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("missing", ["corpus_pipeline", "tallyloom.llm", "public_tokenizers", "xxhash"])
def test_the_entry_works_without_the_training_data_operators(missing):
    """Also where only a package that they need is not there."""
    block = (
        "import sys, warnings; warnings.simplefilter('ignore'); "
        f"sys.modules[{missing!r}] = None; "
        "import __spark_entry__ as e; from checks.queries import QUERIES; "
        "assert set(QUERIES) <= set(e.queries()) and set(QUERIES) <= set(e.oracle_sql())"
    )
    subprocess.run([sys.executable, "-c", block], cwd=Path(__file__).parents[1], check=True, timeout=100)
