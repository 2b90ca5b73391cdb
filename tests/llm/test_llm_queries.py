"""Registered queries against their SQL, and what the driver relies on."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from tallyloom.llm.registry import ORACLE, QUERIES

ROOT = Path(__file__).parents[2]


def test_every_operator_is_registered_once():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_against_sql(spark, duck, sample_dir, name):
    found = QUERIES[name](spark, sample_dir)
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(found.columns)
    by_name = sorted(range(len(columns)), key=lambda i: columns[i])
    expected = sorted(repr([row[i] for i in by_name]) for row in cursor.fetchall())
    assert sorted(repr([r[c] for c in sorted(columns)]) for r in found.collect()) == expected


def test_the_registry_imports_without_a_session():
    code = "import __spark_entry__ as e; assert 'pipeline' in e.queries()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=100)
