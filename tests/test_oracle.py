"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

import pytest
from conftest import DATA, duck

import __spark_entry__ as driver
from txnkpi.plans import oracles, queries

SCALES = os.environ.get("TEST_SCALES", "sf0.001 sf0.01").split()
QUERIES, SQL = queries.queries(), oracles.oracle_sql()

# DuckDB type of each Spark type a result may have.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def _spark_rows(df):
    columns = sorted(df.columns)
    rows = [tuple(row[c] for c in columns) for row in df.collect()]
    types = {name: TYPES[kind] for name, kind in df.dtypes}
    return [(c, types[c]) for c in columns], sorted(rows, key=repr)


def _duck_rows(scale, sql):
    result = duck(scale).execute(sql)
    names = {column[0]: (i, str(column[1])) for i, column in enumerate(result.description)}
    columns = sorted(names)
    rows = [tuple(row[names[c][0]] for c in columns) for row in result.fetchall()]
    return [(c, names[c][1]) for c in columns], sorted(rows, key=repr)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("scale", SCALES)
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name, scale):
    schema, rows = _spark_rows(QUERIES[name](spark, f"{DATA}/{scale}"))
    expected_schema, expected = _duck_rows(scale, SQL[name])
    assert rows == expected
    assert schema == expected_schema


def test_entry(spark):
    assert driver.entry(spark).count() == 1 + 24 + 2 + 2


def test_entry_file_without_the_text_operators(tmp_path):
    home = os.path.dirname(os.path.abspath(driver.__file__))
    shutil.copy(driver.__file__, tmp_path)
    shutil.copytree(
        f"{home}/txnkpi", tmp_path / "txnkpi", ignore=shutil.ignore_patterns("llm")
    )
    code = "import __spark_entry__ as e; print(*e.queries()); assert e.oracle_sql()"
    done = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True
    )
    assert set(done.stdout.split()) == set(QUERIES)


def test_entry_file_adds_to_these_queries():
    assert set(QUERIES) <= set(driver.queries())
    assert set(SQL) <= set(driver.oracle_sql()) <= set(driver.queries())
