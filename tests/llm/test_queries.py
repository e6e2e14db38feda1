"""Queries against their SQL over whole tables, and against plain Python where SQL can't say it."""

from __future__ import annotations

import pytest

from tests.conftest import DATA, duck
from txnkpi.llm import queries


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    got = queries.queries()[name](spark, f"{DATA}/sf0.001")
    want = duck("sf0.001").execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert _rows(got.columns, got.collect()) == _rows(columns, want.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))
