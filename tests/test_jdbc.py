"""SQL of the JDBC sink, run in DuckDB, and its transaction on a stand-in connection."""

from __future__ import annotations

import duckdb
import pytest

from txnkpi.plans.registry import DECLARED_ONLY, REGISTRY
from txnkpi.sources import jdbc

HOUR = REGISTRY["kpi_by_hour"]
COLUMNS = HOUR.schema.names


def test_every_table_can_be_created():
    connection = duckdb.connect()
    for kpi in REGISTRY.values():
        connection.execute(jdbc.create_table_sql(kpi.name, kpi.schema, kpi.key))
        connection.execute(jdbc.create_table_sql(kpi.name, kpi.schema, kpi.key))
    for name, schema in DECLARED_ONLY.items():
        connection.execute(jdbc.create_table_sql(name, schema))


def _tables(connection):
    connection.execute(jdbc.create_table_sql("t", HOUR.schema, HOUR.key))
    connection.execute(jdbc.create_table_sql("s", HOUR.schema))
    connection.execute("insert into t values (1, 10, 1, 1, 0, 0), (2, 20, 2, 2, 0, 0)")
    connection.execute("insert into s values (2, 99, 9, 9, 1, 5), (3, 30, 3, 3, 0, 0)")


def test_upsert_keeps_replaces_and_adds():
    connection = duckdb.connect()
    _tables(connection)
    for _ in range(2):
        for text in jdbc.upsert_sql("t", "s", COLUMNS, HOUR.key):
            connection.execute(text)
    query = "select trans_hour, nb_transactions from t order by 1"
    found = connection.execute(query).fetchall()
    assert found == [(1, 10), (2, 99), (3, 30)]


def test_refresh_replaces_everything():
    connection = duckdb.connect()
    _tables(connection)
    for text in jdbc.refresh_sql("t", "s", COLUMNS):
        connection.execute(text)
    assert connection.execute("select trans_hour from t order by 1").fetchall() == [(2,), (3,)]


class StandIn:
    """Records what a JDBC connection is asked to do."""

    def __init__(self, fail_at=None):
        self.calls, self.fail_at = [], fail_at

    def setAutoCommit(self, on):
        self.calls.append(("auto", on))

    def createStatement(self):
        return self

    def execute(self, text):
        if text == self.fail_at:
            raise RuntimeError("refused")
        self.calls.append(text)

    def commit(self):
        self.calls.append("commit")

    def rollback(self):
        self.calls.append("rollback")

    def close(self):
        pass


def test_transaction_commits_once():
    connection = StandIn()
    jdbc.run_transaction(connection, ["a", "b"])
    assert connection.calls == [("auto", False), "a", "b", "commit"]


def test_transaction_rolls_back():
    connection = StandIn(fail_at="b")
    with pytest.raises(RuntimeError):
        jdbc.run_transaction(connection, ["a", "b"])
    assert connection.calls == [("auto", False), "a", "rollback"]


def test_empty_batch_touches_nothing(spark):
    empty = spark.createDataFrame([], HOUR.schema)
    assert jdbc.publish_jdbc(empty, "jdbc:none:", "t", {}, HOUR.key) is False


def test_each_load_has_a_staging_table_of_its_own(spark, monkeypatch):
    staged, done = [], []
    monkeypatch.setattr(jdbc, "stage", lambda *args: staged.append(args[3]))
    monkeypatch.setattr(jdbc, "_connect", lambda *args: None)
    monkeypatch.setattr(jdbc, "run_transaction", lambda _, texts: done.append(texts))
    batch = spark.createDataFrame([], REGISTRY["kpi_global"].schema)
    for _ in range(2):
        assert jdbc.publish_jdbc(batch, "jdbc:none:", "t", {}, on_empty="clear")
    assert len(set(staged)) == 2 and all(name.startswith("t_staging_") for name in staged)
    assert all(staged[i] in done[2 * i][-1] for i in (0, 1))
    assert [done[1], done[3]] == [[f"DROP TABLE IF EXISTS {name}"] for name in staged]


def test_a_staging_table_goes_when_the_load_fails(spark, monkeypatch):
    staged, done = [], []

    def fail(*args):
        staged.append(args[3])
        raise RuntimeError("refused")

    monkeypatch.setattr(jdbc, "stage", fail)
    monkeypatch.setattr(jdbc, "_connect", lambda *args: None)
    monkeypatch.setattr(jdbc, "run_transaction", lambda _, texts: done.append(texts))
    batch = spark.createDataFrame([], REGISTRY["kpi_global"].schema)
    with pytest.raises(RuntimeError, match="refused"):
        jdbc.publish_jdbc(batch, "jdbc:none:", "t", {}, on_empty="clear")
    assert done == [[f"DROP TABLE IF EXISTS {staged[0]}"]]
