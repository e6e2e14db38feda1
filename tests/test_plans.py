"""Physical plans: scans, shuffles, push-down and absence of Python workers."""

from __future__ import annotations

import re

import pytest
from conftest import DATA

from pyspark.sql import Observation

from txnkpi.operators import cleaning, kpis, quality, sizing
from txnkpi.operators.publishing import upsert
from txnkpi.plans import bindings, queries
from txnkpi.sources import paths
from txnkpi.sources.raw_csv import read_raw


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(pattern, text):
    return len(re.findall(pattern, text))


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "raw")
    bindings.events_wide(spark, f"{DATA}/sf0.001").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def transactions(spark, raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "clean")
    cleaning.clean(raw).write.parquet(path)
    return spark.read.parquet(path)


def test_clean_is_one_scan_one_shuffle_with_filters_pushed(raw):
    text = plan(cleaning.clean(raw))
    assert count("FileScan", text) == 1
    assert count("Exchange hashpartitioning", text) == 1
    assert count("Exchange", text) == 1
    assert "SortAggregate" not in text
    pushed = re.search(r"PushedFilters: \[([^\]]*)", text).group(1)
    for wanted in ("IsNotNull(Time)", "IsNotNull(Amount)", "GreaterThan(Amount,0.0)"):
        assert wanted in pushed
    # Copies are collapsed before the shuffle, filters run before that.
    assert text.index("Exchange") < text.rindex("HashAggregate") < text.index("Filter")


def test_clean_csv_pushes_filters(spark, edge_csv):
    schema = "Time double, V1 double, Amount double, Class double"
    text = plan(cleaning.clean(read_raw(spark, edge_csv, schema)))
    assert "GreaterThan(Amount,0.0)" in text and "IsNotNull(Class)" in text


def test_counted_ingest_keeps_the_single_shuffle(raw):
    seen = Observation()
    counted = cleaning.count_copies(raw).observe(seen, *cleaning.report_columns())
    text = plan(cleaning.clean_counted(counted))
    assert count("Exchange", text) == 1 and "SortAggregate" not in text


@pytest.mark.parametrize("name", ["clean_transactions", "kpi_suite", "ingest_report"])
def test_reducers_of_a_query_follow_its_input(spark, monkeypatch, name):
    """Inside ``sized``; outside of it the session is as it was."""
    folder = f"{DATA}/sf0.01"
    before = spark.conf.get(sizing.SHUFFLE)
    raw = spark.read.parquet(f"{folder}/events.parquet")
    monkeypatch.setattr(sizing, "REDUCER_BYTES", paths.scanned_bytes(raw) // 100)
    with sizing.sized(raw):
        text = plan(queries.queries()[name](spark, folder))
    reducers = [int(n) for n in re.findall(r"hashpartitioning\(.*, (\d+)\)", text)]
    assert max(reducers) > 20 and int(before) < 20
    queries.queries()[name](spark, folder).collect()
    assert spark.conf.get(sizing.SHUFFLE) == before


def test_suite_reads_once_and_expands_only_cells(transactions):
    text = plan(kpis.kpi_suite(transactions))
    assert count("FileScan", text) == 1
    # The expansion sits above the aggregate that makes the cells.
    assert text.index("Expand") < text.index("partial_count(trans_time")


def test_by_hour_reads_four_columns(transactions):
    text = plan(kpis.kpi_by_hour(transactions))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {
        "trans_time",
        "amount",
        "is_fraud",
        "trans_hour",
    }


def test_top_fraud_is_a_top_n_with_pushed_class(transactions):
    text = plan(kpis.kpi_top_fraud_amounts(transactions))
    assert "TakeOrderedAndProject(limit=20" in text
    assert "EqualTo(is_fraud,1)" in text
    assert "user_id" not in text


def test_gate_clean_is_one_scan(transactions):
    assert count("FileScan", plan(quality.gate_clean(transactions))) == 1


def test_upsert_is_an_anti_join_without_a_cross_join(transactions):
    table = kpis.kpi_by_category(transactions.withColumnRenamed("event_type", "category"))
    text = plan(upsert(table, table, "category"))
    assert "LeftAnti" in text
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_no_python_workers(raw, transactions):
    frames = [
        cleaning.clean(raw),
        cleaning.ingest_report(raw),
        kpis.kpi_suite(transactions),
        kpis.kpi_top_fraud_amounts(transactions),
        quality.gate_clean(transactions),
    ]
    assert not any(re.search("Python|Pandas|Arrow", plan(df)) for df in frames)
