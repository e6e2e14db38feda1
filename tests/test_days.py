"""Work day by day: the dated table, rows of earlier days, KPIs from kept cells, rejects."""

from __future__ import annotations

import datetime
import glob
import threading

import pytest
from pyspark.sql import functions as F
from test_skew import shuffled_rows

from txnkpi.operators import cleaning, kpis
from txnkpi.plans import by_day, daily, history, incremental
from txnkpi.plans.registry import REGISTRY
from txnkpi.sources import published
from txnkpi.sources.raw_csv import read_raw

SOLD = "trans_date date, category string, amount double, is_fraud int, merchant string, state string"
RAW = "Time double, Amount double, Class double, note string"


def rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


# --- the table by date


def _sold(spark, days, amount=1.0, each=3):
    data = [(d and datetime.date(2024, 1, d), "c", amount, i % 2, f"m{i}", None) for d in days for i in range(each)]
    return spark.createDataFrame(data, SOLD)


def test_a_load_replaces_its_days_only(spark, tmp_path):
    path = str(tmp_path / "transactions")
    by_day.write_days(_sold(spark, [1, 2, 3, None]), path)
    untouched = set(glob.glob(f"{path}/trans_date=2024-01-01/*.parquet"))
    by_day.write_days(_sold(spark, [2, 4], amount=5.0, each=1), path)
    found = by_day.read_days(spark, path)
    assert found.schema == by_day.SCHEMA
    counts = {(r.trans_date and r.trans_date.day): (r.n, r.s) for r in found.groupBy("trans_date").agg(F.count("*").alias("n"), F.sum("amount").alias("s")).collect()}
    assert counts == {1: (3, 3.0), 2: (1, 5.0), 3: (3, 3.0), 4: (1, 5.0), None: (3, 3.0)}
    assert set(glob.glob(f"{path}/trans_date=2024-01-01/*.parquet")) == untouched


def test_a_day_of_kpis_reads_one_partition(spark, tmp_path):
    path = str(tmp_path / "transactions")
    by_day.write_days(_sold(spark, range(1, 20)), path)
    day = by_day.read_days(spark, path).filter(F.col("trans_date") == datetime.date(2024, 1, 7))
    kpi = kpis.kpi_daily(day)
    assert [tuple(r) for r in kpi.collect()] == [(datetime.date(2024, 1, 7), 3, 3.0, 1, 1 / 3)]
    scan = kpi._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trans_date" in scan
    day.collect()
    assert partitions_read(day) == [1]


def partitions_read(df):
    """Partitions that each file scan of an executed plan has read."""
    found, pending = [], [df._jdf.queryExecution().executedPlan()]
    while pending:
        node = pending.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            found.append(node.metrics().apply("numPartitions").value())
        pending.extend(node.children().apply(i) for i in range(node.children().size()))
    return found


# --- rows of earlier days

NAN = float("nan")
FIRST = [(1.0, 5.0, 0.0, "a"), (NAN, None, 1.0, None), (0.0, 7.0, 0.0, "b"), (2.0, 9.0, 0.0, "c")]


def _raw(spark, data):
    return spark.createDataFrame(data, RAW)


def test_rows_of_earlier_days_go(spark, tmp_path):
    path = str(tmp_path / "history")
    first = history.fresh_rows(_raw(spark, FIRST + FIRST[:2]), path, "2024-01-01", 4)
    assert rows(first) == rows(_raw(spark, FIRST))
    history.remember(first, path, "2024-01-01", 4)
    second = [*FIRST, (-0.0, 7.0, 0.0, "b"), (1.0, 5.0, 0.0, "A"), (1.0, 5.0, 0.0, "A"), (None, None, 1.0, None)]
    fresh = history.fresh_rows(_raw(spark, second), path, "2024-01-02", 4)
    assert rows(fresh) == rows(_raw(spark, [(1.0, 5.0, 0.0, "A"), (None, None, 1.0, None)]))
    history.remember(fresh, path, "2024-01-02", 4)
    # A day that runs again does not meet its own rows, and later days do not count.
    again = history.fresh_rows(_raw(spark, second), path, "2024-01-02", 4)
    assert rows(again) == rows(fresh)
    assert rows(history.fresh_rows(_raw(spark, FIRST), path, "2024-01-01", 4)) == rows(_raw(spark, FIRST))
    # A rerun that brings less gives free what it had kept before.
    history.remember(_raw(spark, [(1.0, 5.0, 0.0, "A")]), path, "2024-01-02", 4)
    third = history.fresh_rows(_raw(spark, second), path, "2024-01-03", 4)
    assert rows(third) == rows(_raw(spark, [(None, None, 1.0, None)]))


def test_equal_fingerprints_drop_nothing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(history, "_prints", lambda names: [F.lit(1).cast("bigint").alias(p) for p in history.PRINT])
    path = str(tmp_path / "history")
    history.remember(_raw(spark, FIRST[:3]), path, "1", 4)
    assert rows(history.fresh_rows(_raw(spark, FIRST * 2), path, "2", 4)) == rows(_raw(spark, FIRST[3:]))


def test_wide_rows_move_once_and_known_ones_not_at_all(spark, tmp_path):
    path = str(tmp_path / "history")
    ids = spark.range(0, 20_000, 1, 4)
    raw = ids.select(*(F.col("id").cast("double").alias(c) for c in ("Time", "Amount", "Class")))
    history.remember(raw.filter("Time < 18000"), path, "1", 4)
    fresh = history.fresh_rows(raw, path, "2", 4)
    moved = shuffled_rows(fresh)
    assert fresh.count() == 2000
    assert sum(moved) < 4 * 2000 + 18_000 + 2000  # fingerprints that hit, and the new rows


def test_the_history_stays_where_it_is(spark, tmp_path):
    """Fingerprints of the day go to the buckets; those of the history are not shuffled."""
    path = str(tmp_path / "history")
    history.remember(_raw(spark, FIRST), path, "1", 8)
    table = spark.table(history._prints_table(spark, path, 8))
    day = spark.range(100).select(F.col("id").alias(history.PRINT[0]), F.col("id").alias(history.PRINT[1]))
    hits = day.join(table.hint("merge"), history.PRINT, "left_semi")
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1


# --- KPIs from kept cells


def test_days_in_any_order_equal_the_whole(spark, tmp_path):
    root = str(tmp_path / "by_day")
    data = [(float(i * 977), 0.1 * i + 0.01, i % 3 == 0) for i in range(1, 600)]
    transactions = cleaning.derive(spark.createDataFrame(data, "trans_time double, amount double, is_fraud boolean").withColumn("is_fraud", F.col("is_fraud").cast("int")))
    day = F.floor(F.col("trans_time") / 86400)
    incremental.add_day(transactions.filter(day == 9), root, "2")
    for n in (3, 2, 1, 0, 4, 5, 6):
        incremental.add_day(transactions.filter(day == n), root, str(n))
    version = published.snapshot(spark, root).version
    incremental.add_day(transactions.filter(day == 0).limit(0), root, "9")
    whole = transactions.filter(day <= 6)
    for name, df in incremental.kpi_tables(spark, root).items():
        assert rows(df) == rows(REGISTRY[name].build(whole)), name
    incremental.add_day(transactions.filter(day == 5), root, "2")
    assert rows(kpis.suite_of_cells(incremental.cells(spark, root, version))) == rows(kpis.kpi_suite(whole))


def test_days_added_at_the_same_time_are_all_there(spark, tmp_path):
    root = str(tmp_path / "by_day")
    one = spark.createDataFrame([(0.0, 5.0, 1, 0, "micro")], "trans_time double, amount double, is_fraud int, trans_hour int, amount_category string")
    threads = [threading.Thread(target=incremental.add_day, args=(one, root, str(n))) for n in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert published.snapshot(spark, root).version == 4
    assert incremental.kpi_tables(spark, root)["kpi_global"].first().nb_transactions == 4


# --- refused rows

LINES = "Time,Amount,Class,note\n0,5,0,a\n0,5,0,a\n1,abc,0,b\n,5,1,c\n,5,1,c\n2,5,0.5,\"d, e\"\nInf,5,0,f\n3,-1,0,g\n4,5,1,h\n"


def test_every_refused_row_is_kept_with_its_reason(spark, tmp_path):
    for name in ("one", "two"):
        (tmp_path / "raw").mkdir(exist_ok=True)
        (tmp_path / "raw" / f"{name}.csv").write_text(LINES)
    output = str(tmp_path / "output")
    counts = daily.ingest(spark, str(tmp_path / "raw"), output, RAW, rejects=True)
    clean, rejects = daily.read_ingested(spark, output)
    assert rows(clean) == rows(cleaning.clean(read_raw(spark, str(tmp_path / "raw"), RAW)))
    found = {(r.reason, r.file.rsplit("/", 1)[1], r.text): r.rows for r in rejects.collect()}
    texts = {"missing": [("1,abc,0,b", 1), (",5.0,1.0,c", 2)], "odd_class": [('2.0,5.0,0.5,"d, e"', 1)], "endless_time": [("Infinity,5.0,0.0,f", 1)], "nonpositive": [("3.0,-1.0,0.0,g", 1)]}
    for name in ("one.csv", "two.csv"):
        for reason, wanted in texts.items():
            for text, n in wanted:
                assert found.pop((reason, name, text)) == n
    assert not found
    assert counts["raw_rows"] == 18 == counts["clean_rows"] + counts["duplicate_rows"] + rejects.agg(F.sum("rows")).first()[0]


def test_columns_that_clash_are_refused(spark, tmp_path):
    raw = _raw(spark, FIRST).withColumnRenamed("note", "reason")
    with pytest.raises(ValueError, match="reason"):
        daily.write_clean_and_rejects(raw, str(tmp_path))


# --- settings


def test_lazy_frames_leave_the_session_as_it_is(spark, tmp_path):
    from txnkpi.operators import sizing

    path = str(tmp_path / "raw")
    _raw(spark, FIRST).write.csv(path, header=True)
    raw, before = read_raw(spark, path, RAW), spark.conf.get(sizing.SHUFFLE)
    huge = 10 * sizing.REDUCER_BYTES * int(before)
    cleaning.clean(raw).collect()
    cleaning.ingest_report(raw).collect()
    assert spark.conf.get(sizing.SHUFFLE) == before
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(sizing.paths, "text_bytes", lambda _: huge)
        with sizing.sized(raw):
            assert int(spark.conf.get(sizing.SHUFFLE)) == 10 * int(before)
    assert spark.conf.get(sizing.SHUFFLE) == before
