"""Cleaning on hand-made rows: boundaries, copies, missing and unreadable values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from txnkpi.operators import cleaning, quality
from txnkpi.sources.raw_csv import infer_raw_schema, read_raw

RAW = "Time double, V1 double, Amount double, Class double"


@pytest.fixture(scope="module")
def clean_rows(spark, edge_csv):
    return cleaning.clean(read_raw(spark, edge_csv)).collect()


def test_clean_edge_rows(clean_rows):
    found = sorted(
        (r.trans_time, r.V1 or 0.0, r.amount, r.is_fraud, r.trans_hour, r.amount_category)
        for r in clean_rows
    )
    assert found == [
        (-7200.0, 0.3, 2.675, 0, -2, "micro"),
        (-1800.0, 0.3, 2.675, 1, 0, "micro"),
        (0.0, 1.5, 9.99, 0, 0, "micro"),
        (0.0, 1.6, 9.99, 0, 0, "micro"),
        (3599.9, 0.1, 10.0, 1, 0, "small"),
        (3600.0, 0.1, 99.99, 0, 1, "small"),
        (7200.0, 0.1, 100.0, 0, 2, "medium"),
        (86399.0, 0.1, 999.99, 0, 23, "medium"),
        (86400.0, 0.0, 1000.0, 1, 0, "large"),
        (172800.0, 0.0, 5000.0, 1, 0, "large"),
    ]


def test_clean_column_order_and_types(spark, edge_csv):
    assert cleaning.clean(read_raw(spark, edge_csv)).dtypes == [
        ("trans_time", "double"),
        ("V1", "double"),
        ("amount", "double"),
        ("is_fraud", "int"),
        ("trans_hour", "int"),
        ("amount_category", "string"),
    ]


def test_report_accounts_for_every_row(spark, edge_csv):
    report = cleaning.ingest_report(read_raw(spark, edge_csv)).first().asDict()
    assert report == {
        "raw_rows": 19,
        "corrupt_rows": 1,
        "missing_rows": 5,
        "endless_time_rows": 0,
        "odd_class_rows": 0,
        "nonpositive_rows": 2,
        "duplicate_rows": 2,
        "clean_rows": 10,
    }


def test_report_of_nothing(spark):
    report = cleaning.ingest_report(spark.createDataFrame([], RAW)).first()
    assert set(report) == {0}


def test_counted_path_gives_the_same_rows(spark, edge_csv):
    raw = read_raw(spark, edge_csv)
    counted = cleaning.clean_counted(cleaning.count_copies(raw))
    plain = cleaning.clean(raw)
    assert counted.columns == plain.columns
    assert counted.exceptAll(plain).isEmpty() and plain.exceptAll(counted).isEmpty()


def test_values_the_clean_types_cannot_hold_have_their_own_counts(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (inf, 1.0, 5.0, 0.0),
        (-inf, 1.0, 5.0, 0.0),
        (1.0, 1.0, 5.0, 3e9),
        (1.0, 1.0, nan, 0.0),
        (nan, 1.0, 5.0, 0.0),
        (1.0, 1.0, 5.0, nan),
        (1.0, 1.0, inf, 1.0),
        (1.0, nan, 5.0, 1.0),
        (1.0, 1.0, 5.0, 0.9),
        (1.0, 1.0, 5.0, -0.5),
        (1.0, 1.0, 5.0, 1.9),
        (1.0, 1.0, -5.0, 2.0),
    ]
    raw = spark.createDataFrame(rows, RAW)
    kept = sorted(r.amount for r in cleaning.clean(raw).collect())
    assert kept == [5.0, inf]
    report = cleaning.ingest_report(raw)
    found = report.first()
    assert (found.missing_rows, found.endless_time_rows, found.odd_class_rows) == (3, 2, 4)
    assert (found.nonpositive_rows, found.clean_rows, found.raw_rows) == (1, 2, len(rows))
    gate = quality.gate_ingest(report)
    assert sorted(quality.failed(gate)) == ["no_endless_times", "no_odd_classes"]


def test_copies_include_null_nan_and_signed_zero(spark):
    nan = float("nan")
    rows = [(0.0, None, 5.0, 0.0), (-0.0, None, 5.0, 0.0), (1.0, nan, 5.0, 0.0)] * 2
    raw = spark.createDataFrame(rows, RAW)
    assert cleaning.drop_copies(raw).count() == 2
    assert cleaning.count_copies(raw).agg(F.sum("_copies")).first()[0] == 6


def test_text_columns_and_odd_names(spark):
    raw = spark.createDataFrame(
        [("1", "5.5", "1", "x"), ("1", "5.5", "1", "x"), ("1", "abc", "1", "x")],
        "Time string, Amount string, Class string, `shop.name` string",
    )
    counted = cleaning.clean_counted(cleaning.count_copies(raw))
    for df in (cleaning.clean(raw), counted):
        assert [tuple(r) for r in df.collect()] == [(1.0, 5.5, 1, "x", 0, "micro")]


def test_boolean_class(spark):
    raw = spark.createDataFrame([(1.0, 5.0, True)], "Time double, Amount double, Class boolean")
    assert cleaning.clean(raw).first().is_fraud == 1


def test_without_ansi_casts(spark, edge_csv):
    with_ansi = cleaning.clean(read_raw(spark, edge_csv)).collect()
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        without = cleaning.clean(read_raw(spark, edge_csv)).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert sorted(map(repr, without)) == sorted(map(repr, with_ansi))


def test_header_in_another_case(spark, tmp_path):
    path = tmp_path / "lower.csv"
    path.write_text("time,amount,class\n3600,5,1\n")
    raw = read_raw(spark, str(path))
    assert quality.failed(quality.gate_source(raw)) == []
    row = cleaning.clean(raw).first()
    assert (row.trans_time, row.amount, row.is_fraud, row.trans_hour) == (3600.0, 5.0, 1, 1)


def test_header_in_another_order_fails(spark, tmp_path):
    path = tmp_path / "moved.csv"
    path.write_text("Time,Class,Amount\n3600,5,1\n")
    with pytest.raises(Exception, match="header"):
        read_raw(spark, str(path), "Time double, Amount double, Class double").collect()


def test_blank_and_repeated_header_names(spark, tmp_path):
    blank, repeated = tmp_path / "blank.csv", tmp_path / "repeated.csv"
    blank.write_text(",Time,Amount,Class\n0,3600,5,1\n1,3600,5,1\n")
    repeated.write_text("x,x,Time,Amount,Class\n0,0,3600,5,1\n0,0,3600,5,1\n")
    rows = cleaning.clean(read_raw(spark, str(blank))).collect()
    assert sorted(tuple(r) for r in rows) == [
        (0, 3600.0, 5.0, 1, 1, "micro"),
        (1, 3600.0, 5.0, 1, 1, "micro"),
    ]
    assert cleaning.clean(read_raw(spark, str(repeated), check_header=False)).count() == 1


def test_columns_beside_a_blank_header_do_not_trade_places(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",Time,Amount,Class\n0,3600,5,1\n")
    (tmp_path / "b.csv").write_text(",Amount,Time,Class\n0,5,3600,1\n")
    schema = "_c0 int, Time double, Amount double, Class double"
    assert read_raw(spark, str(tmp_path / "a.csv"), schema).first()._c0 == 0
    with pytest.raises(Exception, match="b.csv"):
        read_raw(spark, str(tmp_path), schema).collect()


def test_a_column_named_like_a_blank_one_is_compared(spark, tmp_path):
    path = tmp_path / "named.csv"
    path.write_text("Time,_c5,Amount,Class\n3600,7,5,1\n")
    assert read_raw(spark, str(path)).first()._c5 == 7
    with pytest.raises(Exception, match="header"):
        moved = "Time double, Amount double, _c5 int, Class double"
        read_raw(spark, str(path), moved).collect()


def test_several_blank_header_names_need_a_decision(spark, tmp_path):
    path = tmp_path / "blanks.csv"
    path.write_text(",,Time,Amount,Class\n0,1,3600,5,1\n")
    with pytest.raises(ValueError, match="blank header"):
        read_raw(spark, str(path))
    assert read_raw(spark, str(path), check_header=False).first().Amount == 5


def test_known_columns_are_double_and_others_inferred(spark, tmp_path):
    path = tmp_path / "types.csv"
    path.write_text("Time,Shop,Amount,Class,Rate\n0,7,5,0,1.5\n0,7,5,0,1.50\n0,7,oops,0.0,2\n")
    schema = infer_raw_schema(spark, str(path))
    assert {f.name: f.dataType.simpleString() for f in schema} == {
        "Time": "double",
        "Shop": "int",
        "Amount": "double",
        "Class": "double",
        "Rate": "double",
    }
    raw = read_raw(spark, str(path), schema)
    assert cleaning.clean(raw).count() == 1
    assert cleaning.ingest_report(raw).first().corrupt_rows == 1


@pytest.mark.parametrize(
    ("row", "kind"), [("0,5,true", "boolean"), ("2024-01-01 10:00:00,5,1", "timestamp")]
)
def test_known_columns_must_be_numbers(spark, tmp_path, row, kind):
    path = tmp_path / "kinds.csv"
    path.write_text(f"Time,Amount,Class\n{row}\n")
    with pytest.raises(TypeError, match=kind):
        infer_raw_schema(spark, str(path))


def test_quoted_numbers(spark, tmp_path):
    path = tmp_path / "quoted.csv"
    path.write_text('Time,Amount,Class\n"0","5.5","1"\n')
    assert cleaning.clean(read_raw(spark, str(path))).first().amount == 5.5


def test_gate_source_names_what_is_missing(spark):
    raw = spark.createDataFrame([], "Time double, Amount double")
    assert sorted(quality.failed(quality.gate_source(raw))) == ["has_class", "has_rows"]


def test_gate_clean_reports_negative_hours(spark, edge_csv):
    report = quality.gate_clean(cleaning.clean(read_raw(spark, edge_csv)))
    assert {r["check"]: r["measured"] for r in report.collect()} == {
        "has_rows": 10,
        "no_missing_criticals": 0,
        "no_nonpositive_amounts": 0,
        "no_hours_out_of_range": 1,
        "no_unknown_buckets": 0,
        "no_unknown_classes": 0,
    }
    assert quality.failed(report) == ["no_hours_out_of_range"]
    with pytest.raises(quality.GateError, match="no_hours_out_of_range"):
        quality.enforce(report, "clean")


def test_gate_clean_sees_bad_rows(spark):
    rows = [
        (None, 5.0, 1, None, "micro"),
        (1.0, float("nan"), 0, 0, "large"),
        (1.0, -5.0, 7, 30, "tiny"),
        (1.0, 5.0, None, 0, None),
    ]
    transactions = spark.createDataFrame(
        rows,
        "trans_time double, amount double, is_fraud int, trans_hour int, "
        "amount_category string",
    )
    report = {r["check"]: r["measured"] for r in quality.gate_clean(transactions).collect()}
    assert report == {
        "has_rows": 4,
        "no_missing_criticals": 3,
        "no_nonpositive_amounts": 1,
        "no_hours_out_of_range": 2,
        "no_unknown_buckets": 2,
        "no_unknown_classes": 2,
    }
