"""Gates that know past runs, and published tables whose schema changes."""

from __future__ import annotations

import pytest
from pyspark.sql.types import StructType

from txnkpi.operators import quality
from txnkpi.plans import daily, run_figures
from txnkpi.sources import evolving, published

PAST, NOW = "run string, check string, measured bigint", "check string, measured bigint"


def _judged(spark, past, now, **more):
    report = quality.gate_history(spark.createDataFrame(past, PAST), spark.createDataFrame(now, NOW), **more)
    return {r.check: (r.passed, r.runs, r.low, r.high) for r in report.collect()}


def test_bands_of_past_runs(spark):
    past = [(str(i), "rows", 1000 + i) for i in range(9)] + [(str(i), "flat", 50) for i in range(9)]
    past += [("x", "rows", 0), ("0", "young", 5), ("1", "young", None)]
    found = _judged(spark, past, [("rows", 200), ("flat", 54), ("young", 999), ("new", 1)], least_runs=3)
    # Median 1003.5, a tenth of which is more than five deviations.
    assert found["rows"] == (False, 10, 1003.5 - 100.35, 1003.5 + 100.35)
    assert found["flat"] == (True, 9, 45.0, 55.0)
    assert found["young"][:2] == (True, 1) and found["new"] == (True, 0, None, None)


def test_one_bad_run_does_not_move_the_band_and_a_lost_check_fails(spark):
    past = [(str(i), "rows", 1000 + 40 * (i % 3)) for i in range(9)]
    calm = _judged(spark, past, [("rows", 1100)])
    assert _judged(spark, [*past, ("bad", "rows", 10**9)], [("rows", 1100)])["rows"][0] == calm["rows"][0]
    assert _judged(spark, past, [("other", 1)])["rows"][:2] == (False, 9)
    assert _judged(spark, [], []) == {}


def test_runs_keep_their_figures_and_replace_them(spark, tmp_path):
    root = str(tmp_path)
    for run, n in (("a", 1), ("b", 2), ("a", 3)):
        counts = run_figures.of_counts(spark, {"rows": n})
        run_figures.remember(run_figures.of_run(counts, run), root, run)
    assert {tuple(r) for r in run_figures.past(spark, root).collect()} == {("a", "rows", 3), ("b", "rows", 2)}
    assert {r.run for r in run_figures.past(spark, root, "a").collect()} == {"b"}


def test_a_daily_run_is_held_against_its_history(spark, edge_csv, tmp_path):
    history, schema = str(tmp_path / "history"), "Time double, V1 double, Amount double, Class double"
    figures = [(str(i), "raw_rows", 1_000_000) for i in range(6)]
    run_figures.remember(spark.createDataFrame(figures, PAST), history, "before")
    where = edge_csv, str(tmp_path / "output"), str(tmp_path / "published")
    report = daily.run_pipeline(spark, *where, schema, history=history, run="today")
    assert report.failed_checks["history"] == ["raw_rows"]
    assert "today" in {r.run for r in run_figures.past(spark, history).collect()}
    again = quality.gate_history(
        run_figures.past(spark, history), run_figures.of_counts(spark, report.counts)
    )
    with pytest.raises(quality.GateError, match="raw_rows"):
        quality.enforce(again, "history")
    with pytest.raises(ValueError):
        daily.run_pipeline(spark, *where, schema, run="today")


# --- schemas


def _add(spark, root, part, rows, schema):
    return evolving.add_part(spark.createDataFrame(rows, schema), root, "t", part)


def test_columns_are_added_and_widened(spark, tmp_path):
    root = str(tmp_path)
    _add(spark, root, "1", [(1, 1.5)], "a int, b float")
    _add(spark, root, "2", [(2**40, 0.1, "x")], "a bigint, b double, `c.d` string")
    _add(spark, root, "3", [("y", 3)], "`c.d` string, a smallint")
    now = evolving.read_evolved(spark, root, "t")
    assert now.dtypes == [("a", "bigint"), ("b", "double"), ("c.d", "string")]
    assert {tuple(r) for r in now.collect()} == {(1, 1.5, None), (2**40, 0.1, "x"), (3, None, "y")}
    first = evolving.read_evolved(spark, root, "t", version=1)
    assert first.dtypes == [("a", "int"), ("b", "float")] and first.count() == 1


def test_a_replaced_part_takes_its_schema_along(spark, tmp_path):
    root = str(tmp_path)
    for rows, schema in (([(1,)], "a int"), ([(5,)], "a bigint")):
        _add(spark, root, "1", rows, schema)
    table = published.snapshot(spark, root).tables["t"]
    assert len(table.schemas) == 1 and len(table.parts) == 1
    assert [tuple(r) for r in evolving.read_evolved(spark, root, "t").collect()] == [(5,)]


@pytest.mark.parametrize("schema, value", [("a string", "x"), ("a bigint", 1), ("A double", 1.0), ("a date", None)])
def test_what_cannot_be_held_is_refused_before_writing(spark, tmp_path, schema, value):
    root = str(tmp_path)
    _add(spark, root, "1", [(1.0,)], "a double")
    with pytest.raises(evolving.SchemaConflict):
        _add(spark, root, "2", [(value,)], schema)
    assert published.versions(spark, root) == [1]
    assert len([p for p in (tmp_path / "t").iterdir() if p.is_dir()]) == 1


def test_filters_and_columns_reach_every_scan(spark, tmp_path):
    root = str(tmp_path)
    _add(spark, root, "1", [(1, "x")], "a int, b string")
    _add(spark, root, "2", [(2, "y")], "a bigint, b string")
    found = evolving.read_evolved(spark, root, "t").filter("a > 1 and b = 'y'").select("a")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThan(a,1)") == 2 and plan.count("EqualTo(b,y)") == 2
    assert [tuple(r) for r in found.collect()] == [(2,)]


def test_types_that_hold_both():
    def kind(text):
        return StructType.fromDDL(f"a {text}")[0].dataType

    for first, second, both in (
        ("tinyint", "int", "int"), ("int", "double", "double"), ("float", "smallint", None),
        ("decimal(10,2)", "decimal(9,4)", "decimal(12,4)"), ("decimal(38,2)", "decimal(9,4)", None),
        ("bigint", "double", None), ("string", "string", "string"),
    ):
        for x, y in ((first, second), (second, first)):
            found = evolving.wider(kind(x), kind(y))
            assert (found and found.simpleString()) == both
