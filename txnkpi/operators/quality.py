"""Checks between the stages, one row each: (check, passed, measured).

A gate reports. ``failed`` turns a report into an error where the caller asks for it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnkpi.functions import AMOUNT_BUCKETS, REQUIRED, TOP_BUCKET
from txnkpi.operators.kpis import kpi_cells

GATE_SCHEMA = "check string, passed boolean, measured bigint"


class GateError(RuntimeError):
    """A gate with failed checks."""


def _rows(measured: DataFrame, checks: Iterable[tuple[str, Column, Column]]) -> DataFrame:
    """One row per check from a one-row frame of measurements."""
    structs = [
        F.struct(
            F.lit(name).alias("check"),
            passed.alias("passed"),
            value.cast("bigint").alias("measured"),
        )
        for name, passed, value in checks
    ]
    return measured.select(F.inline(F.array(*structs)))


def gate_source(raw: DataFrame, count: bool = True) -> DataFrame:
    """Raw transactions have the required columns, in any letter case, and rows.

    Counting reads all rows. Without ``count`` Spark looks for a first row in one split
    after another, and the number of rows is reported as NULL.
    """
    present = {name.lower() for name in raw.columns}
    found = {name: name.lower() in present for name in REQUIRED}
    checks = [
        (f"has_{name.lower()}", F.lit(found[name]), F.lit(int(found[name])))
        for name in REQUIRED
    ]
    if count:
        measured, rows = raw.agg(F.count(F.lit(1)).alias("rows")), F.col("rows")
        return _rows(measured, [*checks, ("has_rows", rows > 0, rows)])
    checks.append(("has_rows", F.lit(bool(raw.select(F.lit(1)).head(1))), F.lit(None)))
    return _rows(raw.sparkSession.range(1), checks)


def gate_ingest(report: DataFrame) -> DataFrame:
    """The counts of ``ingest_report``: rows are left, and none had a value that is refused.

    Missing values, copies and amounts that are not positive are expected in raw rows.
    """
    kept, odd, endless = map(F.col, ("clean_rows", "odd_class_rows", "endless_time_rows"))
    return _rows(
        report,
        [
            ("has_clean_rows", kept > 0, kept),
            ("no_odd_classes", odd == 0, odd),
            ("no_endless_times", endless == 0, endless),
        ],
    )


def gate_cells(cells: DataFrame) -> DataFrame:
    """The checks of ``gate_clean`` over cells that are already there."""
    rows = F.col("nb_rows")
    buckets = [name for name, _ in AMOUNT_BUCKETS] + [TOP_BUCKET]

    def count_where(ok: Column) -> Column:
        return F.coalesce(F.sum(F.when(~F.coalesce(ok, F.lit(False)), rows)), F.lit(0))

    measured = cells.agg(
        F.coalesce(F.sum(rows), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("nb_missing"), F.lit(0)).alias("missing_criticals"),
        F.coalesce(F.sum("nb_nonpositive"), F.lit(0)).alias("nonpositive_amounts"),
        count_where(F.col("trans_hour").between(0, 23)).alias("hours_out_of_range"),
        count_where(F.col("amount_category").isin(buckets)).alias("unknown_buckets"),
        count_where(F.col("is_fraud").isin(0, 1)).alias("unknown_classes"),
    )
    bad = [name for name in measured.columns if name != "rows"]
    return _rows(
        measured,
        [
            ("has_rows", F.col("rows") > 0, F.col("rows")),
            *[(f"no_{name}", F.col(name) == 0, F.col(name)) for name in bad],
        ],
    )


def gate_clean(transactions: DataFrame) -> DataFrame:
    """Clean transactions hold what the KPIs assume; one scan, reduced to cells."""
    return gate_cells(kpi_cells(transactions))


def gate_kpis(spark: SparkSession, tables: dict[str, DataFrame | None]) -> DataFrame:
    """Every KPI table was produced; ``measured`` is its row count, NULL if absent.

    A table whose writing did not finish is absent, too: pass None.
    """
    missing = [(name, False, None) for name, df in tables.items() if df is None]
    report = spark.createDataFrame(missing, GATE_SCHEMA)
    for name, df in tables.items():
        if df is not None:
            count = df.agg(F.count(F.lit(1)).alias("measured"))
            check, passed = F.lit(name).alias("check"), F.lit(True).alias("passed")
            report = report.unionByName(count.select(check, passed, "measured"))
    return report


#: Median deviations of a normal distribution in one standard deviation.
NORMAL = 1.4826


def gate_history(
    past: DataFrame,
    now: DataFrame,
    least_runs: int = 5,
    width: float = 5.0,
    share: float = 0.1,
) -> DataFrame:
    """Figures of a run (check, measured) against those of past runs (run, check, measured).

    One row per check, with the number of past runs and the band it should lie in: ``width``
    robust standard deviations around the median, and at least ``share`` of the median. Medians
    let a few bad runs pass into the history without moving the band. A check that past runs
    measured and this one did not fails. With fewer than ``least_runs`` past runs nothing is
    judged: the check passes. Figures that are NULL are not counted as runs.
    """
    known = past.filter(F.col("measured").isNotNull())
    middle = known.groupBy("check").agg(
        F.median("measured").alias("median"), F.count("measured").alias("runs")
    )
    away = F.abs(F.col("measured") - F.col("median"))
    spread = known.join(middle, "check").groupBy("check", "median", "runs")
    spread = spread.agg(F.median(away).alias("deviation"))
    half = F.greatest(F.col("deviation") * NORMAL * width, F.abs("median") * share)
    bands = spread.select(
        "check", "runs", (F.col("median") - half).alias("low"), (F.col("median") + half).alias("high")
    )
    inside = F.coalesce(F.col("measured").between(F.col("low"), F.col("high")), F.lit(False))
    runs = F.coalesce("runs", F.lit(0))
    return now.select("check", "measured").join(bands, "check", "full").select(
        "check",
        ((runs < least_runs) | inside).alias("passed"),
        "measured",
        runs.cast("bigint").alias("runs"),
        "low",
        "high",
    )


def failed(report: DataFrame) -> list[str]:
    """Names of failed checks; a gate report has a handful of rows."""
    return [row["check"] for row in report.filter(~F.col("passed")).collect()]


def enforce(report: DataFrame, gate: str, strict: bool = True) -> list[str]:
    """Names of failed checks; ``strict`` raises if there are any. Looks at the gate once."""
    names = failed(report)
    if names and strict:
        raise GateError(f"{gate}: {', '.join(sorted(names))}")
    return names
