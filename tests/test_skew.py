"""Hot groups collapse before the shuffle: rows counted at the exchange itself."""

from __future__ import annotations

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from txnkpi.operators import cleaning, kpis

TASKS = 8
ROWS = 90_000


def shuffled_rows(df):
    """Records written by each exchange of an executed plan, outermost first."""
    df.collect()
    found, pending = [], [df._jdf.queryExecution().executedPlan()]
    while pending:
        node = pending.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            pending.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            pending.append(node.plan())
        else:
            if name == "ShuffleExchangeExec":
                found.append(node.metrics().apply("shuffleRecordsWritten").value())
            pending.extend(node.children().apply(i) for i in range(node.children().size()))
    return found


@pytest.fixture(scope="module")
def raw(spark):
    """A third of the rows are copies of one row, a third lack their amount."""
    ids = spark.range(0, ROWS, 1, TASKS)
    kind = F.col("id") % 3
    return ids.select(
        F.when(kind == 0, 5.0).otherwise(F.col("id").cast("double")).alias("Time"),
        F.when(kind == 0, 7.0).when(kind == 1, F.col("id") + 1.0).alias("Amount"),
        F.lit(1.0).alias("Class"),
    )


def test_copies_collapse_in_the_map_tasks(raw):
    assert shuffled_rows(cleaning.clean(raw)) == [ROWS // 3 + TASKS]


def test_unusable_rows_collapse_when_counted(raw):
    counted = cleaning.count_copies(raw)
    assert shuffled_rows(counted) == [ROWS // 3 + 2 * TASKS]
    assert counted.agg(F.sum("_copies")).first()[0] == ROWS


def test_low_amounts_collapse_in_the_ingest_that_writes(spark, tmp_path):
    """Half of the rows are not positive: one row for each task goes through the shuffle."""
    ids = spark.range(0, ROWS, 1, TASKS)
    sign = F.when(F.col("id") % 2 == 0, 1.0).otherwise(-1.0)
    raw = ids.select(
        F.col("id").cast("double").alias("Time"),
        (sign * (F.col("id") + 1)).alias("Amount"),
        F.lit(1.0).alias("Class"),
    )
    seen = Observation()
    counted = cleaning.count_copies(raw).observe(seen, *cleaning.report_columns())
    assert shuffled_rows(cleaning.clean_counted(counted)) == [ROWS // 2 + TASKS]
    assert seen.get["nonpositive_rows"] == ROWS // 2
    assert seen.get["clean_rows"] == ROWS // 2


def test_kpis_shuffle_one_row_per_group_and_task(spark):
    transactions = spark.range(0, ROWS, 1, TASKS).select(
        F.col("id").cast("double").alias("trans_time"),
        F.lit(50.0).alias("amount"),
        F.lit(1).alias("is_fraud"),
        F.lit(3).alias("trans_hour"),
        F.lit("small").alias("amount_category"),
    )
    # One row per task, then one per group and band of amounts.
    assert shuffled_rows(kpis.kpi_fraud_vs_normal(transactions)) == [1, TASKS]
    assert shuffled_rows(kpis.kpi_cells(transactions)) == [TASKS]
    # Cells once per task, then the single cell expanded to four levels.
    assert sorted(shuffled_rows(kpis.kpi_suite(transactions))) == [4, TASKS]
