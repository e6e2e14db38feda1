"""KPIs kept up to date day by day.

What the KPIs need of a day are its cells, a few hundred rows of mergeable sums, and its top
fraud amounts. Both are kept as parts of published tables, one part for each day: a day is
added, or replaced when it runs again, by one publication that names the new part beside the
old ones. KPIs over all days then read cells only, never the transactions of earlier days.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txnkpi.operators.kpis import kpi_cells, kpi_top_fraud_amounts
from txnkpi.plans.registry import REGISTRY
from txnkpi.sources import published

CELLS, TOP = "cells_by_day", "top_fraud_by_day"

def add_day(transactions: DataFrame, root: str, day: str) -> int:
    """Add or replace a day of clean transactions; returns the version that has it.

    Several days may be added at the same time: a day that finds another publication in its
    way names its parts on top of that one.
    """
    spark = transactions.sparkSession
    top = kpi_top_fraud_amounts(transactions).withColumn("is_fraud", F.lit(1))
    made = {
        name: published.stage(df, root, name)
        for name, df in ((CELLS, kpi_cells(transactions)), (TOP, top))
    }
    return published.commit_parts(spark, root, day, made)


def _table(spark: SparkSession, root: str, name: str, version: int | None) -> DataFrame:
    table = published.snapshot(spark, root, version).tables[name]
    return published.read_table(spark, root, table, StructType.fromJson(json.loads(table.schema)))


def cells(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """Cells of all days, as of the newest publication or an earlier one."""
    return _table(spark, root, CELLS, version)


def kpi_tables(spark: SparkSession, root: str, version: int | None = None) -> dict[str, DataFrame]:
    """All KPI tables over all days."""
    version = version or published.snapshot(spark, root).version
    sources = {True: cells(spark, root, version), False: _table(spark, root, TOP, version)}
    return {
        kpi.name: kpi.build(sources[True], cells=True) if kpi.from_cells else kpi.build(sources[False])
        for kpi in REGISTRY.values()
    }
