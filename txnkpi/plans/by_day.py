"""The declared ``transactions`` table, laid out by date.

A day is a partition of its own: a load replaces the days it brings and leaves the others
alone, and a query for some days reads their files only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnkpi.operators.conforming import conform
from txnkpi.plans.registry import DECLARED_ONLY

SCHEMA = DECLARED_ONLY["transactions"]
DAY = "trans_date"


def write_days(transactions: DataFrame, path: str) -> None:
    """Replace the days that occur in ``transactions``; rows without a date are a day, too.

    Rows are dealt to files by date. Adaptive execution puts small days together in one task
    and splits a day that holds much more than others over several.
    """
    dealt = conform(transactions, SCHEMA).hint("rebalance", F.col(DAY))
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DAY).parquet(path)


def read_days(spark: SparkSession, path: str) -> DataFrame:
    """The table; a filter on ``trans_date`` keeps other days from being listed or read."""
    return spark.read.schema(SCHEMA).parquet(path).select(*SCHEMA.names)
