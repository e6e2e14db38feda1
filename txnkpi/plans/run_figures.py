"""Figures of past runs, kept as parts of a published table, one part for each run or batch.

``quality.gate_history`` holds the figures of a run against them. A run that is recorded again
replaces its part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from txnkpi.operators.conforming import conform
from txnkpi.sources import published

TABLE = "run_figures"
SCHEMA = (
    StructType().add("run", StringType()).add("check", StringType()).add("measured", LongType())
)


def remember(figures: DataFrame, root: str, part: str) -> int:
    """Keep rows (run, check, measured); returns the version that has them."""
    staged = published.stage(conform(figures, SCHEMA).coalesce(1), root, TABLE)
    return published.commit_parts(figures.sparkSession, root, part, {TABLE: staged})


def past(spark: SparkSession, root: str, but: str | None = None) -> DataFrame:
    """Figures of all runs that were kept, without those of the run ``but``."""
    rows = published.read_published(spark, root, TABLE, SCHEMA)
    return rows if but is None else rows.filter(F.col("run") != but)


def of_run(reports: DataFrame, run: str) -> DataFrame:
    """What gates measured in a run, as rows to be kept."""
    return reports.select(F.lit(run).alias("run"), "check", "measured")


def of_counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    """Row counts of an ingest as (check, measured)."""
    return spark.createDataFrame(list(counts.items()), "check string, measured bigint")
