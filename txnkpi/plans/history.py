"""Raw rows that were not there on earlier days.

A history keeps every distinct raw row by day, and a narrow table of 128-bit fingerprints that
is bucketed, so that a day's fingerprints go to it and it stays where it is. The wide rows of
the day are compared with the few fingerprints that were found before they are shuffled; rows
that hit one are compared with the stored rows in all columns, so a chance collision drops
nothing.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnkpi.functions import CORRUPT
from txnkpi.operators.cleaning import quoted
from txnkpi.sources import paths

DAY, PRINT = "_day", ["_print_a", "_print_b"]
BUCKETS = 64


def _prints(names: list[str]) -> list[Column]:
    """Two hashes of all columns; NULL equals NULL, NaN equals NaN and 0.0 equals -0.0."""
    columns = [F.col(quoted(name)) for name in names]
    return [
        F.xxhash64(*columns).alias(PRINT[0]),
        F.xxhash64(F.lit("second"), *reversed(columns)).alias(PRINT[1]),
    ]


def _rows_path(history: str) -> str:
    return paths.join(history, "rows")


def _prints_table(spark: SparkSession, history: str, buckets: int) -> str:
    """Name of the bucketed fingerprints in the session's catalog; registered if it is not there.

    How many buckets there are is settled when a history begins, and kept beside it.
    """
    settled = paths.join(history, "buckets")
    paths.create_if_absent(spark, settled, str(buckets))
    count = int(paths.read_text(spark, settled))
    name = "txnkpi_history_" + hashlib.sha256(history.encode()).hexdigest()[:16]
    a, b = PRINT
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({a} BIGINT, {b} BIGINT, {DAY} STRING) USING parquet "
        f"CLUSTERED BY ({a}, {b}) INTO {count} BUCKETS LOCATION '{paths.join(history, 'prints')}'"
    )
    spark.catalog.refreshTable(name)
    return name


def fresh_rows(raw: DataFrame, history: str, day: str, buckets: int = BUCKETS) -> DataFrame:
    """Distinct rows of ``raw`` that no earlier day of the history holds.

    Days are ordered as text, such as ``2024-01-31``. A day that runs again does not meet its
    own rows. Beyond the one wide shuffle of ``drop_copies`` only fingerprints move.
    """
    spark, names = raw.sparkSession, [name for name in raw.columns if name != CORRUPT]
    marked = raw.select(*map(quoted, names), *_prints(names))
    known = spark.table(_prints_table(spark, history, buckets)).filter(F.col(DAY) < day)
    if not paths.exists(spark, _rows_path(history)):
        return raw.select(*map(quoted, names)).dropDuplicates()
    found = paths.scratch(spark, "hits")
    marked.select(*PRINT).join(known.select(*PRINT), PRINT, "left_semi").distinct().write.parquet(found)
    hits = spark.read.parquet(found)
    old = spark.read.parquet(_rows_path(history)).filter(F.col(DAY) < day).join(hits, PRINT, "left_semi")
    doubtful = marked.join(hits, PRINT, "left_semi").dropDuplicates()
    same = [doubtful[quoted(n)].eqNullSafe(old[quoted(n)]) for n in (*PRINT, *names)]
    doubtful = doubtful.join(old, reduce(Column.__and__, same), "left_anti")
    fresh = marked.join(hits, PRINT, "left_anti").select(*map(quoted, names)).dropDuplicates()
    return fresh.unionByName(doubtful.select(*map(quoted, names)))


def remember(rows: DataFrame, history: str, day: str, buckets: int = BUCKETS) -> None:
    """Keep a day's distinct rows; a day that runs again replaces its rows.

    Fingerprints that a rerun leaves behind do no harm, as only stored rows make a copy.
    """
    spark = rows.sparkSession
    stored = rows.select("*", *_prints(rows.columns), F.lit(day).alias(DAY))
    writer = stored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(DAY).parquet(_rows_path(history))
    table = _prints_table(spark, history, buckets)
    count = int(paths.read_text(spark, paths.join(history, "buckets")))
    kept = spark.read.parquet(_rows_path(history)).filter(F.col(DAY) == day)
    kept.select(*PRINT, F.col(DAY).cast("string").alias(DAY)).repartition(count, *PRINT).write.insertInto(table)
