"""KPI tables over clean transactions.

Every KPI is a roll-up of one small table of *cells*, one row per (hour, amount bucket,
class) and band of amounts, of which usual amounts have one. ``kpi_cells`` makes it in a single scan, with one partial aggregate per row and a
shuffle of at most a few hundred rows per task; the KPIs then read the cells only. Each
KPI can also be taken straight from the transactions (``cells=False``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnkpi.functions.money import (
    BAND,
    gathered,
    merged_sums,
    money_sums,
    money_total,
    with_bands,
)

CELL_KEYS = ("trans_hour", "amount_category", "is_fraud")

TOP_FRAUD_ROWS = 20

TOTAL = "_total"


def _measures() -> list[Column]:
    """Partial results per group of transactions, all of which can be merged."""
    return [
        F.count("trans_time").alias("nb_transactions"),
        F.count("amount").alias("nb_amounts"),
        F.count("is_fraud").alias("nb_classes"),
        F.sum("is_fraud").alias("nb_fraud"),
        F.min("amount").alias("min_amount"),
        F.max("amount").alias("max_amount"),
        *money_sums(),
    ]


def _merged_counts() -> list[Column]:
    """Partial results but for money, merged over cells or bands."""

    def counted(name: str) -> Column:
        return F.coalesce(F.sum(name), F.lit(0)).alias(name)

    return [
        counted("nb_transactions"),
        counted("nb_amounts"),
        counted("nb_classes"),
        F.sum("nb_fraud").alias("nb_fraud"),
        F.min("min_amount").alias("min_amount"),
        F.max("max_amount").alias("max_amount"),
    ]


def _merged_measures() -> list[Column]:
    """The same partial results, merged over cells of one band."""
    return [*_merged_counts(), *merged_sums()]


def _reported() -> dict[str, Column]:
    """Published figures from partial results: money to 2 places, rates to 4."""
    total = F.col(TOTAL)
    mean = total / F.nullif(F.col("nb_amounts"), F.lit(0))
    rate = F.col("nb_fraud") / F.nullif(F.col("nb_classes"), F.lit(0))
    return {
        "nb_transactions": F.col("nb_transactions"),
        "total_amount": F.round(total, 2),
        "avg_amount": F.round(mean, 2),
        "min_amount": F.round("min_amount", 2),
        "max_amount": F.round("max_amount", 2),
        "nb_fraud": F.col("nb_fraud"),
        "fraud_rate_pct": F.round(rate * 100, 4),
        "fraud_rate": rate,
    }


VOLUME_AND_RATE = (
    "nb_transactions",
    "total_amount",
    "avg_amount",
    "nb_fraud",
    "fraud_rate_pct",
)
GLOBAL_FIGURES = (
    "nb_transactions",
    "total_amount",
    "avg_amount",
    "max_amount",
    "nb_fraud",
    "fraud_rate_pct",
)
SPREAD = ("nb_transactions", "total_amount", "avg_amount", "min_amount", "max_amount")


def _kpi(
    source: DataFrame, keys: tuple[str, ...], figures: tuple[str, ...], cells: bool
) -> DataFrame:
    """Figures per key, from transactions or from cells."""
    if cells:
        banded = source.groupBy(*keys, BAND).agg(*_merged_measures())
    else:
        banded = with_bands(source).groupBy(*keys, BAND).agg(*_measures())
    reported = _reported()
    return _totalled(banded, keys).select(
        *keys, *[reported[name].alias(name) for name in figures]
    )


def _totalled(banded: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Partial results per key and band, put together per key with the exact total."""
    return (
        banded.groupBy(*keys)
        .agg(*_merged_counts(), *gathered())
        .withColumn(TOTAL, money_total())
    )


def kpi_global(source: DataFrame, cells: bool = False) -> DataFrame:
    """One row over everything; also for empty input (0 and NULLs)."""
    return _kpi(source, (), GLOBAL_FIGURES, cells)


def kpi_by_hour(source: DataFrame, cells: bool = False) -> DataFrame:
    """Figures per hour of day, in hour order."""
    by_hour = _kpi(source, ("trans_hour",), VOLUME_AND_RATE, cells)
    return by_hour.orderBy("trans_hour")


def kpi_by_amount_category(source: DataFrame, cells: bool = False) -> DataFrame:
    """Figures per amount bucket, largest rounded total first."""
    by_bucket = _kpi(source, ("amount_category",), VOLUME_AND_RATE, cells)
    return by_bucket.orderBy(F.desc("total_amount"), "amount_category")


def kpi_fraud_vs_normal(source: DataFrame, cells: bool = False) -> DataFrame:
    """Volume and spread of amounts per class."""
    return _kpi(source, ("is_fraud",), SPREAD, cells)


def kpi_top_fraud_amounts(transactions: DataFrame, n: int = TOP_FRAUD_ROWS) -> DataFrame:
    """The n fraudulent transactions with the highest amounts.

    Sort plus limit becomes a per-task top-n and a merge of n rows per task; the class
    filter and the needed columns reach the Parquet scan. Equal amounts are put in order
    by time, bucket and hour, so the result does not depend on partitioning.
    """
    return (
        transactions.filter(F.col("is_fraud") == 1)
        .select("trans_time", "amount", "amount_category", "trans_hour")
        .orderBy(F.desc("amount"), "trans_time", "amount_category", "trans_hour")
        .limit(n)
    )


def kpi_cells(transactions: DataFrame) -> DataFrame:
    """Partial results per (hour, bucket, class): one scan for KPIs and the clean gate."""
    missing = (
        F.col("trans_time").isNull()
        | F.isnan("trans_time")
        | F.col("amount").isNull()
        | F.isnan("amount")
        | F.col("is_fraud").isNull()
    )
    return with_bands(transactions).groupBy(*CELL_KEYS, BAND).agg(
        *_measures(),
        F.count(F.lit(1)).alias("nb_rows"),
        F.count_if(missing).alias("nb_missing"),
        F.count_if(F.col("amount") <= 0).alias("nb_nonpositive"),
    )


def kpi_suite(transactions: DataFrame) -> DataFrame:
    """The four aggregate KPIs in long form, from one scan.

    Transactions are reduced to cells first, so the fourfold expansion of grouping sets
    touches a few hundred rows instead of every transaction.
    """
    return suite_of_cells(kpi_cells(transactions))


def suite_of_cells(cells: DataFrame) -> DataFrame:
    """``kpi_suite`` from cells that are there already, of one day or of many."""
    sets = [[BAND], ["trans_hour", BAND], ["amount_category", BAND], ["is_fraud", BAND]]
    reported = _reported()
    rolled = cells.groupingSets(sets, *CELL_KEYS, BAND).agg(
        F.grouping_id().alias("level"), *_merged_measures()
    )
    rolled = _totalled(rolled, ("level", *CELL_KEYS))
    # grouping_id sets a bit for each key that is rolled up: hour 8, bucket 4, class 2.
    name = (
        F.when(F.col("level") == 14, "kpi_global")
        .when(F.col("level") == 6, "kpi_by_hour")
        .when(F.col("level") == 10, "kpi_by_amount_category")
        .otherwise("kpi_fraud_vs_normal")
    )
    figures = [f for f in reported if f != "fraud_rate"]
    return rolled.select(
        name.alias("kpi"), *CELL_KEYS, *[reported[f].alias(f) for f in figures]
    )


def kpi_daily(transactions: DataFrame) -> DataFrame:
    """Volume and plain fraud ratio per date (``trans_date`` column)."""
    figures = ("nb_transactions", "total_amount", "nb_fraud", "fraud_rate")
    return _table_kpi(transactions, "trans_date", figures)


def kpi_by_category(transactions: DataFrame) -> DataFrame:
    """Volume and fraud count per merchant category (``category`` column)."""
    figures = ("nb_transactions", "total_amount", "nb_fraud")
    return _table_kpi(transactions, "category", figures)


def _table_kpi(transactions: DataFrame, key: str, figures: tuple[str, ...]) -> DataFrame:
    """KPI over the declared transactions table, which has no time-of-day column."""
    banded = (
        with_bands(transactions)
        .groupBy(key, BAND)
        .agg(
            F.count(F.lit(1)).alias("nb_transactions"),
            F.count("is_fraud").alias("nb_classes"),
            F.sum("is_fraud").alias("nb_fraud"),
            *money_sums(),
        )
    )
    counts = [F.sum(n).alias(n) for n in ("nb_transactions", "nb_classes", "nb_fraud")]
    reported = _reported()
    return (
        banded.groupBy(key)
        .agg(*counts, *gathered())
        .withColumn(TOTAL, money_total())
        .select(key, *[reported[name].alias(name) for name in figures])
    )
