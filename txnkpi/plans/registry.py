"""The KPI tables: schema, key, load mode and builder, in publishing order."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from txnkpi.operators import kpis

_TYPES = {
    "trans_date": DateType(),
    "trans_time": DoubleType(),
    "trans_hour": IntegerType(),
    "amount": DoubleType(),
    "amount_category": StringType(),
    "category": StringType(),
    "is_fraud": IntegerType(),
    "merchant": StringType(),
    "state": StringType(),
    "nb_transactions": LongType(),
    "total_amount": DoubleType(),
    "avg_amount": DoubleType(),
    "min_amount": DoubleType(),
    "max_amount": DoubleType(),
    "nb_fraud": LongType(),
    "fraud_rate_pct": DoubleType(),
    "fraud_rate": DoubleType(),
}


def table_schema(*names: str) -> StructType:
    """Schema of a table made of known columns."""
    return StructType([StructField(name, _TYPES[name]) for name in names])


@dataclass(frozen=True)
class Kpi:
    """One published table. With a key it is upserted, without one refreshed."""

    name: str
    schema: StructType
    build: Callable[..., DataFrame]
    key: str | None = None
    from_cells: bool = True

    @property
    def mode(self) -> str:
        """How a batch meets the published table."""
        return "upsert" if self.key else "refresh"


REGISTRY: dict[str, Kpi] = {
    kpi.name: kpi
    for kpi in (
        Kpi("kpi_global", table_schema(*kpis.GLOBAL_FIGURES), kpis.kpi_global),
        Kpi(
            "kpi_by_hour",
            table_schema("trans_hour", *kpis.VOLUME_AND_RATE),
            kpis.kpi_by_hour,
            key="trans_hour",
        ),
        Kpi(
            "kpi_by_amount_category",
            table_schema("amount_category", *kpis.VOLUME_AND_RATE),
            kpis.kpi_by_amount_category,
            key="amount_category",
        ),
        Kpi(
            "kpi_fraud_vs_normal",
            table_schema("is_fraud", *kpis.SPREAD),
            kpis.kpi_fraud_vs_normal,
            key="is_fraud",
        ),
        Kpi(
            "kpi_top_fraud_amounts",
            table_schema("trans_time", "amount", "amount_category", "trans_hour"),
            kpis.kpi_top_fraud_amounts,
            from_cells=False,
        ),
    )
}

# Declared, but not part of the daily run: their input has dates and categories.
DECLARED_ONLY = {
    "transactions": table_schema(
        "trans_date", "category", "amount", "is_fraud", "merchant", "state"
    ),
    "kpi_daily": table_schema(
        "trans_date", "nb_transactions", "total_amount", "nb_fraud", "fraud_rate"
    ),
    "kpi_by_category": table_schema(
        "category", "nb_transactions", "total_amount", "nb_fraud"
    ),
}
