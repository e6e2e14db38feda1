"""DataFrame operators: cleaning, KPIs, gates, schema conformance and publishing."""

from txnkpi.operators.cleaning import clean, ingest_report
from txnkpi.operators.conforming import conform
from txnkpi.operators.kpis import (
    kpi_by_amount_category,
    kpi_by_category,
    kpi_by_hour,
    kpi_cells,
    kpi_daily,
    kpi_fraud_vs_normal,
    kpi_global,
    kpi_suite,
    kpi_top_fraud_amounts,
)
from txnkpi.operators.publishing import refresh, upsert
from txnkpi.operators.quality import gate_clean, gate_ingest, gate_kpis, gate_source

__all__ = [
    "clean",
    "conform",
    "gate_clean",
    "gate_ingest",
    "gate_kpis",
    "gate_source",
    "ingest_report",
    "kpi_by_amount_category",
    "kpi_by_category",
    "kpi_by_hour",
    "kpi_cells",
    "kpi_daily",
    "kpi_fraud_vs_normal",
    "kpi_global",
    "kpi_suite",
    "kpi_top_fraud_amounts",
    "refresh",
    "upsert",
]
