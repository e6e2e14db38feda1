"""The KPI registry, the daily run and its sizing."""

from txnkpi.plans.daily import ingest, publish, run_pipeline, transform
from txnkpi.plans.registry import REGISTRY

__all__ = ["REGISTRY", "ingest", "publish", "run_pipeline", "transform"]
