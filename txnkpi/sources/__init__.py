"""Readers and writers: raw CSV, stage tables, published versions, JDBC."""

from txnkpi.sources.published import current_version, read_published, write_version
from txnkpi.sources.raw_csv import infer_raw_schema, read_raw

__all__ = [
    "current_version",
    "infer_raw_schema",
    "read_published",
    "read_raw",
    "write_version",
]
