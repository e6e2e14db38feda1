"""Parquet tables between the stages, below one output folder."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from txnkpi.sources import paths

# A table of this size is read by one task, so rolling it up needs no shuffle.
ONE_TASK_BYTES = 16 * 1024**2

CLEAN = "transactions_clean"
INGESTED, KIND = "ingested", "kind"
CELLS = "kpi_cells"
KPIS = "kpis"
PROFILE = "profile"


def clean_path(output: str) -> str:
    """Folder of the clean transactions."""
    return paths.join(output, CLEAN)


def ingested_path(output: str, kind: str | None = None) -> str:
    """Folder of an ingest that kept its rejects, or of its ``clean`` or ``rejected`` rows."""
    return paths.join(output, INGESTED, *([f"{KIND}={kind}"] if kind else []))


def profile_path(output: str) -> str:
    """Folder of the sketches of the clean transactions' columns."""
    return paths.join(output, PROFILE)


def cells_path(output: str) -> str:
    """Folder of the partial results the KPIs are rolled up from."""
    return paths.join(output, CELLS)


def kpi_path(output: str, name: str) -> str:
    """Folder of one KPI table."""
    return paths.join(output, KPIS, name)


def write(df: DataFrame, path: str) -> None:
    """Replace a Parquet folder."""
    df.write.mode("overwrite").parquet(path)


def write_all(frames: dict[str, DataFrame]) -> None:
    """Write independent tables at the same time, path by path; the first error is raised.

    Each is a job of its own, so small ones fill the cluster while a large one finishes.
    """
    with ThreadPoolExecutor(len(frames)) as pool:
        for done in [pool.submit(write, df, path) for path, df in frames.items()]:
            done.result()


def read(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a Parquet folder. With a schema no file is opened to find it."""
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def read_compact(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame:
    """Read a Parquet folder, as a single partition if its size on disk allows."""
    df = read(spark, path, schema)
    return df.coalesce(1) if paths.scanned_bytes(df) <= ONE_TASK_BYTES else df


def read_if_there(
    spark: SparkSession, path: str, schema: StructType | None = None
) -> DataFrame | None:
    """Read a Parquet folder, or None when it is absent or was not written to the end."""
    return read(spark, path, schema) if paths.finished(spark, path) else None
