"""Times of the headline queries and stages; prints one JSON line.

``queries`` are run from raw rows to a finished result. ``repeated_scans`` is the same
work as separate actions (a count before every write, one scan per KPI, inferred schema),
the form the one-pass stages are measured against. Medians of warm runs.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txnkpi.functions import CORRUPT
from txnkpi.operators import cleaning
from txnkpi.plans import bindings, daily
from txnkpi.plans.queries import queries
from txnkpi.plans.registry import REGISTRY
from txnkpi.session import create_session
from txnkpi.sources import paths, tables
from txnkpi.sources.raw_csv import read_raw

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))
RAW_SCHEMA = "Time double, Amount double, Class double"

HEADLINES = [
    "kpi_global_lineitem",
    "kpi_by_hour_lineitem",
    "kpi_by_amount_category_lineitem",
    "kpi_fraud_vs_normal_lineitem",
    "kpi_top_fraud_amounts_lineitem",
    "kpi_suite_lineitem",
    "clean_transactions",
    "clean_transactions_coarse",
    "ingest_report",
    "gate_clean",
    "kpi_daily",
    "kpi_by_category",
    "upsert_by_amount_category",
]


def consume(df: DataFrame) -> None:
    """Run a plan to its end without keeping the result."""
    df.write.format("noop").mode("overwrite").save()


def median_seconds(work: Callable[[], object]) -> float:
    """Median over RUNS runs after one warm-up."""
    times = []
    for _ in range(RUNS + 1):
        start = time.perf_counter()
        work()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 3)


def stages(spark: SparkSession, folder: str) -> tuple[dict, dict]:
    """Stage times on the largest table as CSV: one-pass form and repeated scans."""
    raw, output, root, plain = (
        paths.scratch(spark, name) for name in ("raw", "output", "published", "plain")
    )
    bindings.lineitem(spark, folder).write.csv(raw, header=True)

    def ingest_repeated() -> None:
        df = read_raw(spark, raw)
        df.drop(CORRUPT).count()
        transactions = cleaning.clean(df)
        transactions.count()
        tables.write(transactions, tables.clean_path(plain))

    def transform_repeated() -> None:
        transactions = tables.read(spark, tables.clean_path(plain))
        built = {name: kpi.build(transactions) for name, kpi in REGISTRY.items()}
        for df in built.values():
            df.count()
        for name, df in built.items():
            tables.write(df, tables.kpi_path(plain, name))

    ours = {
        "stage_ingest_csv": median_seconds(
            lambda: daily.ingest(spark, raw, output, RAW_SCHEMA)
        ),
        "stage_transform": median_seconds(lambda: daily.transform(spark, output)),
        "stage_publish": median_seconds(lambda: daily.publish(spark, output, root)),
    }
    repeated = {
        "stage_ingest_csv": median_seconds(ingest_repeated),
        "stage_transform": median_seconds(transform_repeated),
    }
    return ours, repeated


def main() -> None:
    """Measure and print."""
    conf = {
        "spark.master": f"local[{CPUS}]",
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "4g"),
        "spark.sql.shuffle.partitions": CPUS,
    }
    spark = create_session("txnkpi-bench", conf)
    spark.sparkContext.setLogLevel("ERROR")
    catalog = queries()
    times = {
        name: median_seconds(lambda name=name: consume(catalog[name](spark, FOLDER)))
        for name in HEADLINES
    }
    ours, repeated = stages(spark, FOLDER)
    times |= ours
    rows = spark.read.parquet(f"{FOLDER}/lineitem.parquet").count()
    result = {
        "metric": "total median time of headline queries and stages",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "repeated_scans": repeated,
        "lineitem_rows": rows,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
