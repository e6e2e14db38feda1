"""Run the stages: ``python -m txnkpi {schema,ingest,transform,publish,run}``.

``schema`` prints the inferred schema of the raw files, to be kept and handed to ``ingest``
and ``run`` with ``--schema``, which then parse the files once instead of twice.

Paths come from options or from RAW_DATA_PATH, OUTPUT_PATH and PUBLISH_PATH. The JDBC
options of ``publish`` and ``run`` load the KPI tables into a database as well.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from txnkpi.operators.publishing import CLEAR, KEEP
from txnkpi.operators.quality import enforce
from txnkpi.plans import daily
from txnkpi.plans.registry import REGISTRY
from txnkpi.session import create_session
from txnkpi.sources import jdbc
from txnkpi.sources.raw_csv import infer_raw_schema


def arguments(argv: list[str] | None) -> argparse.Namespace:
    """Parsed command line with every path the stage needs."""
    parser = argparse.ArgumentParser(prog="txnkpi", description=__doc__.splitlines()[0])
    parser.add_argument("stage", choices=["schema", "ingest", "transform", "publish", "run"])
    parser.add_argument("--raw", default=os.getenv("RAW_DATA_PATH"))
    parser.add_argument("--output", default=os.getenv("OUTPUT_PATH"))
    parser.add_argument("--target", default=os.getenv("PUBLISH_PATH"))
    parser.add_argument("--schema", help="file with the raw schema as JSON")
    parser.add_argument(
        "--on-empty", choices=[KEEP, CLEAR], default=KEEP, help="what refreshed tables do"
    )
    parser.add_argument(
        "--strict", action="store_true", help="end with an error if a check fails"
    )
    parser.add_argument("--history", help="folder of past runs' figures")
    parser.add_argument("--run-id", help="name of this run in the history")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-user", default=os.getenv("JDBC_USER"))
    parser.add_argument("--jdbc-driver", default="org.postgresql.Driver")
    args = parser.parse_args(argv)
    needed = {
        "schema": ["raw"],
        "ingest": ["raw", "output"],
        "transform": ["output"],
        "publish": ["output", "target"],
        "run": ["raw", "output", "target"],
    }
    for name in needed[args.stage]:
        if not getattr(args, name):
            parser.error(f"--{name} is required")
    return args


def _load_jdbc(spark: SparkSession, args: argparse.Namespace) -> None:
    properties = {
        "user": args.jdbc_user or "",
        "password": os.getenv("JDBC_PASSWORD", ""),
        "driver": args.jdbc_driver,
    }
    for name, batch in daily.batches_of(spark, args.output).items():
        loaded = jdbc.publish_jdbc(
            batch, args.jdbc_url, name, properties, REGISTRY[name].key, args.on_empty
        )
        print(f"{name}: {'loaded' if loaded else 'empty, left as it was'}")


def _gates(args: argparse.Namespace, gates: dict[str, DataFrame]) -> None:
    """Print what gates report; with ``--strict`` end at the first that has a failed check."""
    for name, report in gates.items():
        failed = enforce(report, name, args.strict)
        print(f"{name}: {', '.join(failed) if failed else 'all checks passed'}")


def run_stage(spark: SparkSession, args: argparse.Namespace) -> None:
    """Run one stage and print what it reports."""
    schema = None
    if args.schema:
        with open(args.schema, encoding="utf-8") as file:
            schema = StructType.fromJson(json.load(file))
    if args.stage == "schema":
        print(infer_raw_schema(spark, args.raw).json())
    elif args.stage == "ingest":
        counts = daily.ingest(spark, args.raw, args.output, schema)
        print(counts)
        _gates(args, {"ingest": daily.check_ingest(spark, counts)})
    elif args.stage == "transform":
        daily.transform(spark, args.output)
        clean, kpis = daily.check_clean, daily.check_kpis
        _gates(args, {"clean": clean(spark, args.output), "kpis": kpis(spark, args.output)})
    elif args.stage == "publish":
        if args.strict:
            _gates(args, {"kpis": daily.check_kpis(spark, args.output)})
        for row in daily.publish(spark, args.output, args.target, args.on_empty):
            print(*row)
    else:
        where = args.raw, args.output, args.target
        past = args.history, args.run_id
        print(daily.run_pipeline(spark, *where, schema, args.strict, args.on_empty, *past))
    if args.jdbc_url and args.stage in ("publish", "run"):
        _load_jdbc(spark, args)


def main(argv: list[str] | None = None) -> None:
    """Command line entry point."""
    args = arguments(argv)
    spark = create_session(f"txnkpi-{args.stage}")
    try:
        run_stage(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
