"""Ingest while finished map outputs vanish; prints what was counted as JSON.

Run by ``test_lost_outputs`` in a process of its own, as it needs its own session. The first
reducer that gets a row removes shuffle files of the stage it reads from, before it passes the
row on. All other reducers come later than that, so some of them always miss their input.
"""

from __future__ import annotations

import glob
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import pandas as pd
from pyspark.sql import functions as F

from txnkpi.operators import cleaning
from txnkpi.plans import bindings, daily
from txnkpi.session import create_session
from txnkpi.sources import tables

THREADS, REDUCERS = 2, 40


def main(work: str, folder: str) -> None:
    """Write clean rows in ``work`` and lose map outputs inside the first reducer."""
    spark = create_session(
        "txnkpi-lost-outputs",
        {
            "spark.master": f"local[{THREADS}]",
            "spark.local.dir": f"{work}/local",
            "spark.sql.shuffle.partitions": str(REDUCERS),
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.files.maxPartitionBytes": "1m",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    rows = bindings.lineitem(spark, folder)
    refunds = rows.withColumn("Amount", -F.col("Amount"))
    rows.unionByName(rows).unionByName(refunds).repartition(16).write.parquet(f"{work}/raw")
    raw = spark.read.parquet(f"{work}/raw")
    wanted = cleaning.ingest_report(raw).first().asDict()

    outputs = f"{work}/local/**/shuffle_*.data"
    old, once = set(glob.glob(outputs, recursive=True)), f"{work}/removed"

    @F.pandas_udf("double")
    def lose(seconds: pd.Series) -> pd.Series:
        try:
            os.close(os.open(once, os.O_CREAT | os.O_EXCL))
        except FileExistsError:
            return seconds
        for path in sorted(set(glob.glob(outputs, recursive=True)) - old)[::2]:
            os.remove(path)
        return seconds

    hour = cleaning.trans_hour  # derived behind the shuffle, hence in the reducers
    cleaning.trans_hour = lambda seconds: hour(lose(seconds))
    spark.sparkContext.setJobGroup("ingest", "ingest")
    found = daily.write_clean(raw, f"{work}/output")
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("ingest")]
    stages = {s for job in jobs for s in job.stageIds}
    infos = [tracker.getStageInfo(s) for s in stages]
    reruns = sum(info.currentAttemptId > 0 for info in infos if info)
    on_disk = tables.read(spark, tables.clean_path(f"{work}/output")).count()
    spark.stop()
    print(json.dumps({"wanted": wanted, "found": found, "rows": on_disk, "reruns": reruns}))


if __name__ == "__main__":
    main(*sys.argv[1:])
