"""One Spark session and one DuckDB connection per scale factor for all tests."""

from __future__ import annotations

import os
import sys
from functools import cache

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

DATA = "/root/testdata"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("txnkpi-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxMetadataStringLength", "2000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@cache
def duck(scale: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from '{DATA}/{scale}/{table}.parquet'"
        )
    return connection


@pytest.fixture(scope="session")
def edge_csv(tmp_path_factory):
    """The hand-made edge rows as a CSV file."""
    path = tmp_path_factory.mktemp("edge") / "edge.csv"
    path.write_text(EDGE_ROWS)
    return str(path)


EDGE_ROWS = """\
Time,V1,Amount,Class
0,1.5,9.99,0
0,1.5,9.99,0
0,1.6,9.99,0
3599.9,0.1,10.0,1
3600,0.1,99.99,0
7200,0.1,100.0,0
86399,0.1,999.99,0
86400,,1000.0,1
172800,,5000.0,1
172800,,5000.0,1
10,0.2,0,0
10,0.2,-3,0
,0.2,5,0
11,0.2,,0
12,0.2,5,
13,0.2,NaN,0
14,0.2,abc,0
-7200,0.3,2.675,0
-1800,0.3,2.675,1
"""
