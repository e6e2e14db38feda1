"""Publish KPI tables to a relational database over JDBC.

Spark writes the batch to a staging table in parallel; one short transaction on the
driver's connection then moves it into the target, so no row passes through Python.
The SQL texts are tested; no database was at hand to test the connection itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from txnkpi.operators.publishing import KEEP, checked_rows, replaces

# Column types of the target tables. 64-bit counts keep their width here.
SQL_TYPES = {
    IntegerType(): "INTEGER",
    LongType(): "BIGINT",
    DoubleType(): "FLOAT",
    StringType(): "VARCHAR",
    DateType(): "DATE",
}

# Widths of the text columns.
WIDTHS = {"amount_category": 20, "category": 100, "merchant": 200, "state": 10}


def _sql_type(field: StructField) -> str:
    width = WIDTHS.get(field.name)
    return SQL_TYPES[field.dataType] + (f"({width})" if width else "")


def create_table_sql(table: str, schema: StructType, key: str | None = None) -> str:
    """CREATE TABLE for a KPI; the key column becomes the primary key."""
    columns = [
        f"{f.name} {_sql_type(f)}" + (" PRIMARY KEY" if f.name == key else "")
        for f in schema
    ]
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(columns)})"


def upsert_sql(table: str, staging: str, columns: Sequence[str], key: str) -> list[str]:
    """Statements that upsert a staging table into its target, in standard SQL."""
    changes = ", ".join(f"{name} = s.{name}" for name in columns if name != key)
    values = ", ".join(f"s.{name}" for name in columns)
    return [
        f"MERGE INTO {table} AS t USING {staging} AS s ON t.{key} = s.{key} "
        f"WHEN MATCHED THEN UPDATE SET {changes} "
        f"WHEN NOT MATCHED THEN INSERT ({', '.join(columns)}) VALUES ({values})"
    ]


def refresh_sql(table: str, staging: str, columns: Sequence[str]) -> list[str]:
    """Statements that replace all rows of the target by a staging table."""
    names = ", ".join(columns)
    return [
        f"TRUNCATE TABLE {table}",
        f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}",
    ]


def run_transaction(connection, statements: Sequence[str]) -> None:
    """All statements or none, on a JDBC connection."""
    connection.setAutoCommit(False)
    try:
        for text in statements:
            statement = connection.createStatement()
            statement.execute(text)
            statement.close()
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def _connect(spark: SparkSession, url: str, properties: dict[str, str]):
    jvm = spark._jvm
    options = jvm.java.util.Properties()
    for name, value in properties.items():
        options.setProperty(name, value)
    return jvm.java.sql.DriverManager.getConnection(url, options)


def stage(
    batch: DataFrame, rows: int, url: str, staging: str, properties: dict[str, str]
) -> None:
    """Write a staging table and make sure that it has the batch's number of rows.

    JDBC tasks commit one by one, so a task that runs again after its executor was lost
    can leave its rows twice.
    """
    batch.write.jdbc(url, staging, mode="overwrite", properties=properties)
    staged = batch.sparkSession.read.jdbc(url, staging, properties=properties).count()
    if staged != rows:
        raise RuntimeError(f"{staging} has {staged} rows instead of {rows}; run again")


def publish_jdbc(
    batch: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    key: str | None = None,
    on_empty: str = KEEP,
) -> bool:
    """Upsert by ``key``, or replace all rows without one; False if nothing was to change.

    Each load stages its rows in a table of its own, so loads at the same time do not meet
    before the transaction.
    """
    spark, staging = batch.sparkSession, f"{table}_staging_{uuid.uuid4().hex[:12]}"
    rows = checked_rows(batch, key)
    if not replaces(rows, key, on_empty):
        return False
    if key:
        merge = upsert_sql(table, staging, batch.columns, key)
    else:
        merge = refresh_sql(table, staging, batch.columns)
    create = create_table_sql(table, batch.schema, key)
    try:
        stage(batch, rows, url, staging, properties)
        run_transaction(_connect(spark, url, properties), [create, *merge])
    finally:
        run_transaction(_connect(spark, url, properties), [f"DROP TABLE IF EXISTS {staging}"])
    return True
