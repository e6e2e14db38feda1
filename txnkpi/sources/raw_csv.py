"""Raw transaction CSV files with a header row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DoubleType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

from txnkpi.functions import CORRUPT, REQUIRED

READABLE = (NumericType, StringType)


def _blank(schema: StructType) -> list[int]:
    """Places of columns whose header is blank: Spark names them by their place."""
    return [i for i, name in enumerate(schema.names) if name == f"_c{i}"]


def infer_raw_schema(spark: SparkSession, path: str) -> StructType:
    """Schema of raw CSV files: known columns as double, all others as inferred.

    Pass-through columns need their own types, as they are part of the duplicate key:
    ``1.5`` and ``1.50`` are the same number but different text. Inference parses every
    file once; for large or daily input keep the result (``schema.json()``) and hand it to
    ``read_raw``. Known columns may hold numbers, or text where a few values are no numbers;
    a column of dates or truth values is an error, as every row would count as missing.
    """
    inferred = spark.read.csv(path, header=True, inferSchema=True).schema
    known = {name.lower() for name in REQUIRED}
    for field in inferred:
        if field.name.lower() in known and not isinstance(field.dataType, READABLE):
            kind = field.dataType.simpleString()
            raise TypeError(f"column {field.name} holds {kind} values, not numbers")
    return StructType(
        [
            StructField(f.name, DoubleType()) if f.name.lower() in known else f
            for f in inferred
        ]
    )


def read_raw(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    check_header: bool = True,
) -> DataFrame:
    """Raw transactions plus a ``_corrupt`` column with the text of unreadable rows.

    A value that does not fit its column becomes NULL in that row alone. Without
    ``schema`` (a type or DDL text) the files are parsed a first time to infer it. Header
    names of every file are compared with the schema, so columns in another order fail
    instead of trading places; one blank name, as of a row number, is compared like any
    other. Headers with several blank or repeated names cannot be compared:
    ``check_header=False`` takes all columns by position, and then they must agree.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    schema = schema or infer_raw_schema(spark, path)
    blank = _blank(schema) if check_header else []
    if len(blank) > 1:
        raise ValueError(f"blank header names at places {blank}; see check_header")
    if CORRUPT not in schema.names:
        schema = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    named = [
        StructField("" if i in blank else f.name, f.dataType) for i, f in enumerate(schema)
    ]
    rows = spark.read.csv(
        path,
        schema=StructType(named),
        header=True,
        enforceSchema=not check_header,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT,
    )
    return rows.toDF(*schema.names) if blank else rows
