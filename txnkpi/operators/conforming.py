"""Bring a KPI table to its declared schema before it is published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType


def conform(df: DataFrame, schema: StructType, strict: bool = False) -> DataFrame:
    """Declared columns in declared order and type.

    A column the table lacks becomes NULL; a column the schema does not know is an error,
    as it would be for an INSERT. ``strict`` narrows counts to 32 bits, the width of the
    relational tables, and fails on overflow instead of wrapping around.
    """
    unknown = [name for name in df.columns if name not in schema.names]
    if unknown:
        raise ValueError(f"columns not in the target table: {unknown}")
    columns = []
    for field in schema:
        column = F.col(field.name) if field.name in df.columns else F.lit(None)
        narrow = strict and isinstance(field.dataType, LongType)
        wanted = IntegerType() if narrow else field.dataType
        columns.append(column.cast(wanted).alias(field.name))
    return df.select(*columns)
