"""Published tables whose schema changes from part to part.

Each part is written, and later read, in its own schema; the table's file of names holds all
schemas by id and the schema the table has as of that publication. Reading casts and adds what
a part lacks, so no part is ever rewritten. A schema may gain columns, at the end, and widen
them: to a wider integer, from float or an integer of up to 32 bits to double, to a decimal that
holds all digits of both, from NULLs only to anything. Everything else is a ``SchemaConflict``
before anything is written. Columns that a later part does not have stay, as NULLs.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, NullType, StructField, StructType

from txnkpi.sources import paths, published

#: Fixed order of types, each of which holds every value of those before it.
INTEGERS = ("tinyint", "smallint", "int", "bigint")
FLOATS = ("float", "double")
TO_DOUBLE = (*INTEGERS[:3], *FLOATS)


class SchemaConflict(ValueError):
    """A part whose schema the table cannot take in."""


def schema_id(schema: StructType) -> str:
    """A short name for a schema, the same for equal ones."""
    return hashlib.sha256(schema.json().encode()).hexdigest()[:16]


def wider(first: DataType, second: DataType) -> DataType | None:
    """The type of the two that holds all values of both, if there is one."""
    names = first.simpleString(), second.simpleString()
    if isinstance(second, NullType) or names[0] == names[1]:
        return first
    if isinstance(first, NullType):
        return second
    if isinstance(first, DecimalType) and isinstance(second, DecimalType):
        scale = max(first.scale, second.scale)
        whole = max(first.precision - first.scale, second.precision - second.scale)
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    for order in (INTEGERS, FLOATS):
        if set(names) <= set(order):
            return (first, second)[order.index(names[0]) < order.index(names[1])]
    if "double" in names and set(names) <= set(TO_DOUBLE):
        return (first, second)[names[1] == "double"]
    return None


def merged(old: StructType, new: StructType) -> StructType:
    """The schema of a table of both; an error where a column cannot hold both."""
    fields = {f.name: f.dataType for f in old}
    spelled = {name.lower(): name for name in fields}
    for field in new:
        known = spelled.setdefault(field.name.lower(), field.name)
        if known != field.name:
            raise SchemaConflict(f"columns {known!r} and {field.name!r} differ in case only")
        before = fields.get(field.name, field.dataType)
        found = wider(before, field.dataType)
        if found is None:
            kinds = before.simpleString(), field.dataType.simpleString()
            raise SchemaConflict(f"column {field.name!r} is {kinds[0]} and cannot take in {kinds[1]}")
        fields[field.name] = found
    return StructType([StructField(name, kind) for name, kind in fields.items()])


def _parsed(text: str) -> StructType:
    return StructType.fromJson(json.loads(text))


def add_part(df: DataFrame, root: str, name: str, part: str) -> int:
    """Publish rows as a part of a table, or in place of the part so named, in their own schema.

    Ends with ``PublishConflict`` if another run publishes meanwhile.
    """
    spark = df.sparkSession
    base = published.snapshot(spark, root)
    old = base.tables.get(name, published.Table({}, schema=StructType([]).json()))
    whole = merged(_parsed(old.schema), df.schema)
    ident = schema_id(df.schema)
    staged = published.stage(df, root, name)
    part_schemas = {**old.part_schemas, part: ident}
    every = {**old.schemas, ident: df.schema.json()}
    table = replace(
        old,
        parts={**old.parts, part: staged.parts["all"]},
        schema=whole.json(),
        schemas={i: text for i, text in every.items() if i in part_schemas.values()},
        part_schemas=part_schemas,
    )
    return published.commit(spark, root, base, {name: table})


def read_evolved(
    spark: SparkSession, root: str, name: str, version: int | None = None
) -> DataFrame:
    """All parts in the schema that the table has as of the newest publication or another one.

    One scan per schema, whatever the number of parts; filters and the choice of columns reach
    each of them.
    """
    table = published.snapshot(spark, root, version).tables[name]
    whole = _parsed(table.schema)
    frames = []
    for ident, text in table.schemas.items():
        own = _parsed(text)
        folders = [paths.join(root, f) for p, f in sorted(table.parts.items()) if table.part_schemas[p] == ident]
        rows = spark.read.schema(own).parquet(*folders)
        frames.append(
            rows.select(
                *[
                    (rows[_quoted(f.name)] if f.name in own.names else F.lit(None))
                    .cast(f.dataType)
                    .alias(f.name)
                    for f in whole
                ]
            )
        )
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
