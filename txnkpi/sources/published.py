"""Published tables: immutable Parquet folders, put in force together by one small file.

``<root>/<table>/<unique name>`` holds rows that some run wrote; nothing reads a folder for
being there. ``<root>/_commits/commit-000007.json`` names the folders that make up every table
as of the seventh publication, and is put in place whole or not at all, unless there is one.
So readers of a snapshot see all tables of one publication; of two runs that start from the
same publication one wins and the other gets ``PublishConflict``; a run that dies leaves
folders nobody names. Folders are never written over, hence a plan may read what it replaces.

A table may be made of several parts, each a folder of its own. ``write_buckets`` deals rows to
parts by their key, so that an upsert writes only the parts it touches and names the others
again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from txnkpi.operators.publishing import upsert
from txnkpi.sources import paths

COMMITS, PREFIX, SUFFIX = "_commits", "commit-", ".json"
BUCKET = "_bucket"


class PublishConflict(RuntimeError):
    """Another run has published since the snapshot that this one started from."""


@dataclass(frozen=True)
class Table:
    """Folders of a published table, relative to the root, by part; bucketed if it has a key.

    ``version`` is the publication that changed it last. See ``evolving`` for parts of different
    schemas.
    """

    parts: dict[str, str]
    key: str | None = None
    buckets: int = 1
    schema: str | None = None
    version: int = 0
    #: Where parts differ in schema: all of them by id, and the id of each part's.
    schemas: dict[str, str] = field(default_factory=dict)
    part_schemas: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class Snapshot:
    """All published tables as of one publication; version 0 is before the first."""

    version: int = 0
    tables: dict[str, Table] = field(default_factory=dict)


def _commit_path(root: str, version: int) -> str:
    return paths.join(root, COMMITS, f"{PREFIX}{version:06d}{SUFFIX}")


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all publications, in order."""
    names = paths.children(spark, paths.join(root, COMMITS))
    named = (n for n in names if n.startswith(PREFIX) and n.endswith(SUFFIX))
    return sorted(int(n.removeprefix(PREFIX).removesuffix(SUFFIX)) for n in named)


def snapshot(spark: SparkSession, root: str, version: int | None = None) -> Snapshot:
    """The newest publication, or the one asked for."""
    if version is None:
        version = max(versions(spark, root), default=0)
    if version == 0:
        return Snapshot()
    stored = json.loads(paths.read_text(spark, _commit_path(root, version)))
    return Snapshot(version, {name: Table(**table) for name, table in stored["tables"].items()})


def commit(spark: SparkSession, root: str, base: Snapshot, changed: dict[str, Table]) -> int:
    """Put changed tables in force on top of ``base``, all at once; returns the version."""
    version = base.version + 1
    changed = {name: replace(table, version=version) for name, table in changed.items()}
    named = {name: vars(table) for name, table in {**base.tables, **changed}.items()}
    text = json.dumps({"version": version, "tables": named}, indent=1)
    if not paths.create_if_absent(spark, _commit_path(root, version), text):
        raise PublishConflict(f"version {version} of {root} was published by another run")
    return version


def _stored(df: DataFrame, root: str, table: str, *by: str) -> str:
    """Write rows to a folder of their own; returns it relative to the root."""
    folder = paths.join(table, f"data-{uuid.uuid4().hex}")
    path = paths.join(root, folder)
    df.write.mode("error").partitionBy(*by).parquet(path)
    if not paths.finished(df.sparkSession, path):
        raise RuntimeError(
            "no _SUCCESS marker was written: "
            "mapreduce.fileoutputcommitter.marksuccessfuljobs must stay on"
        )
    return folder


def stage(df: DataFrame, root: str, table: str) -> Table:
    """Write a whole table, which ``commit`` then puts in force."""
    return Table({"all": _stored(df, root, table)}, schema=df.schema.json())


def read_table(
    spark: SparkSession, root: str, table: Table | None, schema: StructType
) -> DataFrame:
    """Rows of a table of some snapshot; none if it is not in there."""
    folders = [paths.join(root, folder) for folder in sorted(table.parts.values())] if table else []
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*folders)


def read_published(
    spark: SparkSession, root: str, table: str, schema: StructType, version: int | None = None
) -> DataFrame:
    """A table of the newest publication, or of an earlier one."""
    return read_table(spark, root, snapshot(spark, root, version).tables.get(table), schema)


def current_version(spark: SparkSession, root: str, table: str) -> int | None:
    """The publication that changed a table last, None before the first."""
    now = snapshot(spark, root).tables.get(table)
    return now.version if now else None


def write_version(df: DataFrame, root: str, table: str, base: Snapshot | None = None) -> int:
    """Publish one table; the others stay as they are in ``base``, by default the newest."""
    spark = df.sparkSession
    base = base or snapshot(spark, root)
    return commit(spark, root, base, {table: stage(df, root, table)})


MOST_TRIES = 20


def commit_parts(spark: SparkSession, root: str, part: str, staged: dict[str, Table]) -> int:
    """Add staged tables as a part of each published one, or in place of the part so named.

    Several parts may be added at the same time: one that finds another publication in its way
    is named on top of that.
    """
    for _ in range(MOST_TRIES):
        base = snapshot(spark, root)
        changed = {}
        for name, table in staged.items():
            old = base.tables.get(name)
            parts = {**(old.parts if old else {}), part: table.parts["all"]}
            changed[name] = Table(parts, schema=table.schema)
        try:
            return commit(spark, root, base, changed)
        except PublishConflict:
            continue
    raise PublishConflict(f"{root} was published over {MOST_TRIES} times in a row")


# --- tables in buckets of a key


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_buckets(df: DataFrame, root: str, table: str, key: str, buckets: int) -> Table:
    """Write a whole table dealt to buckets of its key; empty buckets are no part."""
    return _replaced(df, root, table, Table({}, key, buckets, df.schema.json()))


def _replaced(df: DataFrame, root: str, table: str, old: Table) -> Table:
    """The old table with the buckets of ``df`` written anew."""
    dealt = df.withColumn(BUCKET, _bucket(old.key, old.buckets)).repartition(old.buckets, BUCKET)
    folder = _stored(dealt, root, table, BUCKET)
    spark = df.sparkSession
    made = {
        name.split("=")[1]: paths.join(folder, name)
        for name in paths.children(spark, paths.join(root, folder))
        if name.startswith(f"{BUCKET}=")
    }
    return Table({**old.parts, **made}, old.key, old.buckets, old.schema)


def upsert_buckets(
    spark: SparkSession, root: str, name: str, old: Table, batch: DataFrame, schema: StructType
) -> Table:
    """Upsert a written batch into a bucketed table; buckets it does not touch stay as they are.

    At most as many numbers as there are buckets come to the driver. Only the files of touched
    buckets are read.
    """
    touched = batch.select(_bucket(old.key, old.buckets).alias(BUCKET)).distinct()
    parts = {str(row[0]) for row in touched.collect()} & old.parts.keys()
    stale = Table({p: old.parts[p] for p in parts}, old.key, old.buckets)
    merged = upsert(read_table(spark, root, stale, schema), batch, old.key)
    return _replaced(merged, root, name, old)
