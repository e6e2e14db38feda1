"""A profile of every column as mergeable sketches, gathered in a pass that is made anyway.

``measures`` are aggregates: per column the number of values, a HyperLogLog sketch of distinct
values and, for numbers, a KLL sketch of quantiles with the least and the highest value. They
ride on a write as an observation, some kilobytes a column whatever the rows. Kept profiles of
days or files merge without reading rows again.

Stated errors: a distinct count is off by more than ``DISTINCT_ERROR`` of itself, and the rank
of a quantile by more than ``RANK_ERROR`` of the rows, in fewer than one of a hundred columns.
``exact_profile`` has no error and reads the rows several times.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

LOG_REGISTERS = 12
DISTINCT_ERROR = 3 * 1.04 / math.sqrt(2**LOG_REGISTERS)
QUANTILE_SIZE = 400
RANK_ERROR = 0.01

QUARTERS = (0.25, 0.5, 0.75)
PROFILE = "column string, rows bigint, least double, highest double, distinct_sketch binary, quantile_sketch binary"
REPORT = ("column", "rows", "distinct", "least", "q25", "median", "q75", "highest")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _number(schema: StructType, name: str) -> Column | None:
    """A numeric column as a double, NaN as missing; None for other types."""
    if not isinstance(schema[name].dataType, NumericType):
        return None
    value = F.col(_quoted(name)).cast("double")
    return F.when(~F.isnan(value), value)


def measures(schema: StructType, where: Column | None = None) -> list[Column]:
    """Aggregates of all columns, over the rows that fulfil ``where``."""
    found = []
    where = F.lit(True) if where is None else where
    for i, name in enumerate(schema.names):
        value, number = F.col(_quoted(name)), _number(schema, name)
        there = where & value.isNotNull()
        found += [
            F.count_if(there).alias(f"rows_{i}"),
            F.hll_sketch_agg(F.when(there, F.xxhash64(value)), F.lit(LOG_REGISTERS)).alias(f"distinct_{i}"),
        ]
        if number is not None:
            number = F.when(where, number)
            found += [
                F.min(number).alias(f"least_{i}"),
                F.max(number).alias(f"highest_{i}"),
                F.kll_sketch_agg_double(number, F.lit(QUANTILE_SIZE)).alias(f"quantiles_{i}"),
            ]
    return found


def profile_of(spark: SparkSession, schema: StructType, values: dict[str, object]) -> DataFrame:
    """Measured values as rows, one per column, to be kept and merged."""

    def sketch(name: str) -> bytes | None:
        held = values.get(name)
        return None if held is None else bytes(held)

    rows = [
        (
            name,
            values[f"rows_{i}"],
            values.get(f"least_{i}"),
            values.get(f"highest_{i}"),
            sketch(f"distinct_{i}"),
            sketch(f"quantiles_{i}"),
        )
        for i, name in enumerate(schema.names)
    ]
    return spark.createDataFrame(rows, PROFILE)


def profile(df: DataFrame) -> DataFrame:
    """The profile of a frame, where no pass is made anyway."""
    schema = df.schema
    return profile_of(df.sparkSession, schema, df.agg(*measures(schema)).head().asDict())


def merge(profiles: DataFrame) -> DataFrame:
    """Profiles of several sets of rows as one."""
    return profiles.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        F.min("least").alias("least"),
        F.max("highest").alias("highest"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("quantile_sketch").alias("quantile_sketch"),
    )


def report(profiles: DataFrame) -> DataFrame:
    """Figures out of a profile, one row per column; quantiles are NULL where there are none."""
    sketch = F.when(F.col("least").isNotNull(), F.col("quantile_sketch"))
    cuts = F.kll_sketch_get_quantile_double(sketch, F.array(*map(F.lit, QUARTERS)))
    return profiles.withColumn("cuts", cuts).select(
        "column",
        "rows",
        F.coalesce(F.hll_sketch_estimate("distinct_sketch"), F.lit(0)).cast("bigint").alias("distinct"),
        "least",
        *[F.get("cuts", F.lit(i)).alias(n) for i, n in enumerate(("q25", "median", "q75"))],
        "highest",
    )


#: Distinct values that an exact quantile looks at one by one.
ONE_BY_ONE = 10_000


def exact_quantile(df: DataFrame, name: str, share: float, one_by_one: int = ONE_BY_ONE) -> float | None:
    """The smallest value that at least ``share`` of the values do not exceed; None without any.

    Sketches narrow down an interval around the wanted rank, by a factor of some fifty a round,
    until it holds few distinct values; those are counted. What comes to the driver is bounded,
    and no task holds or sorts a column.
    """
    value = _number(df.schema, name)
    rows = df.select(value.alias("v")).filter(F.col("v").isNotNull())
    total = rows.count()
    if not total:
        return None
    rank = min(max(math.ceil(share * total), 1), total)
    below, inside = 0, rows
    v = F.col("v")
    while True:
        distinct, sketch = inside.agg(
            F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(v))),
            F.kll_sketch_agg_double(v, F.lit(QUANTILE_SIZE)),
        ).head()
        if distinct <= one_by_one:
            break
        here = (rank - below) / inside.count()
        edges = F.array(F.lit(max(here - RANK_ERROR, 0.0)), F.lit(min(here + RANK_ERROR, 1.0)))
        cuts = F.kll_sketch_get_quantile_double(F.lit(bytes(sketch)), edges)
        low, high = df.sparkSession.range(1).select(cuts).head()[0]
        sides = (v < low, v <= low, v < high, v <= high)
        under_low, to_low, under_high, to_high = inside.agg(*map(F.count_if, sides)).head()
        # The edges themselves are left out, so each round has fewer values, whatever the error.
        if rank <= below + under_low:
            inside = inside.filter(v < low)
        elif rank <= below + to_low:
            return low
        elif rank <= below + under_high:
            below, inside = below + to_low, inside.filter((v > low) & (v < high))
        elif rank <= below + to_high:
            return high
        else:
            below, inside = below + to_high, inside.filter(v > high)
    for value, count in inside.groupBy("v").count().orderBy("v").collect():  # few, see above
        below += count
        if below >= rank:
            return value
    raise AssertionError("ranks go up to the number of values")


def exact_profile(df: DataFrame) -> DataFrame:
    """The figures of ``report`` without error, from several passes over each column."""
    spark, schema = df.sparkSession, df.schema
    rows = []
    for name in schema.names:
        value, number = F.col(_quoted(name)), _number(schema, name)
        distinct = df.select(value.alias("v")).groupBy("v").agg(F.count("v").alias("n"))
        counted = distinct.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("v")).head()
        cuts, ends = [None] * len(QUARTERS), (None, None)
        if number is not None:
            ends = tuple(df.agg(F.min(number), F.max(number)).head())
            cuts = [exact_quantile(df, name, q) for q in QUARTERS]
        rows.append((name, counted[0], counted[1], ends[0], *cuts, ends[1]))
    kinds = ("string", "bigint", "bigint", *["double"] * 5)
    return spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(REPORT, kinds)))
