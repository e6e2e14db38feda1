"""Fields derived from one transaction row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Exclusive upper bound of each amount bucket, and the last bucket.
AMOUNT_BUCKETS = (("micro", 10), ("small", 100), ("medium", 1000))
TOP_BUCKET = "large"

SECONDS_PER_HOUR = 3600
HOURS_PER_DAY = 24


def trans_hour(seconds: Column) -> Column:
    """Hour of day of an elapsed-seconds column, truncated toward zero.

    A negative time gives an hour in -23..0, which ``gate_clean`` reports.
    """
    return (seconds / SECONDS_PER_HOUR % HOURS_PER_DAY).cast("int")


def amount_category(amount: Column) -> Column:
    """Name of the first bucket whose upper bound lies above the amount."""
    (name, bound), *rest = AMOUNT_BUCKETS
    chain = reduce(
        lambda column, bucket: column.when(amount < bucket[1], bucket[0]),
        rest,
        F.when(amount < bound, name),
    )
    return chain.otherwise(TOP_BUCKET)
