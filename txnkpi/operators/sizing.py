"""Partition sizes that follow the input size.

Cleaning shuffles whole rows once, and a hash aggregate cannot be split by adaptive
execution afterwards, so its number of reducers has to be right beforehand: 200 of them
would get 500 GB each from 100 TB. Too many are merged again by adaptive execution, at no
cost worth mentioning.

A reducer gets 256 MB of input up to 8 TB. Beyond that their number stays at 32,768, since
shuffle blocks (splits x reducers) would become too small to fetch, and each one's share
grows: 3.2 GB at 100 TB. Such a reducer spills and goes on by sorting; see the README for
what that costs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from txnkpi.sources import paths

MiB = 1024**2

REDUCER_BYTES = 256 * MiB
MAX_REDUCERS = 32_768
MAX_SPLITS = 200_000
MAX_SPLIT_BYTES = 512 * MiB

SHUFFLE = "spark.sql.shuffle.partitions"
INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SPLIT = "spark.sql.files.maxPartitionBytes"


def settings_for(
    input_bytes: int, reducers: int, split_bytes: int, wide: bool = True
) -> dict[str, str]:
    """Settings for a stage over this much input; never below the current ones.

    Reducers of a wide stage, one that shuffles whole rows, aim at 256 MB of input each.
    Splits grow only beyond 200,000 of them, and not far: a map task collapses copies in
    memory, and large splits would spill.
    """
    wanted = math.ceil(input_bytes / REDUCER_BYTES) if wide else 0
    split = min(math.ceil(input_bytes / MAX_SPLITS), MAX_SPLIT_BYTES)
    return {
        SHUFFLE: str(max(reducers, min(wanted, MAX_REDUCERS))),
        SPLIT: str(max(split_bytes, split)),
    }


def _bytes(text: str) -> int:
    """Bytes in a setting such as 134217728b, 128MB or 1g."""
    digits = text.strip().lower().removesuffix("b")
    shift = {"k": 10, "m": 20, "g": 30, "t": 40}.get(digits[-1:], 0)
    return int(digits.rstrip("kmgt")) << shift


@contextmanager
def sized_for(spark: SparkSession, input_bytes: int, wide: bool = True) -> Iterator[None]:
    """Apply ``settings_for`` during a block, then restore the session's settings.

    An initial partition number chosen by the user is left alone.
    """
    if spark.conf.get(INITIAL, None):
        yield
        return
    before = {name: spark.conf.get(name) for name in (SHUFFLE, SPLIT)}
    reducers, split = int(before[SHUFFLE]), _bytes(before[SPLIT])
    wanted = settings_for(input_bytes, reducers, split, wide)
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@contextmanager
def sized(raw: DataFrame) -> Iterator[None]:
    """``sized_for`` the files behind a frame of raw rows.

    For actions on frames that are returned lazily, such as ``clean(raw)``: Spark reads the
    number of reducers when a frame is run, so the action goes inside the block.
    """
    with sized_for(raw.sparkSession, paths.text_bytes(raw)):
        yield
