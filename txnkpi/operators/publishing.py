"""How a new KPI batch meets the table already published."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP, CLEAR = "keep", "clear"


class BatchKeyError(ValueError):
    """A batch whose key column holds NULLs or the same key twice."""


def _key_counts(batch: DataFrame, key: str | None) -> DataFrame:
    """One row: rows of a batch, and its distinct keys (NULL without a key)."""
    keys = F.count_distinct(key) if key else F.lit(None).cast("bigint")
    return batch.agg(F.count(F.lit(1)).alias("rows"), keys.alias("keys"))


def checked_batches(batches: dict[str, tuple[DataFrame, str | None]]) -> dict[str, int]:
    """Rows of batches by name, from (batch, key), after refusing what a primary key would.

    A repeated key would make the outcome depend on row order; NULL is no key. All batches
    are looked at in one job.
    """
    frames = [
        _key_counts(batch, key).select(F.lit(name).alias("name"), "rows", "keys")
        for name, (batch, key) in batches.items()
    ]
    counts = {row.name: row for row in reduce(DataFrame.unionByName, frames).collect()}
    for name, (_, key) in batches.items():
        if key and counts[name].rows != counts[name].keys:
            raise BatchKeyError(f"NULL or repeated values in key column {key!r} of {name}")
    return {name: counts[name].rows for name in batches}


def checked_rows(batch: DataFrame, key: str | None = None) -> int:
    """``checked_batches`` of a single batch."""
    return checked_batches({"batch": (batch, key)})["batch"]


def upsert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """Batch rows replace target rows of equal key; other target rows stay.

    No broadcast is forced: Spark broadcasts the keys when their measured size allows and
    joins by shuffle otherwise. The batch is read twice, so pass a written table.
    """
    stale = target.join(batch.select(key), key, "left_anti").select(*target.columns)
    return stale.unionByName(batch)


def replaces(rows: int, key: str | None, on_empty: str = KEEP) -> bool:
    """Whether a batch of so many rows changes its table.

    An empty batch leaves the old rows in place; ``on_empty="clear"`` empties a table that
    is refreshed. One that is upserted keeps the rows whose keys the batch lacks anyway.
    """
    return rows > 0 or (on_empty == CLEAR and key is None)


def refresh(target: DataFrame, batch: DataFrame, on_empty: str = KEEP) -> DataFrame:
    """The batch replaces the whole target, unless it is empty; see ``replaces``."""
    return batch if replaces(int(not batch.isEmpty()), None, on_empty) else target
