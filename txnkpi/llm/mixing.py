"""Mixing sources to target weights: capped water-filling and seeded repetitions.

Sources share a budget of words by weight. None may be repeated more than ``most_epochs``
times; what a capped source cannot take is shared by weight among the others until no target
is above its cap. A source's target over its size gives whole repetitions of all its rows, and
the rest as one more repetition of a seeded sample: rows in the order of a keyed hash, up to
the row whose middle still lies within the rest.

Native: DataFrame functions only. Rows are summed per source and per bucket of the hash
before anything moves, a source's cut is found inside one of its ``BUCKETS`` buckets, and
texts are never shuffled as long as the table of sources is small.

Defined cases: NULL text has size 0 and is never taken; NULL sources are one source, last in
order. Rows of one id, or without one, are told apart by their text; rows equal in both are
taken alike. If all sizes are 0, all targets are 0. An empty table gives an empty result; further columns are ignored
(``mix_plan``) or kept (``mix``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txnkpi.llm.common import small, written

#: A bucket is the first three hexadecimal digits of a row's hash.
BUCKETS = 16**3


@dataclass(frozen=True)
class Mix:
    weights: tuple[int, ...] = (3, 1, 2)
    budget: float = 1.5
    most_epochs: int = 2
    seed: str = "mix"


def text_size(text: Column) -> Column:
    """Number of words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _source_key(source: Column) -> Column:
    """The source as a name that is never NULL; sorts by code point, NULL last."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("~"))


def _row_hash(row_id: Column, text: Column, seed: str) -> Column:
    """A row's place in its source: by its id, rows of one id by their text."""
    by_id = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(row_id.cast("string"), F.lit(""))))
    return F.concat(by_id, F.lpad(F.hex(F.xxhash64(F.lit(seed), text)), 16, "0"))


def _weighted(sources: DataFrame, mix: Mix) -> DataFrame:
    """Sources with weights that repeat along their order, numbered in parallel."""
    place = Window.partitionBy("part").orderBy("source_key")
    parted = written(
        sources.repartitionByRange("source_key").withColumn("part", F.spark_partition_id()), "sources"
    )
    numbered = parted.withColumn("i", F.row_number().over(place))
    # one row for each partition of the sources
    before = parted.groupBy("part").count().withColumn(
        "before", F.sum("count").over(Window.orderBy("part")) - F.col("count")
    )
    place = (F.col("before") + F.col("i") - 1) % len(mix.weights)
    weights = F.array(*map(F.lit, mix.weights))
    return numbered.join(before, "part").select(
        "source_key", "source_size", F.get(weights, place.cast("int")).cast("bigint").alias("weight")
    )


def water_fill(sources: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Targets for rows (source_key, source_size): what each source gives to the mix.

    The level, words per unit of weight, rises while sources meet their caps; each round is
    one small aggregate over the sources.
    """
    weighted = written(_weighted(sources, mix), "weights")
    cap = F.col("source_size") * mix.most_epochs
    total, weight = weighted.agg(F.sum("source_size"), F.sum("weight")).head()
    budget, capped, capped_weight, level = mix.budget * (total or 0), 0, 0, 0.0
    while weight and capped_weight < weight:
        level = (budget - capped) / (weight - capped_weight)
        full = cap <= F.lit(level) * F.col("weight")
        words, found = weighted.filter(full).agg(F.sum(cap), F.sum("weight")).head()
        if (found or 0) == capped_weight:
            break
        capped, capped_weight = words, found
    target = F.least(cap.cast("double"), F.col("weight") * F.lit(level))
    return weighted.withColumn("target", target)


def _cuts(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Whole repetitions of each source, and the last hash of its fractional one."""
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    shares = targets.withColumn("whole", whole).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size")
    )
    running = Window.partitionBy("source_key").orderBy("bucket")  # at most BUCKETS rows each
    sums = sized.groupBy("source_key", "bucket").agg(F.sum("size").alias("words"))
    sums = sums.withColumn("until", F.sum("words").over(running))
    edge = (
        sums.join(shares, "source_key")
        .filter((F.col("until") - F.col("words") <= F.col("rest")) & (F.col("until") > F.col("rest")))
        .select("source_key", "bucket", "rest", (F.col("until") - F.col("words")).alias("before"))
    )
    inside = Window.partitionBy("source_key", "bucket").orderBy("key", "size")
    cut = (
        sized.join(edge, ["source_key", "bucket"])
        .withColumn("until", F.col("before") + F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("source_key", "bucket")
        .agg(F.max(F.when(F.col("until") - F.col("size") / 2 <= F.col("rest"), F.col("key"))).alias("last"))
        .select("source_key", F.coalesce("last", "bucket").alias("cut"))
    )
    # without an edge the rest exceeds all rows: every hash lies below the mark
    cut = shares.join(cut, "source_key", "left")
    return cut.withColumn("cut", F.coalesce("cut", F.when(F.col("rest") > 0, F.lit("~")).otherwise(F.lit(""))))


def mix_sources(
    docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> tuple[DataFrame, DataFrame]:
    """Sizes of all rows (written once), and the sources with target, whole and cut."""
    key = _row_hash(F.col(id_col), F.col(text_col), mix.seed)
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        _source_key(F.col(source_col)).alias("source_key"),
        text_size(F.col(text_col)).alias("size"),
        key.alias("key"),
    ).withColumn("bucket", F.substring("key", 1, 3))
    sized = written(sized, "sizes")
    sources = sized.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    return sized, written(_cuts(sized, water_fill(sources, mix)), "cuts")


def _repetitions(key: Column) -> Column:
    return F.col("whole") + F.when(key <= F.col("cut"), 1).otherwise(0)


def mix_plan(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: its size, its source's size and target, words taken of it."""
    sized, cuts = mix_sources(docs, mix, id_col, text_col, source_col)
    taken = (F.col("size") * _repetitions(F.col("key"))).cast("bigint")
    return sized.join(small(cuts), "source_key").select(
        "doc_id", "size", "source_size", "target", taken.alias("taken")
    )


def mix(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: every row as often as it is taken, with the number of the repetition.

    Rows without words are not part of it. The column is named ``epoch``; a column of that
    name in ``docs`` is replaced.
    """
    _, cuts = mix_sources(docs, mix, id_col, text_col, source_col)
    cuts = small(cuts.select("source_key", "whole", "cut"))
    key = _row_hash(docs[id_col], docs[text_col], mix.seed)
    times = cuts["whole"] + F.when(key <= cuts["cut"], 1).otherwise(0)
    times = F.when(text_size(docs[text_col]) > 0, times).otherwise(0)
    chosen = docs.join(cuts, _source_key(docs[source_col]) == cuts["source_key"])
    kept = [docs[c] for c in docs.columns if c.lower() != "epoch"]
    epochs = F.when(times > 0, F.sequence(F.lit(1), times.cast("int")))
    return chosen.select(*kept, F.explode(epochs).alias("epoch"))
