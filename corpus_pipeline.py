"""From raw documents to a training mix: five stages, each written and read again by the next.

Rows that compression bands or the base rules reject go; of near-duplicates one stays; rows
that hold a benchmark passage go; personal data gets surrogates; what is left is mixed to
target weights, a row as often as it is taken (column ``epoch``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txnkpi.llm import compression, decontamination, minhash, mixing, pii
from txnkpi.llm.common import documents, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Rows of this similarity (in percent, five-word shingles) are near-duplicates here.
NEAR = minhash.Settings(percent=80)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return compression.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs, NEAR)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.remove_contaminated(docs, documents(spark, sf_dir, "benchmark"))


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.replace_pii(docs, pii.session_key(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("surrogates", surrogates),
    ("mix_sources", mix_sources),
]

#: SQL has neither zstandard nor keyed surrogates; tests compare run() with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
