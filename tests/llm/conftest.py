"""Rows that every operator must stand: NULLs, empty and long texts, ties, repeats, odd columns."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def _prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    syllables = "th an er on re he in ed nd ha at en es of or nt ea ti to it st".split()
    words = ["".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n)]
    return " ".join(w + (".\n" if i % 12 == 11 else "") for i, w in enumerate(words))


def edge_rows() -> list[tuple]:
    base = _prose(1, 200)
    near = base.replace(base.split()[100], "changed", 1)
    passage = _prose(9, 60)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "b"), (3, near, "en", "a"), (4, None, None, None),
        (5, "", "de", "a"), (6, "   \n\t ", "de", "b"), (7, "one", "en", None), (8, "one", "en", "c"),
        (9, _prose(2, 6000), "en", "a"), (10, "the the the " * 60, "fr", "d"),
        (11, _prose(3, 80) + " " + passage + " " + _prose(4, 70), "en", "e"),
        (12, passage.upper() + " " + _prose(5, 90), "en", "e"), (13, passage, "en", "a"),
        (14, "größe ñandú été " * 12, "es", "a"), (15, _prose(6, 300), "en", "a"),
        (16, "#*$% &|<> 12345 !!", None, "b"), (16, "another text of the same id", None, "b"),
        (17, base, "en", "a"), (17, base, "en", "a"), (None, base, "en", "a"), (None, None, None, None),
    ]
    return [(*r, None if r[1] is None else len(r[1])) for r in rows]


@pytest.fixture(scope="session")
def edge(spark, tmp_path_factory):
    """The rows as a Parquet table over several files, with columns of clashing names."""
    path = str(tmp_path_factory.mktemp("edge") / "documents.parquet")
    df = spark.createDataFrame(edge_rows(), SCHEMA)
    for name in ("n", "key", "value", "size", "n_words", "component", "_id", "hash", "kept", "s", "w"):
        df = df.withColumn(name, F.lit("other"))
    df.repartition(3, "doc_id").write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(edge, spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty") / "documents.parquet")
    edge.limit(0).write.parquet(path)
    return spark.read.schema(edge.schema).parquet(path)
