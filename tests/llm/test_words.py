from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnkpi.llm.common import ALNUM, SPACE, Words, binned, lower_ascii, unpacked, words

TEXTS = ["a b  a", "", "été a-b A", " \x0bx\x1cy\xa0z\t", "ünï", "a b a"]


@pytest.mark.parametrize(
    "separator, pattern", [(SPACE, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")]
)
def test_words_as_column_and_as_hashes(spark, separator, pattern):
    want = [re.findall(pattern, t) for t in TEXTS]
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    got = df.orderBy("i").select(words(F.col("t"), separator).alias("w")).collect()
    assert [r.w for r in got] == want
    made = Words([t.encode() for t in TEXTS], separator)
    assert made.count.tolist() == [len(w) for w in want]
    flat = [w for ws in want for w in ws]
    assert len({(w, int(h)) for w, h in zip(flat, made.hash)}) == len(set(flat)) == len(set(made.hash.tolist()))
    assert made.place.tolist() == [i for ws in want for i in range(len(ws))]


def test_windows_of_one_document_only():
    made = Words([b"a b c", b"b c", b"a b c d"])
    at, hashes = made.windows(3)
    assert at.tolist() == [0, 5, 6] and hashes[0] == hashes[1] != hashes[2]
    assert len(Words([]).windows(3)[0]) == 0


def test_lower_ascii_leaves_other_letters(spark):
    df = spark.createDataFrame([("ABC xyz",), ("ÉA",), (None,)], "t string")
    assert {r[0] for r in df.select(lower_ascii(F.col("t"))).collect()} == {"abc xyz", "Éa", None}


def test_blocks_round_trip():
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 4, 1000).astype(np.int32)
    key = rng.integers(0, 2**63, 1000, dtype=np.uint64)
    other = rng.integers(-(2**62), 2**62, 1000)
    batch = binned(bins, key, other)
    got = set()
    for b in batch.column("bin").to_pylist():
        mask = [x == b for x in batch.column("bin").to_pylist()]
        k, o = unpacked(batch.filter(mask).column("block"))
        assert (np.diff(k.astype(object)) >= 0).all()
        got |= {(b, int(x), int(y)) for x, y in zip(k, o.view(np.int64))}
    assert got == {(int(b), int(x), int(y)) for b, x, y in zip(bins, key, other)}


def test_hashes_differ_for_many_words():
    rng = random.Random(3)
    vocabulary = {"".join(rng.choices("abcdeéß", k=rng.randint(1, 9))) for _ in range(50_000)}
    made = Words([" ".join(sorted(vocabulary)).encode()])
    assert len(np.unique(made.hash)) == len(vocabulary) == len(np.unique(made.hash >> np.uint64(8)))
