"""The prefix trie against plain Python: odd rows, long conversations, large groups."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from txnkpi.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def _md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def _brute(rows, regraft=True):
    """Nodes by walking every prefix of every conversation."""
    found = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            found[c].append((turn is not None, turn or 0, role or "", _md5(text or ""), text or ""))
    own = {c: [(t[2], t[4]) for t in sorted(ts)] for c, ts in found.items()}
    built = dict(own)
    if regraft:
        for c in own:
            h = zlib.crc32(str(c).encode()) % 6
            base = c - (abs(c) % 100) * (1 if c > 0 else -1)
            built[c] = own.get(base, [])[:h] + own[c][h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids = defaultdict(int)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node, ms in members.items():
        cost = (len(ms) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += cost
            leaves[node[:d]] += node not in kids
    return sorted(
        (
            min(ms), len(node), min(members[node[:-1]]) if node else None, len(ms), kids[node] if node in kids else 0, leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        )
        for node, ms in members.items()
    )


def _got(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(r) for r in df.select(*names).collect())


def _frame(spark, tmp_path, rows):
    path = str(tmp_path / "conversations")
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("pos", "block", "a", "b", "n", "part", "depth", "size", "up", "md5"):
        df = df.withColumn(name, F.lit("other"))
    df.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def _random_rows(seed, convs, words, most):
    rng = random.Random(seed)
    return [
        (c, t, rng.choice(["user", "assistant"]), rng.choice(words))
        for c in convs for t in range(rng.randint(1, most))
    ]


@pytest.mark.parametrize("block", [1, 3, 4])
def test_random_conversations(spark, tmp_path, block):
    rows = _random_rows(5, [*range(0, 40), *range(100, 130), 207, 399, -5, -100, -101], ["a", "b"], 9)
    df = _frame(spark, tmp_path, rows)
    assert _got(trie.prefix_trie(df, block, regraft=True)) == _brute(rows)


def test_odd_rows(spark, tmp_path):
    rows = [
        (None, 1, "user", "no conversation"), (100, None, None, None), (100, None, "user", "x"), (100, 1, "user", "é" * 7),
        (101, 2, "user", "tie"), (101, 2, "user", "tie"), (101, 2, "a", "tie"), (103, 1, None, ""), (103, 1, "", None),
        (250, 1, "user", "base is absent"), (251, 1, "user", "one"), (252, 1, "user", "one"), (253, 1, "user", "long " * 5000),
        *[(c, 1, "user", "x") for c in range(300, 306)],
    ]
    df = _frame(spark, tmp_path, rows)
    assert _got(trie.prefix_trie(df, regraft=True)) == _brute(rows)
    assert _got(trie.prefix_trie(df)) == _brute(rows, regraft=False)
    assert trie.prefix_trie(df.limit(0), regraft=True).count() == 0


def test_long_conversations_go_in_pieces(spark, tmp_path, monkeypatch):
    """Places, digests and sums of conversations over several pieces and range partitions."""
    monkeypatch.setattr(trie, "PIECE", 4)
    same = [(c, t, "user", f"turn {t}") for c in (7, 8, 9) for t in range(90 + c)]
    fork = [(10, t, "user", f"turn {t}" if t < 50 else f"other {t}") for t in range(80)]
    fork += [(11, t, "user", f"turn {t}" if t < 50 else f"other {t}" if t < 70 else "third") for t in range(85)]
    df = _frame(spark, tmp_path, same + fork)
    ordered = trie.turns_in_order(df)
    assert {(r.conv_id, r.pos) for r in ordered.collect()} == {(c, t) for c, t, _, _ in same + fork}
    assert _got(trie.prefix_trie(df)) == _brute(same + fork, regraft=False)


def test_a_chain_of_forks_takes_few_rounds(spark, tmp_path, monkeypatch):
    """Each conversation leaves the one before a turn later: the tree of paths is a chain."""
    rows = [(c, t, "user", f"turn {t}" if t < c else f"own {t}") for c in range(1, 34) for t in range(c + 1)]
    rounds = []
    monkeypatch.setattr(trie, "written", lambda df, name, write=trie.written: (rounds.append(name), write(df, name))[1])
    df = _frame(spark, tmp_path, rows)
    assert _got(trie.prefix_trie(df)) == _brute(rows, regraft=False)
    assert rounds.count("climb") <= 6


def test_ids_that_end_at_one_node_are_hashed_in_chunks(spark):
    rows = [(2, 5, 6, i) for i in range(-40, 1000, 7)] + [(0, 0, 0, 12), (9, 1, 1, 3), (9, 1, 1, 20)]
    df = spark.createDataFrame(rows, "depth bigint, a bigint, b bigint, conv_id bigint").repartition(5)
    found = {tuple(r)[:3]: r.ends_sha256 for r in trie.hashed_ids(df, chunk_ids=10).collect()}
    for node in {r[:3] for r in rows}:
        ids = ",".join(str(i) for i in sorted(r[3] for r in rows if r[:3] == node))
        assert found[node] == hashlib.sha256(ids.encode()).hexdigest()
