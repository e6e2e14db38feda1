"""Quotation links and backoff scores against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest

from tests.conftest import DATA
from txnkpi.llm import backoff, quotations
from txnkpi.llm.common import LOWER, UPPER

PREFIX = re.compile(r"^(?:[ \t]*>)+")
ANNOUNCED = re.compile(r"(?i)^[ \t]*(?:on|am|le|el)\b.*(?:wrote|schrieb|écrit|escribió)\b.*:[ \t\r]*$")


def _parse(text):
    out = []
    for line in text.split("\n"):
        prefix = PREFIX.match(line)
        level = prefix[0].count(">") if prefix else 0
        body = " ".join(re.findall(r"[^\W_]+", (line[prefix.end():] if prefix else line).lower()))
        out.append((level, body, line))
    return out


def _threads(rows):
    """(conv, turn, role, own, quoted, deepest, parent, root, depth) of rows (conv, turn, role, text)."""
    holds = defaultdict(list)
    for conv, turn, _, text in rows:
        for level, body, _ in _parse(text or ""):
            if level == 0 and body and conv is not None and turn is not None:
                holds[conv, body].append(turn)
    parent = {}
    lines = defaultdict(list)
    for conv, turn, _, text in rows:
        lines[conv, turn] += _parse(text or "")
    for (conv, turn), parsed in lines.items():
        votes = Counter()
        for level, body, _ in parsed:
            before = [t for t in holds[conv, body] if level and t < turn] if turn is not None else []
            if before:
                votes[level, max(before)] += 1
        if votes:
            low = min(level for level, _ in votes)
            parent[conv, turn] = max((n, t) for (level, t), n in votes.items() if level == low)[1]
    out = []
    for conv, turn, role, text in rows:
        parsed = _parse(text or "") if text is not None else []
        own = [
            line for i, (level, _, line) in enumerate(parsed)
            if level == 0 and not (ANNOUNCED.match(line) and i + 1 < len(parsed) and parsed[i + 1][0] > 0)
        ]
        quoted = [level for level, body, _ in parsed if body]
        root, depth = turn, 0
        while (conv, root) in parent:
            root, depth = parent[conv, root], depth + 1
        out.append((conv, turn, role, None if text is None else "\n".join(own).strip(" "), sum(x > 0 for x in quoted), max(quoted, default=0), parent.get((conv, turn)), root, depth))
    return sorted(out, key=repr)


MAIL = [
    (1, 0, "a", "Hello there.\nShall we meet on Monday?\nThe usual place"),
    (1, 1, "b", "On Friday, Ann wrote:\n> Shall we meet on MONDAY\n>The usual  place?\nYes.\nAt nine"),
    (1, 2, "c", "> > The usual place\n> At nine\nLate for me"),
    (1, 3, "a", ">> The usual place\nonly a nested quote"),
    (1, 4, "b", "> nobody said this\nnor that"), (1, 5, "c", "> Late for me\n> Late for me\nSorry"),
    (1, 6, "a", "> At nine\n> Late for me\ntie"), (2, 0, "a", "> Hello there.\nother conversation"),
    (2, 1, "b", "> later"), (2, 2, "a", "later"), (3, 0, None, None), (3, 1, "b", ""), (3, 1, "b", ""),
    (None, 0, "a", "> Hello there."), (4, None, "a", "> x\nx"), (5, 0, "a", ">\n> ...\n---"),
    (6, 0, "a", "deep"), (6, 1, "b", "> " * 9_000 + "deep"),
]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_threads_of_mails(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    assert _rows(quotations.link_quotations(spark.createDataFrame(MAIL, schema))) == _threads(MAIL)
    assert quotations.link_quotations(spark.createDataFrame([], schema)).count() == 0


def test_long_and_random_threads(spark):
    rng = random.Random(3)
    rows = [(0, i, "a", (f"> line {i - 1}\n" if i else "") + f"line {i}") for i in range(70)]
    for conv in range(1, 12):
        said = []
        for turn in range(12):
            own = [f"c{conv} t{turn} l{j} {rng.randint(0, 3)}" for j in range(3)] + ["thanks"]
            quotes = [("> " * rng.randint(1, 3)) + x for x in rng.sample(said, min(len(said), rng.randint(0, 3)))]
            said += own
            rows.append((conv, turn, rng.choice("ab"), "\n".join(quotes + own)))
    docs = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert _rows(quotations.link_quotations(docs)) == _threads(rows)


WRAPPED = [
    (1, 0, "a", "We should move the whole archive to the new machine before the end of the month.\nThe old one is failing and nobody has spare parts.\nThanks"),
    (1, 1, "b", "Something else was said by me here about lunch and tea.\nThanks"),
    # wrapped anew, and words pushed to the next line
    (1, 2, "c", "> We should move the whole archive to the\n> new machine before the end of the month. The\n> old one is failing and nobody has\n> spare parts.\nI agree with this plan and will help you."),
    # part of a line
    (1, 3, "a", "On Monday, b wrote:\n> was said by me here about\nAbout what?"),
    # nearer quote wrapped anew, farther one whole
    (1, 4, "b", "> I agree with this plan\n> and will help you.\n>> The old one is failing and nobody has spare parts.\nFine"),
    # lines joined, beside a whole line that others hold too
    (1, 5, "c", "> Thanks\n> The old one is failing and\n> nobody has spare parts.\nNo"),
    (1, 6, "a", "> words that nobody in this place has ever said\n> at all\nHm"),
    (2, 0, "a", "> We should move the whole archive to the\nother conversation"),
    (2, 1, "b", "> said later by the\n> next message of all"), (2, 2, "a", "said later by the next message of all"),
]


def test_rewrapped_and_partial_quotes(spark):
    docs = spark.createDataFrame(WRAPPED, "conv_id bigint, turn bigint, role string, text string")
    got = {(r.conv_id, r.turn): (r.parent_turn, r.root_turn, r.depth) for r in quotations.link_quotations(docs).collect()}
    assert got == {
        (1, 0): (None, 0, 0), (1, 1): (None, 1, 0), (1, 2): (0, 0, 1), (1, 3): (1, 1, 1), (1, 4): (2, 0, 2),
        (1, 5): (0, 0, 1), (1, 6): (None, 6, 0), (2, 0): (None, 0, 0), (2, 1): (None, 1, 0), (2, 2): (None, 2, 0),
    }


def test_all_conversations(spark):
    table = spark.read.parquet(f"{DATA}/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert _rows(quotations.link_quotations(table)) == _threads(rows)


def _scores(rows, alpha=0.4):
    table = str.maketrans(UPPER, LOWER)
    texts = defaultdict(list)
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(table))
        if words:
            texts[i].append([None, *words, ""])
    uses, pairs, holders, total, single = Counter(), Counter(), defaultdict(set), 0, Counter()
    for i, own in texts.items():
        for t in own:
            for a, b in zip(t, t[1:]):
                uses[a] += 1
                pairs[a, b] += 1
                single[b] += 1
                holders[a, b].add(i)
                total += 1
    out = {}
    for i, own in texts.items():
        bits = known = n = 0
        for t in own:
            for a, b in zip(t, t[1:]):
                seen = len(holders[a, b]) > 1
                bits -= math.log2(pairs[a, b] / uses[a] if seen else alpha * single[b] / total)
                known += seen
                n += 1
        out[i] = (n - 1, known, bits / n)
    return out


@pytest.mark.parametrize("cfg", [
    backoff.Settings(), backoff.Settings(group=50, frequent=20), backoff.Settings(group=300, frequent=0), backoff.Settings(group=2000, frequent=100),
])
def test_scores_are_those_of_plain_python(spark, edge, cfg):
    """Small settings bring rare words, many bins and pairs counted beforehand into play."""
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    want, got = _scores(rows), backoff.backoff_scores(edge, cfg).collect()
    assert len(got) == len(rows)
    for r in got:
        n, known, bits = want.get(r.doc_id, (0, 0, None))
        assert (r.n_words, r.n_known) == (n, known)
        assert r.bits_per_word is None if bits is None else abs(r.bits_per_word - bits) < 1e-5


def test_no_texts(empty):
    assert backoff.backoff_scores(empty).count() == 0
