"""Source divergence against plain Python, by both ways of counting."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from dataclasses import replace

import pytest
from txnkpi.llm import divergence
from txnkpi.llm.divergence import Settings

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _brute(rows, cfg):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))) for text, lang, source in rows]
    df, used, groups = Counter(), defaultdict(Counter), sorted({d[:2] for d in docs})
    for lang, source, terms in docs:
        df.update((lang, t) for t in set(terms))
        used[lang, source].update(terms)
        used[lang].update(terms)
    out = []
    for lang, source in groups:
        kept = {t for (x, t), n in df.items() if x == lang and n >= cfg.min_docs}

        def shares(key):
            total = sum(used[key][t] for t in kept)
            return {t: 1 + 10**9 * (used[key][t] + 2) // (total + 2 * len(kept)) for t in kept}

        p, apart = shares((lang, source)), lambda x, y: (x - y) ** 2 // (x + y)
        pairs = []
        for x, other in groups:
            if x == lang and other != source:
                q = shares((lang, other))
                pairs.append((other, sum(apart(p[t], q[t]) for t in kept)))
        q = shares(lang)
        terms = [(t, apart(p[t], q[t])) for t in kept if used[lang, source][t] and p[t] > q[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, cfg.top_terms)):
            items = sorted(items, key=lambda i: (-i[1], i[0].encode()))[:most]
            out += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(items)]
    return sorted(out)


def _got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def _rows():
    rng = random.Random(3)
    words = [f"{a}{b}" for a in ("wo", "ß", "É", "Ka") for b in ("", "x", "yz", "日本", "q")]
    rows = [
        (" ".join(rng.choices(words, weights=range(1, 21), k=rng.randint(0, 30))) + "!1", rng.choice(["en", "de:x", "", None]), rng.choice(["s", "t", None, "ü", "z:1"]))
        for _ in range(150)
    ]
    return rows + [(None, "en", "s"), ("word " * 9, "lone", "only"), ("few words", "thin", "a"), ("few words", "thin", "b"), (None, "none", "x")]


@pytest.mark.parametrize("most_terms", [10**6, 0])
@pytest.mark.parametrize("min_docs", [10, 3])
def test_equals_plain_python(spark, tmp_path, most_terms, min_docs):
    """Fitted vocabulary and joined vocabulary give the same rows."""
    cfg = Settings(min_docs=min_docs, most_terms=most_terms)
    df = spark.createDataFrame(_rows(), "text string, lang string, source string").selectExpr("*", "'x' as n", "'y' as p", "'z' as term")
    assert _got(divergence.source_divergence(df, cfg)) == _brute(_rows(), cfg)


def test_odd_tables(spark, edge, empty):
    rows = [(r.text, r.lang, r.source) for r in edge.collect()]
    for cfg in (Settings(), Settings(min_docs=2)):
        assert _got(divergence.source_divergence(edge, cfg)) == _brute(rows, cfg)
    assert divergence.source_divergence(empty).count() == 0


def test_counts_beyond_64_bits(spark):
    """10^9 times a count of 10^12 is no bigint."""
    row = spark.range(1).selectExpr("1000000000000L as n", "3000000000000L as total", "5L as v")
    found = row.select(divergence._share("n", "total")).head()[0]
    assert found == 1 + 10**9 * (10**12 + 2) // (3 * 10**12 + 10)


def test_vectors_are_fitted_unless_the_vocabulary_is_too_large(spark, edge, monkeypatch):
    calls = []
    for name in ("vector_counts", "joined_counts"):
        monkeypatch.setattr(divergence, name, lambda *a, f=getattr(divergence, name), n=name: (calls.append(n), f(*a))[1])
    cfg = Settings(min_docs=2)
    divergence.source_divergence(edge, cfg)
    divergence.source_divergence(edge, replace(cfg, most_bytes=10))
    assert calls == ["vector_counts", "joined_counts"]
