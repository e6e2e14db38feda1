"""Targets against plain water-filling, and what is taken against the targets."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from txnkpi.llm import mixing


def _targets(sizes, mix):
    """Sources (in order) with sizes to their targets, one round after another."""
    weights = {s: mix.weights[i % len(mix.weights)] for i, s in enumerate(sizes)}
    budget, open_, target = mix.budget * sum(sizes.values()), set(sizes), {}
    while open_:
        level = (budget - sum(target.values())) / sum(weights[s] for s in open_)
        full = {s for s in open_ if mix.most_epochs * sizes[s] <= level * weights[s]}
        if not full:
            return target | {s: level * weights[s] for s in open_}
        target |= {s: mix.most_epochs * sizes[s] for s in full}
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 500, "c": 20, "d": 3000}, {"a": 100}, {"a": 1, "b": 1, "c": 1}, {"a": 0, "b": 0}, {"a": 0, "b": 7},
    {f"s{i:03}": (i * 37) % 101 for i in range(200)},
])
def test_water_filling(spark, sizes):
    mix = mixing.Mix()
    sources = spark.createDataFrame([("s" + k, v) for k, v in sizes.items()], "source_key string, source_size bigint")
    got = {r.source_key[1:]: r.target for r in mixing.water_fill(sources, mix).collect()}
    want = _targets(dict(sorted(sizes.items())), mix)
    assert got == pytest.approx(want)
    assert sum(got.values()) == pytest.approx(mix.budget * sum(sizes.values()))


def test_what_is_taken_comes_near_the_targets(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.choice([1, 5, 30, 400]), rng.choice(["a"] * 5 + ["b", "c", "d", None])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix_plan(docs).collect()
    assert len(got) == 600 and all(0 <= r.taken <= 2 * r.size and (not r.size or r.taken % r.size == 0) for r in got)
    source = {i: s for i, _, s in rows}
    taken, target = defaultdict(int), {}
    for r in got:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    for s in target:
        assert abs(taken[s] - target[s]) <= 400 / 2 + 1
    assert sorted(got) == sorted(mixing.mix_plan(docs.repartition(7)).collect())
    plan = {r.doc_id: r.taken for r in got}
    times = {r.doc_id: r["count"] for r in mixing.mix(docs).groupBy("doc_id").count().collect()}
    assert times == {i: t // len(rows[i][1].split()) for i, t in plan.items() if t}
    other = mixing.mix_plan(docs, mixing.Mix(seed="other")).collect()
    assert sorted(other) != sorted(got)


def test_odd_rows(edge, empty):
    plan = mixing.mix_plan(edge).collect()
    assert len(plan) == edge.count()
    assert {r.taken for r in plan if r.doc_id in (4, 5, 6)} == {0}
    mixed = mixing.mix(edge)
    assert mixed.columns == [*edge.columns, "epoch"]
    assert mixed.filter("size(split(trim(text), ' ')) < 1 or text is null").count() == 0
    assert {r.epoch for r in mixed.select("epoch").collect()} <= {1, 2}
    assert mixing.mix_plan(empty).count() == mixing.mix(empty).count() == 0
    again = mixing.mix(mixed.withColumn("epoch", F.lit("x")))
    assert dict(again.dtypes)["epoch"] == "int"


def test_rows_without_an_id_are_taken_one_by_one(spark):
    rows = [(None, f"{i} " + "w " * 9, "a") for i in range(100)] + [(1, "w " * 1000, "b"), (2, "w " * 200, "c")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix_plan(docs, mixing.Mix(budget=0.7)).collect()
    of_a = [r for r in got if r.doc_id is None]
    assert abs(sum(r.taken for r in of_a) - of_a[0].target) <= 10 and 0 < of_a[0].target % 1000
