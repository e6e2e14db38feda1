"""Publishing: versions, upsert, refresh, empty batches and refused keys."""

from __future__ import annotations

import os
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest

from txnkpi.operators.conforming import conform
from txnkpi.operators.publishing import (
    CLEAR,
    KEEP,
    BatchKeyError,
    checked_rows,
    refresh,
    replaces,
    upsert,
)
from txnkpi.plans import daily
from txnkpi.plans.registry import DECLARED_ONLY, REGISTRY
from txnkpi.sources import paths, published, tables

BY_CATEGORY = REGISTRY["kpi_by_amount_category"]
CLEAN = (
    "trans_time double, amount double, is_fraud int, trans_hour int, amount_category string"
)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def batch(spark, *keys, n=1):
    values = [(key, n, 1.0, 1.0, 0, 0.0) for key in keys]
    return spark.createDataFrame(values, BY_CATEGORY.schema)


def test_upsert_replaces_adds_and_keeps(spark):
    target, new = batch(spark, "micro", "small"), batch(spark, "small", "large", n=2)
    merged = upsert(target, new, "amount_category")
    assert [(r[0], r[1]) for r in rows(merged)] == [("large", 2), ("micro", 1), ("small", 2)]


def test_upsert_twice_is_upsert_once(spark):
    target, new = batch(spark, "micro", "small"), batch(spark, "small", n=5)
    once = upsert(target, new, "amount_category")
    assert rows(upsert(once, new, "amount_category")) == rows(once)


def test_refused_keys(spark):
    for bad in (batch(spark, "micro", "micro"), batch(spark, "micro", None)):
        with pytest.raises(BatchKeyError):
            checked_rows(bad, "amount_category")
    assert checked_rows(batch(spark, "micro", "small"), "amount_category") == 2
    assert checked_rows(batch(spark, "micro", "micro")) == 2


def test_refresh(spark):
    old, new, none = batch(spark, "micro"), batch(spark, "large"), batch(spark)
    assert rows(refresh(old, new)) == rows(new)
    assert rows(refresh(old, none)) == rows(old)
    assert rows(refresh(old, none, on_empty="clear")) == []


def test_versions_may_read_what_they_replace(spark, tmp_path):
    root, name = str(tmp_path), BY_CATEGORY.name
    assert published.current_version(spark, root, name) is None
    assert rows(published.read_published(spark, root, name, BY_CATEGORY.schema)) == []
    for n in (1, 2, 3):
        target = published.read_published(spark, root, name, BY_CATEGORY.schema)
        merged = upsert(target, batch(spark, f"k{n}", "same", n=n), "amount_category")
        assert published.write_version(merged, root, name) == n
    final = published.read_published(spark, root, name, BY_CATEGORY.schema)
    assert [(r[0], r[1]) for r in rows(final)] == [("k1", 1), ("k2", 2), ("k3", 3), ("same", 3)]


def test_rows_that_no_publication_names_are_ignored(spark, tmp_path):
    root, name = str(tmp_path), BY_CATEGORY.name
    published.write_version(batch(spark, "micro"), root, name)
    published.stage(batch(spark, "dead"), root, name)
    (tmp_path / published.COMMITS / "commit-000009.json.x.tmp").write_text("{")
    assert published.current_version(spark, root, name) == 1
    assert published.write_version(batch(spark, "large"), root, name) == 2
    current = published.read_published(spark, root, name, BY_CATEGORY.schema)
    assert [r[0] for r in rows(current)] == ["large"]
    before = published.read_published(spark, root, name, BY_CATEGORY.schema, version=1)
    assert [r[0] for r in rows(before)] == ["micro"]


def test_a_file_is_created_once(spark, tmp_path):
    path = str(tmp_path / "new" / "file")
    with ThreadPoolExecutor(8) as pool:
        made = list(pool.map(lambda i: paths.create_if_absent(spark, path, f"text {i} é"), range(8)))
    assert sum(made) == 1
    assert paths.read_text(spark, path) == f"text {made.index(True)} é"
    assert os.listdir(tmp_path / "new") in (["file"], ["file", ".file.crc"], [".file.crc", "file"])


def test_of_publishers_at_once_one_wins_and_its_rows_are_whole(spark, tmp_path):
    root = str(tmp_path / "published")

    def publisher(n):
        return published.stage(batch(spark, *(f"{n}-{i}" for i in range(10))).repartition(4), root, BY_CATEGORY.name)

    base = published.snapshot(spark, root)
    staged = [publisher(n) for n in range(4)]

    def commit(table):
        try:
            return published.commit(spark, root, base, {BY_CATEGORY.name: table})
        except published.PublishConflict:
            return None

    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(commit, staged))
    assert sorted(versions, key=str) == [1, None, None, None]
    won = versions.index(1)
    current = published.read_published(spark, root, BY_CATEGORY.name, BY_CATEGORY.schema)
    assert [r[0] for r in rows(current)] == [f"{won}-{i}" for i in range(10)]


def test_a_run_from_an_old_base_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "published")
    first = _output(spark, str(tmp_path / "a"), [(0.0, 5.0, 1, 0, "micro")])
    second = _output(spark, str(tmp_path / "b"), [(3600.0, 70.0, 1, 1, "small")])
    base = published.snapshot(spark, root)
    daily.publish(spark, first, root)
    with pytest.raises(published.PublishConflict):
        daily.publish(spark, second, root, base=base)
    now = published.snapshot(spark, root)
    assert now.version == 1 and set(now.tables) == set(REGISTRY)
    totals = published.read_published(spark, root, "kpi_global", REGISTRY["kpi_global"].schema)
    assert totals.first().total_amount == 5.0


def test_a_reader_sees_all_tables_of_one_run(spark, tmp_path):
    """Each run publishes one amount in all tables; snapshots taken meanwhile never mix them."""
    root = str(tmp_path / "published")
    outputs = [_output(spark, str(tmp_path / str(n)), [(0.0, n + 1.0, 1, 0, "micro")]) for n in range(4)]
    seen, done = [], threading.Event()

    def read():
        while not done.is_set():
            now = published.snapshot(spark, root)
            if now.version:
                names = ("kpi_global", "kpi_by_hour", "kpi_fraud_vs_normal")
                tables_now = [published.read_table(spark, root, now.tables[n], REGISTRY[n].schema) for n in names]
                seen.append({df.first().total_amount for df in tables_now} | {float(now.version)})

    reader = threading.Thread(target=read)
    reader.start()
    for output in outputs:
        daily.publish(spark, output, root)
    done.set()
    reader.join()
    assert seen and all(len(amounts) == 1 for amounts in seen)


def test_upsert_leaves_other_buckets_alone(spark, tmp_path):
    root, name, schema = str(tmp_path), BY_CATEGORY.name, BY_CATEGORY.schema
    keys = [f"k{i}" for i in range(40)]
    old = published.write_buckets(batch(spark, *keys), root, name, "amount_category", 8)
    assert published.commit(spark, root, published.snapshot(spark, root), {name: old}) == 1
    assert old.buckets == 8 and len(old.parts) > 4
    new = batch(spark, "k3", "new", n=7)
    tables.write(new, f"{root}/batch")
    new = tables.read(spark, f"{root}/batch", schema)
    merged = published.upsert_buckets(spark, root, name, old, new, schema)
    same = [p for p in old.parts if merged.parts[p] == old.parts[p]]
    assert len(same) >= len(old.parts) - 2 and merged.parts != old.parts
    published.commit(spark, root, published.snapshot(spark, root), {name: merged})
    current = {r[0]: r[1] for r in rows(published.read_published(spark, root, name, schema))}
    assert current == {**{k: 1 for k in keys}, "k3": 7, "new": 7}


def _output(spark, folder, transactions):
    df = spark.createDataFrame(transactions, CLEAN)
    tables.write(df, tables.clean_path(folder))
    daily.transform(spark, folder)
    return folder


def test_publish_order_modes_and_stale_keys(spark, tmp_path):
    root = str(tmp_path / "published")
    first = _output(
        spark, str(tmp_path / "a"), [(0.0, 5.0, 1, 0, "micro"), (3600.0, 50.0, 0, 1, "small")]
    )
    second = _output(spark, str(tmp_path / "b"), [(3600.0, 70.0, 0, 1, "small")])
    assert daily.publish(spark, first, root) == [
        ("kpi_global", "refresh", 1, 1),
        ("kpi_by_hour", "upsert", 2, 1),
        ("kpi_by_amount_category", "upsert", 2, 1),
        ("kpi_fraud_vs_normal", "upsert", 2, 1),
        ("kpi_top_fraud_amounts", "refresh", 1, 1),
    ]
    # The second day has no fraud: its empty top list leaves the old one in place.
    *_, last = daily.publish(spark, second, root)
    assert last == ("kpi_top_fraud_amounts", "refresh", 0, None)

    def current(name):
        return rows(published.read_published(spark, root, name, REGISTRY[name].schema))

    assert current("kpi_global") == [(1, 70.0, 70.0, 70.0, 0, 0.0)]
    assert [(r[0], r[1], r[2]) for r in current("kpi_by_hour")] == [(0, 1, 5.0), (1, 1, 70.0)]
    assert [r[0] for r in current("kpi_fraud_vs_normal")] == [0, 1]
    assert current("kpi_top_fraud_amounts") == [(0.0, 5.0, "micro", 0)]
    daily.publish(spark, second, root, on_empty="clear")
    assert current("kpi_top_fraud_amounts") == []
    assert [r[0] for r in current("kpi_fraud_vs_normal")] == [0, 1]


def test_refused_batch_stops_all_before_any_is_published(spark, tmp_path):
    root = str(tmp_path / "published")
    folder = _output(spark, str(tmp_path / "a"), [(0.0, 5.0, 1, 0, "micro")])
    broken = tables.kpi_path(folder, "kpi_by_amount_category")
    tables.write(batch(spark, "micro", "micro"), broken)
    with pytest.raises(BatchKeyError):
        daily.publish(spark, folder, root)
    versions = {published.current_version(spark, root, name) for name in REGISTRY}
    assert versions == {None}


def test_one_rule_for_empty_batches():
    for rows, key, on_empty, wanted in (
        (0, None, KEEP, False),
        (0, None, CLEAR, True),
        (0, "k", CLEAR, False),
        (3, "k", KEEP, True),
        (3, None, KEEP, True),
    ):
        assert replaces(rows, key, on_empty) == wanted


def test_conform_orders_casts_and_fills(spark):
    df = spark.createDataFrame([(7, "x")], "nb_transactions int, category string")
    out = conform(df, DECLARED_ONLY["kpi_by_category"])
    assert out.dtypes == [
        ("category", "string"),
        ("nb_transactions", "bigint"),
        ("total_amount", "double"),
        ("nb_fraud", "bigint"),
    ]
    assert rows(out) == [("x", 7, None, None)]


def test_conform_refuses_unknown_columns(spark):
    with pytest.raises(ValueError, match="surprise"):
        conform(spark.createDataFrame([(1,)], "surprise int"), BY_CATEGORY.schema)


def test_strict_conform_fails_on_overflow(spark):
    big = batch(spark, "micro", n=2**31)
    assert conform(big, BY_CATEGORY.schema).first().nb_transactions == 2**31
    with pytest.raises(Exception, match="OVERFLOW"):
        conform(big, BY_CATEGORY.schema, strict=True).collect()
