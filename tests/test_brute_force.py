"""Cleaning, KPIs and upsert on random rows against plain Python."""

from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from txnkpi.operators import clean, ingest_report, kpi_by_hour, kpi_cells, upsert
from txnkpi.plans.registry import REGISTRY

RAW = "Time double, Amount double, Class double, shop string"
SETTINGS = settings(
    max_examples=15,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)

# Few values per column, so that copies, ties and gaps are common.
times = st.sampled_from([None, math.nan, math.inf, -7200.0, -1.0, 0.0, 3600.0, 90000.0])
amounts = st.sampled_from([None, math.nan, -1.0, 0.0, 0.005, 9.99, 10.0, 100.0, 1000.005])
classes = st.sampled_from([None, 0.0, 1.0, 0.9, 2.0])
raw_rows = st.lists(
    st.tuples(times, amounts, classes, st.sampled_from(["a", "b"])), max_size=60
)


def missing(value):
    return value is None or math.isnan(value)


def python_clean(rows):
    present = [r for r in rows if not any(missing(v) for v in r[:3])]
    finite = [r for r in present if not math.isinf(r[0])]
    usable = [r for r in finite if r[2] == int(r[2])]
    positive = [r for r in usable if r[1] > 0]
    kept = set(positive)
    out = []
    for time, amount, klass, shop in kept:
        hour = int(math.fmod(time / 3600, 24))
        bucket = next(
            (n for n, top in (("micro", 10), ("small", 100), ("medium", 1000)) if amount < top),
            "large",
        )
        out.append((time, amount, int(klass), shop, hour, bucket))
    counts = {
        "raw_rows": len(rows),
        "corrupt_rows": 0,
        "missing_rows": len(rows) - len(present),
        "endless_time_rows": len(present) - len(finite),
        "odd_class_rows": len(finite) - len(usable),
        "nonpositive_rows": len(usable) - len(positive),
        "duplicate_rows": len(positive) - len(kept),
        "clean_rows": len(kept),
    }
    return sorted(out), counts


def half_up(value, places):
    return float(Decimal(repr(value)).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP))


def python_by_hour(rows):
    out = []
    for hour in sorted({r[4] for r in rows}):
        group = [r for r in rows if r[4] == hour]
        total = float(sum(Decimal(repr(r[1])) for r in group))
        frauds = sum(r[2] for r in group)
        out.append(
            (
                hour,
                len(group),
                half_up(total, 2),
                half_up(total / len(group), 2),
                frauds,
                half_up(frauds / len(group) * 100, 4),
            )
        )
    return out


@SETTINGS
@given(raw_rows)
def test_clean_and_by_hour(spark, rows):
    raw = spark.createDataFrame(rows, RAW).repartition(3)
    wanted, counts = python_clean(rows)
    transactions = clean(raw)
    assert sorted(tuple(r) for r in transactions.collect()) == wanted
    assert ingest_report(raw).first().asDict() == counts
    by_hour = [tuple(r) for r in kpi_by_hour(transactions).collect()]
    assert by_hour == python_by_hour(wanted)
    rolled = kpi_by_hour(kpi_cells(transactions), cells=True)
    assert [tuple(r) for r in rolled.collect()] == by_hour


@SETTINGS
@given(
    st.dictionaries(st.integers(-23, 23), st.integers(0, 9)),
    st.dictionaries(st.integers(-23, 23), st.integers(10, 19)),
)
def test_upsert_is_a_dictionary_update(spark, old, new):
    schema = REGISTRY["kpi_by_hour"].schema

    def table(rows):
        values = [(key, n, 1.0, 1.0, 0, 0.0) for key, n in rows.items()]
        return spark.createDataFrame(values, schema)

    merged = upsert(table(old), table(new), "trans_hour").collect()
    assert {r.trans_hour: r.nb_transactions for r in merged} == {**old, **new}
    assert len(merged) == len({**old, **new})
