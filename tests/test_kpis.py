"""KPIs on hand-made rows, their invariants and the exactness of money sums."""

from __future__ import annotations

import math
from decimal import Decimal
from fractions import Fraction

import pytest
from conftest import DATA
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txnkpi.functions import gathered, money_sums, money_total, with_bands
from txnkpi.functions.money import BAND
from txnkpi.operators import kpis
from txnkpi.operators.cleaning import clean
from txnkpi.plans import bindings
from txnkpi.plans.registry import REGISTRY
from txnkpi.sources.raw_csv import read_raw

CLEAN = (
    "trans_time double, amount double, is_fraud int, trans_hour int, amount_category string"
)


@pytest.fixture(scope="module")
def edge(spark, edge_csv):
    return clean(read_raw(spark, edge_csv))


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_global(edge):
    assert rows(kpis.kpi_global(edge)) == [(10, 7235.31, 723.53, 5000.0, 4, 40.0)]


def test_by_hour(edge):
    assert rows(kpis.kpi_by_hour(edge)) == [
        (-2, 1, 2.68, 2.68, 0, 0.0),
        (0, 6, 6032.66, 1005.44, 4, 66.6667),
        (1, 1, 99.99, 99.99, 0, 0.0),
        (2, 1, 100.0, 100.0, 0, 0.0),
        (23, 1, 999.99, 999.99, 0, 0.0),
    ]


def test_by_amount_category(edge):
    assert rows(kpis.kpi_by_amount_category(edge)) == [
        ("large", 2, 6000.0, 3000.0, 2, 100.0),
        ("medium", 2, 1099.99, 550.0, 0, 0.0),
        ("small", 2, 109.99, 55.0, 1, 50.0),
        ("micro", 4, 25.33, 6.33, 1, 25.0),
    ]


def test_fraud_vs_normal(edge):
    assert sorted(rows(kpis.kpi_fraud_vs_normal(edge))) == [
        (0, 6, 1222.64, 203.77, 2.68, 999.99),
        (1, 4, 6012.68, 1503.17, 2.68, 5000.0),
    ]


def test_top_fraud(edge):
    top = kpis.kpi_top_fraud_amounts(edge).collect()
    assert [r.amount for r in top] == [5000.0, 1000.0, 10.0, 2.675]
    assert [r.amount for r in kpis.kpi_top_fraud_amounts(edge, 2).collect()] == [5000.0, 1000.0]


def test_top_fraud_ties_are_ordered_by_time(spark):
    ties = [(float(t), 5.0, 1, 0, "micro") for t in range(40, 0, -1)]
    df = spark.createDataFrame(ties, CLEAN).repartition(7)
    assert [r.trans_time for r in kpis.kpi_top_fraud_amounts(df).collect()] == [
        float(t) for t in range(1, 21)
    ]


def test_categories_with_equal_totals_are_ordered_by_name(spark):
    df = spark.createDataFrame(
        [(0.0, 5.004, 0, 0, "b"), (0.0, 5.001, 0, 0, "a"), (0.0, 5.003, 0, 0, "c")], CLEAN
    )
    assert [r[0] for r in rows(kpis.kpi_by_amount_category(df))] == ["a", "b", "c"]


def test_empty_input(spark):
    empty = spark.createDataFrame([], CLEAN)
    for source, cells in ((empty, False), (kpis.kpi_cells(empty), True)):
        assert rows(kpis.kpi_global(source, cells)) == [(0, None, None, None, None, None)]
        assert rows(kpis.kpi_by_hour(source, cells)) == []
        assert rows(kpis.kpi_by_amount_category(source, cells)) == []
        assert rows(kpis.kpi_fraud_vs_normal(source, cells)) == []
    assert rows(kpis.kpi_top_fraud_amounts(empty)) == []


@pytest.mark.parametrize("binding", [bindings.events, bindings.customer, bindings.lineitem])
def test_cells_and_direct_kpis_agree(spark, binding):
    transactions = bindings.cleaned(binding, spark, f"{DATA}/sf0.01").checkpoint()
    cells = kpis.kpi_cells(transactions).checkpoint()
    for kpi in REGISTRY.values():
        if kpi.from_cells:
            direct, rolled = kpi.build(transactions), kpi.build(cells, cells=True)
            assert rows(rolled.orderBy(*rolled.columns)) == rows(
                direct.orderBy(*direct.columns)
            )
            assert direct.dtypes == rolled.dtypes


def test_kpi_schemas_are_the_declared_ones(edge):
    for kpi in REGISTRY.values():
        declared = [(f.name, f.dataType.simpleString()) for f in kpi.schema]
        assert kpi.build(edge).dtypes == declared


def test_groups_add_up_to_the_global_kpi(spark):
    suite = kpis.kpi_suite(bindings.cleaned(bindings.events, spark, f"{DATA}/sf0.01"))
    totals = suite.groupBy("kpi").agg(F.sum("nb_transactions"), F.sum("nb_fraud")).collect()
    assert len(totals) == 4
    assert len({tuple(r)[1:] for r in totals}) == 1


def test_result_does_not_depend_on_order_or_partitions(spark):
    transactions = bindings.cleaned(bindings.lineitem, spark, f"{DATA}/sf0.001")
    shuffled = transactions.orderBy(F.rand(3)).repartition(13)
    for kpi in REGISTRY.values():
        first, second = kpi.build(transactions), kpi.build(shuffled)
        assert sorted(rows(first)) == sorted(rows(second))


def test_null_group_is_kept_apart_from_the_global_row(spark):
    df = spark.createDataFrame(
        [(0.0, 5.0, 0, None, "micro"), (0.0, 7.0, 1, 3, "micro")], CLEAN
    )
    suite = kpis.kpi_suite(df)
    assert suite.filter("kpi = 'kpi_by_hour'").count() == 2
    assert suite.filter("kpi = 'kpi_global'").count() == 1


def test_null_amounts_and_classes_are_left_out_of_means(spark):
    df = spark.createDataFrame(
        [(0.0, 4.0, 1, 0, "micro"), (0.0, None, None, 0, "micro"), (None, 8.0, 0, 0, "micro")],
        CLEAN,
    )
    assert rows(kpis.kpi_global(df)) == [(2, 12.0, 6.0, 8.0, 1, 50.0)]


def _total_of(rows):
    banded = with_bands(rows).groupBy(BAND).agg(*money_sums())
    return banded.agg(*gathered()).select(money_total()).first()[0]


def _total(spark, amounts):
    df = spark.createDataFrame([(a,) for a in amounts], "amount double").repartition(3)
    return _total_of(df)


def test_rounding_ties_of_the_mean(spark):
    # The exact mean is 4061.845; a sum of doubles may land on either side of it.
    amounts = [4061.84, 4061.85, 4061.84, 4061.85, 4061.845, 4061.845]
    df = spark.createDataFrame([(0.0, a, 0, 0, "large") for a in amounts], CLEAN)
    assert rows(kpis.kpi_global(df))[0][2] == 4061.85


def test_large_amounts_do_not_overflow(spark):
    # 2 * 10^7 rows of nearly 10^12: more units than a BIGINT holds.
    rows = spark.range(20_000_000).select(F.lit(999_999_999_999.5).alias("amount"))
    total = _total_of(rows)
    assert total == float(Decimal("999999999999.5") * 20_000_000)


def test_no_digit_is_cut(spark):
    fine = spark.range(10_000_000).select(F.lit(4e-7).alias("amount"))
    assert round(_total_of(fine), 9) == 4.0
    exact = spark.range(10_000_000).select(F.lit(1.0000005).alias("amount"))
    assert _total_of(exact) == 10_000_005.0
    large = spark.range(1_000).select(F.lit(1e9 + 0.0004).alias("amount"))
    assert _total_of(large) == math.fsum([1e9 + 0.0004] * 1_000)


def test_amounts_above_10_to_the_12_sum_the_same_in_any_order(spark):
    amount = F.lit(1e12) + F.rand(5) * 1e13 + F.rand(6)
    rows = spark.range(3_300).select(amount.alias("amount")).checkpoint()
    totals = {_total_of(rows.repartition(n)) for n in (1, 2, 3, 7, 13)}
    assert totals == {math.fsum(r.amount for r in rows.collect())}


def test_wide_infinite_and_nan_amounts(spark):
    assert _total(spark, [1e15, 0.25, 0.5]) == 1e15 + 0.75
    assert _total(spark, [-2.5, 1.25]) == -1.25
    assert _total(spark, [-0.1]) == -0.1
    assert _total(spark, [float("inf"), 1.0]) == math.inf
    assert math.isnan(_total(spark, [float("nan"), 1.0]))
    assert _total(spark, [1e300, 1e300]) == 2e300


MANY = settings(
    max_examples=20,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


@MANY
@given(st.lists(st.floats(-1e17, 1e17), min_size=1, max_size=60))
def test_money_sum_of_any_doubles_is_the_rounded_exact_sum(spark, amounts):
    assert _total(spark, amounts) == float(sum(map(Fraction, amounts)))


@MANY
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False), min_size=1, max_size=40))
def test_money_sum_over_all_exponents(spark, amounts):
    exact = sum(map(Fraction, amounts))
    try:
        wanted = float(exact)
    except OverflowError:
        wanted = math.inf if exact > 0 else -math.inf
    assert _total(spark, amounts) == wanted


def test_sums_of_vast_amounts_do_not_depend_on_partitions(spark):
    power = (F.rand(7) * 1900 - 950).cast("int")
    amount = (F.rand(8) - 0.3) * F.pow(F.lit(2.0), power)
    rows = spark.range(20_000).select(amount.alias("amount")).checkpoint()
    totals = {_total_of(rows.repartition(n)) for n in (1, 3, 7, 13)}
    assert totals == {math.fsum(r.amount for r in rows.collect())}


def test_borders_of_bands(spark):
    """Powers of two at which a band ends, their neighbours, and what cancels out."""
    near = [2.0**e for e in range(-1074, 1024, 1) if (e + 4) % 60 in (0, 1, 59) or e % 60 in (53, 54)]
    amounts = [x for v in near for x in (v, math.nextafter(v, 0), math.nextafter(v, math.inf))]
    assert _total(spark, amounts) == float(sum(map(Fraction, amounts)))
    assert _total(spark, [*amounts, *(-x for x in amounts[1:])]) == amounts[0]
    assert _total(spark, [*amounts, *(-x for x in amounts)]) == 0.0
    assert _total(spark, [1.7e308, 1.7e308, -1.7e308]) == 1.7e308
    assert _total(spark, [1.0, 2.0**-53, 2.0**-1074]) == 1.0 + 2.0**-52
    assert _total(spark, [1.0, 2.0**-53]) == 1.0


@MANY
@given(st.lists(st.integers(-(10**13), 10**13), min_size=1, max_size=40), st.integers(2, 6))
def test_money_sum_is_exact(spark, units, places):
    amounts = [float(Decimal(u).scaleb(-places)) for u in units]
    assert abs(_total(spark, amounts) - math.fsum(amounts)) <= 2**-60 * len(amounts)
