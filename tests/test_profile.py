"""Profiles: sketches within their bounds, merging, exact figures, missing values."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from txnkpi.operators import profile
from txnkpi.plans import daily
from txnkpi.sources import tables

KINDS = "n double, i int, s string, `odd.name` bigint, empty double"


def _rows(count, seed=1):
    rng = random.Random(seed)
    return [
        (
            rng.choice([None, math.nan, rng.gauss(0, 5)]),
            rng.randint(0, 300) if i % 3 else None,
            f"t{rng.randint(0, 5000)}",
            rng.randint(-(2**40), 2**40),
            None,
        )
        for i in range(count)
    ]


def _exact(rows, schema_names):
    found = {}
    for i, name in enumerate(schema_names):
        values = [r[i] for r in rows if r[i] is not None]
        numbers = sorted(v for v in values if not isinstance(v, str) and not math.isnan(v))
        cuts = [numbers[math.ceil(q * len(numbers)) - 1] if numbers else None for q in profile.QUARTERS]
        ends = (numbers[0], numbers[-1]) if numbers else (None, None)
        distinct = len({repr(v) for v in values})
        found[name] = (len(values), distinct, ends[0], *cuts, ends[1])
    return found


def _figures(frame):
    return {r["column"]: tuple(r)[1:] for r in frame.collect()}


def test_exact_profile_equals_plain_python(spark):
    rows = _rows(3000)
    df = spark.createDataFrame(rows, KINDS)
    assert _figures(profile.exact_profile(df)) == _exact(rows, df.columns)


def test_sketches_merge_and_stay_within_their_bounds(spark):
    rows = _rows(40_000, 2)
    parts = [spark.createDataFrame(rows[i::3], KINDS).repartition(4) for i in range(3)]
    kept = profile.profile(parts[0]).union(profile.profile(parts[1])).union(profile.profile(parts[2]))
    found, exact = _figures(profile.report(profile.merge(kept))), _exact(rows, parts[0].columns)
    for i, name in enumerate(parts[0].columns):
        got, want = found[name], exact[name]
        assert (got[0], got[2], got[6]) == (want[0], want[2], want[6])
        assert abs(got[1] - want[1]) <= profile.DISTINCT_ERROR * want[1]
        numbers = [r[i] for r in rows if isinstance(r[i], int | float) and not math.isnan(r[i])]
        for cut, share in zip(got[3:6], profile.QUARTERS):
            assert (cut is None) == (not numbers)
            if numbers:
                assert sum(v < cut for v in numbers) <= (share + profile.RANK_ERROR) * len(numbers)
                assert sum(v <= cut for v in numbers) >= (share - profile.RANK_ERROR) * len(numbers)


@pytest.mark.parametrize("share", [0.0, 0.5, 0.999, 1.0])
def test_exact_quantiles_narrow_down(spark, share):
    """Heavy values at both ends and in the middle, and far more values than are looked at."""
    values = [0.0] * 3000 + [5.0] * 2000 + [9.0] * 3000 + [i / 1000 for i in range(9000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    wanted = sorted(values)[max(math.ceil(share * len(values)), 1) - 1]
    assert profile.exact_quantile(df, "v", share, one_by_one=200) == wanted


def test_no_rows(spark):
    empty = spark.createDataFrame([], KINDS)
    nothing = (0, 0, None, None, None, None, None)
    assert set(_figures(profile.report(profile.profile(empty))).values()) == {nothing}
    assert set(_figures(profile.exact_profile(empty)).values()) == {nothing}


def test_an_ingest_that_keeps_rejects_profiles_clean_rows_only(spark, edge_csv, tmp_path):
    schema = "Time double, V1 double, Amount double, Class double"
    figures = []
    for rejects in (False, True):
        output = str(tmp_path / str(rejects))
        daily.ingest(spark, edge_csv, output, schema, rejects=rejects, profiled=True)
        figures.append(_figures(profile.report(daily.read_profile(spark, output))))
    clean = tables.read(spark, tables.clean_path(str(tmp_path / "False")))
    assert figures[0] == figures[1]
    assert figures[0]["amount"][0] == clean.count()
    assert figures[0]["V1"][1] == clean.agg(F.count_distinct("V1")).head()[0]
