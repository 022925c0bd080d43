import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabulon.operators import quantiles as Q


def _linear(vals, p):
    v = sorted(vals)
    h = (len(v) - 1) * p
    lo, hi = v[math.floor(h)], v[math.ceil(h)]
    return lo if lo == hi else lo + (hi - lo) * (h - math.floor(h))


def _lower(vals, p):
    v = sorted(vals)
    return v[max(math.ceil(len(v) * p) - 1, 0)]


def test_exact_matches_numpy_with_ties(spark):
    rng = np.random.default_rng(7)
    xs = np.concatenate([rng.normal(size=3000), np.full(1000, 2.5), rng.integers(0, 5, 500)])
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = Q.quantile_values(df, ["x"], [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0])
    for p in [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]:
        assert got[("x", p)] == pytest.approx(np.percentile(xs, p * 100), rel=1e-12, abs=1e-12)


def _selected(df, col, ranks, bins):
    counts, bounds = Q.column_summary(df, [col])
    return Q.order_statistics(df, {col: set(ranks)}, counts, bounds, bins=bins)


def test_selection_runs_several_rounds(spark):
    rng = np.random.default_rng(3)
    xs = rng.lognormal(size=2000) * 1e6
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = _selected(df, "x", [0, 999, 1500, 1999], bins=4)
    s = sorted(xs)
    for r in (0, 999, 1500, 1999):
        assert got[("x", r)] == s[r]


def test_large_integers_stay_exact(spark):
    base = 9007199254740993
    df = spark.range(20000).selectExpr(f"id + {base} AS n")
    got = Q.exact_values(df, ["n"], [0.0, 0.25, 0.5, 1.0])
    assert [got[("n", p)] for p in (0.0, 0.25, 0.5, 1.0)] == [base, base + 4999, base + 9999, base + 19999]
    ends = spark.createDataFrame([(-2**63,), (-5,), (7,), (2**63 - 1,)], "n long")
    assert list(Q.exact_values(ends, ["n"], [0.25, 0.5, 0.75, 1.0]).values()) == [-2**63, -5, 7, 2**63 - 1]


def test_ranges_wider_than_the_largest_double(spark):
    values = [-1.7e308, -1e-300, 0.0, 3e-310, 5.0, 1e9, 1.7e308]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [_selected(df, "x", [r], bins=4)[("x", r)] for r in range(7)] == values
    mid = Q.quantile_values(spark.createDataFrame([(-1.7e308,), (1.7e308,)], "x double"), ["x"], [0.5])
    assert mid[("x", 0.5)] == 0.0


def test_infinite_order_statistics(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),), (float("inf"),)], "x double")
    assert Q.quantile_values(df, ["x"], [0.75])[("x", 0.75)] == float("inf")
    assert Q.quantile_values(df, ["x"], [0.5])[("x", 0.5)] == float("inf")


def test_nulls_nan_and_infinities(spark):
    rows = [(None,), (float("nan"),), (float("-inf"),), (1.0,), (2.0,), (3.0,), (float("inf"),)]
    df = spark.createDataFrame(rows, "x double")
    got = Q.quantile_values(df, ["x"], [0.0, 0.5, 1.0], "lower")
    # valid values: -inf, 1, 2, 3, inf (NULL and NaN ignored)
    assert got[("x", 0.0)] == float("-inf")
    assert got[("x", 0.5)] == 2.0
    assert got[("x", 1.0)] == float("inf")


def test_empty_and_all_null_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 1.0)], "a double, b double")
    got = Q.quantile_values(df, ["a", "b"], [0.5])
    assert got[("a", 0.5)] is None
    assert got[("b", 0.5)] == 1.0  # constant column
    empty = spark.createDataFrame([], "a double")
    assert Q.quantile_values(empty, ["a"], [0.25])[("a", 0.25)] is None


def test_integer_column(spark):
    df = spark.createDataFrame([(i,) for i in [5, 1, 9, 3, 3, 7]], "n long")
    got = Q.quantile_values(df, ["n"], [0.25, 0.5, 0.75])
    for p in (0.25, 0.5, 0.75):
        assert got[("n", p)] == pytest.approx(_linear([5, 1, 9, 3, 3, 7], p))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60),
       st.sampled_from([0.0, 0.1, 0.33, 0.5, 0.9, 1.0]))
def test_property_against_brute_force(spark, vals, p):
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = Q.quantile_values(df, ["x"], [p], "linear")[("x", p)]
    assert got == pytest.approx(_linear(vals, p))
    got_lower = Q.quantile_values(df, ["x"], [p], "lower")[("x", p)]
    assert got_lower == _lower(vals, p)


def test_approx_within_rank_error(spark):
    xs = list(range(10000))
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = Q.quantile_values(df, ["x"], [0.5], "approx", rel_err=0.01)[("x", 0.5)]
    assert abs(got - 5000) <= 0.01 * 10000 + 1
