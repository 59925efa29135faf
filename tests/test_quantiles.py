import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from coffer.operators.quantiles import exact_quantiles, quantile_bins

PROBS = [0.0, 0.2, 0.25, 0.5, 0.8, 1.0]


def _cuts(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    return exact_quantiles(df, ["v"], PROBS).first()["v"]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e12, 1e12, allow_nan=False), min_size=1, max_size=60))
def test_same_as_linear_interpolation(spark, values):
    assert _cuts(spark, values) == pytest.approx(np.quantile(values, PROBS).tolist(), rel=1e-12, abs=1e-9)


@pytest.mark.parametrize("values", [
    [7.0], [1.0, 1.0, 1.0, 1.0], [0.0, -0.5, 0.5], [1e-9, 1.0, 1e15], list(range(1000)), [5.0] * 300 + [6.0, 7.0],
])
def test_edges(spark, values):
    assert _cuts(spark, values) == pytest.approx(np.quantile(values, PROBS).tolist(), rel=1e-12)


def test_values_close_together(spark):
    values = (1e6 + np.arange(5000) / 100).tolist()  # all in very few bands
    assert _cuts(spark, values) == pytest.approx(np.quantile(values, PROBS).tolist(), rel=1e-14)


def test_nulls_are_left_out_and_columns_are_independent(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, None), (3.0, 10)], "a double, b int")
    row = exact_quantiles(df, ["a", "b"], [0.5]).first()
    assert row["a"] == [2.0] and row["b"] == [10.0]


def test_empty_input_gives_nulls(spark):
    row = exact_quantiles(spark.createDataFrame([], "a double"), ["a"], [0.5]).first()
    assert row["a"] == [None]


def test_bins_like_qcut(spark):
    rng = np.random.default_rng(3)
    values = np.round(rng.gamma(2.0, 100.0, 200), 2)
    want = pd.qcut(values, 4, labels=["D", "C", "B", "A"]).astype(str)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    got = {r["i"]: r["s"] for r in quantile_bins(df, "v", ["D", "C", "B", "A"], "s").collect()}
    assert [got[i] for i in range(len(values))] == list(want)


def test_bin_edge_belongs_below(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 5)], "v double")
    got = {r["v"]: r["s"] for r in quantile_bins(df, "v", ["D", "C", "B", "A"], "s").collect()}
    assert got == {1.0: "D", 2.0: "D", 3.0: "C", 4.0: "B", 5.0: "A"}


def test_nan_stands_above_all_numbers_and_close_values_are_told_apart(spark):
    df = spark.createDataFrame([(float("nan"),), (-3.0,), (-2.0,), (1.0,), (2.0,), (3.0,), (4.0,)], "v double")
    low, middle, high = exact_quantiles(df, ["v"], [0.0, 0.5, 1.0]).first().v
    assert (low, middle) == (-3.0, 2.0) and high != high
    close = spark.range(50_000).selectExpr("0.5 + id * 1e-12 as v")
    assert exact_quantiles(close, ["v"], [0.5]).first().v[0] == close.selectExpr("percentile(v, 0.5) as p").first().p
