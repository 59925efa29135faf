import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from coffer.operators import clv


def test_log_gamma():
    z = np.array([0.05, 0.5, 1.0, 2.0, 3.7, 7.99, 8.0, 40.0, 1e6])
    assert clv._lgamma(z) == pytest.approx([math.lgamma(v) for v in z], rel=1e-12, abs=1e-12)


def test_gauss_series_against_closed_form():
    z = np.array([0.0, 0.1, 0.5, 0.9])
    ones = np.ones_like(z)
    assert clv._hyp2f1(1.0, 1.0, 2 * ones, z)[1:] == pytest.approx(-np.log1p(-z[1:]) / z[1:], rel=1e-10)


def _long_series(a, b, c, z):
    n = np.arange(3_000_000, dtype=np.longdouble)
    return float(1 + np.cumprod((a + n) * (b + n) / ((c + n) * (n + 1)) * np.longdouble(z)).sum())


@pytest.mark.parametrize("a, b, c", [
    (1.5, -0.3, 2.2), (0.8, 0.2, 1.4), (2.526, -0.207, 2.219), (0.5, 0.25, 3.75),  # c - a - b an integer in some
    (3.0, 0.5, 4.5001), (2.4, 0.7, 11.1), (-0.6, -0.9, 0.3), (1.1, 0.4, -0.45),
])
def test_gauss_function_near_one(a, b, c, monkeypatch):
    monkeypatch.setattr(clv, "SERIES_TERMS", 100)
    for z in (0.3, 0.64, 0.66, 0.9, 0.9999):
        assert clv._hyp2f1(a, b, np.array([c]), np.array([z]))[0] == pytest.approx(_long_series(a, b, c, z), rel=1e-10, abs=1e-10)


def test_polygammas():
    z = np.array([0.05, 0.5, 1.0, 3.7, 7.99, 40.0, 1e6])
    h = 1e-5
    first, second = clv._polygammas(z)
    slope = [(math.lgamma(v * (1 + h)) - math.lgamma(v * (1 - h))) / (2 * h * v) for v in z]
    assert first == pytest.approx(slope, rel=1e-6)
    assert first[2] == pytest.approx(-0.5772156649015329, rel=1e-13) and second[2] == pytest.approx(math.pi**2 / 6, rel=1e-13)
    up, down = clv._polygammas(z * (1 + h))[0], clv._polygammas(z * (1 - h))[0]
    assert second == pytest.approx((up - down) / (2 * h * z), rel=1e-6)


@pytest.mark.parametrize("loglik, slopes, point", [
    (clv.purchase_loglik, clv.purchase_derivatives, (0.7, 5.0, 0.9, 2.4)), (clv.spend_loglik, clv.spend_derivatives, (6.0, 3.7, 15.0)),
])
def test_derivatives_against_differences(loglik, slopes, point):
    rng = np.random.default_rng(1)
    least = 1 if len(point) == 3 else 0
    x, age = rng.integers(least, 9, 40).astype(float), rng.uniform(5, 40, 40)
    data = {"x": x, "age": age, "t_x": np.where(x > 0, age * rng.uniform(0, 1, 40), 0.0), "mean_value": rng.gamma(3, 9, 40)}
    first, second = slopes(np.array(point), data)
    for i in range(len(point)):
        h = np.eye(len(point))[i] * 1e-5 * point[i]
        up, down, width = np.array(point) + h, np.array(point) - h, 2e-5 * point[i]
        assert (loglik(up, data) - loglik(down, data)) / width == pytest.approx(first[i], abs=1e-7)
        for j in range(len(point)):
            change = (slopes(up, data)[0][j] - slopes(down, data)[0][j]) / width
            assert change == pytest.approx(second[min(i, j), max(i, j)], abs=1e-7)


def test_fits_end_at_a_flat_point_after_few_passes(spark, monkeypatch):
    passes, totals = [], clv.derivative_totals
    monkeypatch.setattr(clv, "derivative_totals", lambda *args: passes.append(1) or totals(*args))
    data = spark.createDataFrame(_simulated(3000)).withColumn("mean_value", F.col("age") / 3 + F.col("x")).repartition(4).checkpoint()
    for fit, loglik, slopes, columns, rows in (
        (clv.fit_purchases, clv.purchase_loglik, clv.purchase_derivatives, ["x", "t_x", "age"], data),
        (clv.fit_spend, clv.spend_loglik, clv.spend_derivatives, ["x", "mean_value"], data.filter("x > 0")),
    ):
        passes.clear()
        found = fit(data, penalty=0.0)
        assert len(passes) <= 10  # besides one that counts and one that starts
        point = np.array([getattr(found, f) for f in found.__dataclass_fields__])
        _, gradient, _ = totals(rows.withColumn("n", F.lit(1)), columns, loglik, slopes, point[None])
        assert np.abs(gradient[0] * point / rows.count()).max() < 1e-6


def test_expected_purchases_against_the_published_form():
    """The published form has 2F1(r+x, b+x; a+b+x-1; z) times a power; ours is its Euler transform."""
    p = clv.PurchaseParams(0.243, 4.414, 0.793, 2.426)
    x, t_x, age, t = np.array([0.0, 2.0, 5.0]), np.array([0.0, 30.43, 10.0]), np.array([38.86, 38.86, 38.86]), 39.0
    z = t / (p.alpha + age + t)
    series = np.array([clv._hyp2f1(p.r + xi, p.b + xi, np.array([p.a + p.b + xi - 1]), np.array([zi]))[0] for xi, zi in zip(x, z)])
    top = (p.a + p.b + x - 1) / (p.a - 1) * (1 - ((p.alpha + age) / (p.alpha + age + t)) ** (p.r + x) * series)
    below = 1 + np.where(x > 0, p.a / (p.b + np.maximum(x, 1) - 1) * ((p.alpha + age) / (p.alpha + t_x)) ** (p.r + x), 0)
    got = clv.expected_purchases(p, x, t_x, age, t)
    assert got == pytest.approx(top / below, rel=1e-9)
    assert got[1] == pytest.approx(1.226, abs=2e-3)  # worked example of the 2005 paper


def test_large_x_stays_finite():
    p = clv.PurchaseParams(0.5, 3.0, 1.3, 2.0)
    x, t_x, age = np.array([1e6, 1e6]), np.array([99.0, 100.0]), np.array([100.0, 100.0])
    gone, active = clv.expected_purchases(p, x, t_x, age, 24.0)
    assert gone == 0.0  # a million purchases, then a silent week: certainly gone
    assert np.isfinite(active) and active > 100_000


def _simulated(n=4000, seed=11):
    rng = np.random.default_rng(seed)
    rate, drop = rng.gamma(0.8, 1 / 6.0, n), rng.beta(0.9, 2.5, n)
    age = rng.uniform(30, 80, n)
    x, t_x = np.zeros(n), np.zeros(n)
    for i in range(n):
        t = 0.0
        while True:
            t += rng.exponential(1 / rate[i])
            if t > age[i]:
                break
            x[i] += 1
            t_x[i] = t
            if rng.random() < drop[i]:
                break
    return pd.DataFrame({"client_id": np.arange(n), "x": x, "t_x": t_x, "age": age, "mean_value": 1.0})


def test_fit_recovers_simulated_parameters(spark):
    data = _simulated()
    p = clv.fit_purchases(spark.createDataFrame(data), penalty=0.0)
    assert p.r == pytest.approx(0.8, rel=0.2) and p.alpha == pytest.approx(6.0, rel=0.25)
    assert p.a / (p.a + p.b) == pytest.approx(0.9 / 3.4, rel=0.2)


def test_spend_fit_recovers_population_mean(spark):
    rng = np.random.default_rng(5)
    n, p, q, v = 4000, 6.0, 4.0, 15.0
    x = rng.integers(1, 12, n).astype(float)
    nu = rng.gamma(q, 1 / v, n)
    m = rng.gamma(p * x, 1 / (nu * x))
    data = spark.createDataFrame(pd.DataFrame({"x": x, "mean_value": m}))
    got = clv.fit_spend(data, penalty=0.0)
    stable = clv.fit_spend(data, penalty=0.0, stable=True)
    assert (stable.p, stable.q, stable.v) == pytest.approx((got.p, got.q, got.v), rel=0.05)
    assert clv.fit_spend(data, penalty=10.0, stable=True).q > 1
    assert got.v * got.p / (got.q - 1) == pytest.approx(v * p / (q - 1), rel=0.06)


def test_gamma_gamma_mean_is_between_own_and_population(spark):
    params = clv.GammaGammaParams(6.25, 3.74, 15.44)
    df = spark.createDataFrame([(1.0, 20.0), (50.0, 20.0)], "frequency double, mean_value double")
    got = [r["expected_value"] for r in clv.gamma_gamma_mean(df, params).collect()]
    population = params.v * params.p / (params.q - 1)
    assert 20 < got[1] < got[0] < population


def test_lifetime_value_discounts_months(spark):
    p, g = clv.PurchaseParams(0.8, 6.0, 0.9, 2.5), clv.GammaGammaParams(6.25, 3.74, 15.44)
    df = spark.createDataFrame([(1, 3.0, 20.0, 40.0, 30.0)], "client_id int, x double, t_x double, age double, mean_value double")
    row = clv.lifetime_value(df, p, g).first()
    steps = [clv.expected_purchases(p, *(np.array([v]) for v in (3.0, 20.0, 40.0)), clv.WEEKS_PER_MONTH * m)[0] for m in range(1, 7)]
    gains = np.diff([0.0, *steps]) / 1.01 ** np.arange(1, 7)
    assert row["clv"] == pytest.approx(row["expected_value"] * gains.sum(), rel=1e-12)


def test_conventions(spark):
    base = spark.createDataFrame([(1, 4, 400, 14, 140)], "client_id int, frequency int, monetary int, recency int, age_days int")
    paper = clv.model_inputs(base).first()
    stated = clv.model_inputs(base, "reference").first()
    assert (paper["x"], paper["t_x"], paper["age"]) == (3.0, 18.0, 20.0)
    assert (stated["x"], stated["t_x"]) == (4.0, 2.0)
    with pytest.raises(ValueError):
        clv.model_inputs(base, "other")
