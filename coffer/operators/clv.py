"""Customer lifetime value: BG/NBD purchase model and gamma-gamma spend model.

Models: Fader, Hardie and Lee (2005), "Counting your customers the easy way"; Fader and Hardie (2013), gamma-gamma.
The data stays in Spark: a fit sums log-likelihoods over partitions, for a batch of parameter points per job, and only
those sums (a few dozen numbers) come to the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coffer.operators.quantiles import quantile_bins
from coffer.session import ensure_checkpoint_dir

# Weeks per month, months of the value horizon, discount per month, penalties.
WEEKS_PER_MONTH = 4.345
VALUE_MONTHS = 6
MONTHLY_DISCOUNT = 0.01
PURCHASE_PENALTY = 0.001
SPEND_PENALTY = 0.01
HORIZON_WEEKS = (12.0, 24.0)
SEGMENTS = ("D", "C", "B", "A")
SERIES_TERMS = 2_000


@dataclass(frozen=True)
class PurchaseParams:
    """BG/NBD: purchase rate is gamma(r, alpha), drop-out probability is beta(a, b)."""

    r: float
    alpha: float
    a: float
    b: float


@dataclass(frozen=True)
class GammaGammaParams:
    p: float
    q: float
    v: float


# -- inputs ------------------------------------------------------------------------------------------------------------


def clv_inputs(base: DataFrame) -> DataFrame:
    """Model table in the stated convention: all purchases counted, recency since the last one, weeks, mean value.

    Clients with less than one week of age, one week of recency, one purchase or a mean value of 1 are left out.
    """
    return base.select(
        "client_id",
        "frequency",
        "monetary",
        (F.col("age_days") / 7).alias("t_weekly"),
        (F.col("recency") / 7).alias("recency_weekly"),
        (F.col("monetary").cast("double") / F.col("frequency")).alias("mean_value"),
    ).filter(
        (F.col("t_weekly") >= 1) & (F.col("recency_weekly") >= 1) & (F.col("frequency") >= 1) & (F.col("mean_value") >= 1)
    )


def model_inputs(base: DataFrame, convention: str = "paper") -> DataFrame:
    """x, t_x, age (weeks) and mean value as the models take them.

    ``paper``: x counts repeat purchases and t_x is the age at the last one. ``reference``: x counts all purchases and
    t_x is the time since the last one.
    """
    inputs = clv_inputs(base)
    if convention == "reference":
        x, t_x = F.col("frequency"), F.col("recency_weekly")
    elif convention == "paper":
        x, t_x = F.col("frequency") - 1, F.col("t_weekly") - F.col("recency_weekly")
    else:
        raise ValueError(f"unknown convention {convention!r}")
    return inputs.select(
        "client_id", x.cast("double").alias("x"), F.greatest(t_x, F.lit(0.0)).alias("t_x"),
        F.col("t_weekly").alias("age"), "mean_value",
    )


# -- fitting -----------------------------------------------------------------------------------------------------------


def _lgamma(z: np.ndarray) -> np.ndarray:
    """Log gamma for positive arrays: shifted above 8, then Stirling's series."""
    z = np.asarray(z, dtype=float)
    shift = np.zeros_like(z)
    w = z.copy()
    for _ in range(8):
        low = w < 8
        shift = np.where(low, shift + np.log(np.where(low, w, 1.0)), shift)
        w = np.where(low, w + 1, w)
    inv = 1 / w
    inv2 = inv * inv
    series = inv * (1 / 12 - inv2 * (1 / 360 - inv2 * (1 / 1260 - inv2 * (1 / 1680 - inv2 / 1188))))
    return (w - 0.5) * np.log(w) - w + 0.5 * np.log(2 * np.pi) + series - shift


def _polygammas(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of log gamma for positive arrays, the same way."""
    w = np.array(z, dtype=float)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for _ in range(8):
        low = w < 8
        inv = np.where(low, 1 / np.where(low, w, 1.0), 0.0)
        first, second, w = first - inv, second + inv * inv, np.where(low, w + 1, w)
    inv = 1 / w
    i2 = inv * inv
    tail = i2 * (1 / 12 - i2 * (1 / 120 - i2 * (1 / 252 - i2 * (1 / 240 - i2 * (1 / 132 - i2 * (691 / 32760 - i2 / 12))))))
    slope = i2 * (1 / 6 - i2 * (1 / 30 - i2 * (1 / 42 - i2 * (1 / 30 - i2 * (5 / 66 - i2 * (691 / 2730 - i2 * 7 / 6))))))
    return first + np.log(w) - 0.5 * inv - tail, second + inv * (1 + 0.5 * inv + slope)


def purchase_loglik(params: np.ndarray, data: dict[str, np.ndarray]) -> np.ndarray:
    r, alpha, a, b = params
    x, t_x, age = data["x"], data["t_x"], data["age"]
    rate = _lgamma(r + x) - _lgamma(np.array([r])) + r * np.log(alpha)
    drop = _lgamma(np.array([a + b])) + _lgamma(b + x) - _lgamma(np.array([b])) - _lgamma(a + b + x)
    alive = -(r + x) * np.log(alpha + age)
    gone = np.log(a) - np.log(b + np.maximum(x, 1) - 1) - (r + x) * np.log(alpha + t_x)
    return rate + drop + np.where(x > 0, np.logaddexp(alive, gone), alive)


def spend_loglik(params: np.ndarray, data: dict[str, np.ndarray]) -> np.ndarray:
    p, q, v = params
    x, m = data["x"], data["mean_value"]
    return (
        _lgamma(p * x + q) - _lgamma(p * x) - _lgamma(np.array([q])) + q * np.log(v)
        + (p * x - 1) * np.log(m) + p * x * np.log(x) - (p * x + q) * np.log(x * m + v)
    )


# Derivatives of the log-likelihood per row by parameter: a list of first ones, and second ones by pair (i <= j). A pair that
# is left out is zero.
Derivatives = tuple[list[np.ndarray], dict[tuple[int, int], np.ndarray]]


def purchase_derivatives(params: np.ndarray, data: dict[str, np.ndarray]) -> Derivatives:
    """By r, alpha, a, b. The sum of the alive and the gone case is weighted by their shares."""
    r, alpha, a, b = params
    x, t_x, age = data["x"], data["t_x"], data["age"]
    n, then, now, left = r + x, alpha + t_x, alpha + age, b + np.maximum(x, 1) - 1
    alive = -n * np.log(now)
    gone = np.where(x > 0, np.log(a) - np.log(left) - n * np.log(then), -np.inf)
    is_alive = np.exp(alive - np.logaddexp(alive, gone))
    is_gone = 1 - is_alive
    zero = np.zeros_like(x)
    by_alive = [-np.log(now), -n / now, zero, zero]
    by_gone = [-np.log(then), -n / then, zero + 1 / a, -1 / left]
    (r_n, r_n2), (r_0, r_02) = _polygammas(n), _polygammas(np.array([r]))
    (s_0, s_02), (s_n, s_n2) = _polygammas(np.array([a + b])), _polygammas(a + b + x)
    (b_n, b_n2), (b_0, b_02) = _polygammas(b + x), _polygammas(np.array([b]))
    first = [r_n - r_0 + np.log(alpha), zero + r / alpha, s_0 - s_n, s_0 - s_n + b_n - b_0]
    first = [f + is_alive * u + is_gone * w for f, u, w in zip(first, by_alive, by_gone)]
    second = {
        (0, 0): r_n2 - r_02, (0, 1): 1 / alpha - is_alive / now - is_gone / then,
        (1, 1): -r / alpha**2 + is_alive * n / now**2 + is_gone * n / then**2,
        (2, 2): s_02 - s_n2 - is_gone / a**2, (2, 3): s_02 - s_n2, (3, 3): s_02 - s_n2 + b_n2 - b_02 + is_gone / left**2,
    }
    spread = [u - w for u, w in zip(by_alive, by_gone)]
    both = is_alive * is_gone
    return first, {(i, j): second.get((i, j), zero) + both * spread[i] * spread[j] for i in range(4) for j in range(i, 4)}


def spend_derivatives(params: np.ndarray, data: dict[str, np.ndarray]) -> Derivatives:
    """By p, q, v."""
    p, q, v = params
    x, m = data["x"], data["mean_value"]
    whole = x * m + v
    (a1, a2), (b1, b2), (c1, c2) = _polygammas(p * x + q), _polygammas(p * x), _polygammas(np.array([q]))
    first = [x * (a1 - b1 + np.log(m) + np.log(x) - np.log(whole)), a1 - c1 + np.log(v) - np.log(whole), q / v - (p * x + q) / whole]
    return first, {
        (0, 0): x * x * (a2 - b2), (0, 1): x * a2, (0, 2): -x / whole, (1, 1): a2 - c2, (1, 2): 1 / v - 1 / whole,
        (2, 2): -q / v**2 + (p * x + q) / whole**2,
    }


LogLik = Callable[[np.ndarray, dict[str, np.ndarray]], np.ndarray]


def loglik_totals(data: DataFrame, columns: Sequence[str], loglik: LogLik, points: np.ndarray) -> DataFrame:
    """Weighted log-likelihood of each parameter point (point, total): one job, partition sums added up by Spark."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(len(points))
        for batch in batches:
            arrays = {c: batch[c].to_numpy(dtype=float) for c in columns}
            weight = batch["n"].to_numpy(dtype=float)
            for i, point in enumerate(points):
                sums[i] += float(np.sum(weight * loglik(point, arrays)))
        yield pd.DataFrame({"point": np.arange(len(points)), "total": sums})

    parts = data.mapInPandas(partial, "point long, total double")
    return parts.groupBy("point").agg(F.sum("total").alias("total"))


Slopes = Callable[[np.ndarray, dict[str, np.ndarray]], Derivatives]


def derivative_totals(
    data: DataFrame, columns: Sequence[str], loglik: LogLik, slopes: Slopes, points: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted log-likelihood, gradient and Hessian at each parameter point: one job. A task sends its sums."""
    dim = points.shape[1]
    pairs = [(i, j) for i in range(dim) for j in range(i, dim)]
    terms = 1 + dim + len(pairs)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((len(points), terms))
        for batch in batches:
            arrays = {c: batch[c].to_numpy(dtype=float) for c in columns}
            weight = batch["n"].to_numpy(dtype=float)
            for k, point in enumerate(points):
                first, second = slopes(point, arrays)
                rows = [loglik(point, arrays), *first, *[second[pair] for pair in pairs]]
                sums[k] += [float(np.sum(weight * row)) for row in rows]
        yield pd.DataFrame({"place": np.arange(sums.size), "total": sums.ravel()})

    summed = data.mapInPandas(partial, "place long, total double").groupBy("place").agg(F.sum("total").alias("total"))
    found = np.zeros(len(points) * terms)
    for row in summed.collect():  # a few dozen
        found[row["place"]] = row["total"]
    found = found.reshape(len(points), terms)
    hessians = np.zeros((len(points), dim, dim))
    for k, (i, j) in enumerate(pairs):
        hessians[:, i, j] = hessians[:, j, i] = found[:, 1 + dim + k]
    return found[:, 0], found[:, 1:1 + dim], hessians


#: Step lengths that one job tries.
STEP_LENGTHS = np.array([1.0, 0.5, 0.2, 0.05])


def maximise(
    data: DataFrame, columns: Sequence[str], loglik: LogLik, slopes: Slopes, starts: Sequence[Sequence[float]], weight: float,
    penalty: float, floor: Sequence[float] | None = None, tolerance: float = 1e-7, max_steps: int = 60,
) -> np.ndarray:
    """Parameters (all above ``floor``, zero by default) with the lowest penalised mean negative log-likelihood.

    Newton steps on the logs of the parameters less their floor, from exact derivatives. Each step is one job: it takes the
    derivatives at all its step lengths, so the best of them is where the next step begins; the first takes them at all
    ``starts``. ``data`` has the columns and a
    count ``n``; ``weight`` is its sum. Ends where no entry of the gradient passes ``tolerance``; raises where
    ``max_steps`` do not get there.
    """
    dim = len(starts[0])
    least = np.zeros(dim) if floor is None else np.asarray(floor, dtype=float)

    def evaluated(thetas: np.ndarray) -> list[tuple[float, np.ndarray, np.ndarray]]:
        above = np.exp(thetas)
        points = least + above
        values, gradients, hessians = derivative_totals(data, columns, loglik, slopes, points)
        out = []
        for k in range(len(points)):
            slope = (-gradients[k] / weight + 2 * penalty * points[k]) * above[k]
            curve = (-hessians[k] / weight + 2 * penalty * np.eye(dim)) * np.outer(above[k], above[k]) + np.diag(slope)
            out.append((-values[k] / weight + penalty * float(np.sum(points[k] ** 2)), slope, curve))
        return out

    thetas, reach = np.log(np.asarray(starts, dtype=float) - least), 1.0
    tried = evaluated(thetas)
    first = min(range(len(tried)), key=lambda k: tried[k][0] if np.isfinite(tried[k][0]) else np.inf)
    theta, (value, slope, curve) = thetas[first], tried[first]
    for _ in range(max_steps):
        if np.abs(slope).max() <= tolerance:
            return least + np.exp(theta)
        eig, basis = np.linalg.eigh(curve)
        step = -basis @ ((basis.T @ slope) / np.maximum(np.abs(eig), 1e-9))
        step *= min(1.0, 2 * reach / np.linalg.norm(step))
        thetas = theta + STEP_LENGTHS[:, None] * step
        tried = evaluated(thetas)
        best = min(range(len(tried)), key=lambda k: tried[k][0] if np.isfinite(tried[k][0]) else np.inf)
        # where values agree to rounding, the flatter point is the better one
        level = abs(tried[best][0] - value) <= 1e-13 * max(1.0, abs(value)) and np.abs(tried[0][1]).max() < np.abs(slope).max()
        best = 0 if level else best
        if level or tried[best][0] < value:
            theta, (value, slope, curve), reach = thetas[best], tried[best], 1.0
        else:
            reach *= 0.02
    raise RuntimeError(f"the fit did not settle in {max_steps} steps; last point {least + np.exp(theta)}, gradient {slope}")


def fit_purchases(inputs: DataFrame, penalty: float = PURCHASE_PENALTY, reach: float = 10.0) -> PurchaseParams:
    """BG/NBD fit. Equal (x, t_x, age) rows are counted first; times are scaled so the oldest client has age ``reach``.

    The counted table is checkpointed to the shared folder, because every step of the fit reads it again. The rate starts
    from the mean and variance of purchases per time, drop-out from the best of a few chances.
    """
    ensure_checkpoint_dir(inputs.sparkSession)
    counted = inputs.groupBy("x", "t_x", "age").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    rate, n = F.col("x") / F.col("age"), F.col("n")
    oldest, weight, mean, square = counted.agg(F.max("age"), F.sum(n), F.sum(n * rate), F.sum(n * rate * rate)).first()
    scale = reach / oldest
    scaled = counted.withColumns({"t_x": F.col("t_x") * scale, "age": F.col("age") * scale})
    mean, square = mean / weight / scale, square / weight / scale**2
    alpha = float(np.clip(mean / max(square - mean * mean, 1e-9), 0.05, 50.0))
    r = float(np.clip(mean * alpha, 0.05, 20.0))
    starts = [(r * k, alpha * k, a, b) for k in (0.7, 1.5) for a, b in ((0.3, 2.0), (1.0, 3.0), (2.0, 2.0))]
    r, alpha, a, b = maximise(scaled, ["x", "t_x", "age"], purchase_loglik, purchase_derivatives, starts, weight, penalty)
    return PurchaseParams(float(r), float(alpha / scale), float(a), float(b))


def fit_spend(inputs: DataFrame, penalty: float = SPEND_PENALTY, stable: bool = False) -> GammaGammaParams:
    """Gamma-gamma fit on clients with a repeat purchase.

    The penalty weighs parameters as they are, so with amounts in the hundred thousands it presses v, and with it q,
    towards zero, and below q = 1 the population has no finite mean. ``stable`` fits amounts divided by their mean and
    keeps q above 1; v is scaled back. Starts from the mean amount, with the best of a few shapes.
    """
    ensure_checkpoint_dir(inputs.sparkSession)
    counted = (
        inputs.filter((F.col("x") > 0) & (F.col("mean_value") > 0))
        .groupBy("x", "mean_value")
        .agg(F.count(F.lit(1)).alias("n"))
        .checkpoint()
    )
    weight, total = counted.agg(F.sum("n"), F.sum(F.col("n") * F.col("mean_value"))).first()
    unit = total / weight
    columns = ["x", "mean_value"]
    if not stable:
        starts = [(p, q, max(unit * (q - 1) / p, 1e-3)) for p in (2.0, 6.0) for q in (1.5, 4.0)]
        p, q, v = maximise(counted, columns, spend_loglik, spend_derivatives, starts, weight, penalty)
        return GammaGammaParams(float(p), float(q), float(v))
    scaled = counted.withColumn("mean_value", F.col("mean_value") / unit)
    starts = [(p, q, (q - 1) / p) for p in (2.0, 6.0) for q in (1.5, 4.0)]
    p, q, v = maximise(scaled, columns, spend_loglik, spend_derivatives, starts, weight, penalty, (0.0, 1.0, 0.0))
    return GammaGammaParams(float(p), float(q), float(v * unit))


# -- scoring -----------------------------------------------------------------------------------------------------------


def _gauss(a: np.ndarray, b: np.ndarray, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Gauss series, until every term is negligible; raises where some is not after ``SERIES_TERMS``."""
    total, term = np.ones_like(z), np.ones_like(z)
    for n in range(SERIES_TERMS):
        term = term * ((a + n) * (b + n)) / ((c + n) * (n + 1)) * z
        total = total + term
        if np.all(np.abs(term) <= 1e-15 * np.abs(total)):
            return total
    raise ArithmeticError(f"the series does not settle for z up to {float(np.max(z))}")


def _signed_gamma(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign and log of the size of gamma, for any argument but the poles, where the log is infinite."""
    z = np.asarray(z, dtype=float)
    below = z <= 0
    mirrored = np.where(below, 1 - z, z)
    sine = np.where(below, np.sin(np.pi * (z - 2 * np.round(z / 2))), 1.0)
    with np.errstate(divide="ignore"):
        size = np.where(below, np.log(np.pi) - np.log(np.abs(sine)) - _lgamma(mirrored), _lgamma(mirrored))
    return np.where(below & (sine < 0), -1.0, 1.0), size


def _near_one(a: float, b: float, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """2F1 by its two series in 1 - z; c - a - b must not be an integer."""
    rest, w = c - a - b, 1 - z

    def ratio(up: Sequence[np.ndarray], down: Sequence[np.ndarray], power: np.ndarray) -> np.ndarray:
        sign, size = np.ones_like(w), power
        for part, way in [(u, 1) for u in up] + [(d, -1) for d in down]:
            s, g = _signed_gamma(part + np.zeros_like(w))
            sign, size = sign * s, size + way * g
        return sign * np.exp(size)

    return (
        ratio([c, rest], [c - a, c - b], np.zeros_like(w)) * _gauss(a, b, 1 - rest, w)
        + ratio([c, -rest], [a, b], rest * np.log(w)) * _gauss(c - a, c - b, 1 + rest, w)
    )


#: Above this z the series in 1 - z is used: both then settle in well under a hundred terms.
NEAR_ONE = 0.65
#: Distance from an integer at which the transformation loses no more than three digits.
APART = 0.01


def _hyp2f1(a: float, b: float, c: np.ndarray, z: np.ndarray) -> np.ndarray:
    """2F1(a, b; c; z) for 0 <= z < 1.

    Near 1 the linear transformation to 1 - z takes the place of the Gauss series. It has no value where c - a - b is an
    integer; there the function, which is smooth in c, is interpolated from three points on either side.
    """
    out = np.empty_like(z)
    near = (z > NEAR_ONE) & (z < 1)
    if (~near).any():
        out[~near] = _gauss(a, b, c[~near], z[~near])
    rest = c - a - b
    close = near & (np.abs(rest - np.round(rest)) < APART / 2)
    plain = near & ~close
    if plain.any():
        out[plain] = _near_one(a, b, c[plain], z[plain])
    if close.any():
        means = [(_near_one(a, b, c[close] + k * APART, z[close]) + _near_one(a, b, c[close] - k * APART, z[close])) / 2 for k in (1, 2, 3)]
        out[close] = (15 * means[0] - 6 * means[1] + means[2]) / 10
    return out


def expected_purchases(p: PurchaseParams, x: np.ndarray, t_x: np.ndarray, age: np.ndarray, t: float) -> np.ndarray:
    """Expected purchases in the next ``t`` time units.

    Euler's transformation moves the power of the published formula out of the series, so large x cannot overflow.
    """
    z = t / (p.alpha + age + t)
    series = (1 - z) ** (p.a - 1) * _hyp2f1(p.a + p.b - 1 - p.r, p.a - 1, p.a + p.b + x - 1, z)
    base = (p.a + p.b + x - 1) / (p.a - 1) * (1 - series)
    with np.errstate(over="ignore"):
        odds = np.exp((p.r + x) * (np.log(p.alpha + age) - np.log(p.alpha + t_x)))
        gone = np.where(x > 0, p.a / (p.b + np.maximum(x, 1) - 1) * odds, 0.0)
    return base / (1 + gone)


def with_expected_purchases(
    inputs: DataFrame, params: PurchaseParams, horizons: Sequence[float], name: str = "expected"
) -> DataFrame:
    """Adds an array of expected purchases, one entry per horizon in weeks. Row-wise, no shuffle."""

    @F.pandas_udf("array<double>")
    def score(x: pd.Series, t_x: pd.Series, age: pd.Series) -> pd.Series:
        columns = [
            expected_purchases(params, x.to_numpy(float), t_x.to_numpy(float), age.to_numpy(float), t) for t in horizons
        ]
        return pd.Series(list(np.column_stack(columns)))

    return inputs.withColumn(name, score("x", "t_x", "age"))


def gamma_gamma_column(x: Column, mean_value: Column, params: GammaGammaParams) -> Column:
    """Conditional mean value per purchase, a weighted mean of the client's own and the population's."""
    own = params.p * x / (params.p * x + params.q - 1)
    population = params.v * params.p / (params.q - 1)
    return (1 - own) * population + own * mean_value


def gamma_gamma_mean(inputs: DataFrame, params: GammaGammaParams) -> DataFrame:
    """Adds ``expected_value`` to a table with ``frequency`` and ``mean_value``."""
    return inputs.withColumn("expected_value", gamma_gamma_column(F.col("frequency"), F.col("mean_value"), params))


def lifetime_value(
    inputs: DataFrame, purchases: PurchaseParams, spend: GammaGammaParams, months: int = VALUE_MONTHS,
    discount: float = MONTHLY_DISCOUNT,
) -> DataFrame:
    """Expected purchases at 12 and 24 weeks, expected value per purchase and discounted value over the months."""
    steps = [WEEKS_PER_MONTH * m for m in range(1, months + 1)]
    scored = with_expected_purchases(inputs, purchases, [*HORIZON_WEEKS, *steps])
    upto = [F.lit(0.0), *[F.col("expected")[len(HORIZON_WEEKS) + i] for i in range(months)]]
    discounted = sum(((upto[m] - upto[m - 1]) / (1 + discount) ** m for m in range(1, months + 1)), F.lit(0.0))
    mean = gamma_gamma_column(F.col("x"), F.col("mean_value"), spend)
    return scored.select(
        "client_id", "x", "age", "mean_value",
        F.col("expected")[0].alias("expected_12_weeks"), F.col("expected")[1].alias("expected_24_weeks"),
        mean.alias("expected_value"), (mean * discounted).alias("clv"),
    )


def value_segments(scored: DataFrame) -> DataFrame:
    """Quarters by value, D lowest to A highest."""
    return quantile_bins(scored, "clv", SEGMENTS, "segment")
