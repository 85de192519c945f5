"""The smooth curve against the same penalised fit, solved on the single rows in another way."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlake.operators import curves

AT = np.arange(101)


def cardinal(t):
    """The cubic B-spline on the knots 0, 1, 2, 3, 4, piece by piece."""
    pieces = [t**3, 1 + 3 * (t - 1) + 3 * (t - 1) ** 2 - 3 * (t - 1) ** 3, 4 - 6 * (t - 2) ** 2 + 3 * (t - 2) ** 3, (4 - t) ** 3]
    return pieces[math.floor(t)] / 6 if 0 <= t < 4 else 0.0


def plain_design(ages, low, high):
    """Twenty splines over 17 equal intervals; beyond the ends, the tangent there."""
    width = (high - low) / 17

    def line(x):
        return np.array([cardinal((x - low) / width + 3 - k) for k in range(20)])

    eps = 1e-4 * width
    rows = []
    for x in ages:
        inside = min(max(x, low), high - 1e-9 * width)
        row = line(inside)
        if x < low:
            row = row + (x - low) * (line(low + eps) - line(low)) / eps
        if x > high:
            row = row + (x - high) * (line(high - eps / 2) - line(high - 1.5 * eps)) / eps
        rows.append(row)
    return np.array(rows)


def plain_fit(ages, rates, at):
    """Least squares on the rows with the penalty as further rows, the strength by generalised cross-validation."""
    low, high = min(ages), max(ages)
    design, best = plain_design(ages, low, high), None
    second = np.array([[1.0 if j in (i, i + 2) else -2.0 if j == i + 1 else 0.0 for j in range(20)] for i in range(18)])
    for strength in [10 ** (-3 + 0.6 * k) for k in range(11)]:
        stacked = np.vstack([design, math.sqrt(strength) * second])
        solved = np.linalg.lstsq(stacked, np.concatenate([rates, np.zeros(18)]), rcond=None)[0]
        hat = design @ np.linalg.pinv(stacked)[:, : len(ages)]
        error = float(np.sum((rates - design @ solved) ** 2))
        score = len(ages) * error / (len(ages) - 1.4 * np.trace(hat)) ** 2
        if best is None or score < best[0]:
            best = (score, solved)
    return plain_design(at, low, high) @ best[1]


@pytest.mark.parametrize("seed, low, high, noise", [(0, 18, 90, 0.1), (1, 0, 90, 0.02), (2, 18, 60, 0.5), (3, 30, 95, 0.0)])
def test_curves_are_the_penalised_fit(spark, seed, low, high, noise):
    rng = np.random.default_rng(seed)
    ages = np.repeat(np.arange(low, high + 1), rng.integers(1, 4, high - low + 1))
    rates = 1 + np.sin(ages / 14) + (ages > 55) * 0.3 + noise * rng.normal(size=len(ages))
    rows = [(1, int(a), float(r)) for a, r in zip(ages, rates)]
    fitted = curves.fit_curves(spark.createDataFrame(rows, "sex int, age int, activity_rate double"), ["sex"]).orderBy("age")
    found = np.array([r["activity"] for r in fitted.collect()])
    assert np.allclose(found, plain_fit(ages, rates, AT), atol=2e-4 * max(1, np.abs(found).max()))


def test_rates_that_are_unknown_are_left_out(spark):
    rows = [(1, a, 0.5 + a / 10) for a in range(20, 60)] + [(1, 70, None), (2, 30, None)]
    fitted = curves.fit_curves(spark.createDataFrame(rows, "sex int, age int, activity_rate double"), ["sex"])
    assert fitted.select("sex").distinct().collect() == [(1,)]
    assert fitted.where(F.abs(F.col("activity") - 0.5 - F.col("age") / 10) > 1e-5).count() == 0
