"""Statistics the operators need and Spark has no function for."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def t_two_sided(t: Column, df: Column) -> Column:
    """Two-sided p-value of Student's t: in closed form for 1, 2 or 3 degrees of freedom, else by the incomplete beta function."""
    x = F.abs(t)
    one = 1 - F.lit(2 / math.pi) * F.atan(x)
    two = 1 - x / F.sqrt(x * x + 2)
    y = x / math.sqrt(3)
    three = 1 - F.lit(2 / math.pi) * (F.atan(y) + y / (1 + y * y))

    @F.pandas_udf("double")
    def tail(t: pd.Series, df: pd.Series) -> pd.Series:
        out = pd.Series(np.nan, index=t.index)
        more = (df > 3) & t.notna()
        if more.any():
            n = df[more].to_numpy(dtype=float)
            x = n / (n + t[more].to_numpy(dtype=float) ** 2)
            out[more] = incomplete_beta(n / 2, np.full_like(n, 0.5), x)
        return out

    general = tail(F.when(df > 3, x), F.when(df > 3, df.cast("double")).otherwise(0.0))
    return F.when(df == 1, one).when(df == 2, two).when(df == 3, three).when(df > 3, general)


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz), element-wise.

    It converges in about the square root of the larger parameter.
    """
    steps = 500 + int(10 * math.sqrt(float(np.max(np.maximum(a, b)))))
    tiny = 1e-300
    guard = lambda v: np.where(np.abs(v) < tiny, tiny, v)
    c = np.ones_like(x)
    d = 1 / guard(1 - (a + b) * x / (a + 1))
    h = d.copy()
    for m in range(1, steps):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1 / guard(1 + even * d)
        c = guard(1 + even / c)
        h = h * d * c
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / guard(1 + odd * d)
        c = guard(1 + odd / c)
        step = d * c
        h = h * step
        if np.all(np.abs(step - 1) < 1e-14):
            return h
    if not np.all(np.abs(step - 1) < 1e-9):
        raise ArithmeticError("the incomplete beta function did not converge")
    return h


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The regularised incomplete beta function I_x(a, b), element-wise, from the side that converges."""
    lgamma = np.vectorize(math.lgamma, otypes=[float])
    inside = (x > 0) & (x < 1)
    a, b, y = a[inside], b[inside], x[inside]
    result = (x >= 1).astype(float)
    if a.size:
        front = np.exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * np.log(y) + b * np.log1p(-y))
        direct = y < (a + 1) / (a + b + 2)
        left = front * _beta_fraction(a, b, y) / a
        right = 1 - front * _beta_fraction(b, a, 1 - y) / b
        result[inside] = np.where(direct, left, right)
    return result


def binomial_upper_tail(k: np.ndarray, n: np.ndarray, p: float) -> np.ndarray:
    """P(X >= k) for X ~ Binomial(n, p), as the incomplete beta function I_p(k, n - k + 1).

    The cost grows with the square root of n at most, so counts of any size are fine.
    """
    k = np.asarray(k, dtype=float)
    n = np.asarray(n, dtype=float)
    result = np.ones_like(k)
    inside = k > 0
    a = k[inside]
    result[inside] = incomplete_beta(a, n[inside] - a + 1, np.full_like(a, p))
    return np.clip(result, 0.0, 1.0)


def binomial_p_value(k: Column, n: Column, p: float) -> Column:
    """One-sided p-value that the share is above `p`, for columns of counts."""

    @F.pandas_udf("double")
    def upper_tail(k: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series(binomial_upper_tail(k.to_numpy(), n.to_numpy(), p))

    return upper_tail(k.cast("double"), n.cast("double"))
