"""Tail probabilities of the normal, chi-squared and Student distributions.

They are applied to finished test statistics: one row per test, never per data row.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def normal_two_sided(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def gamma_upper(a: float, x: float) -> float:
    """Regularised upper incomplete gamma function."""
    if x <= 0:
        return 1.0
    scale = math.exp(a * math.log(x) - x - math.lgamma(a))
    if x < a + 1:  # power series of the lower part
        term = total = 1.0 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return 1.0 - total * scale
    # continued fraction, evaluated from the tail
    value = 0.0
    for k in range(400, 0, -1):
        value = k * (k - a) / (x + 2 * k + 1 - a - value)
    return scale / (x + 1 - a - value)


def chi2_upper(x: float, freedom: float) -> float:
    return gamma_upper(freedom / 2, x / 2)


def beta_lower(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_lower(b, a, 1 - x)
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    value = 0.0  # continued fraction, evaluated from the tail
    for m in range(400, 0, -1):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        value = even / (1 + odd / (1 + value))
    first = -(a + b) * x / (a + 1)
    return front / a / (1 + first / (1 + value))


def t_two_sided(t: float, freedom: float) -> float:
    return beta_lower(freedom / 2, 0.5, freedom / (freedom + t * t))


def t_inverse(prob: float, freedom: float) -> float:
    """Quantile by bisection; ``prob`` at least one half."""
    low, high = 0.0, 1.0
    while 1 - t_two_sided(high, freedom) / 2 < prob:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        if 1 - t_two_sided(middle, freedom) / 2 < prob:
            low = middle
        else:
            high = middle
    return (low + high) / 2


def _each(function, *columns: pd.Series) -> pd.Series:
    return pd.Series(
        [None if any(pd.isna(v) for v in row) else function(*row) for row in zip(*columns)], dtype="float64"
    )


@F.pandas_udf(DoubleType())
def normal_p(z: pd.Series) -> pd.Series:
    return _each(normal_two_sided, z)


@F.pandas_udf(DoubleType())
def chi2_p(x: pd.Series, freedom: pd.Series) -> pd.Series:
    return _each(chi2_upper, x, freedom)


@F.pandas_udf(DoubleType())
def t_p(t: pd.Series, freedom: pd.Series) -> pd.Series:
    return _each(t_two_sided, t, freedom)


@F.pandas_udf(DoubleType())
def t_quantile(prob: pd.Series, freedom: pd.Series) -> pd.Series:
    return _each(t_inverse, prob, freedom)
