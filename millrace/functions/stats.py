"""Tail probabilities for a handful of result rows; Spark SQL has no erf and no t distribution."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function by the modified Lentz method."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 400):
        for factor in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + factor * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + factor / c
            c = c if abs(c) > tiny else tiny
            value *= d * c
        if abs(d * c - 1.0) < 1e-15:
            break
    return value


def incomplete_beta(a: float, b: float, x: float) -> float:
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1 - x) / b


def student_two_sided(t: float, df: float) -> float:
    return incomplete_beta(df / 2, 0.5, df / (df + t * t))


@F.pandas_udf(T.DoubleType())
def normal_tail_udf(z: pd.Series) -> pd.Series:
    return z.map(lambda v: None if pd.isna(v) else normal_tail(v)).astype("float64")


@F.pandas_udf(T.DoubleType())
def student_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) or pd.isna(b) else student_two_sided(a, b) for a, b in zip(t, df, strict=True)], dtype="float64")
