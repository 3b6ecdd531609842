"""Tail probabilities for one-row test results: normal, Student t, chi-square.

Small scalar helpers behind pandas UDFs; the data work before them (ranks, moments) is all Spark.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Z_95 = 1.959963984540054  # two-sided 95 % normal quantile


def normal_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def _fraction(term, limit: int = 10_000) -> float:
    """Modified Lentz evaluation of b0 + a1/(b1 + a2/(b2 + ...)); ``term(i)`` gives (a_i, b_i)."""
    tiny = 1e-300
    value = term(0)[1] or tiny
    c, d = value, 0.0
    for i in range(1, limit):
        a, b = term(i)
        d = 1.0 / ((b + a * d) or tiny)
        c = (b + a / c) or tiny
        value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return value
    raise ArithmeticError("the continued fraction does not converge")


def chi2_sf(x: float, df: float) -> float:
    """Upper tail of chi-square through the regularised incomplete gamma function."""
    if x <= 0:
        return 1.0
    a, half = df / 2.0, x / 2.0
    front = math.exp(a * math.log(half) - half - math.lgamma(a))
    if half < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= half / n
            total += term
        return max(0.0, 1.0 - front * total)
    return front / _fraction(lambda i: (1.0, half + 1 - a) if i == 0 else (-i * (i - a), half + 2 * i + 1 - a))


def _log_gamma_ratio(a: float, b: float) -> float:
    """log(gamma(a + b) / gamma(a)) from the differences of Stirling's terms, so no digits cancel at large a."""
    steps = max(0, math.ceil(16 - a))
    shifted = sum(math.log((a + i) / (a + b + i)) for i in range(steps))
    a += steps

    def rest(z: float) -> float:
        return 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - 1 / (1680 * z**7)

    return shifted + (a - 0.5) * math.log1p(b / a) + b * math.log(a + b) - b + rest(a + b) - rest(a)


def _beta_cdf(x: float, y: float, a: float, b: float) -> float:
    """Regularised incomplete beta function at x, with y = 1 - x given in full precision."""
    if x <= 0 or y <= 0:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_cdf(y, x, b, a)

    def term(i: int) -> tuple[float, float]:
        if i == 0:
            return 0.0, 1.0
        k = i // 2
        if i % 2:
            return -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1)), 1.0
        return k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k)), 1.0

    log_x = math.log(x) if x < y else math.log1p(-y)
    log_y = math.log(y) if y < x else math.log1p(-x)
    large, small = max(a, b), min(a, b)
    log_front = a * log_x + b * log_y + _log_gamma_ratio(large, small) - math.lgamma(small)
    return math.exp(log_front) / a / _fraction(term)


def _beta_series(x: float, a: float, b: float) -> float:
    """The same function as a sum of positive terms, which loses no digits for small x and large b."""
    term = total = 1.0 / a
    n = 0
    while term > total * 1e-17:
        term *= x * (a + b + n) / (a + 1 + n)
        total += term
        n += 1
    return math.exp(a * math.log(x) + b * math.log1p(-x) + _log_gamma_ratio(b, a) - math.lgamma(a)) * total


def t_sf(t: float, df: float) -> float:
    """Upper tail of Student's t."""
    square = t * t
    if square > df:
        tail = 0.5 * _beta_cdf(df / (df + square), square / (df + square), df / 2.0, 0.5)
    elif square > 1400:  # (1 + t^2 / df) ^ (-df / 2) is below 1e-200 here
        tail = 0.0
    else:
        tail = 0.5 * (1.0 - _beta_series(square / (df + square), 0.5, df / 2.0)) if square else 0.5
    return tail if t >= 0 else 1.0 - tail


def _known(*values) -> bool:
    return all(v is not None and not math.isnan(v) for v in values)


@F.pandas_udf(T.DoubleType())
def _normal_tail(z: pd.Series) -> pd.Series:
    return z.map(lambda v: normal_sf(v) if _known(v) else None).astype(float)


@F.pandas_udf(T.DoubleType())
def _t_tail(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([t_sf(a, b) if _known(a, b) else None for a, b in zip(t, df, strict=True)], dtype=float)


@F.pandas_udf(T.DoubleType())
def _chi2_tail(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([chi2_sf(a, b) if _known(a, b) else None for a, b in zip(x, df, strict=True)], dtype=float)


def normal_p(z: Column, alternative: str = "two-sided") -> Column:
    return _sided(z, lambda v: _normal_tail(v), alternative)


def t_p(t: Column, df: Column, alternative: str = "two-sided") -> Column:
    return _sided(t, lambda v: _t_tail(v, df), alternative)


def chi2_p(x: Column, df: Column) -> Column:
    return _chi2_tail(x.cast("double"), df.cast("double"))


def _sided(statistic: Column, upper, alternative: str) -> Column:
    if alternative == "two-sided":
        return F.least(F.lit(1.0), upper(F.abs(statistic)) * 2)
    return upper(statistic if alternative == "greater" else -statistic)
