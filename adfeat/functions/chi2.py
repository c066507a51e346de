"""Chi-square distribution, evaluated once per feature."""

from __future__ import annotations

import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# the tasks carry these few functions, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TINY = 1e-300


def _log1p_less(u: float) -> float:
    """log(1 + u) - u, without cancellation near 0."""
    if abs(u) > 0.1:
        return math.log1p(u) - u
    total, power, k = 0.0, u, 1
    while True:  # -u²/2 + u³/3 - …
        k += 1
        power *= -u
        if abs(power) <= abs(total) * 1e-18 or power == 0.0:
            return total
        total += power / k


def _stirling(a: float) -> float:
    """log Γ(a) less (a - 1/2) log a - a + log(2π) / 2, for a of 10 or more."""
    r = 1 / (a * a)
    return (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r * (1 / 1680 - r * (1 / 1188 - r * 691 / 360360))))) / a


def _density(a: float, h: float) -> float:
    """h^a e^-h / Γ(a); what is large in it is taken off before it is multiplied."""
    if a < 10:
        return math.exp(a * math.log(h) - h - math.lgamma(a))
    return math.sqrt(a / (2 * math.pi)) * math.exp(a * _log1p_less((h - a) / a) - _stirling(a))


def _tails(x: float, dof: float) -> tuple[float, float]:
    """P(X <= x) and P(X > x), the smaller one computed and the other its complement; an error if a sum does not settle.

    The terms that matter grow with the root of ``dof``."""
    a, h = dof / 2, x / 2
    if math.isnan(h):
        raise ArithmeticError("no chi-square tail of what is no number")
    if h <= 0:
        return 0.0, 1.0
    limit = 1000 + 100 * int(math.sqrt(a + h))
    if h < a + 1:  # power series of the lower tail
        term = total = 1 / a
        for i in range(1, limit):
            term *= h / (a + i)
            total += term
            if term <= total * 1e-17:
                lower = min(1.0, _density(a, h) * total)
                return lower, 1 - lower
    else:  # continued fraction of the upper tail
        b = h + 1 - a
        c, d = 1 / TINY, 1 / b
        f = d
        for i in range(1, limit):
            k = -i * (i - a)
            b += 2
            d = 1 / ((k * d + b) or TINY)
            c = (b + k / c) or TINY
            f *= c * d
            if abs(c * d - 1) < 1e-15:
                upper = min(1.0, _density(a, h) * f)
                return 1 - upper, upper
    raise ArithmeticError(f"chi-square tail of {x} with {dof} degrees of freedom does not settle")


def upper_tail(x: float, dof: float) -> float:
    """P(X > x) for a chi-square variable."""
    return _tails(x, dof)[1]


def quantile(prob: float, dof: float) -> float:
    """Value that a chi-square variable stays below with probability ``prob``.

    Newton's method on the distribution, kept between bounds that halve where it would leave them."""
    if not 0 <= prob < 1:
        raise ValueError(f"no quantile at {prob}")
    if prob == 0:
        return 0.0
    low, high = 0.0, dof + 10 * math.sqrt(2 * dof) + 50
    while _tails(high, dof)[0] < prob:
        low, high = high, 2 * high
    x = min(max(dof, low), high)
    for _ in range(2000):
        lower, upper = _tails(x, dof)
        gap = lower - prob if lower < 0.5 else (1 - prob) - upper
        low, high = (x, high) if gap < 0 else (low, x)
        slope = _density(dof / 2, x / 2) / x  # of the distribution at x
        step = gap / slope if slope > 0 else math.inf
        if abs(step) <= 1e-15 * x:
            return x
        new = x - step
        if not low < new < high:
            new = (low + high) / 2
        if new in (low, high):
            return x
        x = new
    raise ArithmeticError(f"chi-square quantile {prob} with {dof} degrees of freedom does not settle")


@F.pandas_udf(DoubleType())
def chi2_p_value(stat: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(s) or pd.isna(d) else upper_tail(s, d) for s, d in zip(stat, dof)], dtype="float64")


@F.pandas_udf(DoubleType())
def chi2_quantile(prob: pd.Series, dof: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(d) else quantile(p, d) for p, d in zip(prob, dof)], dtype="float64")
