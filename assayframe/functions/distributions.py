"""p-values of t, F, chi-square and studentized range statistics, as columns.

Statistics are one line for each group or pair, so these are Arrow-batched
functions over few rows: the incomplete beta and gamma functions by their
continued fractions and series, the studentized range by quadrature.  Null or
impossible arguments (no degrees of freedom, NaN) give NULL.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_TINY = 1e-300
_STEPS = 10_000


def _fraction(step: Callable[[int], tuple[float, float]], start: float) -> float:
    """A continued fraction start + a1/(b1 + a2/(b2 + ...)), by the modified method of Lentz."""
    f = start or _TINY
    c, d = f, 0.0
    for i in range(1, _STEPS):
        a, b = step(i)
        d = b + a * d or _TINY
        c = b + a / c or _TINY
        d = 1 / d
        f *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return f


def beta_part(x: float, a: float, b: float) -> float:
    """The regularized incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_part(1 - x, b, a)

    def step(i: int) -> tuple[float, float]:
        if i == 1:
            return 1.0, 1.0
        k = i - 1
        m = k // 2
        if k % 2:
            return -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0
        return m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0

    front = a * math.log(x) + b * math.log1p(-x) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    return math.exp(front) * _fraction(step, 0.0) / a


def gamma_rest(a: float, x: float) -> float:
    """The regularized upper incomplete gamma function."""
    if x <= 0:
        return 1.0
    front = a * math.log(x) - x - math.lgamma(a)
    if x < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > abs(total) * 1e-17:
            n += 1
            term *= x / n
            total += term
        return 1 - total * math.exp(front)
    return math.exp(front) / _fraction(lambda i: (-i * (i - a), x + 2 * i + 1 - a), x + 1 - a)


def t_p(t: float, freedom: float) -> float:
    """Chance of a t statistic at least so far from 0, on either side."""
    return beta_part(freedom / (freedom + t * t), freedom / 2, 0.5)


def f_p(f: float, between: float, within: float) -> float:
    """Chance of an F statistic at least so large."""
    return beta_part(within / (within + between * f), within / 2, between / 2) if f > 0 else 1.0


def chi_square_p(x: float, freedom: float) -> float:
    """Chance of a chi-square statistic at least so large."""
    return gamma_rest(freedom / 2, x / 2)


def _below(z: np.ndarray) -> np.ndarray:
    """The standard normal distribution."""
    erf = np.array([math.erf(x / math.sqrt(2)) for x in z.ravel().tolist()])
    return 0.5 * (1 + erf.reshape(z.shape))


def range_p(q: float, groups: int, freedom: float) -> float:
    """Chance of a studentized range of some groups at least so large.

    The range of standard normals is averaged over the standard deviation's
    distribution; both integrals are sums over Gauss-Legendre points.
    """
    if q <= 0:
        return 1.0
    node, weight = np.polynomial.legendre.leggauss(96)
    wide = 9 / math.sqrt(2 * freedom)
    low, high = max(0.0, 1 - wide), 1 + wide
    s = low + (node + 1) / 2 * (high - low)
    log = math.log(2) + freedom / 2 * math.log(freedom / 2) - math.lgamma(freedom / 2) + (freedom - 1) * np.log(s) - freedom * s * s / 2
    density = np.exp(log) * weight / 2 * (high - low)
    z = 9 * node
    inside = np.exp(-z * z / 2) / math.sqrt(2 * math.pi) * weight * 9
    # one number for each point of s: the chance that the range is below q * s
    below = groups * ((np.maximum(0.0, _below(z)[None, :] - _below(z[None, :] - q * s[:, None])) ** (groups - 1)) * inside).sum(axis=1)
    return float(min(1.0, max(0.0, 1 - (density * below).sum())))


def _column(chance: Callable[..., float], *cols: Column) -> Column:
    def each(*parts: pd.Series) -> pd.Series:
        out = []
        for row in zip(*parts, strict=True):
            ok = all(x is not None and math.isfinite(x) for x in row) and all(x > 0 for x in row[1:])
            out.append(chance(*row) if ok else None)
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(each, "double")(*[c.cast("double") for c in cols])


def p_of_t(t: Column, freedom: Column) -> Column:
    return _column(t_p, t, freedom)


def p_of_f(f: Column, between: Column, within: Column) -> Column:
    return _column(f_p, f, between, within)


def p_of_chi_square(x: Column, freedom: Column) -> Column:
    return _column(chi_square_p, x, freedom)


def p_of_range(q: Column, groups: Column, freedom: Column) -> Column:
    return _column(range_p, q, groups, freedom)
