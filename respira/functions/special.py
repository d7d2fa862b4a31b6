"""Student-t tail probability for whole columns (no SciPy on the workers)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_lgamma = np.vectorize(math.lgamma, otypes=[float])


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Continued fraction of the incomplete beta function (modified Lentz), elementwise."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 / _away_from_zero(1.0 - (a + b) * x / (a + 1.0), tiny)
    h = d.copy()
    for m in range(1, 400):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 / _away_from_zero(1.0 + term * d, tiny)
            c = _away_from_zero(1.0 + term / c, tiny)
            h = h * d * c
        if np.all(np.abs(d * c - 1.0) < 1e-15):
            break
    return h


def _away_from_zero(v: np.ndarray, tiny: float) -> np.ndarray:
    return np.where(np.abs(v) < tiny, tiny, v)


def incomplete_beta(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Regularised incomplete beta I_x(a, b)."""
    a, b, x = np.broadcast_arrays(*(np.asarray(v, dtype=float) for v in (a, b, x)))
    inner = np.clip(x, 1e-300, 1 - 1e-16)
    front = np.exp(_lgamma(a + b) - _lgamma(a) - _lgamma(b) + a * np.log(inner) + b * np.log1p(-inner))
    swap = x > (a + 1) / (a + b + 2)
    aa, bb, xx = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - inner, inner)
    v = front * _beta_fraction(aa, bb, xx) / aa
    v = np.where(swap, 1 - v, v)
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, v))


def t_two_sided(t: np.ndarray, dof: np.ndarray) -> np.ndarray:
    """P(|T| >= |t|) with ``dof`` degrees of freedom; NaN without any."""
    t, dof = np.asarray(t, dtype=float), np.asarray(dof, dtype=float)
    ok = (dof > 0) & ~np.isnan(t)
    n = np.where(ok, dof, 1.0)
    x = np.where(np.isinf(t), 0.0, n / (n + np.where(np.isfinite(t), t, 0.0) ** 2))
    return np.where(ok, incomplete_beta(n / 2, np.full_like(n, 0.5), x), np.nan)


def correlation_p_value(r: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation (or simple regression) coefficient from ``n`` pairs."""
    dof = (n - 2).cast("double")
    t = F.when(F.abs(r) >= 1, F.lit(float("inf"))).otherwise(F.abs(r) * F.sqrt(dof / (1 - r * r)))

    # Made here and not at import: tasks import this module too and have no session.
    @F.pandas_udf("double")
    def tail(t: pd.Series, dof: pd.Series) -> pd.Series:
        return pd.Series(t_two_sided(t.to_numpy(dtype=float), dof.to_numpy(dtype=float)))

    p = tail(F.when(dof > 0, t), dof)
    return F.when(r.isNotNull() & (dof > 0), p)
