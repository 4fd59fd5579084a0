"""Tail probabilities.

These run on one row per feature, after all aggregation, so each is a
vectorised pandas UDF over a short column.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _erfc(x: np.ndarray) -> np.ndarray:
    return np.array([math.erfc(v) for v in x])


def _lgamma(x: np.ndarray) -> np.ndarray:
    return np.array([math.lgamma(v) for v in x])


def _normal_two_sided(z: np.ndarray) -> np.ndarray:
    """min(1, 2 P(Z >= z)); z = -inf gives 1."""
    z = np.asarray(z, dtype=float)
    out = np.full(z.shape, np.nan)
    ok = ~np.isnan(z)
    out[ok] = np.minimum(1.0, _erfc(z[ok] / math.sqrt(2.0)))
    return out


def _chi2_upper(x: np.ndarray, df: np.ndarray) -> np.ndarray:
    """P(X >= x) for integer degrees of freedom, by the finite series."""
    x, df = np.asarray(x, dtype=float), np.asarray(df, dtype=float)
    out = np.full(x.shape, np.nan)
    for k in np.unique(df[~np.isnan(df)]).astype(int):
        rows = (df == k) & ~np.isnan(x)
        if k < 1 or not rows.any():
            continue
        half = np.maximum(x[rows], 0.0) / 2.0
        if k % 2 == 0:
            term = np.ones_like(half)
            total = term.copy()
            for i in range(1, k // 2):
                term = term * half / i
                total += term
            out[rows] = np.exp(-half) * total
        else:
            total = np.zeros_like(half)
            term = np.sqrt(half) / math.gamma(1.5)
            for i in range(1, (k - 1) // 2 + 1):
                total += term
                term = term * half / (i + 0.5)
            out[rows] = _erfc(np.sqrt(half)) + np.exp(-half) * total
    return out


def _beta_fraction(a, b, x, rounds=400):
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    value = d.copy()
    for m in range(1, rounds):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + step / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            change = c * d
            value = value * change
        if np.all(np.abs(change - 1.0) < 1e-15):
            break
    return value


def _incomplete_beta(a, b, x):
    """Regularised incomplete beta I_x(a, b), elementwise."""
    swap = x > (a + 1.0) / (a + b + 2.0)
    aa, bb, xx = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1.0 - x, x)
    inside = (xx > 0) & (xx < 1)
    safe = np.where(inside, xx, 0.5)
    front = np.exp(
        _lgamma(aa + bb) - _lgamma(aa) - _lgamma(bb)
        + aa * np.log(safe) + bb * np.log1p(-safe)
    ) / aa
    part = np.where(inside, front * _beta_fraction(aa, bb, safe), np.where(xx <= 0, 0.0, 1.0))
    return np.where(swap, 1.0 - part, part)


def _t_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    t, df = np.asarray(t, dtype=float), np.asarray(df, dtype=float)
    out = np.full(t.shape, np.nan)
    ok = ~np.isnan(t) & (df > 0)
    if ok.any():
        v, q = df[ok], t[ok]
        x = np.where(np.isinf(q), 0.0, v / (v + np.where(np.isinf(q), 0.0, q) ** 2))
        out[ok] = _incomplete_beta(v / 2.0, np.full_like(v, 0.5), x)
    return out


def _rank_sum_counts(n1: int, n2: int) -> np.ndarray:
    """Number of orderings giving each U in 0..n1*n2, by the product formula."""
    small, large = min(n1, n2), max(n1, n2)
    top = small * large
    exact = math.comb(small + large, small) < 2**53
    ways = np.zeros(top + 1, dtype=float if exact or top > 20000 else object)
    ways[0] = 1
    for i in range(1, small + 1):
        shifted = ways.copy()
        if large + i <= top:
            shifted[large + i:] = shifted[large + i:] - ways[: top + 1 - large - i]
        for start in range(i):
            shifted[start::i] = np.cumsum(shifted[start::i])
        ways = shifted
    return ways


def _mann_whitney_exact(u: np.ndarray, n1: np.ndarray, n2: np.ndarray) -> np.ndarray:
    """Two-sided exact p; the counting runs once per distinct (n1, n2).

    By symmetry the lower tail is read, whose counts are small: the upper ones
    come from differences of large numbers.
    """
    frame = pd.DataFrame({"u": u, "n1": n1, "n2": n2}, dtype=float)
    out = np.full(len(frame), np.nan)
    for (a, b), rows in frame.dropna().groupby(["n1", "n2"]):
        ways = _rank_sum_counts(int(a), int(b))
        total = math.comb(int(a + b), int(min(a, b)))
        smaller = np.minimum(rows["u"], a * b - rows["u"])
        at = np.floor(smaller + 1e-9).astype(int)
        lower = np.cumsum(ways[: at.max() + 1])
        out[rows.index] = [min(1.0, float(2 * lower[i] / total)) for i in at]
    return out


def _column(kernel, arguments: int):
    """Column function over a numpy kernel; a missing result is NaN, not null."""
    if arguments == 1:

        @F.pandas_udf(DoubleType())
        def run(a: pd.Series) -> pd.Series:
            return pd.Series(kernel(a.to_numpy(dtype=float)))

    elif arguments == 2:

        @F.pandas_udf(DoubleType())
        def run(a: pd.Series, b: pd.Series) -> pd.Series:
            return pd.Series(kernel(a.to_numpy(dtype=float), b.to_numpy(dtype=float)))

    else:

        @F.pandas_udf(DoubleType())
        def run(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
            return pd.Series(kernel(
                a.to_numpy(dtype=float), b.to_numpy(dtype=float), c.to_numpy(dtype=float)))

    return lambda *columns: F.coalesce(run(*columns), F.lit(math.nan))


normal_two_sided = _column(_normal_two_sided, 1)
chi2_upper = _column(_chi2_upper, 2)
t_two_sided = _column(_t_two_sided, 2)
mann_whitney_exact = _column(_mann_whitney_exact, 3)
