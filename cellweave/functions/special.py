"""Distribution tails in numpy: incomplete gamma and beta by series and continued fractions."""

from __future__ import annotations

import math

import numpy as np

_lgamma = np.vectorize(math.lgamma, otypes=[float])
_erfc = np.vectorize(math.erfc, otypes=[float])


def gammainc(a, x):
    """Regularised lower incomplete gamma function P(a, x)."""
    a, x = np.broadcast_arrays(np.asarray(a, float), np.asarray(x, float))
    out = np.zeros(a.shape)
    for i in np.ndindex(a.shape):
        out[i] = _gammainc(float(a[i]), float(x[i]))
    return out


def _gammainc(a: float, x: float) -> float:
    if x <= 0:
        return 0.0
    lead = math.exp(-x + a * math.log(x) - math.lgamma(a))
    if x < a + 1:
        term = total = 1 / a
        k = a
        while abs(term) > abs(total) * 1e-16:
            k += 1
            term *= x / k
            total += term
        return total * lead
    b, tiny = x + 1 - a, 1e-300
    c, d = 1 / tiny, 1 / b
    h = d
    for i in range(1, 10_000):
        an = -i * (i - a)
        b += 2
        d = an * d + b
        d = 1 / (d if abs(d) > tiny else tiny)
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return 1 - lead * h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - betainc(b, a, 1 - x)
    lead = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    f = c = 1.0
    d, tiny = 0.0, 1e-300
    for i in range(10_000):
        m = i // 2
        num = 1.0 if i == 0 else (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)) if i % 2 == 0 else -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)))
        d = 1 + num * d
        d = 1 / (d if abs(d) > tiny else tiny)
        c = 1 + num / c
        c = c if abs(c) > tiny else tiny
        f *= c * d
        if abs(1 - c * d) < 1e-15:
            break
    return lead * (f - 1)


def normal_two_sided(z):
    return _erfc(np.abs(np.asarray(z, float)) / math.sqrt(2))


def chi2_tail(x, df):
    return 1 - gammainc(np.asarray(df, float) / 2, np.asarray(x, float) / 2)


def student_two_sided(t, df):
    t, df = np.broadcast_arrays(np.asarray(t, float), np.asarray(df, float))
    return np.array([betainc(d / 2, 0.5, d / (d + v * v)) if np.isfinite(v) and d > 0 else (0.0 if np.isinf(v) else float("nan")) for v, d in zip(t.ravel(), df.ravel(), strict=True)]).reshape(t.shape)


def hypergeom_tail(k, total, good, drawn):
    """P(X > k) for X good ones among drawn of total."""
    out = []
    for a, m, n, d in zip(*(np.ravel(v).tolist() for v in np.broadcast_arrays(k, total, good, drawn)), strict=True):
        hi = min(n, d)
        x = np.arange(int(a) + 1, int(hi) + 1, dtype=float)
        if not len(x):
            out.append(0.0)
            continue
        logs = _lgamma(n + 1.0) - _lgamma(x + 1) - _lgamma(n - x + 1) + _lgamma(m - n + 1.0) - _lgamma(d - x + 1) - _lgamma(np.maximum(m - n - d + x, 0) + 1) - (_lgamma(m + 1.0) - _lgamma(d + 1.0) - _lgamma(m - d + 1.0))
        out.append(float(np.exp(logs)[m - n - d + x >= 0].sum()))
    return np.array(out)
