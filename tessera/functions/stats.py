"""Small closed-form statistics evaluated on the driver.

Only ever applied to results whose size is bounded by the model, not the data:
one row per stratum (log-rank), one p-vector and p×p matrix per Newton step
(Cox), a handful of fit statistics.
"""

from __future__ import annotations

import math

import numpy as np


def _gammainc_lower_series(a: float, x: float) -> float:
    term = total = 1.0 / a
    ap = a
    for _ in range(10000):
        ap += 1.0
        term *= x / ap
        total += term
        if abs(term) < abs(total) * 1e-15:
            break
    return total * math.exp(-x + a * math.log(x) - math.lgamma(a))


def _gammainc_upper_cf(a: float, x: float) -> float:
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in range(1, 10000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = tiny if abs(d) < tiny else d
        c = b + an / c
        c = tiny if abs(c) < tiny else c
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < 1e-15:
            break
    return math.exp(-x + a * math.log(x) - math.lgamma(a)) * h


def chi2_sf(x: float, df: float) -> float:
    """Upper tail of the chi-square distribution, Q(df/2, x/2)."""
    if x is None or df <= 0 or math.isnan(x):
        return float("nan")
    if x <= 0:
        return 1.0
    a, y = df / 2.0, x / 2.0
    if y < a + 1.0:
        return max(0.0, 1.0 - _gammainc_lower_series(a, y))
    return _gammainc_upper_cf(a, y)


def norm_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def quad_form_inv(u: np.ndarray, v: np.ndarray) -> float:
    """u' V^- u with a pseudo-inverse (singular V when a group is empty)."""
    return float(u @ np.linalg.pinv(v) @ u)
