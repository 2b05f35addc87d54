"""Special functions on arrays: log gamma and its derivatives, and tails of the normal and chi-square distributions."""

from __future__ import annotations

import math

import numpy as np


def log_gamma(x) -> np.ndarray:
    """For x > 0: the argument is moved to 8 and more, where the asymptotic series is exact enough."""
    x = np.asarray(x, dtype=float)
    shift = np.zeros_like(x)
    y = x.copy()
    for _ in range(8):
        small = y < 8
        shift = np.where(small, shift - np.log(np.where(small, y, 1.0)), shift)
        y = np.where(small, y + 1, y)
    z = 1.0 / (y * y)
    return shift + (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + (1 / 12 - z * (1 / 360 - z * (1 / 1260 - z / 1680))) / y


def digamma(x) -> np.ndarray:
    """The derivative of log gamma for x > 0, as it is worked out."""
    y = np.asarray(x, dtype=float).copy()
    shift = np.zeros_like(y)
    for _ in range(8):
        small = y < 8
        shift = np.where(small, shift - 1 / np.where(small, y, 1.0), shift)
        y = np.where(small, y + 1, y)
    z = 1.0 / (y * y)
    return shift + np.log(y) - 0.5 / y - z * (1 / 12 - z * (1 / 120 - z * (1 / 252 - z / 240)))


def trigamma(x) -> np.ndarray:
    """The second derivative of log gamma for x > 0."""
    y = np.asarray(x, dtype=float).copy()
    shift = np.zeros_like(y)
    for _ in range(8):
        small = y < 8
        shift = np.where(small, shift + 1 / np.where(small, y, 1.0) ** 2, shift)
        y = np.where(small, y + 1, y)
    z = 1.0 / (y * y)
    return shift + 1 / y + z / 2 + z / y * (1 / 6 - z * (1 / 30 - z * (1 / 42 - z / 30)))


def normal_tail(z) -> np.ndarray:
    """P(|Z| >= |z|)."""
    return np.vectorize(lambda v: math.erfc(abs(v) / math.sqrt(2)) if np.isfinite(v) else np.nan, otypes=[float])(np.asarray(z, dtype=float))


def chi_square_tail(x: float, df: float) -> float:
    """P(X >= x) by the incomplete gamma function: its series below, its continued fraction above the mode."""
    if not np.isfinite(x) or df <= 0:
        return float("nan")
    if x <= 0:
        return 1.0
    a, z = df / 2, x / 2
    front = math.exp(-z + a * math.log(z) - math.lgamma(a))
    if z < a + 1:
        term = total = 1 / a
        n = a
        while abs(term) > 1e-15 * abs(total):
            n += 1
            term *= z / n
            total += term
        return max(0.0, 1 - front * total)
    b, c = z + 1 - a, 1e300
    d = 1 / b
    h = d
    for i in range(1, 500):
        an = -i * (i - a)
        b += 2
        d = 1 / (an * d + b or 1e-300)
        c = b + an / c or 1e-300
        h *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return min(1.0, front * h)


def beta_share(x: float, a: float, b: float) -> float:
    """The regularised incomplete beta function by its continued fraction, from the side where that is short."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_share(1 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1))
    h = d
    for m in range(1, 500):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d, c = 1 / (1 + step * d), 1 + step / c
            h *= d * c
        if abs(d * c - 1) < 1e-14:
            break
    return front * h


def f_quantile(share: float, of: float, over: float) -> float:
    """The value below which an F variable of (of, over) degrees of freedom is with this probability."""
    low, high = 0.0, 1.0
    below = lambda v: beta_share(of * v / (of * v + over), of / 2, over / 2)
    while below(high) < share and high < 1e12:
        high *= 2
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < share else (low, middle)
    return (low + high) / 2
