"""Small numpy helpers for probability functions that Spark does not have."""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np

_NORMAL = NormalDist()
# Coefficients of the Stirling series of log-gamma, B(2k) / (2k (2k - 1)).
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)


def log_gamma(x) -> np.ndarray:
    """log Gamma for positive arguments: recurrence up by 8, then the Stirling series."""
    x = np.asarray(x, dtype=float)
    small = np.minimum(x, 1e6)  # far out the series needs no recurrence
    product = np.ones_like(small)
    for i in range(8):
        product = product * (small + i)
    far = x > 1e6
    z = np.where(far, x, x + 8.0)
    inverse = 1.0 / z
    square, series = inverse * inverse, np.zeros_like(z)
    for c in reversed(_STIRLING):
        series = series * square + c
    stirling = (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + series * inverse
    return stirling - np.where(far, 0.0, np.log(product))


def polygamma(x) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of log Gamma (digamma, trigamma) for positive arguments, as ``log_gamma`` is summed."""
    x = np.asarray(x, dtype=float)
    far = x > 1e6
    near = np.where(far, 1.0, x)  # far out the series needs no recurrence
    first, second = np.zeros_like(near), np.zeros_like(near)
    for i in range(8):
        step = 1.0 / (near + i)
        first, second = first + step, second + step * step
    z = np.where(far, x, x + 8.0)
    inverse = 1.0 / z
    square = inverse * inverse
    slope, bend = np.zeros_like(z), np.zeros_like(z)
    for k, c in reversed(list(enumerate(_STIRLING, 1))):
        slope, bend = slope * square + (2 * k - 1) * c, bend * square + (2 * k - 1) * 2 * k * c
    digamma = np.log(z) - 0.5 * inverse - slope * square - np.where(far, 0.0, first)
    trigamma = inverse + 0.5 * square + bend * square * inverse + np.where(far, 0.0, second)
    return digamma, trigamma


def hyp2f1(a, b, c, z, max_terms: int = 200_000, tolerance: float = 1e-14) -> np.ndarray:
    """Gauss hypergeometric series for 0 <= z < 1.

    Elements that have converged are set aside every few terms, so that one slow
    element does not keep a whole batch busy.
    """
    a, b, c, z = (np.array(v, dtype=float).ravel() for v in np.broadcast_arrays(a, b, c, z))
    result = np.ones(z.shape)
    open_, term, total = np.arange(z.size), np.ones(z.size), np.ones(z.size)
    for k in range(max_terms):
        term = term * ((a + k) * (b + k) / ((c + k) * (k + 1.0))) * z
        total = total + term
        if k % 16 == 15 or open_.size == 0:
            busy = np.abs(term) > tolerance * np.abs(total)
            result[open_[~busy]] = total[~busy]
            open_, term, total = open_[busy], term[busy], total[busy]
            a, b, c, z = a[busy], b[busy], c[busy], z[busy]
            if open_.size == 0:
                return result
    raise ArithmeticError("hypergeometric series did not converge")


def normal_cdf(z) -> np.ndarray:
    z = np.asarray(z, dtype=float)
    return np.array([0.5 * math.erfc(-v / math.sqrt(2.0)) for v in z.ravel()]).reshape(z.shape)


def normal_sf(z) -> np.ndarray:
    return normal_cdf(-np.asarray(z, dtype=float))


def normal_ppf(p) -> np.ndarray:
    p = np.asarray(p, dtype=float)
    return np.array([_NORMAL.inv_cdf(v) for v in p.ravel()]).reshape(p.shape)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 100_000):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for step in (even, odd):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            h *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return h
    raise ArithmeticError("incomplete beta function did not converge")


def _stirling_rest(x: float) -> float:
    """log-gamma less Stirling's main terms, for x of 10 or more."""
    r = 1.0 / (x * x)
    return (1.0 / 12.0 - r * (1.0 / 360.0 - r * (1.0 / 1260.0 - r / 1680.0))) / x


def log_beta(a: float, b: float) -> float:
    """Logarithm of the beta function without differences of large log-gammas."""
    a, b = min(a, b), max(a, b)
    if b < 10.0:
        return math.lgamma(a) + math.lgamma(b) - math.lgamma(a + b)
    rest, share = _stirling_rest(b) - _stirling_rest(a + b), -math.log1p(a / b)  # share: log(b / (a + b))
    if a < 10.0:
        return math.lgamma(a) + rest + a - a * math.log(a + b) + (b - 0.5) * share
    return 0.5 * math.log(2.0 * math.pi) - 0.5 * math.log(b) + _stirling_rest(a) + rest + (a - 0.5) * math.log(a / (a + b)) + b * share


def beta_inc(a: float, b: float, x: float, y: float | None = None) -> float:
    """Regularised incomplete beta function; ``y`` is 1 - x where the caller knows it more exactly."""
    y = 1.0 - x if y is None else y
    if x <= 0.0:
        return 0.0
    if y <= 0.0:
        return 1.0
    log_x = math.log(x) if x < 0.5 else math.log1p(-y)
    log_y = math.log(y) if y < 0.5 else math.log1p(-x)
    front = math.exp(a * log_x + b * log_y - log_beta(a, b))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, y) / b


def t_two_sided(t: float, df: float) -> float:
    """Exact up to a million degrees of freedom; beyond, by Peizer and Pratt's normal deviate, whose error falls with df ** 2."""
    if df > 1e6:
        z = (df - 2.0 / 3.0 + 0.1 / df) * math.sqrt(math.log1p(t * t / df) / (df - 5.0 / 6.0))
        return math.erfc(z / math.sqrt(2.0))
    return beta_inc(df / 2.0, 0.5, df / (df + t * t), t * t / (df + t * t))


def f_upper(f: float, df1: float, df2: float) -> float:
    return beta_inc(df2 / 2.0, df1 / 2.0, df2 / (df2 + df1 * f), df1 * f / (df2 + df1 * f))


def t_quantile(p: float, df: float) -> float:
    """Quantile of Student's t for p > 0.5, by bisection."""
    tail = 2.0 * (1.0 - p)
    low, high = 0.0, 1.0
    while t_two_sided(high, df) > tail:
        high *= 2.0
    for _ in range(200):
        mid = 0.5 * (low + high)
        low, high = (mid, high) if t_two_sided(mid, df) > tail else (low, mid)
    return 0.5 * (low + high)


def shapiro_wilk(values) -> tuple[float, float]:
    """W and p by Royston's approximation (1995), for 3 to 5000 values."""
    x = np.sort(np.asarray(values, dtype=float))
    n = len(x)
    if n < 3 or x[-1] == x[0]:
        return math.nan, math.nan
    m = normal_ppf((np.arange(1, n + 1) - 0.375) / (n + 0.25))
    ss = float(m @ m)
    u = 1.0 / math.sqrt(n)
    a = np.zeros(n)
    # Published polynomial coefficients, highest power first.
    last = np.polyval([-2.706056, 4.434685, -2.071190, -0.147981, 0.221157, m[-1] / math.sqrt(ss)], u)
    second = np.polyval([-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, m[-2] / math.sqrt(ss)], u)
    if n == 3:
        a[0], a[-1] = -math.sqrt(0.5), math.sqrt(0.5)
    elif n <= 5:
        phi = (ss - 2 * m[-1] ** 2) / (1 - 2 * last**2)
        a[1:-1] = m[1:-1] / math.sqrt(phi)
        a[0], a[-1] = -last, last
    else:
        phi = (ss - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last**2 - 2 * second**2)
        a[2:-2] = m[2:-2] / math.sqrt(phi)
        a[0], a[1], a[-2], a[-1] = -last, -second, second, last
    w = min(float(a @ x) ** 2 / float(((x - x.mean()) ** 2).sum()), 1.0)
    return w, shapiro_p(w, n)


def shapiro_from_sums(n: float, mm: float, mx: float, xx: float, low: float, low2: float, high2: float, high: float) -> tuple[float, float]:
    """W and p from sums over a sample of any size, values taken from their mean.

    mm, mx, xx: sums of squared normal scores, of scores times values, of squared values. low, low2, high2, high: the two
    smallest and the two largest values. The outer weights are corrected, the inner ones are scaled scores.
    """
    if n < 3 or not xx > 0.0:
        return math.nan, math.nan
    top, top2 = (float(normal_ppf(np.array([(n - k - 0.375) / (n + 0.25)]))[0]) for k in (0, 1))
    u = 1.0 / math.sqrt(n)
    # Published polynomial coefficients, highest power first.
    last = np.polyval([-2.706056, 4.434685, -2.071190, -0.147981, 0.221157, top / math.sqrt(mm)], u)
    second = np.polyval([-3.582633, 5.682633, -1.752461, -0.293762, 0.042981, top2 / math.sqrt(mm)], u)
    if n == 3:
        total = math.sqrt(0.5) * (high - low)
    elif n <= 5:
        phi = (mm - 2 * top**2) / (1 - 2 * last**2)
        total = (mx - top * (high - low)) / math.sqrt(phi) + last * (high - low)
    else:
        phi = (mm - 2 * top**2 - 2 * top2**2) / (1 - 2 * last**2 - 2 * second**2)
        total = (mx - top * (high - low) - top2 * (high2 - low2)) / math.sqrt(phi) + last * (high - low) + second * (high2 - low2)
    w = min(total**2 / xx, 1.0)
    return w, shapiro_p(w, int(n))


def shapiro_p(w: float, n: int) -> float:
    """p of W by Royston's approximation."""
    if n == 3:
        return max(6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))), 0.0)
    if w >= 1.0:
        return 1.0
    if n <= 11:
        gamma = -2.273 + 0.459 * n
        if gamma <= math.log(1 - w):
            return 0.0
        y = -math.log(gamma - math.log(1 - w))
        mu = np.polyval([-0.0006714, 0.025054, -0.39978, 0.5440], n)
        sigma = math.exp(np.polyval([-0.0020322, 0.062767, -0.77857, 1.3822], n))
    else:
        y, ln = math.log(1 - w), math.log(n)
        mu = np.polyval([0.0038915, -0.083751, -0.31082, -1.5861], ln)
        sigma = math.exp(np.polyval([0.0030302, -0.082676, -0.4803], ln))
    return float(normal_sf((y - mu) / sigma))


#: Positions at either end of a sample, and lengths of runs, whose normal scores are added one by one.
_ONE_BY_ONE = 64


def _score_integrals(x: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Antiderivatives at x + 1/2 of the normal score and of its square by position, with the midpoint rule's corrections.

    With z the score and f the density: z integrates to -f, z * z to p - z f; by p, z grows by 1 / f.
    """
    width = n + 0.25
    p = (x + 0.5 - 0.375) / width
    z = normal_ppf(p)
    f = np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)
    step, cube = 1 / (f * width), 1 / (f * width) ** 3
    once = -f * width - step / 24 + 7 / 5760 * (1 + 2 * z * z) * cube
    square = (p - z * f) * width - 2 * z * step / 24 + 7 / 5760 * (8 * z + 4 * z**3) * cube
    return once, square


def normal_score_sums(before, count, n) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the normal scores, and of their squares, of positions before + 1 .. before + count in a sample of n.

    A score is the normal quantile of (i - 0.375) / (n + 0.25). Positions near the ends and short runs are added one by one,
    the inside of a long run by its integral, so a run of any length costs the same.
    """
    before, count, n = (np.asarray(v, np.int64) for v in (before, count, n))
    end = before + count
    low = np.clip(np.maximum(before, _ONE_BY_ONE), before, end)
    high = np.clip(np.minimum(end, n - _ONE_BY_ONE), low, end)
    short = high - low <= _ONE_BY_ONE
    low, high = np.where(short, end, low), np.where(short, end, high)
    once, square = np.zeros(len(n)), np.zeros(len(n))
    inside = high > low
    if inside.any():
        for sign, at in ((-1.0, low), (1.0, high)):
            a, b = _score_integrals(at[inside].astype(float), n[inside].astype(float))
            once[inside] += sign * a
            square[inside] += sign * b
    for start, stop in ((before, low), (high, end)):
        size = stop - start
        of = np.repeat(np.arange(len(n)), size)
        place = start[of] + 1 + np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
        z = normal_ppf((place - 0.375) / (n[of] + 0.25)) if len(of) else np.zeros(0)
        once += np.bincount(of, z, len(n))
        square += np.bincount(of, z * z, len(n))
    return once, square
