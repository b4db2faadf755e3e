"""Student t and F tail probabilities (SciPy is not a dependency).

Called on one small model row per section, never on data rows.
"""

from __future__ import annotations

import math


def regularised_beta(x: float, a: float, b: float) -> float:
    """I_x(a, b) by its continued fraction, on the side where it converges fast."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - regularised_beta(1.0 - x, b, a)
    log_front = (
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
        + a * math.log(x) + b * math.log1p(-x)
    )
    tiny = 1e-300
    value, c, d = 1.0, 1.0, 0.0
    for step in range(5000):
        m, odd = divmod(step, 2)
        if step == 0:
            term = 1.0
        elif odd:
            term = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        else:
            term = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1.0 / ((1.0 + term * d) or tiny)
        c = (1.0 + term / c) or tiny
        value *= c * d
        if abs(c * d - 1.0) < 1e-16:
            break
    return math.exp(log_front) * (value - 1.0) / a


def t_two_sided(t: float, df: float) -> float:
    """P(|T| > |t|)."""
    return regularised_beta(df / (df + t * t), df / 2.0, 0.5)


def f_upper(f: float, df1: float, df2: float) -> float:
    """P(F > f)."""
    return regularised_beta(df2 / (df2 + df1 * f), df2 / 2.0, df1 / 2.0)


def t_quantile(level: float, df: float) -> float:
    """The t with P(|T| <= t) = ``level``: half-width of a two-sided interval."""
    target = 1.0 - level
    low, high = 0.0, 1.0
    while t_two_sided(high, df) > target:
        high *= 2.0
    for _ in range(200):
        middle = 0.5 * (low + high)
        if middle in (low, high):
            break
        if t_two_sided(middle, df) > target:
            low = middle
        else:
            high = middle
    return 0.5 * (low + high)
