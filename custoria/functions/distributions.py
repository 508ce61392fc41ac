"""Tail probabilities for the few test statistics of a report (never per row)."""

from __future__ import annotations

import math


def _continued_fraction(first: float, terms) -> float:
    """Modified Lentz evaluation; ``terms`` yields (a_n, b_n)."""
    tiny = 1e-300
    f = c = first or tiny
    d = 0.0
    for a, b in terms:
        d = b + a * d or tiny
        c = b + a / c or tiny
        d = 1.0 / d
        f *= c * d
        if abs(c * d - 1.0) < 1e-15:
            break
    return f


def chi_square_tail(x: float, dof: int) -> float:
    """P(X > x) for a chi-square variable."""
    if x <= 0:
        return 1.0
    a, z = dof / 2.0, x / 2.0
    scale = math.exp(-z + a * math.log(z) - math.lgamma(a))
    if z < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= z / n
            total += term
        return max(0.0, 1.0 - total * scale)
    terms = ((-i * (i - a), z + 2 * i + 1 - a) for i in range(1, 10_000))
    return scale / _continued_fraction(z + 1 - a, terms)


def _beta_share(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function."""
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_share(1 - x, b, a)
    scale = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a

    def terms():
        for m in range(10_000):
            if m:
                yield m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), 1.0
            yield -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)), 1.0

    return scale / _continued_fraction(1.0, terms())


def t_two_sided(t: float, dof: float) -> float:
    """P(|T| > |t|) for Student's t."""
    return _beta_share(dof / (dof + t * t), dof / 2.0, 0.5)
