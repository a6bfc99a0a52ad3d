"""Scalar feature expressions (P7-P11) and windowed-sum building blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def within(age, n: int, strict: bool = False) -> Column:
    """``age <= n`` (click / buy windows) or ``age < n`` (open windows)."""
    a = col(age)
    return a < n if strict else a <= n


def window_sum(value, age, n: int | None, strict: bool = False, extra: Column | None = None) -> Column:
    """``sum(if(age <= n [and extra], value, 0))``; ``n=None`` sums everything."""
    cond = F.lit(True) if n is None else within(age, n, strict)
    if extra is not None:
        cond = cond & extra
    return F.sum(F.when(cond, col(value)).otherwise(F.lit(0)))


def safe_ratio(num, den, default: float | None = 0.0) -> Column:
    """``num / den`` with 0 / NULL denominators mapped to ``default``."""
    r = F.try_divide(col(num).cast("double"), col(den).cast("double"))
    return r if default is None else F.coalesce(r, F.lit(float(default)))


def guarded_ctr(clicks, opens, floor: int) -> Column:
    """0 when opens are NULL or below ``floor``, else ``coalesce(clicks,0)/opens``."""
    o = col(opens)
    return (F.when(o.isNull() | (o < floor), F.lit(0.0))
            .otherwise(F.try_divide(F.coalesce(col(clicks), F.lit(0)).cast("double"), o.cast("double"))))


def flag(cond: Column) -> Column:
    """Binary flag (P10)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def recency_gap(last_seen, last_buy, default: int = -1) -> Column:
    """``coalesce(last_seen - last_buy, default)``."""
    return F.coalesce(col(last_seen) - col(last_buy), F.lit(default)).cast("bigint")
