"""Day arithmetic (P4-P6). Days are ``DateType``; ``yyyyMMdd`` text is parsed once."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

DateLike = "str | datetime.date"


def to_day(value) -> _dt.date:
    """Normalise an as-of day given as ``date``, ``yyyy-MM-dd`` or ``yyyyMMdd``."""
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    text = str(value).strip()
    fmt = "%Y%m%d" if len(text) == 8 and text.isdigit() else "%Y-%m-%d"
    return _dt.datetime.strptime(text, fmt).date()


def day_lit(value) -> Column:
    return F.lit(to_day(value))


def shift(value, days: int) -> _dt.date:
    return to_day(value) + _dt.timedelta(days=days)


def window_start(asof, day_num: int) -> _dt.date:
    """First day of a ``day_num``-day window ending on ``asof``."""
    return shift(asof, -(day_num - 1))


def day_col(col) -> Column:
    """A day column from ``DATE``, timestamp, or ``yyyyMMdd`` text / int."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.try_to_date(c.cast("string"), "yyyyMMdd"), F.to_date(c))


def age(dt, asof) -> Column:
    """Days between the as-of day and the event day (P5), as BIGINT."""
    c = F.col(dt) if isinstance(dt, str) else dt
    return F.datediff(day_lit(asof), c).cast("bigint")


def day_slug(dt, days_back: int = 0) -> Column:
    """``MMdd`` slug of a day, optionally shifted back."""
    c = F.col(dt) if isinstance(dt, str) else dt
    return F.date_format(F.date_sub(c, days_back), "MMdd")


def day_in(dt, days) -> Column:
    """``dt IN (days)`` written so the scan can prune: a range over the span of
    the days (pushed to the reader, also through ``to_date(ts)``) plus the exact
    set (a bare ``IN`` over a derived date is not pushed)."""
    c = F.col(dt) if isinstance(dt, str) else dt
    ds = sorted({to_day(d) for d in days})
    return c.between(F.lit(ds[0]), F.lit(ds[-1])) & c.isin(ds)
