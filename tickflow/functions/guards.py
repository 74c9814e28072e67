"""Guarded arithmetic: ANSI mode raises on division by zero, and NaN is not null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite(c: Column | str) -> Column:
    """The value when it is a finite number, else null."""
    c = _c(c)
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def guarded_div(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """num/den where den > 0, else the default."""
    return F.when(den > 0, num / den).otherwise(F.lit(default).cast("double"))


def clip(c: Column | str, lo, hi) -> Column:
    """Clamp; null stays null (greatest/least would skip it)."""
    c = _c(c)
    return F.when(c.isNotNull(), F.greatest(F.least(c, _lit(hi)), _lit(lo)))


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def signed_log(c: Column) -> Column:
    return F.signum(c) * F.log1p(F.abs(c))
