"""Time as epoch microseconds (long) for grid arithmetic, TIMESTAMP_NTZ at the edges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_us(ts: Column | str) -> Column:
    """TIMESTAMP_NTZ (UTC wall clock) to epoch microseconds."""
    return F.unix_micros(_c(ts).cast("timestamp"))


def from_us(us: Column | str) -> Column:
    return F.timestamp_micros(_c(us)).cast("timestamp_ntz")


def floor_us(us: Column | str, step: int) -> Column:
    us = _c(us)
    return us - F.pmod(us, F.lit(step))


def ceil_us(us: Column | str, step: int) -> Column:
    us = _c(us)
    return us + F.pmod(-us, F.lit(step))
