"""Functions of a depth snapshot held as two array<struct<price,size>> columns, best first."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEVELS = "array<struct<price:double,size:double>>"


def _sum(levels: Column, term) -> Column:
    return F.aggregate(levels, F.lit(0.0), lambda acc, lv: acc + term(lv))


def _pairs(levels: Column, depth: int) -> Column:
    return F.slice(F.coalesce(levels, F.array().cast(LEVELS)), 1, depth)


def depth_imbalance(bids: Column, asks: Column, depth: int) -> Column:
    """(sum of bid sizes - sum of ask sizes) / (their sum), 0 on an empty book."""
    b = _sum(_pairs(bids, depth), lambda lv: lv["size"])
    a = _sum(_pairs(asks, depth), lambda lv: lv["size"])
    return F.when(a + b > 0, (b - a) / (a + b)).otherwise(F.lit(0.0))


def depth_wap(bids: Column, asks: Column, mid: Column, depth: int) -> Column:
    """Size-weighted price over both sides; the mid where there is none."""
    b, a = _pairs(bids, depth), _pairs(asks, depth)
    volume = _sum(b, lambda lv: lv["size"]) + _sum(a, lambda lv: lv["size"])
    notional = _sum(b, lambda lv: lv["price"] * lv["size"]) + _sum(
        a, lambda lv: lv["price"] * lv["size"]
    )
    wap = F.when(volume > 0, notional / volume)
    return F.when(wap > 0, wap).otherwise(mid)
