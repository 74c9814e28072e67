"""Ordered operators: hand-computed cases and plain loops, with chunk edges everywhere."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickflow.functions.clock import from_us
from tickflow.operators import dedup as d
from tickflow.operators import grid as g
from tickflow.operators import ordered as o


def series(spark, values, symbol="X"):
    return spark.createDataFrame([(symbol, i, None if v is None else float(v)) for i, v in enumerate(values)], "symbol string, i long, v double")


def out(df, col):
    return [r[col] for r in df.orderBy("symbol", "i").collect()]


def test_rolling_std(spark):
    got = out(o.rolling_std(series(spark, [1.0, 2, 3, 4]), "v", ["symbol"], ["i"], 2), "rolling_std")
    assert got == pytest.approx([0, 0.5, 0.5, 0.5])


def test_ema_hand(spark):
    assert out(o.ema(series(spark, [2.0, 4, 8]), "v", ["symbol"], ["i"], 3), "ema") == pytest.approx([2, 3, 5.5])


@pytest.mark.parametrize("span,block", [(5, 3), (50, None), (300, 64), (1, None)])
def test_ema_loop(spark, span, block):
    rnd = random.Random(span)
    x = [rnd.uniform(-5, 5) for _ in range(400)]
    a = 2 / (span + 1)
    want = [x[0]]
    for v in x[1:]:
        want.append((1 - a) * want[-1] + a * v)
    assert out(o.ema(series(spark, x), "v", ["symbol"], ["i"], span, block=block), "ema") == pytest.approx(want, rel=1e-9, abs=1e-12)


def rank(values, w, least, strict):
    res = []
    for i, v in enumerate(values):
        win = values[max(0, i - w + 1): i + 1]
        n = sum(1 for y in win if (y < v if strict else y <= v))
        res.append(n / len(win) if len(win) >= least else None)
    return res


def test_rank_hand(spark):
    df = series(spark, [1.0, 3, 2, 2])
    got = out(o.rolling_rank(df, ["v"], ["symbol"], ["i"], 3, 2), "v_rank")
    assert got[0] is None and got[1:] == pytest.approx([1 / 2, 1 / 3, 0])
    le = out(o.rolling_rank(df, ["v"], ["symbol"], ["i"], 3, None, inclusive=True, before=0.0), "v_rank")
    assert le == pytest.approx([0, 0, 2 / 3, 2 / 3])


@pytest.mark.parametrize("block", [3, 10, 64])
@pytest.mark.parametrize("strict", [True, False])
def test_rank_loop(spark, block, strict):
    rnd = random.Random(block)
    x = [float(rnd.randint(0, 9)) for _ in range(150)]
    got = out(o.rolling_rank(series(spark, x), ["v"], ["symbol"], ["i"], 12, 4, inclusive=not strict, block=block), "v_rank")
    for a, b in zip(got, rank(x, 12, 4, strict)):
        assert (a is None and b is None) or a == pytest.approx(b)


def test_interpolate(spark):
    df = series(spark, [None, 1.0, None, 3.0, None])
    assert out(o.interpolate(df, ["v"], ["symbol"], ["i"], "i"), "v") == [1, 1, 2, 3, 3]


@pytest.mark.parametrize("pieces", [1, 7, 31])
def test_fills_do_not_depend_on_chunks(spark, pieces):
    rnd = random.Random(4)
    x = [rnd.choice([None, 0.0, 1.0, 2.0, None]) for _ in range(120)]
    df = o.range_chunks(series(spark, x), ["symbol"], ["i"], pieces)
    f, b, z = [], [None] * len(x), []
    last = nz = None
    for v in x:
        last = v if v is not None else last
        nz = v if v else nz
        f.append(last)
        z.append(nz if nz is not None else v)
    nxt = None
    for i in range(len(x) - 1, -1, -1):
        nxt = x[i] if x[i] is not None else nxt
        b[i] = nxt
    args = (["v"], ["symbol"], ["i"], "chunk")
    assert out(o.ffill(df, *args), "v") == f
    assert out(o.bfill(df, *args), "v") == b
    assert out(o.ffill_zero(df, *args), "v") == z
    line = o.interpolate(df, ["v"], ["symbol"], ["i"], "i", "chunk")
    known = [(i, v) for i, v in enumerate(x) if v is not None]
    want = np.interp(range(len(x)), [i for i, _ in known], [v for _, v in known])
    assert out(line, "v") == pytest.approx(list(want))


def test_clipped_return(spark):
    got = out(o.log_returns(series(spark, [100.0, 200.0, None, -1.0, 200.0]), "v", ["symbol"], ["i"]), "log_return")
    assert got == pytest.approx([0, 0.1, 0, 0, 0])


def test_index_is_total(spark):
    df = spark.range(5000).withColumn("k", F.pmod(F.xxhash64("id"), F.lit(997)))
    got = o.ordered_index(df, ["k", "id"], pieces=9).orderBy("idx").collect()
    assert [r["idx"] for r in got] == list(range(5000))
    assert [(r["k"], r["id"]) for r in got] == sorted((r["k"], r["id"]) for r in got)


def ticks(spark):
    rows = [("X", 50_000, 1, 1.0), ("X", 70_000, 2, 2.0), ("X", 130_000, 3, 3.0), ("X", 410_000, 4, 4.0)]
    return spark.createDataFrame(rows, "symbol string, us long, seq long, v double").withColumn("ts", from_us("us"))


def test_bins(spark):
    step = 100_000
    df = ticks(spark)

    def vals(x, c):
        return [r[c] for r in x.orderBy("bin").collect()]

    assert vals(g.bin_asof(df, "v", step), "asof") == [None, 2, 3, 3, 3]
    assert vals(g.bin_last(df, "v", step), "last") == [2, 3, None, None, 4]
    assert vals(g.bin_sum(df, "v", step), "total") == [3, 3, 0, 0, 4]


def test_labels(spark):
    seg = spark.sql("select timestamp_ntz'2024-01-01 10:00:00' segment_start, 2 regime union all select timestamp_ntz'2024-01-01 10:10:00', 0")
    rows = spark.sql("select explode(array(timestamp_ntz'2024-01-01 09:59:00', timestamp_ntz'2024-01-01 10:05:00', timestamp_ntz'2024-01-01 10:10:00', timestamp_ntz'2024-01-03 11:00:00')) ts")
    got = [r["regime"] for r in g.asof_labels(rows, seg).orderBy("ts").collect()]
    assert got == [2, 2, 0, 0]


def greedy(rows, gap):
    last, kept = {}, []
    for sym, us, seq, must in sorted(rows):
        if must or sym not in last or us - last[sym] >= gap:
            kept.append(seq)
            last[sym] = us
    return sorted(kept)


def test_throttle_hand(spark):
    rows = [("X", 0, 0, False), ("X", 500_000, 1, False), ("X", 600_000, 2, True), ("X", 1_200_000, 3, False), ("X", 1_700_000, 4, False)]
    df = spark.createDataFrame(rows, "symbol string, us long, seq long, must boolean")
    assert sorted(r["seq"] for r in d.throttle(df, F.col("must")).collect()) == [0, 2, 4]


@pytest.mark.parametrize("pieces", [1, 6, 25])
def test_throttle_loop(spark, pieces):
    rnd = random.Random(pieces)
    rows, us = [], 0
    for seq in range(500):
        us += rnd.choice([0, 1, 2, 3])
        rows.append((rnd.choice("AAAB"), us, seq, rnd.random() < 0.05))
    df = spark.createDataFrame(rows, "symbol string, us long, seq long, must boolean")
    chunked = o.range_chunks(df, ["symbol"], ["us", "seq"], pieces)
    got = d.throttle(chunked, F.col("must"), gap_us=10, chunk="chunk").collect()
    assert sorted(r["seq"] for r in got) == greedy(rows, 10)


def test_taker_imbalance_hand(spark):
    from tickflow.plans.features import taker_imbalance

    rows = [("a", "Buy", "PlusTick", 100.0), ("b", "Buy", "MinusTick", 100.0), ("c", "Sell", "MinusTick", 200.0), ("d", "Sell", "Unknown", 50.0)]
    df = spark.createDataFrame(
        [(i, "X", *r) for i, r in enumerate(rows)],
        "seq long, symbol string, trdMatchID string, side string, tickDirection string, foreignNotional double",
    ).withColumn("ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    assert taker_imbalance(df).first()["f4"] == pytest.approx(-math.log(351))


@pytest.mark.parametrize("strict", [True, False])
def test_ranks_count_windows(strict):
    rng = np.random.default_rng(11)
    x = rng.integers(0, 40, 700).astype(float)
    x[rng.random(700) < 0.1] = np.nan
    for first, window, start in ((0, 1, 0), (0, 50, 0), (60, 50, 1000), (0, 900, 0)):
        got = o._ranks(x, first, window, 3, strict, start)
        for i in range(first, len(x)):
            seen = min(start + i + 1, window)
            part = x[max(0, i - window + 1): i + 1]
            want = np.nan if seen < 3 else ((part < x[i]).sum() if strict else (part <= x[i]).sum()) / seen
            assert np.array_equal(got[i - first], want, equal_nan=True)
    assert len(o._ranks(np.zeros(0), 0, 5, 1, True, 0)) == 0


def test_wide_ranks_are_fast():
    import time

    x = np.random.default_rng(12).random(300_000)
    began = time.time()
    o._ranks(x, 0, 3600, 100, True, 0)
    assert time.time() - began < 3
