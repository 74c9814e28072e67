"""Operators whose key may be as long as the table: no task or window holds a whole key."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_ordered import greedy
from tickflow.functions.clock import from_us
from tickflow.operators import dedup as d
from tickflow.operators import grid as g
from tickflow.operators import ordered as o
from tickflow.plans import features as pf

DAY = 86_400_000_000


@pytest.mark.parametrize("fold,pieces", [(2, 37), (5, 60), (64, 30)])
def test_throttle_folds_chunk_maps_in_levels(spark, monkeypatch, fold, pieces):
    monkeypatch.setattr(d, "FOLD", fold)
    rnd = random.Random(fold)
    rows, us = [], 0
    for seq in range(900):
        us += rnd.choice([0, 1, 2, 3, 9])
        rows.append((rnd.choice("AAAAB"), us, seq, rnd.random() < 0.02))
    df = spark.createDataFrame(rows, "symbol string, us long, seq long, must boolean")
    chunked = o.range_chunks(df, ["symbol"], ["us", "seq"], pieces)
    got = d.throttle(chunked, F.col("must"), gap_us=40, chunk="chunk").collect()
    assert sorted(r["seq"] for r in got) == greedy(rows, 40)


def test_throttle_start_and_empty(spark):
    rows = [("X", 5, 0, False), ("X", 12, 1, False), ("Y", 1, 2, False)]
    df = spark.createDataFrame(rows, "symbol string, us long, seq long, must boolean")
    start = spark.createDataFrame([("X", 0)], "symbol string, last long")
    got = d.throttle(df, F.col("must"), gap_us=10, start=start).collect()
    assert sorted(r["seq"] for r in got) == [1, 2]
    assert d.throttle(df.where("false"), F.col("must"), gap_us=10).collect() == []


def test_composed_map_equals_the_walk():
    """A composed map gives, for every entry time, what walking its chunks one by one gives."""
    rnd = np.random.default_rng(4)
    import pandas as pd

    for _ in range(30):
        us = np.sort(rnd.integers(0, 200, 60))
        must = rnd.random(60) < 0.05
        cuts = np.sort(rnd.choice(np.arange(1, 60), 6, replace=False))
        parts = []
        for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, 60]):
            n = d._candidates(us[lo:hi], must[lo:hi], 25)
            ends = d._exits(us[lo:hi], must[lo:hi], 25)
            parts.append(pd.DataFrame({"entry": us[lo:hi][:n], "must": must[lo:hi][:n], "exit": ends[:n]}))
        entry, hit, leave = d._compose(parts, 25)
        for last in [None, *range(int(us[0]) - 40, int(us[0]) + 1)]:
            kept = np.flatnonzero(d._greedy(us, must, 25, last))
            at = d._first_accepted(entry, hit, 25, last)
            want = int(us[kept[-1]]) if len(kept) else None
            assert (int(leave[at]) if at < len(entry) else None) == want


@pytest.mark.parametrize("pieces", [1, 7])
def test_intervals_overlapping_and_a_week_long(spark, pieces):
    rnd = random.Random(pieces)
    rows = [(rnd.choice("AAB"), rnd.randint(0, 10 * DAY), i, rnd.choice([None, 1.0, 2.0, 3.0])) for i in range(400)]
    rows += [("A", 100, 400, 7.0), ("A", 100, 401, None), ("A", 100, 402, 8.0)]
    spans = [(rnd.choice("ABC"), s := rnd.randint(0, 9 * DAY), s + rnd.choice([1, 3_600_000_000, DAY, 7 * DAY])) for _ in range(80)]
    spans += [("A", 100, 101), ("A", 99, 100), ("A", 50, 50), ("A", 60, 40), spans[0]]
    df = spark.createDataFrame(rows, "symbol string, us long, seq long, v double").withColumn("ts", from_us("us"))
    iv = spark.createDataFrame(spans, "symbol string, a long, b long").select(
        "symbol", from_us("a").alias("start_ts"), from_us("b").alias("end_ts"), F.lit("x").alias("extra")
    )
    want = {}
    for sym, a, b in spans:
        inside = sorted((u, q, v) for s, u, q, v in rows if s == sym and a <= u < b)
        if inside:
            valid = [v for _, _, v in inside if v is not None]
            want[sym, a, b] = valid[-1] if valid else None
    got = g.last_in_interval(df, iv, "v", order=("seq",), pieces=pieces).selectExpr(
        "symbol", "unix_micros(cast(start_ts as timestamp)) a", "unix_micros(cast(end_ts as timestamp)) b", "last"
    ).collect()
    assert {(r["symbol"], r["a"], r["b"]): r["last"] for r in got} == want and len(got) == len(want)


def test_blocks_of_a_long_key_equal_plain_loops(spark):
    rnd = random.Random(2)
    x = [rnd.uniform(-5, 5) for _ in range(700)]
    df = spark.createDataFrame([(None if i % 7 == 0 else "K", i, v) for i, v in enumerate(x)], "k string, i long, v double")
    got = o.in_blocks(
        df, ["k"], ["i"], max(9, o.ema_reach(4)),
        lambda rows, keys: o.ema(o.rolling_std(rows, "v", keys, ["i"], 10), "v", keys, ["i"], 4), block=50,
    ).collect()
    assert len(got) == 700 and set(got[0].asDict()) == {"k", "i", "v", "rolling_std", "ema"}
    for key in (None, "K"):
        seen, y = [], None
        for r in sorted((r for r in got if r["k"] == key), key=lambda r: r["i"]):
            seen.append(r["v"])
            y = r["v"] if y is None else 0.6 * y + 0.4 * r["v"]
            assert r["ema"] == pytest.approx(y, rel=1e-12, abs=1e-12)
            std = np.std(seen[-10:]) if len(seen) >= 10 else 0.0
            assert r["rolling_std"] == pytest.approx(std, rel=1e-9, abs=1e-12)


def test_bins_over_days_without_a_wide_window(spark):
    rows = [("X", 50, 1, 1.0), ("X", 3 * DAY + 10, 2, None), ("X", 5 * DAY, 3, 5.0), ("Y", DAY, 4, 2.0)]
    df = spark.createDataFrame(rows, "symbol string, us long, seq long, v double").withColumn("ts", from_us("us"))
    last = g.bin_last(df, "v", DAY, fill=True).where("symbol = 'X'").orderBy("bin").collect()
    assert [r["last"] for r in last] == [1.0, 1.0, 1.0, 1.0, 1.0, 5.0]
    asof = g.bin_asof(df, "v", DAY).where("symbol = 'X'").orderBy("bin").collect()
    assert [r["asof"] for r in asof] == [None, 1.0, 1.0, 1.0, 1.0, 5.0]
    f7 = pf.oi_log_return(df.withColumn("openInterest", F.col("v")), DAY).where("symbol = 'X'").orderBy("bin").collect()
    assert [r["f7"] for r in f7] == pytest.approx([0, 0, 0, 0, 0, math.log(5)])


def _windows(df):
    text = df._jdf.queryExecution().optimizedPlan().toString()
    return re.findall(r"windowspecdefinition\(([^)]*)\)", text), text


def test_no_window_over_rows_is_keyed_by_symbol_alone(spark):
    rows = [("X", i * 3_600_000_000, i, float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "symbol string, us long, seq long, v double").withColumn("ts", from_us("us"))
    dense = [
        g.bin_last(df, "v", 3_600_000_000, fill=True), g.bin_asof(df, "v", 3_600_000_000),
        pf.oi_log_return(df.withColumn("openInterest", F.col("v")), 3_600_000_000),
    ]
    for plan in dense:
        specs, text = _windows(plan)
        assert specs
        for spec in specs:
            # Ordered by bin: within days.  Ordered by day: one small row a day.
            parts = [re.sub(r"#\d+L?", "", p.strip()) for p in spec.split(",")]
            assert "_day" in parts[1] or "_day" in parts[:2], spec
