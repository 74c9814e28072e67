"""Book rebuild: hand-computed cases, and random streams against a plain sequential restatement."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tickflow.functions.clock import from_us
from tickflow.operators import book as bk
from tickflow.plans import features as pf

SCHEMA = "symbol string, us long, seq long, action string, id long, side string, price double, size int"


def events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", from_us("us"))


BK1 = [
    ("X", 0, 1, "partial", 1, "Buy", 100.0, 10),
    ("X", 0, 2, "partial", 2, "Sell", 101.0, 5),
    ("X", 50_000, 3, "insert", 3, "Buy", 100.5, 2),
    ("X", 120_000, 4, "update", 3, "Buy", 0.0, 4),
    ("X", 120_000, 5, "delete", 3, "Buy", 0.0, 0),
    ("X", 250_000, 6, "insert", 4, "Buy", 99.0, 1),
]


@pytest.mark.parametrize(
    "snapshot,mids", [("batch", [100.5, 100.75, 100.5, 100.5]), ("row", [None, 100.75, None, 100.0])]
)
@pytest.mark.parametrize("pieces", [1, 4])
def test_hand_computed_mids(spark, snapshot, mids, pieces):
    chunked = bk.chunk_book(events(spark, BK1), pieces=pieces)
    got = bk.book_ticks(chunked, snapshot=snapshot).orderBy("us").collect()
    assert [r["us"] for r in got] == [0, 50_000, 120_000, 250_000]
    assert [r["mid"] for r in got] == mids


def test_hand_computed_grid(spark):
    df = events(spark, BK1)
    ticks, moves = pf.book_tick_table(df, 100_000, 15, "batch", "tick", True)
    bins = {r["bin"]: r for r in pf.book_bins(ticks, moves, 100_000).where("in_book").collect()}
    assert bins[0]["ret"] == pytest.approx(0.002484473, abs=1e-9)
    assert bins[100_000]["ret"] == pytest.approx(-0.002484473, abs=1e-9)
    assert bins[200_000]["ret"] == 0


def test_row_and_tick_returns(spark):
    rows = [
        ("X", 0, 1, "insert", 1, "Buy", 99.0, 1), ("X", 0, 2, "insert", 2, "Sell", 101.0, 1),
        ("X", 1, 3, "insert", 3, "Sell", 100.5, 1), ("X", 1, 4, "delete", 1, "Buy", 0.0, 0),
        ("X", 1, 5, "insert", 4, "Buy", 99.5, 1),
    ]
    ticks = bk.book_ticks(bk.chunk_book(events(spark, rows)))
    got = {m: bk.tick_returns(ticks, returns=m).where("us = 1").first()["log_return"] for m in ("tick", "row")}
    assert got["tick"] == pytest.approx(math.log(100.0 / 100.0))
    assert got["row"] == pytest.approx(math.log(100.0 / 99.75))


def naive(rows, snapshot, depth):
    """(symbol, us) -> (mid, bids, asks), replayed one row at a time."""
    out, book, snap = {}, {}, {}
    for sym, us, _seq, action, ident, side, price, size in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        levels = book.setdefault(sym, {})
        if action == "partial" and (snapshot == "row" or snap.get(sym) != us):
            levels.clear()
            snap[sym] = us
        key = (side, ident)
        if action in ("partial", "insert"):
            if price and price > 0 and size is not None and size > 0:
                levels[key] = (price, size)
        elif action == "update" and key in levels and size is not None:
            if size > 0:
                levels[key] = (levels[key][0], size)
            else:
                del levels[key]
        elif action == "delete":
            levels.pop(key, None)
        sides = []
        for s, flip in (("Buy", -1), ("Sell", 1)):
            total = {}
            for (ls, _), (p, z) in levels.items():
                if ls == s:
                    total[p] = total.get(p, 0) + z
            sides.append([(p, float(total[p])) for p in sorted(total, key=lambda p: flip * p)][:depth])
        mid = (sides[0][0][0] + sides[1][0][0]) / 2 if sides[0] and sides[1] else None
        out[sym, us] = (mid, *sides)
    return out


def random_rows(seed, n=600):
    rnd = random.Random(seed)
    rows, us = [], 0
    for seq in range(n):
        us += rnd.choice([0, 0, 1, 5, 40])
        side = rnd.choice(["Buy", "Sell"])
        action = rnd.choices(["insert", "update", "delete", "partial"], [5, 4, 3, 0.4])[0]
        base = 100 - rnd.randint(1, 9) if side == "Buy" else 100 + rnd.randint(1, 9)
        rows.append(
            (rnd.choice("AAAB"), us, seq, action, rnd.randint(1, 14), side,
             float(base) if action in ("insert", "partial") else 0.0, rnd.choice([0, 1, 2, 3, None]))
        )
    return rows


@pytest.mark.parametrize("snapshot", ["batch", "row"])
@pytest.mark.parametrize("seed,pieces", [(1, 1), (2, 13), (3, 40)])
def test_replay_equals_sequential(spark, seed, pieces, snapshot):
    rows = random_rows(seed)
    want = naive(rows, snapshot, 4)
    chunked = bk.chunk_book(events(spark, rows), pieces=pieces)
    got = bk.book_ticks(chunked, depth=4, snapshot=snapshot).collect()
    assert len(got) == len(want)
    for r in got:
        mid, bids, asks = want[r["symbol"], r["us"]]
        assert r["mid"] == mid
        assert [tuple(x) for x in r["bids"]] == bids
        assert [tuple(x) for x in r["asks"]] == asks


def test_state_equals_replay_end(spark):
    rows = random_rows(9)
    last = {}
    for (sym, us), v in naive(rows, "batch", 99).items():
        last[sym] = v
    got = bk.top_levels(bk.book_state(events(spark, rows)), 99).collect()
    for sym, (_, bids, asks) in last.items():
        for side, want in (("Buy", bids), ("Sell", asks)):
            mine = sorted((r for r in got if r["symbol"] == sym and r["side"] == side), key=lambda r: r["level"])
            assert [(r["price"], float(r["size"])) for r in mine] == want


def test_chunking_does_not_change_returns(spark):
    df = events(spark, random_rows(5))
    one, many = (
        {(r["symbol"], r["us"]): r["log_return"] for r in bk.tick_returns(bk.book_ticks(bk.chunk_book(df, pieces=p))).collect()}
        for p in (1, 17)
    )
    assert one == many


def test_relabel(spark):
    rows = [
        ("X", 0, 1, "insert", 1, "Buy", 100.0, 5), ("X", 1, 2, "update", 1, "Buy", 0.0, 0),
        ("X", 2, 3, "update", 1, "Buy", 0.0, 0), ("X", 3, 4, "update", 7, "Sell", 0.0, 0),
        ("X", 4, 5, "insert", 7, "Sell", 101.0, 2), ("X", 5, 6, "update", 7, "Sell", 0.0, None),
        ("X", 6, 7, "update", 7, "Sell", 0.0, 0),
    ]
    for pieces in (1, 4):
        got = bk.relabel_kills(bk.chunk_book(events(spark, rows), pieces=pieces)).collect()
        assert sorted(r["seq"] for r in got) == [2, 7]


def test_live_state_moves_price(spark):
    rows = [("X", 0, 1, "insert", 1, "Buy", 100.0, 5), ("X", 1, 2, "update", 1, "Buy", 99.0, 7)]
    df = events(spark, rows)
    got = bk.live_levels(bk.live_facts(df), bk.live_epochs(df)).collect()
    assert [(r["price"], r["size"]) for r in got] == [(99.0, 7)]
    kept = bk.book_state(df).collect()
    assert [(r["price"], r["size"]) for r in kept] == [(100.0, 7)]


def test_depth_functions(spark):
    from tickflow.functions.depth import depth_imbalance, depth_wap

    df = spark.sql(
        "select array(struct(100D as price, 3D as size), struct(99D as price, 1D as size)) b, array(struct(101D as price, 1D as size)) a"
    ).select(
        depth_imbalance(F.col("b"), F.col("a"), 15).alias("obi"),
        depth_wap(F.col("b"), F.col("a"), F.lit(100.5), 15).alias("wap"),
        depth_wap(F.array().cast("array<struct<price:double,size:double>>"), F.lit(None).cast("array<struct<price:double,size:double>>"), F.lit(7.0), 15).alias("none"),
    )
    r = df.first()
    assert r["obi"] == pytest.approx(0.6)
    assert r["wap"] == pytest.approx((300 + 99 + 101) / 5)
    assert r["none"] == 7.0
