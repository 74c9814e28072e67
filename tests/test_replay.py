"""The array-wise replay against a plain dictionary book, on books larger than one block."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_book import events, naive
from tickflow.operators import book as bk
from tickflow.operators import replay

ACTIONS = ("insert", "update", "delete", "partial")


def busy_rows(seed, n, prices, ids):
    rnd = random.Random(seed)
    rows, us = [], 0
    for seq in range(n):
        us += rnd.choice([0, 0, 1, 7])
        action = rnd.choices(ACTIONS, [6, 5, 2, 0.01])[0]
        side = rnd.choice(["Buy", "Sell", "Sell", "Buy", "Other", None]) if seq % 50 == 0 else rnd.choice(["Buy", "Sell"])
        price = rnd.choice([None, 0.0, -1.0]) if seq % 41 == 0 else float(rnd.randint(1, prices))
        rows.append(("X", us, seq, action, rnd.randint(1, ids), side, price, rnd.choice([None, 0, 1, 2, 9])))
    return rows


def arrays(rows):
    col = lambda i, kind: np.array([np.nan if r[i] is None else r[i] for r in rows], kind)
    side = np.array([replay.SIDES.index(r[5]) if r[5] in replay.SIDES else -1 for r in rows])
    flags = [np.array([r[3] == a for r in rows]) for a in ACTIONS]
    return replay.Deltas(
        col(1, np.int64), col(2, np.int64), side, col(4, np.int64), col(6, float), col(7, float),
        flags[0], flags[1], flags[2], flags[3],
    )


NOTHING = replay.Levels(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0))


@pytest.mark.parametrize("snapshot", ["batch", "row"])
@pytest.mark.parametrize("seed,prices,ids", [(1, 5, 40), (2, 400, 300), (3, 5000, 20000)])
def test_sweep_equals_dictionaries(seed, prices, ids, snapshot):
    rows = busy_rows(seed, 3000, prices, ids)
    want = naive(rows, snapshot, 15)
    d = arrays(rows)
    lives = replay.lives(d, NOTHING, replay.clearings(d, snapshot, None))
    last = np.flatnonzero(np.r_[d.us[1:] != d.us[:-1], True])
    for side in (0, 1):
        got = replay.sweep(replay.changes(lives, side, len(rows)), last, last, 15)
        at = 0
        for i, row in enumerate(last):
            levels = want["X", d.us[row]][1 + side]
            stop = at + got.lengths[i]
            assert list(zip(got.prices[at:stop], got.sizes[at:stop])) == levels
            assert got.top[i] == levels[0][0] if levels else np.isnan(got.top[i])
            at = stop
        assert at == len(got.prices)


def test_sweep_from_a_given_book():
    """Cutting the rows and starting the second half from the levels alive at the cut changes nothing."""
    rows = [r for r in busy_rows(8, 2000, 60, 200) if r[3] != "partial"]
    want, cut = naive(rows, "batch", 4), 1111
    cut = next(i for i in range(cut, len(rows)) if rows[i][1] != rows[i - 1][1])
    head, tail = arrays(rows[:cut]), arrays(rows[cut:])
    lv = replay.lives(head, NOTHING, np.zeros(0, np.int64))
    open_ = lv.alive & (lv.end == cut)
    # lives() does not give ids back; any distinct ones in the order of the levels serve levels untouched later.
    order = np.lexsort((head.id, head.side))
    pos_id = dict(zip(order, head.id[order]))
    start = replay.Levels(
        lv.side[open_], np.array([pos_id[p] for p in lv.pos[open_]]), lv.price[open_], lv.size[open_]
    )
    lives = replay.lives(tail, start, np.zeros(0, np.int64))
    every = np.arange(len(tail.us))
    last = np.r_[tail.us[1:] != tail.us[:-1], True]
    for side in (0, 1):
        got = replay.sweep(replay.changes(lives, side, len(every)), every, every[:0], 4)
        for row in every[last]:
            levels = want["X", tail.us[row]][1 + side]
            assert got.top[row] == levels[0][0] if levels else np.isnan(got.top[row])


def test_empty_sides_and_no_rows():
    rows = [("X", 0, 0, "update", 1, "Buy", 1.0, 4), ("X", 1, 1, "delete", 1, None, 1.0, 4)]
    d = arrays(rows)
    lives = replay.lives(d, NOTHING, replay.clearings(d, "batch", None))
    got = replay.sweep(replay.changes(lives, 0, 2), np.arange(2), np.arange(2), 3)
    assert np.isnan(got.top).all() and list(got.lengths) == [0, 0] and not len(got.prices)


@pytest.mark.parametrize("pieces", [1, 9])
def test_depth_only_at_interval_ends(spark, pieces):
    rows = busy_rows(5, 1500, 30, 60)
    want = naive(rows, "batch", 3)
    got = bk.book_ticks(bk.chunk_book(events(spark, rows), pieces=pieces), depth=3, depth_every_us=100).collect()
    times = sorted(u for _, u in want)
    after = dict(zip(times, times[1:]))
    for r in got:
        mid, bids, asks = want["X", r["us"]]
        assert r["mid"] == mid
        nxt = after.get(r["us"])
        if nxt is None or -(-r["us"] // 100) != -(-nxt // 100):
            assert [tuple(x) for x in r["bids"]] == bids and [tuple(x) for x in r["asks"]] == asks


@pytest.mark.parametrize("pieces", [1, 12])
def test_kills_by_plain_loop(spark, pieces):
    rows, live, want = busy_rows(6, 1500, 30, 60), set(), set()
    snap = None
    for _, us, seq, action, ident, side, price, size in rows:
        if action == "partial" and us != snap:
            live.clear()
            snap = us
        if side not in replay.SIDES:
            continue
        if action in ("insert", "partial") and price and price > 0 and size:
            live.add((side, ident))
        elif action == "delete" or (action == "update" and size == 0):
            if action == "update" and (side, ident) in live:
                want.add(seq)
            live.discard((side, ident))
    got = bk.relabel_kills(bk.chunk_book(events(spark, rows), pieces=pieces)).select(F.col("seq")).collect()
    assert {r["seq"] for r in got} == want and len(got) == len(want)


def test_small_keys_and_null_keys_in_one_chunk(spark):
    rows = [(f"S{i}", t, 10 * i + t, "insert", t, s, p, 1) for i in range(20) for t, s, p in ((1, "Buy", 9.0), (2, "Sell", 11.0))]
    df = events(spark, [*rows, (None, 5, 999, "insert", 1, "Buy", 3.0, 1)])
    got = bk.book_ticks(bk.chunk_book(df, pieces=1), depth=2).collect()
    assert sorted((r["symbol"], r["us"], r["mid"]) for r in got if r["us"] == 2) == sorted((f"S{i}", 2, 10.0) for i in range(20))
    assert {r["symbol"] for r in got} == {f"S{i}" for i in range(20)}
