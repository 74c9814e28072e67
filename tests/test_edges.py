"""Cases the shared tables do not hold: ties, chunk edges, large and missing ids, stale days."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickflow.operators import book as bk
from tickflow.operators.dedup import dedup_last, throttle
from tickflow.operators.grid import asof_labels, dense_grid, densify
from tickflow.operators.joins import nearest_centroid
from tickflow.operators.regimes import ward_groups
from tickflow.operators.reports import coverage_matrix
from tickflow.plans.features import aligned_feeds, taker_imbalance
from tickflow.sources import messages as ms
from tickflow.sources.parquet import export_daily
from tickflow.streaming.feeds import dedup_stream, write_rows

BIG = (1 << 53) + 1
START = dt.datetime(2024, 1, 1)
BOOK = "symbol string, ts timestamp_ntz, seq long, id long, side string, action string, price double, size int"


def at(seconds: float) -> dt.datetime:
    return START + dt.timedelta(seconds=seconds)


def one_snapshot(n: int) -> list[tuple]:
    """A snapshot of ``n`` rows of one time, then deletes and inserts, with ids beyond 2**53."""
    rows = [("X", at(0), i, BIG + i, "Buy" if i % 2 else "Sell", "partial", 99.5 - i / 2 if i % 2 else 100.5 + i / 2, 10 + i) for i in range(n)]
    pick, seq = random.Random(2), n
    for step in range(60):
        when = at(1 + step // 3)
        ident = BIG + pick.randrange(n)
        action = pick.choice(["delete", "insert", "update", "update"])
        side = "Buy" if (ident - BIG) % 2 else "Sell"
        price = None if action != "insert" else (99.5 if side == "Buy" else 100.5) + pick.randrange(20) * (-0.5 if side == "Buy" else 0.5)
        rows.append(("X", when, seq, ident, side, action, price, 0 if action == "delete" else pick.randrange(0, 30)))
        seq += 1
    return rows


def replayed(rows: list[tuple]) -> dict:
    """Mid and best levels after the last row of each time, by a dictionary of levels."""
    levels: dict = {}
    out, cleared = {}, None
    for _, ts, _, ident, side, action, price, size in rows:
        if action == "partial" and ts != cleared:
            levels, cleared = {}, ts
        if action in ("partial", "insert"):
            if price and size and price > 0 and size > 0:
                levels[side, ident] = (price, size)
        elif action == "delete" or size <= 0:
            levels.pop((side, ident), None)
        elif (side, ident) in levels:
            levels[side, ident] = (levels[side, ident][0], size)
        bids = [p for (s, _), (p, _) in levels.items() if s == "Buy"]
        asks = [p for (s, _), (p, _) in levels.items() if s == "Sell"]
        out[ts] = (max(bids) + min(asks)) / 2 if bids and asks else None
    return out


@pytest.mark.parametrize("pieces", [1, 4, 40])
def test_replay_over_chunk_edges(spark, pieces):
    rows = one_snapshot(40)
    df = spark.createDataFrame(rows, BOOK)
    ticks = bk.book_ticks(bk.chunk_book(df, ["symbol"], pieces), ["symbol"], depth=3).collect()
    assert {t.ts: t.mid for t in ticks} == replayed(rows)


def test_chunks_follow_the_rows(spark):
    df = spark.range(1000)
    assert bk.many_pieces(df, rows=10) == 100


def test_throttle_of_equal_times(spark):
    rows = [("a", i // 4 * 300_000, i, False) for i in range(400)]
    df = spark.createDataFrame(rows, "symbol string, us long, seq long, must boolean")
    kept = [r.us for r in throttle(df, F.col("must"), gap_us=1_000_000).orderBy("us").collect()]
    want, last = [], None
    for _, us, _, _ in rows:
        if last is None or us - last >= 1_000_000:
            want.append(us)
            last = us
    assert kept == want


def test_trades_without_an_id_all_count(spark):
    rows = [(1, "X", None, 5), (2, "X", None, 5), (3, "X", "", 5), (4, "X", "a", 5), (5, "X", "a", 7)]
    df = spark.createDataFrame(rows, "seq long, symbol string, trdMatchID string, size int")
    kept = dedup_last(df, ["symbol", "trdMatchID"], ident="trdMatchID")
    assert sorted(r.seq for r in kept.collect()) == [1, 2, 3, 5]


def test_flow_has_trades_without_an_id(spark):
    rows = [(i, at(0), "X", None, 100.0, 1, 100.0, "Buy", "PlusTick") for i in range(3)]
    df = spark.createDataFrame(
        rows, "seq long, ts timestamp_ntz, symbol string, trdMatchID string, price double, size int, foreignNotional double, side string, tickDirection string"
    )
    one = taker_imbalance(df.limit(1), 1_000_000).first().f4
    assert taker_imbalance(df, 1_000_000).first().f4 > one


def test_instrument_updates_of_one_time_add_up(spark):
    book = spark.createDataFrame(one_snapshot(4), BOOK)
    trades = spark.createDataFrame(
        [], "seq long, ts timestamp_ntz, symbol string, trdMatchID string, price double, size int, foreignNotional double, side string, tickDirection string"
    )
    updates = spark.createDataFrame(
        [(1, at(2), "X", 101.0, None, None), (2, at(2), "X", None, 102.0, 7)],
        "seq long, ts timestamp_ntz, symbol string, markPrice double, indexPrice double, volume24h long",
    )
    rows = aligned_feeds(book, trades, updates, step=1_000_000, depth=3).where("mark IS NOT NULL AND index IS NOT NULL AND volume IS NOT NULL")
    assert rows.count() > 0


def test_dedup_stream_passes_rows_without_an_id(spark, tmp_path):
    schema = "trdMatchID string, ts timestamp_ntz"
    rows = [("a", at(1)), ("a", at(2)), (None, at(1)), (None, at(2)), ("", at(3)), ("b", at(3))]
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = dedup_stream(spark.readStream.schema(schema).parquet(str(tmp_path / "in")), "trdMatchID")
    write_rows(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    got = sorted(str(r.trdMatchID) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert got == ["", "None", "None", "a", "b"]


def test_export_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "days")
    day = lambda n: spark.createDataFrame([(at(86400 * n), float(n))], "ts timestamp_ntz, f0 double")
    for n in (1, 2, 2):
        export_daily(day(n), path)
    assert sorted(r.f0 for r in spark.read.parquet(path).collect()) == [1.0, 2.0]


def test_rows_keep_without_any_label(spark):
    rows = spark.createDataFrame([(at(1), 1), (at(2), 2)], "ts timestamp_ntz, n int")
    labels = spark.createDataFrame([], "regime int, segment_start timestamp_ntz")
    got = asof_labels(rows, labels).collect()
    assert sorted((r.n, r.regime) for r in got) == [(1, None), (2, None)]


def test_numbers_of_messages(spark):
    text = '{"table":"trade","action":"insert","data":[{"symbol":"X","timestamp":"2024-01-01T00:00:00Z","price":"1e2","size":%s,"grossValue":%s}]}'
    cases = [("100.0", "1e9"), ("7", "9007199254740993"), ("1.5", "1"), ("9999999999", "1"), ("5", '"x"')]
    df = spark.createDataFrame([(i, text % c) for i, c in enumerate(cases)], "offset long, value string")
    parsed = ms.parse_messages(df)
    got = {r.seq // ms.SEQ_STRIDE: (r.price, r["size"], r.grossValue) for r in ms.trades(ms.good_rows(ms.route(parsed))).collect()}
    assert got == {0: (100.0, 100, 10**9), 1: (100.0, 7, 9007199254740993)}
    assert {r.offset: r.reason for r in ms.quarantine(parsed).collect()} == {2: "bad size", 3: "bad size", 4: "bad grossValue"}


def test_ten_years_of_bins(spark):
    df = spark.createDataFrame([("X", at(0)), ("X", at(3650 * 86400))], "symbol string, ts timestamp_ntz")
    # 3,153,600,001 bins of 100 ms would be one array; a coarser step keeps the test short.
    assert dense_grid(df, 10_000_000).count() == 365 * 86400 + 1


def test_gaps_across_days(spark):
    day = 86_400_000_000
    rows = [("X", 0, 1), ("X", 2 * day + 3_600_000_000, 2), ("Y", 5, 3)]
    got = densify(spark.createDataFrame(rows, "symbol string, bin long, v int"), ["symbol"], 3_600_000_000).collect()
    assert len([r for r in got if r.symbol == "X"]) == 50 and len(got) == 51
    assert sorted(r.v for r in got if r.v is not None) == [1, 2, 3]


def test_silent_days_are_expected(spark):
    rows = spark.createDataFrame([("trades", "X", at(0).date(), at(0)), ("trades", "X", at(3 * 86400).date(), None)], "feed string, symbol string, day date, ts timestamp_ntz")
    matrix = coverage_matrix(rows, ["trades"], ["X"]).orderBy("day").collect()
    assert [(r.rows, r.bad_times) for r in matrix] == [(1, 0), (0, 0), (0, 0), (1, 1)]
    assert coverage_matrix(rows, ["trades"], ["X"], (at(-86400).date(), at(5 * 86400).date())).count() == 7


@pytest.mark.parametrize("block", [10_000, 3])
def test_nearest_of_many_centres(spark, block):
    centres = spark.createDataFrame([(i, [float(i), 0.0]) for i in range(10)], "label int, centroid array<double>")
    points = spark.createDataFrame([(i, [i + 0.4, 1.0]) for i in range(9)] + [(100, [4.5, 0.0])], "id int, x array<double>")
    got = {r.id: r.nearest for r in nearest_centroid(points, centres, "id", "x", "label", block=block).collect()}
    assert got == {**{i: i for i in range(9)}, 100: 4}


def test_package_is_shipped(spark, tmp_path):
    from tickflow import shipping

    shipping.ship(spark)
    shipping.ship(spark)
    assert [f for f in spark.sparkContext.listFiles if f.endswith("tickflow.zip")]


def test_ward_takes_the_cheapest_merges():
    import numpy as np

    def greedy(x, target):
        groups = [[i] for i in range(len(x))]
        while len(groups) > target:
            best = None
            for i in range(len(groups)):
                for j in range(i):
                    p, q = x[groups[i]], x[groups[j]]
                    d = ((p.mean(axis=0) - q.mean(axis=0)) ** 2).sum() * len(p) * len(q) / (len(p) + len(q))
                    best = min(best or (d, j, i), (d, j, i))
            groups[best[1]] += groups.pop(best[2])
        return {frozenset(g) for g in groups}

    pick = np.random.default_rng(4)
    for n, target in ((1, 1), (9, 3), (40, 5), (30, 30)):
        x = pick.normal(size=(n, 3))
        labels = ward_groups(x, target)
        assert {frozenset(i for i in range(n) if labels[i] == g) for g in set(labels)} == greedy(x, target)


def test_silences_inside_a_second(spark):
    from tickflow.operators import reports as rp

    us = [0, 100_000, 700_000, 700_000, 999_999, 1_000_000, 3_500_000, 3_600_000, 60_000_000, 60_250_000]
    rows = spark.createDataFrame([("a", u, i == 3) for i, u in enumerate(us)], "symbol string, us long, is_error boolean").select(
        "symbol", F.timestamp_micros("us").alias("ts"), "is_error"
    )
    got = rp.second_gaps(rows, ["symbol"], 1_000_000).orderBy("bin").collect()
    assert [(r.bin // 1_000_000, r.n, r.errors, r.max_gap) for r in got] == [(0, 5, 1, 0.6), (1, 1, 0, 0.000001), (3, 2, 0, 2.5), (60, 2, 0, 56.4)]


def test_first_arrivals_over_batches(spark, tmp_path):
    """Copies within a batch, of earlier batches, beyond the horizon, without an id, and a batch that is repeated."""
    from tickflow.streaming.feeds import first_arrivals

    def batch(*rows):
        return spark.createDataFrame(rows, "id string, seq long, us long").withColumn("ts", F.timestamp_micros("us"))

    def run(df, number):
        return sorted((r.id or "", r.seq) for r in first_arrivals(df, ["id"], str(tmp_path / "seen"), number, 100).collect())

    assert run(batch(("a", 2, 10), ("a", 1, 12), ("b", 3, 20), (None, 4, 20), ("", 5, 20), ("", 5, 20)), 0) == [("", 4), ("", 5), ("", 5), ("a", 1), ("b", 3)]
    again = batch(("a", 6, 100), ("c", 7, 110))
    assert run(again, 1) == [("c", 7)]
    assert run(again, 1) == [("c", 7)]
    assert run(batch(("a", 8, 500), ("c", 9, 500)), 2) == [("a", 8), ("c", 9)]
    assert run(batch(("a", 10, 501)), 3) == []
