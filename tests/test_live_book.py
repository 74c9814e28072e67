"""The live book over batches: its state, what it tells, kills across batches, restarts."""

import random

from pyspark.sql import functions as F

from tests.test_replay import busy_rows
from tickflow.functions.clock import from_us
from tickflow.operators import book as bk
from tickflow.streaming import feeds as st

SCHEMA = "symbol string, us long, seq long, action string, id long, side string, price double, size int"
COLS = ["symbol", "ts", "seq", "action", "id", "side", "price", "size"]


def rows_of(seed, n=600):
    rnd = random.Random(seed)
    return [(rnd.choice("AAB"), *r[1:5], r[5] if r[5] in ("Buy", "Sell") else "Buy", *r[6:]) for r in busy_rows(seed, n, 12, 25)]


def plain(rows):
    """symbol -> (side, id) -> (price, size); and the seqs of updates to 0 that removed a level."""
    book, snap, kills = {}, {}, set()
    for sym, us, seq, action, ident, side, price, size in rows:
        levels = book.setdefault(sym, {})
        if action == "partial" and snap.get(sym) != us:
            levels.clear()
            snap[sym] = us
        key = (side, ident)
        if action in ("partial", "insert") and price and price > 0 and size:
            levels[key] = (price, size)
        elif action == "update" and key in levels:
            # An update gives what it carries: a price, a size, or both.
            if size == 0:
                del levels[key]
                kills.add(seq)
            else:
                old = levels[key]
                levels[key] = (price if price and price > 0 else old[0], size or old[1])
        elif action == "delete":
            levels.pop(key, None)
    return book, kills


def batches(spark, rows, path, at, first=0):
    for i, (lo, hi) in enumerate(zip([0, *at], [*at, len(rows)])):
        df = spark.createDataFrame(rows[lo:hi], SCHEMA).withColumn("ts", from_us("us")).select(*COLS)
        df.coalesce(1).write.parquet(f"{path}/in/{first + i}")


def test_live_book_over_batches_and_a_restart(spark, tmp_path):
    rows = rows_of(3)
    book, kills = plain(rows)
    schema = spark.createDataFrame(rows[:1], SCHEMA).withColumn("ts", from_us("us")).select(*COLS).schema
    root = str(tmp_path)

    def drain():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in/*")
        st.book_stream(stream, f"{root}/book", f"{root}/ck", depth=3).awaitTermination()

    batches(spark, rows[:300], root, [120, 121])
    drain()
    mid, _ = plain(rows[:300])
    assert spark.read.parquet(f"{root}/book/levels/slot=0").count() == sum(map(len, mid.values()))
    batches(spark, rows[300:], root, [100], first=3)
    drain()
    got = {(r["symbol"], r["side"], r["id"]): (r["price"], r["size"]) for r in st.live_book(spark, f"{root}/book").collect()}
    want = {(s, *k): v for s, levels in book.items() for k, v in levels.items()}
    assert got == want
    # Live levels and nothing else, in two places whatever the number of batches.
    assert spark.read.parquet(f"{root}/book/levels/slot=0").count() == len(want)
    assert sorted(r[0] for r in spark.read.parquet(f"{root}/book/levels").select("slot").distinct().collect()) == [0, 1]
    stored = spark.read.parquet(f"{root}/book/rows")
    assert stored.count() == len(rows)
    by_seq = {r[2]: r[3] for r in rows}
    changed = {r["seq"] for r in stored.collect() if r["action"] != by_seq[r["seq"]]}
    assert changed == kills
    # The newest top told for each symbol is that of the book.
    tops = st.latest(spark, f"{root}/book/top", ["symbol"]).collect()
    for r in tops:
        for side, sign in (("Buy", -1), ("Sell", 1)):
            sizes = {}
            for (s, _), (p, z) in book[r["symbol"]].items():
                if s == side:
                    sizes[p] = sizes.get(p, 0) + z
            best = [(p, sizes[p]) for p in sorted(sizes, key=lambda p: sign * p)[:3]]
            assert [(x["price"], x["size"]) for x in r["top"] if x["side"] == side] == best


def test_quiet_batches_tell_no_top_and_a_repeated_batch_changes_nothing(spark, tmp_path):
    rows = [("A", 1, 1, "insert", 1, "Buy", 10.0, 5), ("A", 1, 2, "insert", 2, "Sell", 11.0, 5), ("A", 1, 3, "insert", 3, "Sell", 12.0, 5)]
    later = [("A", 5, 4, "insert", 9, "Sell", 40.0, 1), ("B", 5, 5, "update", 1, "Buy", 0.0, 0)]
    last = [("A", 6, 6, "update", 1, "Buy", 0.0, 0), ("A", 6, 7, "delete", 2, "Sell", 0.0, 0), ("A", 7, 8, "partial", 5, "Buy", None, 1)]
    df = lambda x: spark.createDataFrame(x, SCHEMA).withColumn("ts", from_us("us")).select(*COLS)
    root = str(tmp_path)
    st.advance_book(df(rows), root, 0, depth=2)
    st.advance_book(df(later), root, 1, depth=2)
    assert {r["batch"] for r in spark.read.parquet(f"{root}/top").collect()} == {0}
    for _ in range(2):
        told = st.advance_book(df(last), root, 2, depth=2).collect()
        assert {r["seq"]: r["action"] for r in told} == {6: "delete", 7: "delete", 8: "partial"}
        # The snapshot's only row is no valid level: the book is empty, and so is the top.
        assert st.live_book(spark, root).count() == 0
        top = spark.read.parquet(f"{root}/top").where("batch = 2").collect()
        assert [(r["symbol"], r["top"]) for r in top] == [("A", [])]
    # A batch without rows keeps the state.
    assert st.advance_book(df(rows).where("false"), root, 3, depth=2).count() == 0
    assert st.live_book(spark, root).count() == 0


def test_snapshot_over_two_batches_is_one(spark, tmp_path):
    rows = [("A", 1, 0, "insert", 7, "Buy", 9.0, 1), ("A", 2, 1, "partial", 1, "Buy", 10.0, 5), ("A", 2, 2, "partial", 2, "Sell", 11.0, 5)]
    more = [("A", 2, 3, "partial", 3, "Sell", 12.0, 5), ("A", 2, 4, "update", 1, "Buy", 0.0, 0)]
    df = lambda x: spark.createDataFrame(x, SCHEMA).withColumn("ts", from_us("us")).select(*COLS)
    st.advance_book(df(rows), str(tmp_path), 0)
    told = st.advance_book(df(more), str(tmp_path), 1).orderBy("seq").collect()
    assert [r["action"] for r in told] == ["partial", "delete"]
    assert sorted(r["id"] for r in st.live_book(spark, str(tmp_path)).collect()) == [2, 3]


def test_batch_kills_equal_streamed_kills(spark, tmp_path):
    rows = rows_of(11, 300)
    df = spark.createDataFrame(rows, SCHEMA).withColumn("ts", from_us("us")).select(*COLS)
    want = {r["seq"] for r in bk.relabel_kills(bk.chunk_book(df)).collect()}
    got = set()
    for n in range(3):
        part = df.where((F.col("seq") >= 100 * n) & (F.col("seq") < 100 * n + 100))
        told = st.advance_book(part, str(tmp_path), n).join(part.select("seq", F.col("action").alias("was")), "seq")
        got |= {r["seq"] for r in told.where("action <> was").collect()}
    assert got == want == plain(rows)[1]
