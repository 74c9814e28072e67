"""Ingest with its three states: keys seen, throttle, live book; over batches and a restart."""

import json

from pyspark.sql import functions as F

from tickflow.streaming import feeds as st


def message(table, action, *data):
    return json.dumps({"table": table, "action": action, "data": list(data)})


def level(ident, side="Buy", **values):
    return {"symbol": "X", "id": ident, "side": side, **values}


def quote(second):
    stamp = f"2024-01-01T00:00:{second:04.1f}00Z"
    return message("instrument", "update", {"symbol": "X", "timestamp": stamp, "markPrice": 100.0 + second})


BOOK = [
    (0, message("orderBookL2", "partial", level(1, price=100.0, size=5), level(2, "Sell", price=101.0, size=4))),
    (1, message("orderBookL2", "insert", level(3, price=99.0, size=7))),
    (2, message("orderBookL2", "update", level(3, size=0))),  # kills a level of this batch
    (3, message("orderBookL2", "update", level(1, size=0))),  # one of an earlier batch
    (4, message("orderBookL2", "update", level(1, size=0))),  # already gone
    (5, message("orderBookL2", "update", level(2, "Sell", size=9))),
]
QUOTES = [0.0, 0.4, 0.8, 1.0, 1.9, 2.0, 2.1, 3.5]


def test_stored_rows_follow_from_all_batches(spark, tmp_path):
    root = str(tmp_path)
    received = 1704067200.0
    rows = [(o, v, received + o) for o, v in BOOK] + [(10 + i, quote(s), received + 10 + i) for i, s in enumerate(QUOTES)]
    cuts = [(0, 3), (3, 12), (12, 14), (14, 99)]

    def drain(parts):
        for lo, hi in parts:
            part = [r for r in rows if lo <= r[0] < hi]
            spark.createDataFrame(part, st.MESSAGES).coalesce(1).write.mode("append").parquet(f"{root}/in")
        st.ingest(
            st.read_stream(spark, f"{root}/in", st.MESSAGES, 1), f"{root}/out", f"{root}/ck", feeds=["orderbook", "instruments"],
            throttles={"instruments": (F.lit(False), 1_000_000)}, book=True,
        ).awaitTermination()

    drain(cuts[:2])
    drain(cuts[2:])
    book = spark.read.parquet(f"{root}/out/orderbook").orderBy("seq").collect()
    assert [(r["id"], r["action"]) for r in book] == [
        (1, "partial"), (2, "partial"), (3, "insert"), (3, "delete"), (1, "delete"), (1, "update"), (2, "update"),
    ]
    assert [(r["id"], r["price"], r["size"]) for r in st.live_book(spark, f"{root}/out/live").collect()] == [(2, 101.0, 9)]
    kept = spark.read.parquet(f"{root}/out/instruments").orderBy("seq").collect()
    assert [r["markPrice"] - 100 for r in kept] == [0.0, 1.0, 2.0, 3.5]
