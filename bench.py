"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from tickflow.catalog import load  # noqa: E402
from tickflow.fixtures import feed  # noqa: E402
from tickflow.operators import book as bk  # noqa: E402
from tickflow.plans import features as pf  # noqa: E402
from tickflow.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "ingest_route", "dedup_trades_last", "f4_taker_imbalance", "book_asof", "book_ticks", "features_long",
    "rolling_rank_lt", "ema", "segments", "sanitize", "profile_trades", "trade_stats", "label_asof",
    "knn_graph", "density_cluster", "regimes_end_to_end",
]


def dense_features(spark, sf_dir):
    """The seven features on a one-second grid: about 13 million symbol-rows for 30 days."""
    return pf.features_long(
        feed(spark, sf_dir, "orderbook"), feed(spark, sf_dir, "trades"), feed(spark, sf_dir, "instruments"),
        step=1_000_000, depth=15, span=300, vol_window=50,
    )


def busy_book(spark, sf_dir):
    """The book feed 25 times over at 1.6 ms: about 50 deltas a second and symbol, replayed to depth 15."""
    row = F.col("seq") * 25 + F.col("_r")
    many = feed(spark, sf_dir, "orderbook").withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(24)))).select(
        "symbol", "id", "side", "action", "price", "size", (row * 1600).alias("us"), row.alias("seq")
    )
    return bk.chunk_book(many), many


def main() -> None:
    only = sys.argv[1:]
    spark = local_session(CPUS, "tickflow-bench", os.environ.get("BENCH_MEMORY", "16g"))
    queries = load()[0]
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    rows = 0
    for name in [*HEADLINE, "features_1s"]:
        if only and name not in only:
            continue
        began = time.time()
        if name == "features_1s":
            # Every column is computed; the sums keep the driver out of it.
            df = dense_features(spark, SF_DIR)
            got = df.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c) for c in pf.FEATURE_COLS]).first()
            rows = got["n"]
        else:
            queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - began, 3)
        print(name, times[name], file=sys.stderr)
    deltas = {}
    if not only or "busy_book" in only:
        began = time.time()
        chunked, many = busy_book(spark, SF_DIR)
        bk.book_ticks(chunked, depth=15).write.format("noop").mode("overwrite").save()
        took = time.time() - began
        n = many.count()
        deltas = {"busy_book_deltas": n, "busy_book_sec": round(took, 3), "busy_book_deltas_per_sec": round(n / took)}
        print("busy_book", took, file=sys.stderr)
    out = {
        "metric": "total wall time of headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": CPUS,
    }
    if rows:
        out["features_1s_rows"] = rows
        out["features_1s_rows_per_sec"] = round(rows / times["features_1s"])
    print(json.dumps(out | deltas))


if __name__ == "__main__":
    main()
