"""Day job, back-fill and per-file reports: files written, read back and compared with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow.catalog.common import BIN, DEPTH, SPAN, SYMBOLS, VOL, book_ctes, feed, over_feeds, query, rounded
from tickflow.catalog.features import FEATURE_CTES, WIDE_SQL
from tickflow.catalog.feeds import KILLS_SQL
from tickflow.catalog.streams import replayed_feed
from tickflow.operators import reports as rp
from tickflow.plans import days
from tickflow.plans.features import FEATURE_COLS
from tickflow.session import work_path
from tickflow.sources import parquet as pq
from tickflow.streaming import feeds as st


@query("day_job", over_feeds(f"SELECT ts, {WIDE_SQL} FROM features GROUP BY ts", FEATURE_CTES))
def day_job(spark, sf):
    """Feeds stored by day, wide features of all days exported as daily CSV files and loaded again."""
    root, out = work_path(spark, "feeds"), work_path(spark, "days")
    for name in days.FEEDS:
        pq.write_feed(feed(spark, sf, name), f"{root}/{name}")
    days.day_job(spark, root, out, SYMBOLS, BIN, DEPTH, SPAN, VOL)
    cols = [f"{s}_{c}" for s in SYMBOLS for c in FEATURE_COLS]
    schema = ", ".join(["ts timestamp_ntz", *[f"{c} double" for c in cols]])
    return rounded(pq.load_features(spark, out, schema), *cols)


_HOURLY = "SELECT symbol, date_trunc('hour',ts) AS ts, max(volume24h) AS volume24h, max(openInterest) AS oi FROM instruments GROUP BY 1,2"


@query("backfill_mid", over_feeds(
    """SELECT i.symbol, i.ts, i.volume24h, i.oi, b.mid AS mid_price, 'symbol,ts,volume24h,mid_price,oi' AS header
       FROM i ASOF LEFT JOIN b ON i.symbol=b.symbol AND i.ts>=b.h""",
    book_ctes() + f""",
i AS ({_HOURLY}),
b AS (SELECT * FROM (SELECT symbol, date_trunc('hour',ts) AS h, arg_max(mid, seq) FILTER (mid IS NOT NULL) AS mid FROM ticks GROUP BY 1,2) WHERE mid IS NOT NULL)"""))
def backfill_mid(spark, sf):
    """Hourly rows stored as daily CSV files without a mid price, which is filled in behind volume24h."""
    before, after = work_path(spark, "before"), work_path(spark, "after")
    rows = feed(spark, sf, "instruments").groupBy("symbol", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).agg(
        F.max("volume24h").alias("volume24h"), F.max("openInterest").alias("oi")
    )
    pq.export_daily(rows, before, "csv")
    stored = pq.load_features(spark, before, rows.schema)
    pq.export_daily(days.backfill_mid(stored, feed(spark, sf, "orderbook"), BIN), after, "csv")
    # The order of the columns is read from the files themselves.
    header = ",".join(pq.load_features(spark, after).columns)
    types = "symbol string, ts timestamp_ntz, volume24h long, mid_price double, oi long"
    return pq.load_features(spark, after, types).withColumn("header", F.lit(header))


def _per_file(spark, sf, name, keep, col):
    """The feed as a collector leaves it, a file a day; the report goes by file."""
    path = work_path(spark, name)
    rows = feed(spark, sf, name).select("seq", "ts", "symbol", col).withColumn("date", F.to_date("ts"))
    rows.repartition("date").write.partitionBy("date").parquet(path)
    stored = spark.read.parquet(path).withColumn("file", F.col("_metadata.file_path"))
    return rp.first_rows(stored, keep, ["file"]).select("date", "seq", "symbol", col, "matches")


def _per_day_sql(table, col, keep):
    return over_feeds(f"""SELECT date, seq, symbol, {col} AS "{col}", matches FROM (SELECT *, CAST(ts AS DATE) AS date, count(*) OVER (PARTITION BY CAST(ts AS DATE)) AS matches,
    row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY ts,seq) AS r FROM {table} WHERE {keep}) WHERE r<=3""")


@query("nonzero_liqs_by_file", _per_day_sql("liquidations", "leavesQty", "leavesQty>0"))
def nonzero_liqs_by_file(spark, sf):
    return _per_file(spark, sf, "liquidations", F.col("leavesQty") > 0, "leavesQty")


@query("nonzero_funding_by_file", _per_day_sql("instruments", "fundingRate", "fundingRate<>0"))
def nonzero_funding_by_file(spark, sf):
    return _per_file(spark, sf, "instruments", F.col("fundingRate") != 0, "fundingRate")


@query("stream_relabel", over_feeds(
    "SELECT o.symbol, o.seq, CASE WHEN k.seq IS NULL THEN o.action ELSE 'delete' END AS action FROM ob o LEFT JOIN kills k ON k.seq=o.seq",
    book_ctes() + f", kills AS ({KILLS_SQL})"))
def stream_relabel(spark, sf):
    """Deltas as the book stream stores them: an update to size 0 of a level of the live book is a delete."""
    path = work_path(spark, "relabel")
    ck = work_path(spark, "ck")
    replayed_feed(spark, sf, "orderbook", lambda rows: st.book_stream(rows, path, ck))
    return spark.read.parquet(f"{path}/rows").select("symbol", "seq", "action")
