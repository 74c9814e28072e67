"""Streaming queries: files in, batches of a stream, result read back and compared with batch SQL."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.catalog.common import book_ctes, feed, over_feeds, query, r6, rounded
from tickflow.catalog.feeds import GAP_US, MSG, raw_messages
from tickflow.catalog.registry import SQL
from tickflow.session import cut, work_path
from tickflow.streaming import feeds as st

FOREVER = "60 days"


def _replayed(df, path, run, by="seq", parts=3):
    """Hand whole rows in order of ``by`` to a stream as ``parts`` batches.

    Each part is appended to ``path`` in as many files as it has tasks; ``run`` starts the stream over the folder, which
    takes all that is new as one batch, goes on from its checkpoint and stops.
    """
    top = (df.agg(F.max(by)).first()[0] or 0) + 1
    for i in range(parts):
        low, high = top * i // parts, top * (i + 1) // parts
        df.where((F.col(by) >= low) & (F.col(by) < high)).write.mode("append").parquet(path)
        run(st.read_stream(df.sparkSession, path, df.schema)).awaitTermination()


def replayed_feed(spark, sf, name, run):
    _replayed(feed(spark, sf, name), work_path(spark, f"in-{name}"), run)


def _messages(spark, sf):
    return cut(raw_messages(spark, sf).select(F.col("offset").cast("long").alias("offset"), "value", "received"))


@query("stream_ingest", over_feeds(
    """SELECT feed, CAST(t AS DOUBLE) AS timestamp, seq, symbol FROM m WHERE NOT (feed='orderbook' AND u=0) AND px IS NOT NULL""", MSG))
def stream_ingest(spark, sf):
    """Raw messages through the ingest stream; every row of the four feeds read back."""
    src, root, ck = (work_path(spark, n) for n in ("messages", "ingest", "ck"))
    _replayed(_messages(spark, sf), src, lambda rows: st.ingest(rows, root, ck), "offset")
    return _read_back(spark, root)


def _read_back(spark, root):
    parts = [
        spark.read.parquet(f"{root}/{n}").select(F.lit(n).alias("feed"), "timestamp", "seq", "symbol")
        for n in st.PROJECTIONS
    ]
    return functools.reduce(DataFrame.unionByName, parts)


# The first row of each key; rows without an id all pass.
@query("stream_ingest_dedup", over_feeds(
    """SELECT feed, CAST(t AS DOUBLE) AS timestamp, seq, symbol FROM keyed WHERE ident IS NULL
       UNION ALL SELECT feed, CAST(t AS DOUBLE), seq, symbol FROM keyed WHERE ident IS NOT NULL
       QUALIFY row_number() OVER (PARTITION BY feed, ident ORDER BY seq)=1""", MSG + """,
keyed AS (SELECT *, CASE feed WHEN 'trades' THEN CASE WHEN event_id%59<>0 THEN concat('T',event_id-event_id%2) END
    WHEN 'liquidations' THEN concat('L',event_id-event_id%3) WHEN 'orderbook' THEN concat(u,'/',t) ELSE concat(symbol,'/',t) END AS ident
  FROM m WHERE NOT (feed='orderbook' AND u=0) AND px IS NOT NULL
  UNION ALL SELECT *, NULL FROM (SELECT * REPLACE (seq+1000000000000000 AS seq) FROM m) WHERE feed='trades' AND event_id%59=0 AND px IS NOT NULL)"""))
def stream_ingest_dedup(spark, sf):
    """All messages twice through the ingest stream, the copies in later batches: a key is stored once."""
    src, root, ck = (work_path(spark, n) for n in ("messages", "ingest", "ck"))
    raw = _messages(spark, sf)
    twice = raw.unionByName(raw.withColumn("offset", F.col("offset") + 1_000_000_000))
    _replayed(twice, src, lambda rows: st.ingest(rows, root, ck, dedup_us=60 * 86_400_000_000), "offset", 2)
    return _read_back(spark, root)


@query("stream_dedup", over_feeds('SELECT DISTINCT trdMatchID AS "trdMatchID" FROM trades'))
def stream_dedup(spark, sf):
    path, ck = work_path(spark, "dedup"), work_path(spark, "ck")

    def run(trades):
        rows = st.dedup_stream(trades, "trdMatchID", delay=FOREVER)
        return st.write_rows(rows.select("trdMatchID", "ts"), path, ck)

    replayed_feed(spark, sf, "trades", run)
    return spark.read.parquet(path).select("trdMatchID")


@query("stream_book", over_feeds(
    "SELECT a.symbol, a.side, a.id, a.price, a.size FROM alive a JOIN last ON a.tseq=last.q",
    book_ctes() + ", last AS (SELECT symbol, max(seq) AS q FROM ob GROUP BY symbol)"))
def stream_book(spark, sf):
    """The live book after the stream equals the book rebuilt in batch (updates carry no price)."""
    path, ck = work_path(spark, "book"), work_path(spark, "ck")
    replayed_feed(spark, sf, "orderbook", lambda rows: st.book_stream(rows, path, ck))
    return st.live_book(spark, path)


@query("stream_throttle", SQL["throttle_instruments"])
def stream_throttle(spark, sf):
    path, ck = work_path(spark, "throttle"), work_path(spark, "ck")

    def run(rows):
        return st.throttle_stream(rows.select("symbol", "ts", "seq"), path, ck, F.col("seq") % 5 == 0, GAP_US)

    replayed_feed(spark, sf, "instruments", run)
    return spark.read.parquet(f"{path}/rows").select("symbol", "ts", "seq")


_FLOW = """sum(CASE side WHEN 'Buy' THEN abs(foreignNotional)*w WHEN 'Sell' THEN -abs(foreignNotional)*abs(w) ELSE 0 END)"""


@query("stream_taker_imbalance", over_feeds(
    f"""SELECT symbol, h AS ts, {r6('CASE WHEN x>0 THEN ln(1+x) WHEN x<0 THEN -ln(1-x) ELSE 0 END')} AS f4 FROM (SELECT symbol, date_trunc('hour',ts) AS h, {_FLOW} AS x
        FROM (SELECT *, CASE tickDirection WHEN 'PlusTick' THEN 1.5 WHEN 'ZeroPlusTick' THEN 1.5 WHEN 'MinusTick' THEN -1.5 WHEN 'ZeroMinusTick' THEN -1.5 ELSE 1.0 END AS w FROM trades) GROUP BY 1,2)"""))
def stream_taker_imbalance(spark, sf):
    path, ck = work_path(spark, "taker"), work_path(spark, "ck")

    def run(rows):
        return st.write_rows(st.taker_imbalance_stream(rows, "1 hour", FOREVER), path, ck, "update")

    replayed_feed(spark, sf, "trades", run)
    return rounded(st.latest(spark, path, ["symbol", "ts"]), "f4")


@query("stream_hooks", over_feeds("SELECT seq, symbol FROM m WHERE feed='trades' AND v*10>1000 AND px IS NOT NULL", MSG))
def stream_hooks(spark, sf):
    """A hook that stores large trades and one that always fails."""
    src, root, found, ck = (work_path(spark, n) for n in ("messages", "hooks", "whales", "ck"))
    def whales(batch, number):
        hit = batch.where(F.abs("foreignNotional") > 1000).select("seq", "symbol").withColumn("batch", F.lit(number))
        hit.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(found)

    def broken(batch, number):
        raise ValueError("hook error, logged and skipped")

    st.log.disabled = True
    try:
        _replayed(
            _messages(spark, sf), src,
            lambda rows: st.ingest(rows, root, ck, feeds=["trades"], hooks={"trades": [broken, whales]}), "offset",
        )
    finally:
        st.log.disabled = False
    return spark.read.parquet(found).select("seq", "symbol")


@query("stream_metrics", over_feeds("SELECT 'instruments' AS feed, count(*) AS rows, count(*) FILTER (markPrice IS NULL) AS errors FROM instruments"))
def stream_metrics(spark, sf):
    """The metrics table of a stream: every batch, not only the recent ones."""
    table, path, ck = (work_path(spark, n) for n in ("metrics", "rows", "ck"))

    def run(rows):
        return st.write_rows(rows, path, ck, metrics=(table, "instruments", F.col("markPrice").isNull()))

    replayed_feed(spark, sf, "instruments", run)
    batches = spark.read.parquet(table)
    return batches.groupBy(F.col("name").alias("feed")).agg(F.sum("rows").alias("rows"), F.sum("errors").alias("errors"))
