"""Ingest, typing, projection, dedup and throttle queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.catalog.common import book_ctes, feed, over_feeds, query, r6, raw, rounded
from tickflow.functions.clock import to_us
from tickflow.operators import book as bk
from tickflow.operators import dedup as d
from tickflow.operators import reports as rp
from tickflow.operators import typing as ty
from tickflow.sources import messages as ms

REF = "2024-01-15 00:00:00"


def raw_messages(spark, sf):
    """JSON messages built from the events: up to three rows of a feed and action per message.

    Every 97th event also sends a control message; message texts with offset % 101 = 0 are cut
    off, and prices of trades with event id % 41 = 0 are not numbers.  Book rows have no time of
    their own, every 43rd row of the other feeds an impossible one; sizes of trades are written
    with a decimal point, and every 59th trade has no id.
    """
    e = raw(spark, sf)
    k, ident = F.col("k"), F.col("event_id")
    price = F.when(F.col("u") % 2 == 0, 1000 - F.col("u") * 0.5).otherwise(1000 + F.col("u") * 0.5)
    side = F.when(F.col("u") % 2 == 0, "Buy").otherwise("Sell")
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    action = (
        F.when(k >= 40, "insert").when(ident % 500 == 0, "partial").when(k < 16, "insert")
        .when(k < 30, "update").otherwise("delete")
    )
    table = (
        F.when(k < 40, "orderBookL2").when(k < 70, "trade").when(k < 90, "instrument")
        .otherwise("liquidation")
    )
    is_book, is_trade, is_instr, is_liq = k < 40, k.between(40, 69), k.between(70, 89), k >= 90
    row = F.struct(
        F.when(~is_book, F.when(ident % 43 == 0, "1970-01-01T00:00:00Z").otherwise(stamp)).alias("timestamp"), F.col("symbol").alias("symbol"),
        F.when(is_book, F.when(F.col("u") == 0, F.lit(None)).otherwise(F.col("u"))).alias("id"),
        F.when(~is_instr, side).alias("side"),
        F.when(is_book & ~((ident % 500 == 0) | (k < 16)), F.lit(None).cast("string"))
        .when(is_trade & (ident % 41 == 0), "n/a")
        .when(~is_instr, F.when(is_trade, 1000 + (k - 55) * 0.5).otherwise(price).cast("string")).alias("price"),
        F.when(is_book | is_trade, F.concat(F.floor("v").cast("string"), F.when(is_trade, ".0").otherwise(""))).alias("size"),
        F.when(is_trade & (ident % 59 != 0), F.concat(F.lit("T"), (ident - ident % 2).cast("string"))).alias("trdMatchID"),
        F.when(is_trade, F.col("v") * 10).alias("foreignNotional"),
        F.when(is_trade, "PlusTick").alias("tickDirection"),
        F.when(is_liq, F.concat(F.lit("L"), (ident - ident % 3).cast("string"))).alias("orderID"),
        F.when(is_liq, F.floor("v").cast("int")).alias("leavesQty"),
        F.when(is_liq, (k - 90).cast("int")).alias("cumQty"),
        F.when(is_instr & (ident % 7 != 0), 1000 + (F.col("v") - 20) / 100).alias("markPrice"),
        F.when(is_instr & (ident % 3 != 0), (k - 80) / 10000).alias("fundingRate"),
        F.when(is_instr & (ident % 5 == 0), 1000 + F.col("u")).alias("openInterest"),
    )
    batch = F.floor(ident / 3)
    grouped = e.groupBy(table.alias("table"), action.alias("action"), batch.alias("batch")).agg(
        F.min("event_id").alias("offset"), F.round(F.unix_micros(F.max("ts").cast("timestamp")) / 1e6, 3).alias("received"),
        F.transform(F.array_sort(F.collect_list(F.struct("event_id", row.alias("r")))), lambda x: x["r"]).alias("data"),
    )
    text = F.to_json(F.struct("table", "action", "data"))
    feeds = grouped.select(
        "offset", F.when(F.col("offset") % 101 == 0, F.substring(text, 1, 40)).otherwise(text).alias("value"), "received"
    )
    kind = ident % 5
    control = e.where(ident % 97 == 0).select(
        F.col("event_id").alias("offset"),
        F.when(kind == 0, '{"info":"welcome"}').when(kind == 1, '{"success":true,"subscribe":"trade"}')
        .when(kind == 2, '{"error":"bad topic"}').when(kind == 3, '{"success":true}')
        .otherwise("not json").alias("value"),
        F.lit(None).cast("double").alias("received"),
    )
    return feeds.unionByName(control)


# The same messages for the SQL checks, as rows: m(offset, pos, tbl, action, cut, event columns).
MSG = """
e0 AS (SELECT *, CASE WHEN k<40 THEN 'orderBookL2' WHEN k<70 THEN 'trade' WHEN k<90 THEN 'instrument' ELSE 'liquidation' END AS tbl,
         CASE WHEN k<40 THEN 'orderbook' WHEN k<70 THEN 'trades' WHEN k<90 THEN 'instruments' ELSE 'liquidations' END AS feed,
         CASE WHEN k>=40 THEN 'insert' WHEN event_id%500=0 THEN 'partial' WHEN k<16 THEN 'insert' WHEN k<30 THEN 'update' ELSE 'delete' END AS action
       FROM raw),
mm AS (SELECT *, min(event_id) OVER w AS "offset", round(CAST(epoch_us(max(ts) OVER w) AS DOUBLE)/1e6,3) AS received, CAST(row_number() OVER (w ORDER BY event_id)-1 AS INT) AS pos
      FROM e0 WINDOW w AS (PARTITION BY tbl, action, event_id//3)),
m AS (SELECT *, CASE WHEN k>=40 AND k<70 AND event_id%41=0 THEN NULL WHEN k>=40 AND k<70 THEN 1000+(k-55)*0.5::DOUBLE
        WHEN u%2=0 THEN 1000-u*0.5::DOUBLE ELSE 1000+u*0.5::DOUBLE END AS px,
        CASE WHEN u%2=0 THEN 'Buy' ELSE 'Sell' END AS side, "offset"*1000000+pos AS seq,
        CASE WHEN k<40 OR event_id%43=0 THEN received ELSE round(CAST(epoch_us(ts) AS DOUBLE)/1e6,3) END AS t
      FROM mm WHERE "offset"%101<>0)"""


def _routed(spark, sf, **options):
    return ms.route(ms.parse_messages(raw_messages(spark, sf)), **options)


@query("ingest_route", over_feeds('SELECT "offset", pos, feed, action, symbol FROM m', MSG))
def ingest_route(spark, sf):
    return _routed(spark, sf).select("offset", "pos", "feed", "action", "symbol")


@query(
    "ingest_control_counts",
    over_feeds(
        """SELECT kind, count(*) AS messages FROM (
             SELECT CASE WHEN "offset"%101=0 THEN 'malformed' ELSE 'data' END AS kind FROM (SELECT DISTINCT "offset", tbl, action FROM mm)
             UNION ALL SELECT CASE event_id%5 WHEN 0 THEN 'info' WHEN 1 THEN 'subscribe' WHEN 2 THEN 'error' WHEN 3 THEN 'success' ELSE 'malformed' END
             FROM raw WHERE event_id%97=0) GROUP BY 1""",
        MSG,
    ),
)
def ingest_control_counts(spark, sf):
    return ms.control_counts(ms.parse_messages(raw_messages(spark, sf)))


@query(
    "select_streams",
    over_feeds(
        """SELECT "offset", pos, feed, symbol FROM m WHERE feed IN ('trades','liquidations') AND symbol IN ('click','view')""", MSG
    ),
)
def select_streams(spark, sf):
    return _routed(spark, sf, feeds=["trades", "liquidations"], symbols=["click", "view"]).select(
        "offset", "pos", "feed", "symbol"
    )


@query(
    "ingest_quarantine",
    over_feeds(
        """SELECT DISTINCT "offset", -1 AS pos, NULL::VARCHAR AS feed, 'malformed message' AS reason, tbl||action AS g FROM mm WHERE "offset"%101=0
           UNION ALL SELECT event_id, -1, NULL, 'malformed message', '' FROM raw WHERE event_id%97=0 AND event_id%5=4
           UNION ALL SELECT "offset", pos, feed, 'bad price', '' FROM m WHERE px IS NULL""",
        MSG,
    ).replace("SELECT DISTINCT", "SELECT \"offset\", pos, feed, reason FROM (SELECT DISTINCT")
    .replace("WHERE px IS NULL", "WHERE px IS NULL)"),
)
def ingest_quarantine(spark, sf):
    return ms.quarantine(ms.parse_messages(raw_messages(spark, sf)))


def _rows(spark, sf):
    """Routed rows whose numbers parse; a row that does not parse is skipped."""
    return ms.good_rows(_routed(spark, sf))


def _arrival():
    return ty.epoch_to_ts("received")


@query(
    "norm_trades",
    over_feeds(
        f"""SELECT seq, t AS timestamp, CASE WHEN event_id%59<>0 THEN concat('T',CAST(event_id-event_id%2 AS STRING)) END AS "trdMatchID", symbol, px AS price, CAST(floor(v) AS INT) AS size,
              0.0::DOUBLE AS "homeNotional", {r6('v*10')} AS "foreignNotional", side, 'PlusTick' AS "tickDirection", 0::BIGINT AS "grossValue"
            FROM m WHERE feed='trades' AND px IS NOT NULL""",
        MSG,
    ),
)
def norm_trades(spark, sf):
    return rounded(ms.trades(_rows(spark, sf), _arrival()), "foreignNotional")


@query(
    "norm_liquidations",
    over_feeds(
        """SELECT seq, t AS timestamp, concat('L',CAST(event_id-event_id%3 AS STRING)) AS "orderID", symbol, side, CAST(k-90 AS INT) AS "orderQty",
             px AS price, CAST(floor(v) AS INT) AS "leavesQty", CAST(k-90 AS INT) AS "cumQty", NULL::VARCHAR AS "ordType", NULL::VARCHAR AS "timeInForce"
           FROM m WHERE feed='liquidations'""",
        MSG,
    ),
)
def norm_liquidations(spark, sf):
    return ms.liquidations(_rows(spark, sf), _arrival())


@query(
    "norm_instruments",
    over_feeds(
        f"""SELECT seq, t AS timestamp, symbol, CASE WHEN event_id%5=0 THEN 1000+u END AS "openInterest",
              CASE WHEN event_id%3<>0 THEN (k-80)/10000.0::DOUBLE END AS "fundingRate", NULL::DOUBLE AS "indicativeFundingRate",
              {r6('CASE WHEN event_id%7<>0 THEN 1000+(v-20)/100 END')} AS "markPrice", NULL::DOUBLE AS "indexPrice", NULL::DOUBLE AS "settlementPrice",
              NULL::DOUBLE AS "turnover24h", NULL::DOUBLE AS "fundingTimestamp", NULL::BIGINT AS "volume24h"
            FROM m WHERE feed='instruments'""",
        MSG,
    ),
)
def norm_instruments(spark, sf):
    return rounded(ms.instruments(_rows(spark, sf), _arrival()), "markPrice")


@query(
    "norm_book",
    over_feeds(
        """SELECT m.seq, m.t AS timestamp, m.u AS id, m.symbol, m.side, CASE WHEN m.action IN ('partial','insert') THEN px END AS price,
             CAST(floor(m.v) AS INT) AS size, m.action FROM m WHERE feed='orderbook' AND u<>0""",
        MSG,
    ),
)
def norm_book(spark, sf):
    return ms.book_deltas(_rows(spark, sf), F.col("received"))


KILLS_SQL = """SELECT t.symbol, t.seq FROM ticks tk JOIN ob t ON t.seq=tk.seq
           JOIN (SELECT o.seq, (SELECT max(p.seq) FROM ob p WHERE p.symbol=o.symbol AND p.seq<o.seq) AS pq FROM ob o WHERE action='update' AND size=0) b ON b.seq=t.seq
           JOIN alive a ON a.tseq=b.pq AND a.side=t.side AND a.id=t.id"""


@query("relabel_kills", over_feeds(KILLS_SQL, book_ctes()))
def relabel_kills(spark, sf):
    """Updates to size 0 of a live level, which the feed normalisation re-labels as deletes."""
    return bk.relabel_kills(bk.chunk_book(feed(spark, sf, "orderbook"))).select("symbol", "seq")


@query(
    "enforce_schema",
    over_feeds(
        f"""SELECT symbol, CASE WHEN event_id%9=0 THEN NULL WHEN event_id%11=0 THEN NULL ELSE k END AS k, {r6('v')} AS v, NULL::BIGINT AS extra, NULL::VARCHAR AS note, 'keep' AS policy FROM raw
            UNION ALL SELECT symbol, CASE WHEN event_id%9=0 THEN 0 WHEN event_id%11=0 THEN 0 ELSE k END, {r6('v')}, 0, '', 'zero' FROM raw"""
    ),
)
def enforce_schema(spark, sf):
    """A text k with nulls and junk, two columns missing; both null policies."""
    k = F.when(F.col("event_id") % 9 == 0, F.lit(None)).when(
        F.col("event_id") % 11 == 0, "junk"
    ).otherwise(F.col("k").cast("string"))
    df = raw(spark, sf).withColumn("k", k)
    schema = T.StructType(
        [
            T.StructField("symbol", T.StringType()), T.StructField("k", T.IntegerType()),
            T.StructField("v", T.DoubleType()), T.StructField("extra", T.LongType()),
            T.StructField("note", T.StringType()),
        ]
    )
    both = [
        ty.enforce_schema(df, schema, policy).withColumn("policy", F.lit(policy))
        for policy in ("keep", "zero")
    ]
    return rounded(both[0].unionByName(both[1]), "v")


@query(
    "normalize_ts",
    over_feeds(
        "SELECT event_id, CASE WHEN event_id%4=3 THEN NULL ELSE round(CAST(epoch_us(ts) AS DOUBLE)/1e6,3) END AS timestamp FROM raw"
    ),
)
def normalize_ts(spark, sf):
    seconds = to_us("ts") / 1e6
    text = (
        F.when(F.col("event_id") % 4 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(F.col("event_id") % 4 == 1, seconds.cast("string"))
        .when(F.col("event_id") % 4 == 2, F.col("ts").cast("string"))
        .otherwise("yesterday")
    )
    return raw(spark, sf).select("event_id", ty.epoch_seconds(text).alias("timestamp"))


@query("epoch_to_ts", over_feeds("SELECT event_id, ts FROM raw"))
def epoch_to_ts(spark, sf):
    return raw(spark, sf).withColumn("s", to_us("ts") / 1e6).select("event_id", ty.epoch_to_ts("s").alias("ts"))


@query(
    "clamp_ts",
    over_feeds(
        f"""SELECT event_id, CASE WHEN ts BETWEEN TIMESTAMP '{REF}' - INTERVAL 24 HOUR AND TIMESTAMP '{REF}' + INTERVAL 24 HOUR THEN ts
              ELSE TIMESTAMP '{REF}' END AS ts FROM raw"""
    ),
)
def clamp_ts(spark, sf):
    ref = F.lit(REF).cast("timestamp_ntz")
    return raw(spark, sf).select("event_id", ty.clamp_ts(F.col("ts"), ref).alias("ts"))


@query(
    "clean_nonfinite",
    over_feeds("SELECT event_id, CASE WHEN event_id%5<3 THEN 0 ELSE v END AS a, CASE WHEN event_id%7=0 THEN 0 ELSE k/4.0::DOUBLE END AS b FROM raw"),
)
def clean_nonfinite(spark, sf):
    e = F.col("event_id")
    a = (
        F.when(e % 5 == 0, float("nan")).when(e % 5 == 1, float("inf")).when(e % 5 == 2, float("-inf"))
        .otherwise(F.col("v"))
    )
    df = raw(spark, sf).select("event_id", a.alias("a"), F.when(e % 7 != 0, F.col("k") / 4.0).alias("b"))
    return ty.zero_nonfinite(df, ["a", "b"])


@query(
    "fix_nonpositive_price",
    over_feeds(
        f"""SELECT i.symbol, i.ts, i.seq, {r6('CASE WHEN indexPrice<=0 THEN coalesce(m,1.0) ELSE indexPrice END')} AS "indexPrice" FROM instruments i
            JOIN (SELECT symbol, median(CASE WHEN indexPrice>0 THEN indexPrice END) AS m FROM instruments GROUP BY 1) USING (symbol)"""
    ),
)
def fix_nonpositive_price(spark, sf):
    df = feed(spark, sf, "instruments").select("symbol", "ts", "seq", "indexPrice")
    return rounded(ty.fix_nonpositive(df, ["indexPrice"]), "indexPrice")


@query(
    "dedup_trades_first",
    over_feeds(
        """SELECT * FROM (SELECT seq, CASE WHEN seq%10=0 THEN '' ELSE trdMatchID END AS "trdMatchID", symbol, price FROM trades)
           QUALIFY row_number() OVER (PARTITION BY CASE WHEN "trdMatchID"='' THEN CAST(seq AS STRING) ELSE "trdMatchID" END ORDER BY seq)=1"""
    ),
)
def dedup_trades_first(spark, sf):
    """First copy of each trade id; empty ids all pass."""
    ident = F.when(F.col("seq") % 10 == 0, "").otherwise(F.col("trdMatchID"))
    df = feed(spark, sf, "trades").select("seq", ident.alias("trdMatchID"), "symbol", "price")
    return d.dedup_first(df, "trdMatchID")


@query(
    "dedup_liqs_first",
    over_feeds('SELECT seq, orderID AS "orderID", symbol, price FROM liquidations QUALIFY row_number() OVER (PARTITION BY orderID ORDER BY seq)=1'),
)
def dedup_liqs_first(spark, sf):
    return d.dedup_first(feed(spark, sf, "liquidations").select("seq", "orderID", "symbol", "price"), "orderID")


def _last(name, feed_name, keys, cols, prep=lambda df: df, sql_from=None):
    sel = ", ".join(f'{c} AS "{c}"' for c in cols)
    sql = f"SELECT {sel} FROM {sql_from or feed_name} QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY seq DESC)=1"

    @query(name, over_feeds(sql))
    def last(spark, sf):
        return d.dedup_last(prep(feed(spark, sf, feed_name)).select(*cols), keys)


_last("dedup_trades_last", "trades", ["symbol", "trdMatchID"], ["seq", "ts", "symbol", "trdMatchID", "price", "size"])
_last("dedup_liqs_last", "liquidations", ["symbol", "orderID"], ["seq", "ts", "symbol", "orderID", "leavesQty"])
# Timestamps are unique in the test feeds; on the hour they are not.
_last(
    "dedup_book_last", "orderbook", ["symbol", "id", "ts"], ["seq", "ts", "symbol", "id", "action"],
    lambda df: df.withColumn("ts", F.window("ts", "1 day").start),
    "(SELECT seq, date_trunc('day',ts) AS ts, symbol, id, action FROM orderbook)",
)
_last(
    "dedup_instr_last", "instruments", ["symbol", "ts"], ["seq", "ts", "symbol", "openInterest"],
    lambda df: df.withColumn("ts", F.window("ts", "1 day").start),
    "(SELECT seq, date_trunc('day',ts) AS ts, symbol, openInterest FROM instruments)",
)


@query(
    "duplicate_report",
    over_feeds(
        """SELECT symbol, count(*) AS rows, count(DISTINCT trdMatchID) AS distinct_ids, count(*)-count(DISTINCT trdMatchID) AS duplicates
           FROM trades GROUP BY symbol"""
    ),
)
def duplicate_report(spark, sf):
    return d.duplicate_report(feed(spark, sf, "trades"), "trdMatchID")


GAP_US = 4 * 3600 * 1_000_000


@query(
    "throttle_instruments",
    over_feeds(
        "SELECT symbol, ts, seq FROM f WHERE keep",
        f"""t AS (SELECT symbol, ts, seq, seq%5=0 AS must, row_number() OVER (PARTITION BY symbol ORDER BY ts,seq) AS n FROM instruments),
f AS (SELECT symbol, n, ts, seq, ts AS last, true AS keep FROM t WHERE n=1
      UNION ALL SELECT t.symbol, t.n, t.ts, t.seq, CASE WHEN t.must OR t.ts-f.last >= INTERVAL {GAP_US // 1_000_000} SECOND THEN t.ts ELSE f.last END,
        t.must OR t.ts-f.last >= INTERVAL {GAP_US // 1_000_000} SECOND FROM f JOIN t ON t.symbol=f.symbol AND t.n=f.n+1)""",
        recursive=True,
    ),
)
def throttle_instruments(spark, sf):
    """Sparse test data: a gap of four hours instead of one second."""
    df = feed(spark, sf, "instruments").select("symbol", "ts", "seq", to_us("ts").alias("us"))
    return d.throttle(df, F.col("seq") % 5 == 0, gap_us=GAP_US).drop("us")


@query(
    "recent_sample",
    over_feeds(
        """SELECT 'trades' AS feed, ts, seq FROM (SELECT * FROM trades WHERE symbol='click' AND ts>=TIMESTAMP '2024-01-20' ORDER BY ts DESC, seq DESC LIMIT 100)
           UNION ALL SELECT 'liquidations', ts, seq FROM liquidations WHERE symbol='click' AND ts>=TIMESTAMP '2024-01-20'
           UNION ALL SELECT 'orderbook', NULL, a.id FROM alive a WHERE a.tseq=(SELECT max(seq) FROM ob WHERE symbol='click')""",
        book_ctes(),
    ),
)
def recent_sample(spark, sf):
    return rp.recent_sample(
        feed(spark, sf, "trades"), feed(spark, sf, "liquidations"), "click",
        F.lit("2024-01-20").cast("timestamp_ntz"), levels=bk.book_state(feed(spark, sf, "orderbook")),
    )
