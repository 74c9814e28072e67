"""Order book queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow.catalog.common import DEPTH, book_ctes, feed, over_feeds, query, r6, rounded
from tickflow.operators import book as bk
from tickflow.operators.grid import last_in_interval

AT = "2024-01-16 12:00:00"
_AT = f"TIMESTAMP '{AT}'"
# Last row of each symbol at or before the time.
_LAST = f"last AS (SELECT symbol, max(seq) AS q FROM ob WHERE ts<={_AT} GROUP BY symbol)"
_END = "last AS (SELECT symbol, max(seq) AS q FROM ob GROUP BY symbol)"


def _at():
    return F.lit(AT).cast("timestamp_ntz")


@query(
    "book_asof",
    over_feeds(
        "SELECT a.symbol, a.side, a.id, a.price, a.size FROM alive a JOIN last ON a.tseq=last.q",
        book_ctes() + "," + _LAST,
    ),
)
def book_asof(spark, sf):
    return bk.book_state(feed(spark, sf, "orderbook"), _at())


@query(
    "book_levels_at",
    over_feeds(
        """SELECT p.symbol, CAST(date_diff('day', DATE '1970-01-01', CAST(p.t AS DATE)) AS BIGINT) AS chunk,
             a.side, a.id, a.price, a.size
           FROM pts p JOIN alive a ON a.tseq=p.q""",
        book_ctes()
        + """,
sp AS (SELECT symbol, unnest(generate_series(date_trunc('day',min(ts))+INTERVAL 1 DAY, max(ts), INTERVAL 1 DAY)) AS t
       FROM ob GROUP BY symbol),
pts AS (SELECT sp.symbol, sp.t, max(ob.seq) AS q FROM sp JOIN ob ON ob.symbol=sp.symbol AND ob.ts<sp.t GROUP BY ALL)""",
    ),
)
def book_levels_at(spark, sf):
    """Live levels at the start of each day, from per-day facts only."""
    rows = feed(spark, sf, "orderbook")
    days = F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).cast("long")
    chunked = bk._with_us(rows).withColumn("chunk", days)
    return bk.checkpoints(chunked)


@query(
    "book_top_n",
    over_feeds(
        f"""SELECT symbol, side, price, CAST(sum(sz) AS BIGINT) AS size, CAST(max(n) AS BIGINT) AS levels, CAST(rn AS INT) AS level FROM (
            SELECT t.symbol, t.side, t.price, t.sz, t.rn, (SELECT count(*) FROM alive a WHERE a.tseq=t.tseq AND a.side=t.side AND a.price=t.price) AS n
            FROM top t JOIN last ON t.tseq=last.q WHERE t.rn<={DEPTH}) GROUP BY symbol, side, price, rn""",
        book_ctes() + "," + _LAST,
    ),
)
def book_top_n(spark, sf):
    return bk.top_levels(bk.book_state(feed(spark, sf, "orderbook"), _at()), DEPTH)


@query(
    "book_by_price",
    over_feeds(
        """SELECT a.symbol, a.side, a.price, CAST(sum(a.size) AS BIGINT) AS size, count(*) AS levels
           FROM alive a JOIN last ON a.tseq=last.q GROUP BY ALL""",
        book_ctes() + "," + _END,
    ),
)
def book_by_price(spark, sf):
    return bk.book_by_price(bk.book_state(feed(spark, sf, "orderbook")))


@query(
    "market_summary",
    over_feeds(
        f"""SELECT symbol, bb AS best_bid, ba AS best_ask, nb AS bid_levels, na AS ask_levels, (bb+ba)/2 AS mid,
              ba-bb AS spread, {r6('CASE WHEN bb+ba>0 THEN (ba-bb)/((bb+ba)/2)*10000 END')} AS spread_bps
            FROM (SELECT a.symbol, max(price) FILTER (side='Buy') AS bb, min(price) FILTER (side='Sell') AS ba,
                    count(*) FILTER (side='Buy') AS nb, count(*) FILTER (side='Sell') AS na
                  FROM alive a JOIN last ON a.tseq=last.q GROUP BY a.symbol)""",
        book_ctes() + "," + _END,
    ),
)
def market_summary(spark, sf):
    return rounded(bk.market_summary(bk.book_state(feed(spark, sf, "orderbook"))), "spread_bps")


def _ticks(spark, sf):
    return bk.book_ticks(bk.chunk_book(feed(spark, sf, "orderbook")), depth=DEPTH)


@query(
    "book_ticks",
    over_feeds(
        "SELECT symbol, ts, bid1 AS best_bid, ask1 AS best_ask, mid, CAST(bsz AS DOUBLE) AS bid_size, CAST(asz AS DOUBLE) AS ask_size FROM ticks",
        book_ctes(),
    ),
)
def book_ticks(spark, sf):
    """Best quotes, mid and summed depth after every book time, by chunked replay."""
    total = lambda side: F.aggregate(side, F.lit(0.0), lambda acc, lv: acc + lv["size"])
    return _ticks(spark, sf).select(
        "symbol", "ts", F.get("bids", F.lit(0))["price"].alias("best_bid"),
        F.get("asks", F.lit(0))["price"].alias("best_ask"), "mid",
        total("bids").alias("bid_size"), total("asks").alias("ask_size"),
    )


@query(
    "book_wide",
    over_feeds(
        "SELECT t.symbol, t.ts, t.mid, "
        + ", ".join(
            f"coalesce((SELECT max({expr}) FROM top WHERE top.tseq=t.seq AND top.side='{side}' AND top.rn={i}),0) AS {name}_{field}_L{i}"
            for name, side in (("bid", "Buy"), ("ask", "Sell"))
            for field, expr in (("price", "price"), ("size", "CAST(sz AS DOUBLE)"))
            for i in range(1, 4)
        )
        + " FROM ticks t",
        book_ctes(),
    ),
)
def book_wide(spark, sf):
    """The snapshot in its wide form, three levels per side."""
    ticks = bk.book_ticks(bk.chunk_book(feed(spark, sf, "orderbook")), depth=3)
    return bk.flatten_levels(ticks.select("symbol", "ts", "mid", "bids", "asks"), 3)


@query("mid_price_ticks", over_feeds("SELECT symbol, ts, mid FROM ticks", book_ctes()))
def mid_price_ticks(spark, sf):
    chunked = bk.chunk_book(feed(spark, sf, "orderbook"))
    return bk.book_ticks(chunked, depth=0).select("symbol", "ts", "mid")


@query(
    "tick_log_returns",
    over_feeds(f"SELECT symbol, ts, mid, {r6('ret')} AS log_return FROM rets", book_ctes()),
)
def tick_log_returns(spark, sf):
    chunked = bk.chunk_book(feed(spark, sf, "orderbook"))
    ticks = bk.tick_returns(bk.book_ticks(chunked, depth=0))
    return rounded(ticks.select("symbol", "ts", "mid", "log_return"), "log_return")


@query(
    "last_in_interval",
    over_feeds(
        """SELECT i.symbol, i.start_ts, i.end_ts, arg_max(t.mid, t.seq) FILTER (t.mid IS NOT NULL) AS last_mid
           FROM ticks t JOIN i ON i.symbol=t.symbol AND t.ts>=i.start_ts AND t.ts<i.end_ts GROUP BY ALL""",
        book_ctes() + ", i AS (SELECT symbol, ts AS start_ts, ts + INTERVAL 90 MINUTE AS end_ts FROM liquidations)",
    ),
)
def last_in_interval_(spark, sf):
    """Last mid within 90 minutes after each liquidation."""
    spans = feed(spark, sf, "liquidations").select(
        "symbol", F.col("ts").alias("start_ts"), (F.col("ts") + F.expr("INTERVAL 90 MINUTES")).alias("end_ts")
    )
    ticks = bk.book_ticks(bk.chunk_book(feed(spark, sf, "orderbook")), depth=0)
    return last_in_interval(ticks, spans, "mid", order=("us",), name="last_mid")
