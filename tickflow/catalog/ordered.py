"""Ordered (window) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow.catalog.common import (
    RANK_MIN, RANK_W, SPAN, VOL, feed, over_feeds, query, r6, rounded,
)
from tickflow.operators import ordered as o

ORDER = ["ts", "seq"]


def _chunked(spark, sf, name, *cols):
    return o.range_chunks(feed(spark, sf, name).select("symbol", *ORDER, *cols), ["symbol"], ORDER)


@query(
    "log_returns",
    over_feeds(
        f"""SELECT symbol, ts, seq, {r6("coalesce(CASE WHEN price/pp>0 THEN greatest(-0.1,least(0.1,ln(price/pp))) END,0)")} AS log_return
            FROM (SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY ts,seq) AS pp FROM trades)"""
    ),
)
def log_returns(spark, sf):
    df = o.log_returns(_chunked(spark, sf, "trades", "price"), "price", ["symbol"], ORDER, "chunk")
    return rounded(df.select("symbol", *ORDER, "log_return"), "log_return")


@query(
    "ffill",
    over_feeds(
        f"""SELECT symbol, ts, seq, {r6("last_value(markPrice IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts,seq)")} AS "markPrice" FROM instruments"""
    ),
)
def ffill(spark, sf):
    df = o.ffill(_chunked(spark, sf, "instruments", "markPrice"), ["markPrice"], ["symbol"], ORDER, "chunk")
    return rounded(df.drop("chunk"), "markPrice")


@query(
    "bfill",
    over_feeds(
        f"""SELECT symbol, ts, seq, {r6("first_value(markPrice IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts,seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)")} AS "markPrice" FROM instruments"""
    ),
)
def bfill(spark, sf):
    df = o.bfill(_chunked(spark, sf, "instruments", "markPrice"), ["markPrice"], ["symbol"], ORDER, "chunk")
    return rounded(df.drop("chunk"), "markPrice")


@query(
    "ffill_zero",
    over_feeds(
        f"""SELECT symbol, ts, seq, {r6("coalesce(last_value(nullif(indexPrice,0) IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts,seq), indexPrice)")} AS "indexPrice" FROM instruments"""
    ),
)
def ffill_zero(spark, sf):
    df = o.ffill_zero(_chunked(spark, sf, "instruments", "indexPrice"), ["indexPrice"], ["symbol"], ORDER, "chunk")
    return rounded(df.drop("chunk"), "indexPrice")


# Rows per (symbol, day); the reference restarts these windows every day.
def _by_day(spark, sf):
    return feed(spark, sf, "trades").select("symbol", *ORDER, "price", F.to_date("ts").alias("day"))


@query(
    "rolling_std",
    over_feeds(
        f"""SELECT symbol, ts, seq, {r6(f"CASE WHEN row_number() OVER w < {VOL} THEN 0 ELSE stddev_pop(price) OVER (w ROWS BETWEEN {VOL - 1} PRECEDING AND CURRENT ROW) END")} AS rolling_std
            FROM trades WINDOW w AS (PARTITION BY symbol, CAST(ts AS DATE) ORDER BY ts,seq)"""
    ),
)
def rolling_std(spark, sf):
    df = o.in_blocks(
        _by_day(spark, sf), ["symbol", "day"], ORDER, VOL - 1, lambda rows, keys: o.rolling_std(rows, "price", keys, ORDER, VOL)
    )
    return rounded(df.drop("price", "day"), "rolling_std")


@query(
    "ema",
    over_feeds(
        f"SELECT symbol, ts, seq, {r6('y')} AS ema FROM e",
        f"""t AS (SELECT *, CAST(ts AS DATE) AS d, row_number() OVER (PARTITION BY symbol, CAST(ts AS DATE) ORDER BY ts,seq) AS n FROM trades),
e AS (SELECT symbol, d, n, ts, seq, price AS y FROM t WHERE n=1
      UNION ALL SELECT t.symbol, t.d, t.n, t.ts, t.seq, e.y*(1-2.0::DOUBLE/{SPAN + 1})+t.price*(2.0::DOUBLE/{SPAN + 1})
      FROM e JOIN t ON t.symbol=e.symbol AND t.d=e.d AND t.n=e.n+1)""",
        recursive=True,
    ),
)
def ema(spark, sf):
    df = o.in_blocks(
        _by_day(spark, sf), ["symbol", "day"], ORDER, o.ema_reach(SPAN), lambda rows, keys: o.ema(rows, "price", keys, ORDER, SPAN)
    )
    return rounded(df.drop("price", "day"), "ema")


def _rank_sql(op, least, before):
    return over_feeds(
        f"""SELECT a.symbol, a.ts, a.seq, {r6(f"CASE WHEN max(a.n) >= {least} THEN CAST(sum(CASE WHEN b.price {op} a.price THEN 1 ELSE 0 END) AS DOUBLE)/count(*) ELSE {before} END")} AS price_rank
            FROM t a JOIN t b ON a.symbol=b.symbol AND b.n<=a.n AND b.n>a.n-{RANK_W} GROUP BY a.symbol, a.ts, a.seq""",
        "t AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts,seq) AS n FROM trades)",
    )


@query("rolling_rank_le", _rank_sql("<=", RANK_W, 0))
def rolling_rank_le(spark, sf):
    df = o.rolling_rank(
        feed(spark, sf, "trades").select("symbol", *ORDER, "price"), ["price"], ["symbol"], ORDER,
        window=RANK_W, min_periods=None, inclusive=True, before=0.0,
    )
    return rounded(df.drop("price"), "price_rank")


@query("rolling_rank_lt", _rank_sql("<", RANK_MIN, "NULL"))
def rolling_rank_lt(spark, sf):
    df = o.rolling_rank(
        feed(spark, sf, "trades").select("symbol", *ORDER, "price"), ["price"], ["symbol"], ORDER,
        window=RANK_W, min_periods=RANK_MIN,
    )
    return rounded(df.drop("price"), "price_rank")


_LERP = "a.v+(b.v-a.v)*(n-a.n)/(b.n-a.n)"


@query(
    "interpolate",
    over_feeds(
        f"""SELECT symbol, ts, seq, {r6('CASE WHEN v IS NOT NULL THEN v WHEN an IS NULL THEN bv WHEN bn IS NULL THEN av ELSE av+(bv-av)*(n-an)/(bn-an) END')} AS "markPrice"
            FROM (SELECT *,
              last_value(v IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS av,
              last_value(vn IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS an,
              first_value(v IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bv,
              first_value(vn IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bn
              FROM (SELECT *, markPrice AS v, CASE WHEN markPrice IS NOT NULL THEN n END AS vn FROM
                (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts,seq) AS n FROM instruments))
              WINDOW w AS (PARTITION BY symbol ORDER BY n))"""
    ),
)
def interpolate(spark, sf):
    rows = feed(spark, sf, "instruments").select("symbol", *ORDER, "markPrice")
    chunked = o.ordered_index(rows, ORDER, ["symbol"], chunk="chunk")
    df = o.interpolate(chunked, ["markPrice"], ["symbol"], ORDER, "idx", "chunk")
    return rounded(df.drop("idx", "chunk"), "markPrice")


@query(
    "warmup_trim",
    over_feeds("SELECT symbol, ts, seq FROM trades WHERE ts >= (SELECT min(ts) FROM trades) + INTERVAL 60 MINUTE"),
)
def warmup_trim(spark, sf):
    return o.warmup_trim(feed(spark, sf, "trades").select("symbol", "ts", "seq"))


@query(
    "tail_window",
    over_feeds(
        """SELECT symbol, ts, seq, d AS day FROM (SELECT *, CAST(ts AS DATE) AS d, max(ts) OVER (PARTITION BY CAST(ts AS DATE)) AS hi FROM trades)
           WHERE ts > hi - INTERVAL 240 MINUTE"""
    ),
)
def tail_window(spark, sf):
    return o.tail_window(_by_day(spark, sf).drop("price"), ["day"])


@query(
    "ordered_index",
    over_feeds("SELECT seq, ts, row_number() OVER (ORDER BY ts, seq)-1 AS idx FROM trades"),
)
def ordered_index(spark, sf):
    return o.ordered_index(feed(spark, sf, "trades").select("seq", "ts"), ORDER)
