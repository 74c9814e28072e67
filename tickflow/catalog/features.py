"""Feature queries, on a one-hour grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow.catalog.common import (
    BIN, DEPTH, SPAN, SYMBOLS, VOL, book_ctes, feed, over_feeds, query, r6, rounded,
)
from tickflow.functions.clock import from_us
from tickflow.plans import features as p

_FLOW = """
fl AS (SELECT symbol, CAST(ts AS DATE) AS d, date_trunc('hour',ts) AS h,
         sum(CASE side WHEN 'Buy' THEN abs(foreignNotional)*w WHEN 'Sell' THEN -abs(foreignNotional)*abs(w) ELSE 0 END) AS flow
       FROM (SELECT *, CASE tickDirection WHEN 'PlusTick' THEN 1.5 WHEN 'ZeroPlusTick' THEN 1.5 WHEN 'MinusTick' THEN -1.5
               WHEN 'ZeroMinusTick' THEN -1.5 ELSE 1.0 END AS w,
               row_number() OVER (PARTITION BY symbol, trdMatchID ORDER BY seq DESC) AS rn FROM trades) WHERE rn=1 GROUP BY 1,2,3)"""

_F4 = "CASE WHEN {x}>0 THEN ln(1+{x}) WHEN {x}<0 THEN -ln(1-{x}) ELSE 0 END"


@query(
    "f4_taker_imbalance",
    over_feeds(
        f"SELECT g.symbol, g.h AS ts, {r6(_F4.format(x='coalesce(flow,0)'))} AS f4 FROM g LEFT JOIN fl USING (symbol,d,h)",
        _FLOW + ", g AS (SELECT symbol, d, unnest(generate_series(min(h),max(h),INTERVAL 1 HOUR)) AS h FROM fl GROUP BY 1,2)",
    ),
)
def f4_taker_imbalance(spark, sf):
    return rounded(p.taker_imbalance(feed(spark, sf, "trades"), BIN), "f4")


FEATURE_CTES = (
    book_ctes(daily=True)
    + ","
    + _FLOW
    + f""",
tb AS (SELECT symbol, d, date_trunc('hour',ts) AS h, sum(ret) AS ret, arg_max(mid, seq) FILTER (mid IS NOT NULL) AS mid_end FROM rets GROUP BY 1,2,3),
ins AS (SELECT *, CAST(ts AS DATE) AS d, last_value(markPrice IGNORE NULLS) OVER w AS mk, last_value(nullif(indexPrice,0) IGNORE NULLS) OVER w AS ix
        FROM instruments WINDOW w AS (PARTITION BY symbol, CAST(ts AS DATE) ORDER BY ts)),
lim AS (SELECT 'b' AS f, symbol, d, min(h) AS lo, max(h) AS hi FROM tb GROUP BY 2,3
        UNION ALL SELECT 'i', symbol, d, date_trunc('hour',min(ts)), date_trunc('hour',max(ts)) FROM ins GROUP BY 2,3
        UNION ALL SELECT 't', symbol, d, min(h), max(h) FROM fl GROUP BY 2,3),
gr AS (SELECT DISTINCT symbol, d, h FROM (SELECT symbol, d, unnest(generate_series(lo,hi,INTERVAL 1 HOUR)) AS h FROM lim)),
g2 AS (SELECT gr.*, least(gr.h, b.hi) AS bh, least(gr.h, i.hi) AS ih FROM gr
       LEFT JOIN lim b ON b.f='b' AND b.symbol=gr.symbol AND b.d=gr.d LEFT JOIN lim i ON i.f='i' AND i.symbol=gr.symbol AND i.d=gr.d),
ab AS (SELECT g2.symbol, g2.d, g2.h, t.bid1, t.ask1, t.mid AS qmid, t.bsz, t.asz, t.pv FROM g2 ASOF JOIN ticks t ON g2.symbol=t.symbol AND g2.d=t.d AND g2.bh>=t.ts),
ai AS (SELECT g2.symbol, g2.d, g2.h, i.mk, i.ix, i.volume24h FROM g2 ASOF JOIN ins i ON g2.symbol=i.symbol AND g2.d=i.d AND g2.ih>=i.ts),
al AS (SELECT gr.symbol, gr.d, gr.h, coalesce(tb.ret,0) AS f1, last_value(tb.mid_end IGNORE NULLS) OVER w AS mid_price,
         ab.bid1, ab.ask1, ab.qmid, coalesce(ab.bsz,0) AS bsz, coalesce(ab.asz,0) AS asz, ab.pv, ai.mk, ai.ix, ai.volume24h, coalesce(fl.flow,0) AS flow,
         last_value(ab.qmid IGNORE NULLS) OVER w AS kmid
       FROM gr LEFT JOIN tb USING (symbol,d,h) LEFT JOIN ab USING (symbol,d,h) LEFT JOIN ai USING (symbol,d,h) LEFT JOIN fl USING (symbol,d,h)
       WINDOW w AS (PARTITION BY gr.symbol, gr.d ORDER BY gr.h)),
fm AS (SELECT *, coalesce(kmid, median(kmid) OVER (PARTITION BY symbol, d), 1.0) AS fmid FROM al),
fx AS (SELECT symbol, d, h, f1,
         coalesce(CASE WHEN qmid>0 THEN abs(ask1-bid1)/qmid END,0)+coalesce(CASE WHEN ix>0 THEN abs((mk-ix)/ix) END,0) AS f2,
         CASE WHEN bsz+asz>0 THEN CAST(bsz-asz AS DOUBLE)/CAST(bsz+asz AS DOUBLE) ELSE 0 END AS f3,
         {_F4.format(x='flow')} AS f4,
         CASE WHEN bsz+asz>0 AND pv>0 THEN pv/CAST(bsz+asz AS DOUBLE) ELSE fmid END AS f6,
         coalesce(CAST(volume24h AS DOUBLE),0) AS volume24h, coalesce(mid_price,0) AS mid_price,
         row_number() OVER (PARTITION BY symbol, d ORDER BY h) AS n FROM fm),
em AS (SELECT a.symbol, a.d, a.h, sum(CASE WHEN b.n=1 THEN 1 ELSE 2.0::DOUBLE/{SPAN + 1} END * pow(1-2.0::DOUBLE/{SPAN + 1}, a.n-b.n) * b.f6) AS e
       FROM fx a JOIN fx b ON a.symbol=b.symbol AND a.d=b.d AND b.n<=a.n GROUP BY 1,2,3),
ft AS (SELECT fx.symbol, fx.h AS ts, CASE WHEN e>0 THEN f6/e-1 ELSE 0 END AS f0, f1, f2, f3, f4,
         CASE WHEN n<{VOL} THEN 0 ELSE stddev_pop(f1) OVER (PARTITION BY fx.symbol, fx.d ORDER BY n ROWS BETWEEN {VOL - 1} PRECEDING AND CURRENT ROW) END AS f5,
         f6, volume24h, mid_price FROM fx JOIN em USING (symbol,d,h)),
features AS (SELECT symbol, ts, """
    + ", ".join(f"{r6(c)} AS {c}" for c in p.FEATURE_COLS)
    + " FROM ft)"
)


def features(spark, sf, **options):
    return p.features_long(
        feed(spark, sf, "orderbook"), feed(spark, sf, "trades"), feed(spark, sf, "instruments"),
        step=BIN, depth=DEPTH, span=SPAN, vol_window=VOL, **options,
    )


@query("features_long", over_feeds("SELECT * FROM features", FEATURE_CTES))
def features_long(spark, sf):
    return rounded(features(spark, sf), *p.FEATURE_COLS)


def _single(name, col):
    @query(name, over_feeds(f"SELECT symbol, ts, {col} FROM features", FEATURE_CTES))
    def one(spark, sf):
        return rounded(features(spark, sf).select("symbol", "ts", col), col)


_single("f0_price_vs_ema", "f0")
_single("f1_log_return", "f1")
_single("f2_rel_spread", "f2")
_single("f3_obi", "f3")
_single("f5_realized_vol", "f5")
_single("f6_wap", "f6")


@query(
    "align_streams",
    over_feeds(
        f"""SELECT symbol, h AS ts, {r6('f1')} AS ret, {r6('mid_price')} AS mid_end, {r6('mk')} AS mark, {r6('ix')} AS index,
              CAST(volume24h AS DOUBLE) AS volume, {r6('flow')} AS flow FROM al""",
        FEATURE_CTES,
    ),
)
def align_streams(spark, sf):
    grid = p.aligned_feeds(
        feed(spark, sf, "orderbook"), feed(spark, sf, "trades"), feed(spark, sf, "instruments"), step=BIN, depth=DEPTH,
    )
    out = grid.select("symbol", from_us("bin").alias("ts"), "ret", "mid_end", "mark", "index", "volume", "flow")
    return rounded(out, "ret", "mid_end", "mark", "index", "flow")


WIDE_SQL = ", ".join(
    f"coalesce(max({c}) FILTER (symbol='{s}'),0) AS {s}_{c}" for s in SYMBOLS for c in p.FEATURE_COLS
)


@query("wide_features", over_feeds(f"SELECT ts, {WIDE_SQL} FROM features GROUP BY ts", FEATURE_CTES))
def wide_features(spark, sf):
    wide = p.widen(features(spark, sf), SYMBOLS)
    return rounded(wide, *[c for c in wide.columns if c != "ts"])


@query(
    "f7_oi_log_return",
    over_feeds(
        f"""SELECT symbol, h AS ts, {r6("coalesce(ln(l)-ln(lag(l) OVER (PARTITION BY symbol ORDER BY h)),0)")} AS f7
            FROM (SELECT g.symbol, g.h, greatest(coalesce(i.openInterest,0),1) AS l FROM g ASOF LEFT JOIN instruments i
                  ON g.symbol=i.symbol AND g.h>=i.ts)""",
        """g AS (SELECT symbol, unnest(generate_series(date_trunc('hour',min(ts)),date_trunc('hour',max(ts)),INTERVAL 1 HOUR)) AS h
                 FROM instruments GROUP BY symbol)""",
    ),
)
def f7_oi_log_return(spark, sf):
    df = p.oi_log_return(feed(spark, sf, "instruments"), BIN)
    return rounded(df.select("symbol", from_us("bin").alias("ts"), "f7"), "f7")


@query(
    "f8_liq_volume",
    over_feeds(
        "SELECT g.symbol, g.h AS ts, CAST(coalesce(q,0) AS DOUBLE) AS f8 FROM g LEFT JOIN b USING (symbol,h)",
        """b AS (SELECT symbol, date_trunc('hour',ts) AS h, sum(CASE WHEN side='Sell' THEN leavesQty ELSE -leavesQty END) AS q FROM liquidations GROUP BY 1,2),
           g AS (SELECT symbol, unnest(generate_series(min(h),max(h),INTERVAL 1 HOUR)) AS h FROM b GROUP BY symbol)""",
    ),
)
def f8_liq_volume(spark, sf):
    df = p.liquidation_volume(feed(spark, sf, "liquidations"), BIN)
    return df.select("symbol", from_us("bin").alias("ts"), "f8")


@query(
    "f9_funding",
    over_feeds(
        f"SELECT symbol, ts, seq, {r6('fundingRate+0.5*(fundingRate-indicativeFundingRate)', 9)} AS f9 FROM instruments"
    ),
)
def f9_funding(spark, sf):
    df = feed(spark, sf, "instruments")
    return rounded(
        df.select("symbol", "ts", "seq", p.funding_feature("fundingRate", "indicativeFundingRate").alias("f9")),
        "f9", digits=9,
    )


@query(
    "select_features",
    over_feeds(f"SELECT ts, {', '.join(f'coalesce(max({c}) FILTER (symbol={chr(39)}{s}{chr(39)}),0) AS {s}_{c}' for s in SYMBOLS for c in ('f2', 'f5'))} FROM features GROUP BY ts", FEATURE_CTES),
)
def select_features(spark, sf):
    """Symbols from column names, then two features of each."""
    from tickflow.operators.segments import select_features as pick

    wide = p.widen(features(spark, sf), SYMBOLS)
    out = pick(wide, ["f2", "f5"])
    return rounded(out, *[c for c in out.columns if c != "ts"])
