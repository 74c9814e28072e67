"""Report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow.catalog.common import (
    HOUR, SYMBOLS, book_ctes, feed, over_feeds, query, r6, rounded,
)
from tickflow.catalog.features import FEATURE_CTES, features
from tickflow.catalog.gridded import _SEG, segment_labels
from tickflow.operators import book as bk
from tickflow.operators import reports as rp


@query("nonzero_liqs", over_feeds("""SELECT seq, ts, symbol, leavesQty AS "leavesQty", matches FROM (SELECT *, count(*) OVER (PARTITION BY symbol) AS matches,
    row_number() OVER (PARTITION BY symbol ORDER BY ts,seq) AS r FROM liquidations WHERE leavesQty>0) WHERE r<=3"""))
def nonzero_liqs(spark, sf):
    df = feed(spark, sf, "liquidations").select("seq", "ts", "symbol", "leavesQty")
    return rp.first_rows(df, F.col("leavesQty") > 0, ["symbol"])


@query("nonzero_funding", over_feeds("""SELECT seq, ts, symbol, fundingRate AS "fundingRate", matches FROM (SELECT *, count(*) OVER (PARTITION BY symbol) AS matches,
    row_number() OVER (PARTITION BY symbol ORDER BY ts,seq) AS r FROM instruments WHERE fundingRate<>0) WHERE r<=3"""))
def nonzero_funding(spark, sf):
    df = feed(spark, sf, "instruments").select("seq", "ts", "symbol", "fundingRate")
    return rp.first_rows(df, F.col("fundingRate") != 0, ["symbol"])


@query("whale_trades", over_feeds("SELECT seq, ts, symbol, side FROM trades WHERE abs(foreignNotional)>1000"))
def whale_trades(spark, sf):
    """Test notionals are small: alert above 1,000 instead of a million."""
    return rp.whale_trades(feed(spark, sf, "trades"), 1000).select("seq", "ts", "symbol", "side")


@query("funding_alerts", over_feeds(f'SELECT seq, ts, symbol, fundingRate AS "fundingRate", {r6("fundingRate*365*3")} AS annualised FROM instruments WHERE abs(fundingRate)>0.0004'))
def funding_alerts(spark, sf):
    df = rp.funding_alerts(feed(spark, sf, "instruments"), 0.0004)
    return rounded(df.select("seq", "ts", "symbol", "fundingRate", "annualised"), "annualised")


@query("executed_liqs", over_feeds('SELECT seq, ts, symbol, leavesQty AS "leavesQty" FROM liquidations WHERE leavesQty>0'))
def executed_liqs(spark, sf):
    return rp.executed_liquidations(feed(spark, sf, "liquidations"), "leavesQty").select("seq", "ts", "symbol", "leavesQty")


@query("trade_stats", over_feeds(f"""SELECT symbol, count(*) AS trades, {r6('sum(foreignNotional)')} AS volume_usd, min(price) AS min_price, max(price) AS max_price,
    {r6("sum(foreignNotional) FILTER (side='Buy')/sum(foreignNotional) FILTER (side='Sell')")} AS buy_sell_ratio FROM trades GROUP BY symbol"""))
def trade_stats(spark, sf):
    return rounded(rp.trade_stats(feed(spark, sf, "trades")), "volume_usd", "buy_sell_ratio")


@query("liq_long_short", over_feeds("""SELECT symbol, count(*) FILTER (side='Sell') AS long_count, CAST(coalesce(sum(leavesQty) FILTER (side='Sell'),0) AS BIGINT) AS long_qty,
    count(*) FILTER (side='Buy') AS short_count, CAST(coalesce(sum(leavesQty) FILTER (side='Buy'),0) AS BIGINT) AS short_qty FROM liquidations GROUP BY symbol"""))
def liq_long_short(spark, sf):
    return rp.long_short_liquidations(feed(spark, sf, "liquidations"))


PROFILED = {
    "profile_trades": ("trades", ["price", "size", "foreignNotional"]),
    "profile_book": ("orderbook", ["price", "size"]),
    "profile_instr": ("instruments", ["openInterest", "fundingRate", "markPrice"]),
    "profile_liqs": ("liquidations", ["leavesQty", "price"]),
}


def _profile(name, feed_name, cols):
    long = " UNION ALL ".join(
        f"SELECT symbol, CAST(ts AS DATE) AS day, '{c}' AS name, CAST({c} AS DOUBLE) AS x FROM {feed_name} WHERE {c} IS NOT NULL" for c in cols
    )
    sql = f"""SELECT symbol, day, name, count(*) AS count, {r6('avg(x)')} AS mean, {r6('stddev_samp(x)')} AS std, {r6('min(x)')} AS min, {r6('max(x)')} AS max,
      {r6('quantile_cont(x,0.25)')} AS q25, {r6('quantile_cont(x,0.5)')} AS q50, {r6('quantile_cont(x,0.75)')} AS q75,
      {r6('CASE WHEN count(*)<3 THEN NULL WHEN min(x)=max(x) THEN 0 ELSE skewness(x) END')} AS skew FROM ({long}) GROUP BY ALL"""

    @query(name, over_feeds(sql))
    def prof(spark, sf):
        df = feed(spark, sf, feed_name).withColumn("day", F.to_date("ts"))
        return rounded(rp.profile(df, cols), "mean", "std", "min", "max", "q25", "q50", "q75", "skew")


for _name, (_feed, _cols) in PROFILED.items():
    _profile(_name, _feed, _cols)


@query("histogram", over_feeds(
    f"""SELECT s.symbol, CAST(b.bin AS INT) AS bin, {r6('lo+b.bin*w')} AS low, coalesce(c,0) AS count, {r6('coalesce(c,0)/(n*w)')} AS density
        FROM s CROSS JOIN (SELECT unnest(generate_series(0,49)) AS bin) b LEFT JOIN h ON h.symbol=s.symbol AND h.bin=b.bin""",
    """s AS (SELECT symbol, min(foreignNotional) AS lo, (max(foreignNotional)-min(foreignNotional))/50 AS w, count(*) AS n FROM trades GROUP BY symbol),
h AS (SELECT symbol, least(CAST(floor((foreignNotional-lo)/w) AS BIGINT),49) AS bin, count(*) AS c FROM trades JOIN s USING (symbol) GROUP BY 1,2)"""))
def histogram(spark, sf):
    return rounded(rp.histogram(feed(spark, sf, "trades"), "foreignNotional"), "low", "density")


@query("kde", over_feeds(
    f"""SELECT s.symbol, p.point, {r6('lo+p.point*dx')} AS x,
          {r6('sum(exp(-0.5*((lo+p.point*dx-price)/h)**2))/(max(n)*max(h)*sqrt(2*pi()))', 9)} AS density
        FROM s CROSS JOIN (SELECT unnest(generate_series(0,999)) AS point) p JOIN trades t ON t.symbol=s.symbol GROUP BY s.symbol, p.point, lo, dx""",
    """s AS (SELECT symbol, count(*) AS n, stddev_samp(price)*pow(count(*),-0.2) AS h, min(price)-0.5*(max(price)-min(price)) AS lo,
       2*(max(price)-min(price))/999 AS dx FROM trades GROUP BY symbol HAVING count(*)>10)"""))
def kde(spark, sf):
    return rounded(rounded(rp.kde(feed(spark, sf, "trades"), "price"), "x"), "density", digits=9)


@query("boxplot", over_feeds(
    f"""SELECT symbol, name, {r6('q25')} AS q25, {r6('q50')} AS q50, {r6('q75')} AS q75,
          {r6('min(x) FILTER (x>=q25-1.5*(q75-q25) AND x<=q75+1.5*(q75-q25))')} AS whisker_low, {r6('max(x) FILTER (x>=q25-1.5*(q75-q25) AND x<=q75+1.5*(q75-q25))')} AS whisker_high,
          count(*) FILTER (x<q25-1.5*(q75-q25) OR x>q75+1.5*(q75-q25)) AS outliers FROM l JOIN q USING (symbol,name) GROUP BY symbol,name,q25,q50,q75""",
    """l AS (SELECT symbol, 'foreignNotional' AS name, foreignNotional AS x FROM trades UNION ALL SELECT symbol, 'price', price FROM trades),
q AS (SELECT symbol, name, quantile_cont(x,0.25) AS q25, quantile_cont(x,0.5) AS q50, quantile_cont(x,0.75) AS q75 FROM l GROUP BY 1,2)"""))
def boxplot(spark, sf):
    df = rp.boxplot(feed(spark, sf, "trades"), ["foreignNotional", "price"])
    return rounded(df, "q25", "q50", "q75", "whisker_low", "whisker_high")


@query("value_counts", over_feeds("""SELECT symbol, 'side' AS name, side AS value, count(*) AS count FROM trades GROUP BY 1,3
    UNION ALL SELECT symbol, 'tickDirection', tickDirection, count(*) FROM trades GROUP BY 1,3"""))
def value_counts(spark, sf):
    return rp.value_counts(feed(spark, sf, "trades"), ["side", "tickDirection"])


@query("regime_distribution", over_feeds(f"SELECT regime, count(*) AS segments, {r6('count(*)*100.0::DOUBLE/sum(count(*)) OVER ()')} AS pct FROM seg GROUP BY regime", _SEG))
def regime_distribution(spark, sf):
    return rounded(rp.regime_distribution(segment_labels(spark, sf)), "pct")


@query("regime_summary", over_feeds("SELECT regime, count(*) AS segments, count(*)*24.0::DOUBLE AS hours, count(*)*864000 AS samples FROM seg WHERE regime<>-1 GROUP BY regime", _SEG))
def regime_summary(spark, sf):
    """Segments of one day (1,440 minutes)."""
    return rp.regime_summary(segment_labels(spark, sf), minutes=1440)


_TRAITS = {"volatility": "f5", "spread": "f2", "obi": "f3", "taker_imbalance": "f4"}


@query("regime_characteristics", over_feeds(
    "SELECT regime, max(n) AS segments, " + ", ".join(f"{r6(f'avg({n})')} AS {n}" for n in _TRAITS) + " FROM ps GROUP BY regime",
    FEATURE_CTES + "," + _SEG + """,
sm AS (SELECT symbol, date_trunc('day',ts) AS segment_start, """ + ", ".join(f"avg({c}) AS {n}" for n, c in _TRAITS.items()) + """ FROM ft GROUP BY 1,2),
ps AS (SELECT regime, symbol, count(*) AS n, """ + ", ".join(f"avg({n}) AS {n}" for n in _TRAITS) + " FROM sm JOIN seg USING (segment_start) WHERE regime<>-1 GROUP BY 1,2)"))
def regime_characteristics(spark, sf):
    means = features(spark, sf).groupBy("symbol", F.window("ts", "1 day").start.alias("segment_start")).agg(
        *[F.avg(c).alias(c) for c in _TRAITS.values()]
    )
    out = rp.regime_characteristics(means.join(segment_labels(spark, sf), "segment_start"), _TRAITS)
    return rounded(out, *_TRAITS)


@query("regime_transitions", over_feeds("""SELECT f AS from_regime, regime AS to_regime, count(*) AS transitions
    FROM (SELECT *, lag(regime) OVER (ORDER BY segment_start) AS f FROM seg) WHERE f IS NOT NULL GROUP BY 1,2""", _SEG))
def regime_transitions(spark, sf):
    return rp.regime_transitions(segment_labels(spark, sf))


def all_rows(spark, sf):
    """(feed, symbol, ts, is_error): every feed row; an instrument without mark price is an error."""
    parts = []
    for name in ("trades", "orderbook", "instruments", "liquidations"):
        bad = F.col("markPrice").isNull() if name == "instruments" else F.lit(False)
        parts.append(feed(spark, sf, name).select(F.lit(name).alias("feed"), "symbol", "ts", bad.alias("is_error")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


_ALL = "ar AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS feed, symbol, ts, {'markPrice IS NULL' if n == 'instruments' else 'false'} AS bad FROM {n}"
    for n in ("trades", "orderbook", "instruments", "liquidations")
) + ")"


@query("feed_rates", over_feeds(
    f"""SELECT feed, rows, errors, {r6('s')} AS seconds, {r6('rows/s')} AS rows_per_sec, {r6('errors/rows')} AS error_rate
        FROM (SELECT feed, count(*) AS rows, count(*) FILTER (bad) AS errors, CAST(epoch_us(max(ts))-epoch_us(min(ts)) AS DOUBLE)/1e6 AS s FROM ar GROUP BY feed)""", _ALL))
def feed_rates(spark, sf):
    return rounded(rp.feed_rates(all_rows(spark, sf)), "seconds", "rows_per_sec", "error_rate")


@query("feed_quality", over_feeds(
    f"""SELECT feed, symbol, date_trunc('hour',ts) AS ts, count(*) AS n, count(*) FILTER (bad) AS errors, {r6('max(gap)')} AS max_gap,
          CASE WHEN count(*) FILTER (bad)/count(*)>0.05 OR max(gap)>7200 THEN 'poor' WHEN count(*) FILTER (bad)/count(*)>0.01 THEN 'degraded' ELSE 'good' END AS tier,
          max(gap)>14400 AS silent
        FROM (SELECT *, coalesce(CAST(epoch_us(ts)-epoch_us(p) AS DOUBLE)/1e6,0) AS gap
              FROM (SELECT *, lag(ts) OVER (PARTITION BY feed,symbol ORDER BY ts) AS p FROM ar)) GROUP BY ALL""", _ALL))
def feed_quality(spark, sf):
    """Hourly intervals; poor after two silent hours, silent after four."""
    return rounded(rp.feed_quality(all_rows(spark, sf), step=HOUR, poor_gap=7200, silent_gap=14400), "max_gap")


_RULES = [
    ("trades", "min_trades_per_minute", "count(*)", "<10"),
    ("trades", "max_price_change_pct", "(max(price)/min(price)-1)*100", ">5"),
    ("trades", "max_trade_latency_ms", "max(seq%250)", ">100"),
    ("trades", "duplicate_trade_threshold", "count(*)-count(DISTINCT trdMatchID)", ">10"),
    ("orderbook", "min_updates_per_minute", "count(*)", "<100"),
    ("orderbook", "max_book_latency_ms", "max(seq%250)", ">50"),
    ("ticks", "max_spread_pct", "max((ask1-bid1)/mid*100)", ">1"),
    ("liquidations", "max_liquidations_per_minute", "count(*)", ">1000"),
    ("liquidations", "min_liquidation_size", "min(leavesQty)", "<1"),
    ("instruments", "max_funding_rate", "max(abs(fundingRate))", ">0.01"),
    ("gp", "min_update_interval", "max(gap)", ">1"),
]


@query("dq_violations", over_feeds(
    " UNION ALL ".join(
        f"SELECT symbol, ts, '{rule}' AS rule, {r6('value')} AS value, {cmp[1:]}::DOUBLE AS \"limit\" FROM (SELECT symbol, date_trunc('hour',ts) AS ts, CAST({expr} AS DOUBLE) AS value FROM {src} GROUP BY 1,2) WHERE value{cmp}"
        for src, rule, expr, cmp in _RULES
    ),
    book_ctes() + """,
gp AS (SELECT symbol, ts, coalesce(CAST(epoch_us(ts)-epoch_us(p) AS DOUBLE)/1e6,0) AS gap
       FROM (SELECT *, lag(ts) OVER (PARTITION BY symbol ORDER BY ts) AS p FROM instruments))"""))
def dq_violations(spark, sf):
    """All quality rules per symbol and hour; the receipt time is made from the row number."""
    def received(df):
        return df.withColumn("received", F.col("ts") + F.make_dt_interval(secs=(F.col("seq") % 250) / 1000))

    book = feed(spark, sf, "orderbook")
    ticks = bk.book_ticks(bk.chunk_book(book), depth=1)
    bid, ask = F.get("bids", F.lit(0))["price"], F.get("asks", F.lit(0))["price"]
    spreads = ticks.select("symbol", "ts", ((ask - bid) / F.col("mid") * 100).alias("spread_pct"))
    out = rp.dq_violations(
        {
            "trades": received(feed(spark, sf, "trades")), "orderbook": received(book), "spreads": spreads,
            "liquidations": feed(spark, sf, "liquidations"), "instruments": feed(spark, sf, "instruments"),
        },
        step=HOUR,
    )
    return rounded(out, "value")


_FEEDS = ["trades", "orderbook", "instruments", "liquidations"]
_EXPECTED = f"""
dc AS (SELECT feed, symbol, CAST(ts AS DATE) AS day, count(*) AS n FROM ar GROUP BY ALL),
mx AS (SELECT f.feed, s.symbol, d.day, coalesce(dc.n,0) AS rows, 0::BIGINT AS bad_times
  FROM (SELECT DISTINCT day FROM dc) d CROSS JOIN (SELECT unnest({_FEEDS}) AS feed) f CROSS JOIN (SELECT unnest({SYMBOLS + ['ghost']}) AS symbol) s
  LEFT JOIN dc ON dc.feed=f.feed AND dc.symbol=s.symbol AND dc.day=d.day)"""


def _matrix(spark, sf):
    rows = all_rows(spark, sf).withColumn("day", F.to_date("ts"))
    return rp.coverage_matrix(rows, _FEEDS, [*SYMBOLS, "ghost"])


@query("coverage_matrix", over_feeds("SELECT * FROM mx", _ALL + "," + _EXPECTED))
def coverage_matrix(spark, sf):
    return _matrix(spark, sf)


@query("coverage_gaps", over_feeds("SELECT feed, symbol, day FROM mx WHERE rows=0 AND feed IN ('trades','orderbook')", _ALL + "," + _EXPECTED))
def coverage_gaps(spark, sf):
    return rp.coverage_gaps(_matrix(spark, sf))
