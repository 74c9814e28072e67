"""Time grid and lookup-join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow.catalog.common import BIN, book_ctes, feed, over_feeds, query, r6, rounded
from tickflow.operators import book as bk
from tickflow.operators import grid as g
from tickflow.operators import joins as j

_GRID = "SELECT symbol, unnest(generate_series(min(h),max(h),INTERVAL 1 HOUR)) AS h FROM {src} GROUP BY symbol"


def _ts(df):
    return g.bin_ts(df)


@query(
    "bin_sum",
    over_feeds(
        f"SELECT g.symbol, g.h AS ts, {r6('coalesce(t,0)')} AS total FROM g LEFT JOIN b USING (symbol,h)",
        "b AS (SELECT symbol, date_trunc('hour',ts) AS h, sum(foreignNotional) AS t FROM trades GROUP BY 1,2), g AS ("
        + _GRID.format(src="b") + ")",
    ),
)
def bin_sum(spark, sf):
    return rounded(_ts(g.bin_sum(feed(spark, sf, "trades"), "foreignNotional", BIN)), "total")


_MID_BINS = book_ctes() + """,
b AS (SELECT symbol, date_trunc('hour',ts) AS h, arg_max(mid, seq) FILTER (mid IS NOT NULL) AS m FROM ticks GROUP BY 1,2),
g AS (""" + _GRID.format(src="b") + ")"


@query(
    "bin_last_mid",
    over_feeds("SELECT g.symbol, g.h AS ts, b.m AS mid FROM g LEFT JOIN b USING (symbol,h)", _MID_BINS),
)
def bin_last_mid(spark, sf):
    ticks = bk.book_ticks(bk.chunk_book(feed(spark, sf, "orderbook")), depth=0)
    return _ts(g.bin_last(ticks, "mid", BIN, order=("us",), name="mid"))


@query(
    "mid_on_grid",
    over_feeds(
        """SELECT g.symbol, g.h AS ts, last_value(b.m IGNORE NULLS) OVER (PARTITION BY g.symbol ORDER BY g.h) AS mid
           FROM g LEFT JOIN b USING (symbol,h)""",
        _MID_BINS,
    ),
)
def mid_on_grid(spark, sf):
    """The last mid of each bin, filled forward: the mid-price back-fill."""
    ticks = bk.book_ticks(bk.chunk_book(feed(spark, sf, "orderbook")), depth=0)
    return _ts(g.bin_last(ticks, "mid", BIN, order=("us",), name="mid", fill=True))


@query(
    "bin_asof",
    over_feeds(
        """SELECT g.symbol, g.h AS ts, i.openInterest AS oi FROM g ASOF LEFT JOIN instruments i
           ON g.symbol=i.symbol AND g.h>=i.ts""",
        "b AS (SELECT symbol, date_trunc('hour',ts) AS h FROM instruments), g AS (" + _GRID.format(src="b") + ")",
    ),
)
def bin_asof(spark, sf):
    return _ts(g.bin_asof(feed(spark, sf, "instruments"), "openInterest", BIN, name="oi"))


@query(
    "dense_grid",
    over_feeds(
        "SELECT symbol, h AS ts FROM g",
        "b AS (SELECT symbol, date_trunc('hour',ts) AS h FROM liquidations), g AS (" + _GRID.format(src="b") + ")",
    ),
)
def dense_grid(spark, sf):
    return _ts(g.dense_grid(feed(spark, sf, "liquidations"), BIN))


@query(
    "hourly_liquidations",
    over_feeds(
        """SELECT symbol, date_trunc('hour',ts) AS hour, CAST(sum(leavesQty) AS BIGINT) AS qty, count(*) AS liquidations
           FROM liquidations GROUP BY 1,2"""
    ),
)
def hourly_liquidations(spark, sf):
    return (
        feed(spark, sf, "liquidations")
        .groupBy("symbol", F.window("ts", "1 hour").start.alias("hour"))
        .agg(F.sum("leavesQty").alias("qty"), F.count(F.lit(1)).alias("liquidations"))
    )


_SEG = """
seg AS (SELECT date_trunc('day',ts) AS segment_start, CAST(count(*)%4 AS INT)-1 AS regime FROM trades
        WHERE extract(day FROM ts)%3<>1 GROUP BY 1)"""


def segment_labels(spark, sf):
    """Day segments with a label derived from the day's trades; every third day is missing."""
    return (
        feed(spark, sf, "trades")
        .where(F.dayofmonth("ts") % 3 != 1)
        .groupBy(F.window("ts", "1 day").start.alias("segment_start"))
        .agg((F.count(F.lit(1)) % 4 - 1).cast("int").alias("regime"))
    )


@query(
    "label_asof",
    over_feeds(
        """SELECT t.symbol, t.ts, t.seq, coalesce(s.regime, (SELECT arg_min(regime, segment_start) FROM seg)) AS regime
           FROM trades t ASOF LEFT JOIN seg s ON t.ts>=s.segment_start""",
        _SEG,
    ),
)
def label_asof(spark, sf):
    rows = feed(spark, sf, "trades").select("symbol", "ts", "seq")
    return g.asof_labels(rows, segment_labels(spark, sf))


_TH = """
over_ AS (SELECT DISTINCT symbol, 'f6' AS feature, 2.0::DOUBLE AS threshold FROM trades WHERE symbol='click'),
feat AS (SELECT * FROM (VALUES ('f0',15.0::DOUBLE),('f6',4.0),('f1',60.0),('f2',30.0),('f5',30.0)) v(feature,threshold)),
want AS (SELECT DISTINCT symbol, concat('f',CAST(seq%7 AS STRING)) AS feature FROM trades)"""


@query(
    "threshold_lookup",
    over_feeds(
        """SELECT w.symbol, w.feature, coalesce(o.threshold, f.threshold, 15.0::DOUBLE) AS threshold FROM want w
           LEFT JOIN over_ o USING (symbol,feature) LEFT JOIN feat f USING (feature)""",
        _TH,
    ),
)
def threshold_lookup(spark, sf):
    want = feed(spark, sf, "trades").select(
        "symbol", F.concat(F.lit("f"), (F.col("seq") % 7).cast("string")).alias("feature")
    ).distinct()
    return j.with_threshold(want, {("Multi-Level WAP", "click"): 2.0})


@query(
    "nearest_centroid",
    """WITH e AS (SELECT vec_id, label, unnest(generate_series(1,64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
        c AS (SELECT label, i, avg(v) AS m FROM e GROUP BY 1,2),
        x AS (SELECT e.vec_id, c.label, sum((e.v-c.m)**2) AS d FROM e JOIN c USING (i) GROUP BY 1,2)
       SELECT vec_id, arg_min(label, d) AS nearest, round(sqrt(min(d)),6) AS distance FROM x GROUP BY vec_id""",
)
def nearest_centroid(spark, sf):
    points = spark.read.parquet(f"{sf}/embeddings.parquet").select(
        "vec_id", "label", F.col("embedding").cast("array<double>").alias("x")
    )
    near = j.nearest_centroid(points, j.centroids(points, "label", "x"), "vec_id", "x", "label")
    return rounded(near.select("vec_id", "nearest", "distance"), "distance")


@query(
    "regime_params",
    over_feeds(
        """SELECT t.symbol, t.ts, t.seq, coalesce(s.regime, (SELECT arg_min(regime, segment_start) FROM seg)) AS r,
             CASE coalesce(s.regime, (SELECT arg_min(regime, segment_start) FROM seg))
               WHEN 0 THEN 1.0::DOUBLE WHEN 1 THEN 0.5 WHEN 2 THEN 0.25 END AS position_scale
           FROM trades t ASOF LEFT JOIN seg s ON t.ts>=s.segment_start""",
        _SEG,
    ),
)
def regime_params(spark, sf):
    """Strategy parameters by regime; a regime without parameters reads null."""
    labels = segment_labels(spark, sf).withColumnRenamed("regime", "r")
    rows = g.asof_labels(feed(spark, sf, "trades").select("symbol", "ts", "seq"), labels, label="r")
    params = {0: {"position_scale": 1.0}, 1: {"position_scale": 0.5}, 2: {"position_scale": 0.25}}
    return j.with_regime_params(rows, params, "r")
