"""Outlier, sanitising and scaling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow.catalog.common import feed, over_feeds, query, r6, raw, rounded
from tickflow.operators import clean as c
from tickflow.operators import scaling as sc


def _clip(name, method, bounds, n):
    sql = over_feeds(
        f"""SELECT symbol, seq, {r6('greatest(lo, least(hi, foreignNotional))')} AS "foreignNotional" FROM trades JOIN b USING (symbol)""",
        bounds.format(n=n),
    )

    @query(name, sql)
    def clipped(spark, sf):
        df = feed(spark, sf, "trades").select("symbol", "seq", "foreignNotional")
        return rounded(c.clip_outliers(df, "foreignNotional", ["symbol"], method, n), "foreignNotional")


_clip("clip_mad", "mad", """m AS (SELECT symbol, median(foreignNotional) AS m FROM trades GROUP BY 1),
d AS (SELECT symbol, m, 1.4826*median(abs(foreignNotional-m)) AS d FROM trades JOIN m USING (symbol) GROUP BY 1,2),
b AS (SELECT symbol, m-{n}*d AS lo, m+{n}*d AS hi FROM d)""", 5)
_clip("clip_iqr", "iqr", """q AS (SELECT symbol, quantile_cont(foreignNotional,0.25) AS a, quantile_cont(foreignNotional,0.75) AS z FROM trades GROUP BY 1),
b AS (SELECT symbol, a-{n}*(z-a) AS lo, z+{n}*(z-a) AS hi FROM q)""", 5)
_clip("clip_std", "std", """b AS (SELECT symbol, avg(foreignNotional)-{n}*stddev_samp(foreignNotional) AS lo, avg(foreignNotional)+{n}*stddev_samp(foreignNotional) AS hi FROM trades GROUP BY 1)""", 5)

# Feature-like columns of every event: skewed values, a near-uniform one, a price with holes.
_T = {"f0": 4.0, "f1": 1.6, "f6": 3.0}
_OVER = {("f6", "click"): 2.0}
_FEATS = """
fe AS (SELECT event_id, symbol, ts, v AS f0, CAST(k AS DOUBLE) AS f1, CASE WHEN event_id%17=0 THEN -1 ELSE 1000+v END AS f6 FROM raw)"""


def _features(spark, sf):
    return raw(spark, sf).select(
        "event_id", "symbol", "ts", F.col("v").alias("f0"), F.col("k").cast("double").alias("f1"),
        F.when(F.col("event_id") % 17 == 0, -1.0).otherwise(1000 + F.col("v")).alias("f6"),
    )


def _zsql(src: str) -> str:
    """Five unrolled rounds over long rows (event_id, symbol, name, x)."""
    parts = [
        "z0 AS (" + " UNION ALL ".join(f"SELECT event_id, symbol, ts, '{n}' AS name, {n} AS x FROM {src}" for n in _T) + ")",
        "th AS (SELECT symbol, name, CASE WHEN symbol='click' AND name='f6' THEN 2.0 ELSE t END AS t FROM (SELECT DISTINCT symbol FROM z0), "
        "(VALUES " + ",".join(f"('{n}',{t}::DOUBLE)" for n, t in _T.items()) + ") v(name,t))",
    ]
    for i in range(1, 6):
        parts.append(
            f"z{i} AS (SELECT event_id, symbol, ts, name, CASE WHEN s>0 AND abs((x-m)/s)>t THEN NULL ELSE x END AS x FROM "
            f"(SELECT *, avg(x) OVER w AS m, stddev_samp(x) OVER w AS s FROM z{i - 1} WINDOW w AS (PARTITION BY symbol,name)) JOIN th USING (symbol,name))"
        )
    return ",\n".join(parts)


_WIDE = ", ".join(f"{r6(f'max(x) FILTER (name={chr(39)}{n}{chr(39)})')} AS {n}" for n in _T)


@query("zscore_clean", over_feeds(f"SELECT event_id, symbol, ts, {_WIDE} FROM z5 GROUP BY 1,2,3", _FEATS + "," + _zsql("fe")))
def zscore_clean(spark, sf):
    return rounded(c.zscore_clean(_features(spark, sf), _T, _OVER), *_T)


_SANE = """, sf AS (SELECT event_id, symbol, ts, f0, f1, CASE WHEN f6<=0 THEN coalesce(m,1.0) ELSE f6 END AS f6 FROM
   (SELECT *, median(CASE WHEN f6>0 THEN f6 END) OVER (PARTITION BY symbol) AS m FROM {src}))"""


@query("sanitize_features", over_feeds(f"SELECT event_id, symbol, ts, {', '.join(f'{r6(n)} AS {n}' for n in _T)} FROM sf", _FEATS + _SANE.format(src="fe")))
def sanitize_features(spark, sf):
    return rounded(c.sanitize_features(_features(spark, sf), list(_T)), *_T)


_LERP = """, ip AS (SELECT event_id, symbol, ts, name, CASE WHEN x IS NOT NULL THEN x WHEN an IS NULL THEN bv WHEN bn IS NULL THEN av ELSE av+(bv-av)*(n-an)/(bn-an) END AS x FROM
  (SELECT *, last_value(x IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS av,
     last_value(CASE WHEN x IS NOT NULL THEN n END IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS an,
     first_value(x IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bv,
     first_value(CASE WHEN x IS NOT NULL THEN n END IGNORE NULLS) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS bn
   FROM (SELECT *, row_number() OVER (PARTITION BY symbol,name ORDER BY ts) AS n FROM z5) WINDOW w AS (PARTITION BY symbol,name ORDER BY n)))"""


@query("sanitize", over_feeds(
    f"SELECT event_id, symbol, ts, {_WIDE} FROM ip GROUP BY 1,2,3",
    _FEATS + ", tr AS (SELECT * FROM fe WHERE ts>=(SELECT min(ts) FROM fe)+INTERVAL 60 MINUTE)" + _SANE.format(src="tr") + "," + _zsql("sf") + _LERP))
def sanitize(spark, sf):
    return rounded(c.sanitize(_features(spark, sf), list(_T), thresholds=_T, overrides=_OVER), *_T)


_DIMS = [f"e{i}" for i in range(64)]


def _vectors(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    return df.select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(_DIMS)])


_V = "v AS (SELECT vec_id, label, " + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS {c}" for i, c in enumerate(_DIMS)) + " FROM embeddings)"


@query("robust_scale", "WITH " + _V + " SELECT vec_id, " + ", ".join(
    f"{r6(f'({d}-(SELECT median({d}) FROM v))/(SELECT quantile_cont({d},0.75)-quantile_cont({d},0.25) FROM v)')} AS {d}" for d in _DIMS) + " FROM v")
def robust_scale(spark, sf):
    return rounded(sc.robust_scale(_vectors(spark, sf).drop("label"), _DIMS), *_DIMS)


@query("standard_scale", over_feeds(
    f"SELECT seq, ts, {r6('(foreignNotional-m)/s')} AS \"foreignNotional\", {r6('(price-pm)/ps')} AS price FROM trades, (SELECT avg(foreignNotional) AS m, stddev_pop(foreignNotional) AS s, avg(price) AS pm, stddev_pop(price) AS ps FROM trades WHERE ts<TIMESTAMP '2024-01-20')"))
def standard_scale(spark, sf):
    df = feed(spark, sf, "trades").select("seq", "ts", "foreignNotional", "price")
    train, _ = sc.time_split(df, F.lit("2024-01-20").cast("timestamp_ntz"))
    return rounded(sc.standard_scale(train, df, ["foreignNotional", "price"]), "foreignNotional", "price")


@query("time_split", over_feeds("SELECT seq, ts, CASE WHEN ts<TIMESTAMP '2024-01-20' THEN 'train' ELSE 'test' END AS part FROM trades"))
def time_split(spark, sf):
    df = feed(spark, sf, "trades").select("seq", "ts")
    train, test = sc.time_split(df, F.lit("2024-01-20").cast("timestamp_ntz"))
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
