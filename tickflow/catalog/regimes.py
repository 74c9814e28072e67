"""Segment, clustering and regime queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickflow.catalog.common import SYMBOLS, over_feeds, query, r6, rounded
from tickflow.catalog.features import FEATURE_CTES, features
from tickflow.operators import density as dn
from tickflow.operators import neighbours as nb
from tickflow.operators import regimes as rg
from tickflow.operators import segments as sg
from tickflow.plans import features as pf
from tickflow.plans import regimes as pr
from tickflow.schemas import CLUSTER_FEATURES

_SEGFEATURES = [f"f{i}" for i in CLUSTER_FEATURES]
_SEGCOLS = [f"{s}_{f}" for s in SYMBOLS for f in _SEGFEATURES]
_AGG = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


@query("segments", over_feeds(
    "SELECT segment_start, " + ", ".join(f"{r6(f'{fn}({c})')} AS {c}_{n}" for c in _SEGCOLS for n, fn in _AGG.items())
    + " FROM (SELECT date_trunc('day',ts) AS segment_start, ts, "
    + ", ".join(f"coalesce(max({c.split('_')[1]}) FILTER (symbol='{c.split('_')[0]}'),0) AS {c}" for c in _SEGCOLS)
    + " FROM ft GROUP BY ts) GROUP BY 1 HAVING count(*)>1", FEATURE_CTES))
def segments(spark, sf):
    wide = pf.widen(features(spark, sf), SYMBOLS, _SEGFEATURES)
    out = sg.segment_stats(wide, _SEGCOLS, "1 day")
    return rounded(out, *[c for c in out.columns if c != "segment_start"])


def _points(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    return df.select(F.col("vec_id").alias("id"), "label", F.col("embedding").cast("array<double>").alias("x"))


@query("knn_graph", """WITH e AS (SELECT vec_id, unnest(generate_series(1,len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
    p AS (SELECT a.vec_id AS id, b.vec_id AS neighbour, sqrt(sum((a.v-b.v)**2)) AS d FROM e a JOIN e b USING (i) WHERE a.vec_id<>b.vec_id GROUP BY 1,2)
    SELECT id, neighbour, round(d,6) AS distance, CAST(rank AS INT) AS rank FROM
      (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, neighbour) AS rank FROM p) WHERE rank<=15""")
def knn_graph(spark, sf):
    return rounded(nb.knn(_points(spark, sf), 15), "distance")


# The width of each point's neighbourhood by 64 bisections, then a + b - ab of both directions.
@query("fuzzy_graph", """WITH RECURSIVE e AS (SELECT vec_id, unnest(generate_series(1,len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings),
    p AS (SELECT a.vec_id AS id, b.vec_id AS n, sqrt(sum((a.v-b.v)**2)) AS d FROM e a JOIN e b USING (i) WHERE a.vec_id<>b.vec_id GROUP BY 1,2),
    k AS (SELECT id, n, d FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY d, n) AS rank FROM p) WHERE rank<=15),
    g AS (SELECT id, n, greatest(d-coalesce(min(CASE WHEN d>0 THEN d END) OVER (PARTITION BY id),0),0) AS gap FROM k),
    s(id, gaps, lo, hi, sigma, round) AS (
      SELECT id, list(gap), 0::DOUBLE, 'infinity'::DOUBLE, 1::DOUBLE, 0 FROM g GROUP BY id
      UNION ALL
      SELECT id, gaps, lo2, hi2, greatest(CASE WHEN isinf(hi2) THEN sigma*2 ELSE (lo2+hi2)/2 END, 1e-12), round+1 FROM (
        SELECT *, CASE WHEN total>log2(len(gaps)) THEN sigma ELSE hi END AS hi2, CASE WHEN total>log2(len(gaps)) THEN lo ELSE sigma END AS lo2
        FROM (SELECT *, list_sum(list_transform(gaps, lambda x: exp(-x/sigma))) AS total FROM s WHERE round<64))),
    w AS (SELECT g.id, g.n, exp(-gap/sigma) AS w FROM g JOIN s ON s.id=g.id AND s.round=64),
    b AS (SELECT id, n, w FROM w UNION ALL SELECT n, id, w FROM w)
    SELECT id, n AS neighbour, round(sum(w)-CASE WHEN count(*)=2 THEN min(w)*max(w) ELSE 0 END,6) AS weight FROM b GROUP BY 1,2""")
def fuzzy_graph(spark, sf):
    return rounded(nb.fuzzy_graph(nb.knn(_points(spark, sf), 15)), "weight")


@query("embed_2d")
def embed_2d(spark, sf):
    return dn.embed_2d(_points(spark, sf))


@query("embed_2d_spectral")
def embed_2d_spectral(spark, sf):
    return dn.embed_2d(_points(spark, sf), method="spectral", rounds=8)


@query("density_cluster")
def density_cluster(spark, sf):
    return dn.density_cluster(_points(spark, sf), min_cluster_size=15)


DIMENSIONS = 64
_COLS = [f"e{i}" for i in range(DIMENSIONS)]
_ALL = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS {c}" for i, c in enumerate(_COLS))


def _labelled(spark, sf):
    """Vectors with their label as regime; every tenth one is noise."""
    regime = F.when(F.col("vec_id") % 10 == 0, -1).otherwise(F.col("label"))
    return spark.read.parquet(f"{sf}/embeddings.parquet").select(
        "vec_id", regime.cast("int").alias("regime"),
        *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(_COLS)],
    )


_L = f"l AS (SELECT vec_id, CAST(CASE WHEN vec_id%10=0 THEN -1 ELSE label END AS INT) AS regime, {_ALL} FROM embeddings)"


@query("regime_centroids", "WITH " + _L + " SELECT regime, count(*) AS members, " + ", ".join(f"{r6(f'avg({c})')} AS {c}" for c in _COLS) + " FROM l WHERE regime<>-1 GROUP BY regime")
def regime_centroids(spark, sf):
    return rounded(rg.regime_centroids(_labelled(spark, sf), _COLS), *_COLS)


@query("merge_regimes")
def merge_regimes(spark, sf):
    return rg.merge_regimes(_labelled(spark, sf), _COLS, 3).select("vec_id", "regime")


# Small: fewer members than the average regime.
@query("merge_small", "WITH " + _L + """,
  n AS (SELECT regime, count(*) AS n, """ + ", ".join(f"avg(e{i}) AS c{i}" for i in range(DIMENSIONS)) + """ FROM l WHERE regime<>-1 GROUP BY 1),
  t AS (SELECT CAST(ceil(avg(n)) AS BIGINT) AS t FROM n),
  mv AS (SELECT a.regime, arg_min(b.regime, """ + "+".join(f"(a.c{i}-b.c{i})**2" for i in range(DIMENSIONS)) + """) AS r FROM n a, n b, t WHERE a.n<t AND b.n>=t GROUP BY 1)
  SELECT vec_id, coalesce(mv.r, l.regime) AS regime FROM l LEFT JOIN mv ON mv.regime=l.regime""")
def merge_small(spark, sf):
    df = _labelled(spark, sf)
    real = df.where(F.col("regime") != -1)
    least = real.groupBy("regime").count().agg(F.ceil(F.avg("count"))).first()[0]
    out = rg.merge_small(df.withColumn("y", F.array(*_COLS)), "y", least)
    return out.select("vec_id", "regime")


@query("regime_guards", "WITH " + _L + f""", n AS (SELECT regime, count(*) AS n FROM l GROUP BY 1)
  SELECT count(*) FILTER (regime<>-1) AS regimes, {r6("coalesce(sum(n) FILTER (regime=-1),0)/sum(n)")} AS noise_share,
    count(*) FILTER (regime<>-1 AND n<40) AS small_regimes, count(*) FILTER (regime<>-1)>20 AS too_many,
    coalesce(sum(n) FILTER (regime=-1),0)/sum(n)>0.05 AS too_noisy FROM n""")
def regime_guards(spark, sf):
    return rounded(rg.regime_guards(_labelled(spark, sf), max_noise=0.05, min_size=40), "noise_share")


@query("regimes_end_to_end")
def regimes_end_to_end(spark, sf):
    """Feature rows with their regime: hourly grid, segments of six hours."""
    _, rows = pr.discover(
        features(spark, sf), SYMBOLS, "6 hours", rank_window=48, rank_min=5, min_cluster_size=8, min_samples=4,
        neighbours=8,
    )
    return rows
