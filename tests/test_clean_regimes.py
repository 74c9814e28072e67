"""Cleaning, scaling, neighbours and clustering against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickflow.operators import clean as c
from tickflow.operators import density as dn
from tickflow.operators import neighbours as nb
from tickflow.operators import quantiles as q
from tickflow.operators import regimes as rg
from tickflow.operators import reports as rp
from tickflow.operators import scaling as sc


def one(spark, values):
    return spark.createDataFrame([("X", float(v)) for v in values], "symbol string, v double")


def test_mad_clip(spark):
    got = [r["v"] for r in c.clip_outliers(one(spark, [1, 2, 3, 4, 100]), "v").orderBy("v").collect()]
    assert got == pytest.approx([1, 2, 3, 4, 10.413])


def test_robust_scale(spark):
    df = spark.createDataFrame([(float(v), 5.0) for v in (1, 2, 3, 10)], "a double, b double")
    rows = sc.robust_scale(df, ["a", "b"]).orderBy("a").collect()
    assert [r["a"] for r in rows] == pytest.approx([-1 / 2, -1 / 6, 1 / 6, 5 / 2])
    assert [r["b"] for r in rows] == [0, 0, 0, 0]


def test_skew(spark):
    df = one(spark, [1, 2, 3, 10])
    assert rp.profile(df, ["v"], ["symbol"]).first()["skew"] == pytest.approx(1.763632614803888)


def test_quantiles_with_a_hot_value(spark):
    rnd = random.Random(1)
    data = [("h", 7.0)] * 400 + [("h", rnd.uniform(0, 20)) for _ in range(301)] + [("t", 1.0), ("t", 2.0)]
    df = spark.createDataFrame(data, "k string, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = {(r["k"], r["prob"]): r["value"] for r in q.exact_quantiles(df, ["k"], ["v"], probs).collect()}
    for k in ("h", "t"):
        want = np.quantile([v for kk, v in data if kk == k], probs)
        assert [got[k, p] for p in probs] == pytest.approx(list(want))


def brute(points, k):
    ids = sorted(points)
    x = np.array([points[i] for i in ids])
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = {}
    for a, i in enumerate(ids):
        out[i] = [(round(dd, 9), j) for dd, j in sorted((d[a, b], j) for b, j in enumerate(ids) if j != i)[:k]]
    return out


@pytest.mark.parametrize("block", [16, 2048])
def test_knn_is_exact_with_copies(spark, block):
    rnd = random.Random(block)
    pts = {i: [rnd.gauss(i % 3 * 8, 1), rnd.gauss(0, 1)] for i in range(200)}
    for i in range(200, 300):
        pts[i] = [1.5, 1.5]
    df = spark.createDataFrame([(i, v) for i, v in pts.items()], "id long, x array<double>")
    got = {}
    for r in nb.knn(df, 6, block=block).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append((round(r["distance"], 9), r["neighbour"]))
    assert got == brute(pts, 6)


def blobs(spark, n=60):
    rng = np.random.default_rng(0)
    rows, truth = [], {}
    for b, center in enumerate([(0, 0), (30, 0), (0, 30)]):
        for p in rng.normal(center, 1.0, (n - 10 * b, 2)):
            truth[len(rows)] = b
            rows.append((len(rows), [float(v) for v in p]))
    for p in ([200.0, 200.0], [-150.0, 90.0]):
        truth[len(rows)] = -1
        rows.append((len(rows), p))
    return spark.createDataFrame(rows, "id long, x array<double>"), truth


def test_density_finds_blobs(spark):
    df, truth = blobs(spark)
    got = {r["id"]: r["cluster"] for r in dn.density_cluster(df, min_cluster_size=15, min_samples=5).collect()}
    assert set(got) == set(truth)
    for b in range(3):
        labels = [got[i] for i in truth if truth[i] == b]
        # Numbered by size, so the largest blob is 0; the fringe of a blob may be noise.
        assert labels.count(b) >= 0.8 * len(labels)
        assert set(labels) <= {b, -1}
    assert all(got[i] == -1 for i in truth if truth[i] == -1)


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (103, 101)]
    nodes = list(range(41)) + [100, 101, 103, 200]
    got = dn.connected_components(
        spark.createDataFrame(edges, "a long, b long"), spark.createDataFrame([(n,) for n in nodes], "node long")
    )
    comp = {r["node"]: r["component"] for r in got.collect()}
    assert all(comp[i] == 0 for i in range(41))
    assert comp[103] == comp[100] == 100 and comp[200] == 200


def test_spectral_separates_blobs(spark):
    df, truth = blobs(spark, 40)
    real = df.where(F.col("id").isin([i for i, b in truth.items() if b in (0, 1)]))
    got = {r["id"]: r["y"] for r in dn.embed_2d(real, method="spectral", neighbours=8, rounds=10).collect()}
    means = [np.mean([got[i] for i in got if truth[i] == b], axis=0) for b in (0, 1)]
    near = {i: int(np.argmin([np.linalg.norm(np.array(y) - m) for m in means])) for i, y in got.items()}
    assert np.mean([near[i] == truth[i] for i in got]) > 0.9


def test_ward_and_merge(spark):
    assert rg.ward_groups(np.array([[0.0], [0.1], [5.0], [5.2], [20.0]]), 3) == [0, 0, 1, 1, 2]
    rows = [(i, r, v) for i, (r, v) in enumerate([(0, 0.0)] * 5 + [(1, 0.1)] * 3 + [(2, 9.0)] * 9 + [(-1, 4.0)] * 2)]
    df = spark.createDataFrame(rows, "i long, regime int, v double")
    got = {r["i"]: r["regime"] for r in rg.merge_regimes(df, ["v"], 2).collect()}
    assert [got[i] for i in range(19)] == [1] * 8 + [0] * 9 + [-1] * 2


def test_merge_small(spark):
    rows = [(0, [0.0, 0.0])] * 6 + [(1, [0.5, 0.0])] * 2 + [(2, [9.0, 9.0])] * 6 + [(-1, [9.0, 9.0])]
    df = spark.createDataFrame(rows, "regime int, y array<double>")
    got = sorted(r["regime"] for r in rg.merge_small(df, "y", 5).collect())
    assert got == [-1] + [0] * 8 + [2] * 6
    alone = spark.createDataFrame([(0, [0.0])], "regime int, y array<double>")
    assert rg.merge_small(alone, "y", 5).collect()[0]["regime"] == 0


def test_guards(spark):
    labels = spark.createDataFrame([(i,) for i in range(25)], "regime int")
    with pytest.raises(ValueError):
        rg.check_guards(labels)


def test_fuzzy_is_symmetric(spark):
    df, _ = blobs(spark, 30)
    w = {(r["id"], r["neighbour"]): r["weight"] for r in nb.fuzzy_graph(nb.knn(df, 5)).collect()}
    assert all(w[b, a] == pytest.approx(v) and 0 < v <= 1 + 1e-9 for (a, b), v in w.items())


def test_zscore_rounds(spark):
    rnd = np.random.default_rng(3)
    v = np.concatenate([rnd.normal(0, 1, 500), [12.0, 14.0, 500.0]])
    df = spark.createDataFrame([("X", i, float(x)) for i, x in enumerate(v)], "symbol string, i long, f1 double")
    x = v.copy()
    for _ in range(5):
        z = np.abs((x - np.nanmean(x)) / np.nanstd(x, ddof=1))
        x = np.where(z > 4, np.nan, x)
    got = [r["f1"] for r in c.zscore_clean(df, {"f1": 4.0}, {}).orderBy("i").collect()]
    assert [g is None for g in got] == list(np.isnan(x))
