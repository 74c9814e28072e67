"""The exact density hierarchy against a plain single-linkage tree."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickflow.operators import density as dn
from tickflow.operators import hierarchy as hi
from tickflow.operators import neighbours as nb


def plain_tree(x: np.ndarray, min_samples: int) -> list[tuple]:
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    core = np.sort(d, axis=1)[:, min(max(1, min_samples), len(x) - 1)]
    w = np.maximum(np.maximum(d, core), core[:, None])
    edges = sorted((w[i, j], i, j) for i in range(len(x)) for j in range(i + 1, len(x)))
    up = list(range(len(x)))

    def find(v):
        while up[v] != v:
            v = up[v]
        return v

    out = []
    for weight, i, j in edges:
        if find(i) != find(j):
            up[find(j)] = find(i)
            out.append((i, j, weight))
    return out


def plain_clusters(x: np.ndarray, least: int, min_samples: int) -> list[set]:
    """Top down over the single-linkage tree: groups are node sets, recursion instead of pointers."""
    made: dict[frozenset, tuple] = {}
    group = {i: frozenset([i]) for i in range(len(x))}
    for i, j, w in plain_tree(x, min_samples):
        both = group[i] | group[j]
        made[both] = (group[i], group[j], 1 / max(w, 1e-12))
        for v in both:
            group[v] = both
    whole = frozenset(range(len(x)))
    found = []

    def walk(top: frozenset, birth: float, root: bool) -> tuple[float, list]:
        mass, now = 0.0, top
        while True:
            if now not in made:
                return mass, []
            left, right, lam = made[now]
            if len(left) >= least and len(right) >= least:
                mass += len(now) * (lam - birth)
                parts = [(walk(side, lam, False), side) for side in (left, right)]
                inner = sum(best for (best, _), _ in parts)
                chosen = [c for (_, got), _ in parts for c in got]
                break
            big, bit = (left, right) if len(left) >= len(right) else (right, left)
            if len(big) < least:
                mass += len(now) * (lam - birth)
                inner, chosen = 0.0, []
                break
            mass += len(bit) * (lam - birth)
            now = big
        if not root and mass >= inner:
            return mass, [top]
        return inner, chosen

    if len(x) >= least:
        found = walk(whole, 0.0, True)[1]
    return [set(c) for c in found]


def blobs(seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    parts = [rng.normal(c, s, (n, 2)) for c, s, n in (((0, 0), 0.3, 70), ((5, 0), 0.5, 50), ((5.8, 1.2), 0.1, 30), ((0, 9), 1.0, 40))]
    return np.vstack([*parts, rng.uniform(-4, 12, (25, 2))])


def frame(spark, x: np.ndarray, parts: int):
    rows = [(i, [float(v) for v in p]) for i, p in enumerate(x)]
    return spark.createDataFrame(rows, "id long, x array<double>").repartition(parts)


@pytest.mark.parametrize(("make", "k"), [("random", 6), ("two far", 5)])
def test_spanning_tree(spark, make, k):
    rng = np.random.default_rng(4)
    x = {"random": rng.random((150, 2)), "two far": np.vstack([rng.random((60, 2)), rng.random((60, 2)) + 40])}[make]
    df = frame(spark, x, 3)
    near = nb.knn(df, k)
    got = hi.spanning_tree(df, near, 4, block=32).collect()
    assert sorted((r.a, r.b) for r in got) == sorted((i, j) for i, j, _ in plain_tree(x, 4))


@pytest.mark.parametrize(("thin", "block"), [(1, 1 << 20), (3, 45)])
def test_clusters(spark, thin, block):
    """In one block, and over two blocks."""
    x, least = blobs(1)[::thin], 15 // thin
    want = plain_clusters(x, least, 5)
    assert len(want) > 1
    label = {r.id: r.cluster for r in dn.density_cluster(frame(spark, x, 5), min_cluster_size=least, min_samples=5, neighbours=8, block=block).collect()}
    assert len(label) == len(x)
    got = [{i for i, c in label.items() if c == k} for k in set(label.values()) if k >= 0]
    assert sorted(map(sorted, got)) == sorted(map(sorted, want))
    sizes = [sum(c == k for c in label.values()) for k in range(len(got))]
    assert sizes == sorted(sizes, reverse=True)


def test_labels_do_not_depend_on_partitions(spark):
    x = np.round(blobs(3)[::4], 1)
    got = [
        sorted((r.id, r.cluster) for r in dn.density_cluster(frame(spark, x, n), min_cluster_size=4, min_samples=3, neighbours=4).collect())
        for n in (1, 20)
    ]
    assert got[0] == got[1]


def test_few_branches_reach_the_driver(spark):
    """Folding leaves round by round gives what the driver alone gives."""
    x = blobs(2)[::3]
    df = frame(spark, x, 2)
    members, branches = hi.condensed_tree(hi.spanning_tree(df, nb.knn(df, 6), 3), 3)
    assert branches.count() > 4
    one, two = (sorted(map(tuple, hi.clusters(members, branches, rest).collect())) for rest in (1000, 2))
    assert one == two


def test_small_inputs(spark):
    for n in (0, 1, 5):
        df = spark.range(n).select("id", F.array(F.col("id").cast("double"), F.lit(0.0)).alias("x"))
        assert [r.cluster for r in dn.density_cluster(df, min_cluster_size=3, min_samples=2, neighbours=3).collect()] == [-1] * n
    same = spark.range(12).select("id", F.array(F.lit(1.0)).alias("x"))
    assert dn.density_cluster(same, min_cluster_size=3, min_samples=2, neighbours=3).count() == 12
