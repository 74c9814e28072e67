"""Density clustering and embedding as distributed table operations.

Clusters come from the exact hierarchy of ``operators.hierarchy``.  No step gathers the points, the tree
edges or a cluster in one task.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.operators.hierarchy import EDGES, clusters, condensed_tree, spanning_tree
from tickflow.operators.neighbours import fuzzy_graph, knn
from tickflow.operators.ordered import ordered_index
from tickflow.schemas import MIN_CLUSTER_SIZE, MIN_SAMPLES, N_NEIGHBORS
from tickflow.session import cut


def connected_components(edges: DataFrame, nodes: DataFrame, node: str = "node") -> DataFrame:
    """(node, component): smallest node reachable.  ``edges`` has columns a, b.

    Each round takes the smallest label among the neighbours and then jumps to the label's own
    label, which halves long chains.
    """
    both = cut(
        edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = cut(nodes.select(F.col(node).alias("node"), F.col(node).alias("component")))
    while True:
        offered = both.join(labels, both["a"] == labels["node"]).groupBy(F.col("b").alias("node")).agg(
            F.min("component").alias("o")
        )
        least = labels.join(offered, "node", "left").select(
            "node", "component", F.least("component", "o").alias("next")
        )
        target = labels.select(F.col("node").alias("next"), F.col("component").alias("jump"))
        moved = cut(
            least.join(target, "next", "left").select(
                "node", F.col("component").alias("old"), F.least("next", "jump").alias("component")
            )
        )
        labels = moved.select("node", "component")
        if moved.where(F.col("old") != F.col("component")).limit(1).count() == 0:
            return labels


def density_cluster(
    points: DataFrame, id_col: str = "id", x: str = "x", min_cluster_size: int = MIN_CLUSTER_SIZE,
    min_samples: int = MIN_SAMPLES, neighbours: int = N_NEIGHBORS, graph: DataFrame | None = None,
    block: int = EDGES,
) -> DataFrame:
    """(id, cluster): density clusters numbered by size, -1 for noise.

    Clusters are the branches of the exact condensed tree with the largest excess of mass; the root,
    which holds everything, is not a cluster.  Ties go by id.  ``graph`` may hand in neighbour lists of
    at least ``min_samples`` entries.
    """
    pts = points.select(F.col(id_col).alias("id"), F.col(x).alias("x"))
    graph = knn(pts, max(neighbours, min_samples)) if graph is None else graph
    # Whole numbers in the order of the ids stand for them.
    index = cut(ordered_index(pts, ["id"], name="i"))
    name = index.select("id", "i")
    near = (
        graph.join(name, "id").join(name.select(F.col("id").alias("neighbour"), F.col("i").alias("j")), "neighbour")
        .select(F.col("i").alias("id"), F.col("j").alias("neighbour"), "distance", "rank")
    )
    tree = spanning_tree(index.select(F.col("i").alias("id"), "x"), cut(near), min_samples)
    members, branches = condensed_tree(tree, min_cluster_size, block)
    label = cut(clusters(members, branches))
    named = number_by_size(label.groupBy("r", "s").agg(F.count(F.lit(1)).alias("n")), ["r", "s"])
    found = label.join(named, ["r", "s"]).select(F.col("id").alias("i"), "cluster")
    return index.join(found, "i", "left").select("id", F.coalesce("cluster", F.lit(-1)).alias("cluster"))


def number_by_size(sizes: DataFrame, keys: list[str], name: str = "cluster") -> DataFrame:
    """Number clusters 0.. by size, largest first, then by key; one row per cluster goes in."""
    return ordered_index(sizes.withColumn("_neg", -F.col("n")), ["_neg", *keys], name=name).select(
        *keys, F.col(name).cast("int").alias(name)
    )


def embed_pca(points: DataFrame, id_col: str = "id", x: str = "x", k: int = 2) -> DataFrame:
    """(id, y): the first k principal components; the largest loading of each is positive."""
    vec = points.select(F.col(id_col).alias("id"), array_to_vector(F.col(x).cast("array<double>")).alias("v"))
    model = PCA(k=k, inputCol="v", outputCol="y").fit(vec)
    load = model.pc.toArray()
    sign = np.sign(load[np.abs(load).argmax(axis=0), np.arange(k)])
    flip = F.array(*[F.lit(float(s or 1.0)) for s in sign])
    out = model.transform(vec).select("id", vector_to_array("y").alias("y"))
    return out.select("id", F.zip_with("y", flip, lambda a, s: a * s).alias("y"))


def embed_spectral(graph: DataFrame, rounds: int = 10, k: int = 2, steps: int = 4) -> DataFrame:
    """(id, y): leading non-trivial vectors of the normalised graph by power iteration.

    A step is a join of the edges with the current vectors and a sum per point; a round is a few
    steps and an orthonormalisation from k x k global sums.
    """
    degree = graph.groupBy("id").agg(F.sum("weight").alias("deg"))
    edges = cut(
        graph.join(degree, "id")
        .join(degree.select(F.col("id").alias("neighbour"), F.col("deg").alias("deg2")), "neighbour")
        .select("id", "neighbour", (F.col("weight") / F.sqrt(F.col("deg") * F.col("deg2"))).alias("w"))
    )
    seed = [(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(10_007)) / 10_007.0 - 0.5).alias(f"y{i}") for i in range(k)]
    state = cut(degree.select("id", F.sqrt("deg").alias("t"), *seed))
    names = [f"y{i}" for i in range(k)]
    for _ in range(rounds):
        moved = state
        for _ in range(steps):
            there = moved.select(F.col("id").alias("neighbour"), *names)
            spread = edges.join(there, "neighbour").groupBy("id").agg(
                *[F.sum(F.col("w") * F.col(y)).alias(f"s_{y}") for y in names]
            )
            # (I + A)/2 has no negative eigenvalues, so the iteration cannot oscillate.
            moved = moved.join(spread, "id").select(
                "id", "t", *[((F.col(y) + F.col(f"s_{y}")) / 2).alias(y) for y in names]
            )
        moved = cut(moved)
        cols = ["t", *[f"y{i}" for i in range(k)]]
        gram = moved.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"{a}_{b}") for a in cols for b in cols]).first()
        g = np.array([[gram[f"{a}_{b}"] for b in cols] for a in cols], dtype=float)
        # Gram-Schmidt on the Gram matrix: coefficients of each new vector in the old ones.
        basis: list[np.ndarray] = []
        for j in range(len(cols)):
            v = np.eye(len(cols))[j]
            for u in basis:
                v = v - (u @ g @ v) * u
            norm = float(np.sqrt(max(v @ g @ v, 1e-300)))
            basis.append(v / norm)
        out = []
        for i in range(k):
            expr = F.lit(0.0)
            for c, name in zip(basis[i + 1], cols):
                expr = expr + F.col(name) * float(c)
            out.append(expr.alias(f"y{i}"))
        state = cut(moved.select("id", "t", *out))
    return state.select("id", F.array(*[F.col(f"y{i}") / F.col("t") for i in range(k)]).alias("y"))


def embed_2d(
    points: DataFrame, id_col: str = "id", x: str = "x", method: str = "pca", neighbours: int = N_NEIGHBORS,
    rounds: int = 10,
) -> DataFrame:
    """Two-dimensional embedding, by principal components or by the neighbour graph's spectrum."""
    if method == "pca":
        return embed_pca(points, id_col, x)
    if method == "spectral":
        return embed_spectral(fuzzy_graph(knn(points, neighbours, id_col, x)), rounds)
    raise ValueError(f"unknown method {method!r}")
