"""Regime labels: hierarchical merge, small-regime merge, guards."""

from __future__ import annotations

import logging
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.operators.joins import centroids, lookup, nearest_centroid
from tickflow.schemas import MAX_NOISE, MAX_REGIMES, MIN_REGIME_SIZE, TARGET_REGIMES

log = logging.getLogger("tickflow")


def regime_centroids(segments: DataFrame, cols: Sequence[str], regime: str = "regime") -> DataFrame:
    """(regime, members, mean of each column), noise left out."""
    return segments.where(F.col(regime) != -1).groupBy(regime).agg(
        F.count(F.lit(1)).alias("members"), *[F.avg(c).alias(c) for c in cols]
    )


def ward_groups(x: np.ndarray, target: int) -> list[int]:
    """Group number of each centroid after Ward merging down to ``target`` groups.

    Merges are found along chains of nearest neighbours, which need no matrix of distances, and
    applied by cost: Ward costs never fall on the way up, so these are the cheapest merges.
    """
    n = len(x)
    mean, size = np.array(x, dtype=float), np.ones(n)
    active = np.ones(n, bool)
    merges: list[tuple[float, int, int]] = []
    chain: list[int] = []
    for _ in range(n - 1):
        chain = chain or [int(active.argmax())]
        while True:
            a = chain[-1]
            cost = ((mean - mean[a]) ** 2).sum(axis=1) * size * size[a] / (size + size[a])
            cost[~active] = np.inf
            cost[a] = np.inf
            b = int(cost.argmin())
            if len(chain) > 1 and cost[chain[-2]] <= cost[b]:
                b = chain[-2]
                break
            chain.append(b)
        del chain[-2:]
        low, high = min(a, b), max(a, b)
        merges.append((float(cost[b]), low, high))
        mean[low] = (mean[low] * size[low] + mean[high] * size[high]) / (size[low] + size[high])
        size[low] += size[high]
        active[high] = False
    group = list(range(n))

    def top(i: int) -> int:
        while group[i] != i:
            i = group[i]
        return i

    for _, low, high in sorted(merges, key=lambda m: m[0])[: max(0, n - target)]:
        a, b = top(low), top(high)
        group[max(a, b)] = min(a, b)
    tops = [top(i) for i in range(n)]
    number = {t: i for i, t in enumerate(sorted(set(tops)))}
    return [number[t] for t in tops]


def merge_regimes(
    segments: DataFrame, cols: Sequence[str], target: int = TARGET_REGIMES, regime: str = "regime"
) -> DataFrame:
    """Merge clusters down to ``target`` by Ward linkage of their centroids in segment space.

    Regimes are renumbered by size, largest first.  Few enough clusters stay as they are.
    """
    table = regime_centroids(segments, cols, regime)
    rows = table.collect()  # one row for each cluster
    if len(rows) <= target:
        return segments
    rows = sorted(rows, key=lambda r: r[regime])
    group = ward_groups(np.array([[r[c] for c in cols] for r in rows], dtype=float), target)
    members: dict[int, int] = {}
    for g, r in zip(group, rows):
        members[g] = members.get(g, 0) + r["members"]
    order = {g: i for i, g in enumerate(sorted(members, key=lambda g: (-members[g], g)))}
    new = lookup({r[regime]: order[g] for g, r in zip(group, rows)}, F.col(regime), "map<int,int>")
    return segments.withColumn(regime, F.coalesce(new, F.lit(-1)))


def merge_small(
    points: DataFrame, x: str = "y", min_size: int = MIN_REGIME_SIZE, regime: str = "regime"
) -> DataFrame:
    """Give regimes below ``min_size`` the nearest larger regime's number (centroids of ``x``).

    With no larger regime nothing changes; noise stays noise.
    """
    table = centroids(points.where(F.col(regime) != -1), regime, x)
    large = table.where(F.col("members") >= min_size)
    if large.limit(1).count() == 0:
        return points
    small = table.where(F.col("members") < min_size).select(F.col(regime).alias("_old"), "centroid")
    target = nearest_centroid(small, large, "_old", "centroid", regime).select("_old", F.col("nearest").alias("_new"))
    return points.join(target, F.col(regime) == F.col("_old"), "left").withColumn(
        regime, F.coalesce("_new", regime)
    ).drop("_old", "_new")


def regime_guards(
    labels: DataFrame, max_regimes: int = MAX_REGIMES, max_noise: float = MAX_NOISE,
    min_size: int = MIN_REGIME_SIZE, regime: str = "regime",
) -> DataFrame:
    """One row: regimes, noise share, small regimes, and whether each guard holds."""
    counts = labels.groupBy(regime).agg(F.count(F.lit(1)).alias("n"))
    real = F.col(regime) != -1
    out = counts.agg(
        F.count(F.when(real, 1)).alias("regimes"),
        (F.coalesce(F.sum(F.when(~real, F.col("n"))), F.lit(0)) / F.sum("n")).alias("noise_share"),
        F.count(F.when(real & (F.col("n") < min_size), 1)).alias("small_regimes"),
    )
    return out.withColumns(
        {
            "too_many": F.col("regimes") > max_regimes,
            "too_noisy": F.col("noise_share") > max_noise,
        }
    )


def check_guards(labels: DataFrame, **limits) -> DataFrame:
    """Raise when there are too many regimes; warn of much noise and of small regimes."""
    row = regime_guards(labels, **limits).first()
    if row["too_many"]:
        raise ValueError(f"too many regimes: {row['regimes']}")
    if row["too_noisy"]:
        log.warning("%.0f %% of the segments are noise", 100 * row["noise_share"])
    if row["small_regimes"]:
        log.warning("%d regimes are small", row["small_regimes"])
    return labels
