"""Regime discovery plan: features -> segments -> embedding -> clusters -> labelled rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.operators.clean import sanitize
from tickflow.operators.density import density_cluster, embed_2d
from tickflow.operators.grid import asof_labels
from tickflow.operators.ordered import rolling_rank
from tickflow.operators.regimes import check_guards, merge_regimes, merge_small
from tickflow.operators.scaling import robust_scale
from tickflow.operators.segments import STATS
from tickflow.plans.features import FEATURE_COLS
from tickflow.schemas import (
    CLUSTER_FEATURES, MIN_CLUSTER_SIZE, MIN_SAMPLES, N_NEIGHBORS, RANK_MIN, RANK_WINDOW, SEGMENT,
    TARGET_REGIMES,
)
from tickflow.session import cut


def segment_table(
    features: DataFrame, symbols: Sequence[str], interval: str = SEGMENT, rank: str = "f6_rank"
) -> DataFrame:
    """(segment_start, {symbol}_{feature}_{stat}): aggregated long, then laid out wide.

    Segments with any value missing (a symbol without rows, a single row) drop out.
    """
    cols = [rank if f"f{i}" == "f6" else f"f{i}" for i in CLUSTER_FEATURES]
    long = features.groupBy(F.window("ts", interval).start.alias("segment_start"), "symbol").agg(
        *[fn(c).alias(f"{c[:2]}_{name}") for c in cols for name, fn in STATS.items()]
    )
    names = [c for c in long.columns if c not in ("segment_start", "symbol")]
    wide = long.groupBy("segment_start").agg(
        *[
            F.max(F.when(F.col("symbol") == s, F.col(n))).alias(f"{s}_{n}")
            for s in symbols for n in names
        ]
    )
    return wide.na.drop()


def discover(
    features: DataFrame, symbols: Sequence[str], interval: str = SEGMENT,
    rank_window: int = RANK_WINDOW, rank_min: int = RANK_MIN, warmup: str = "60 minutes",
    target: int = TARGET_REGIMES, min_cluster_size: int = MIN_CLUSTER_SIZE,
    min_samples: int = MIN_SAMPLES, neighbours: int = N_NEIGHBORS, method: str = "pca",
) -> tuple[DataFrame, DataFrame]:
    """(segments with regime and embedding, feature rows with regime)."""
    clean = cut(sanitize(features, FEATURE_COLS, warmup))
    ranked = rolling_rank(clean, ["f6"], ["symbol"], ["ts"], rank_window, rank_min).where(
        F.col("f6_rank").isNotNull()
    )
    table = cut(segment_table(ranked, symbols, interval))
    cols = [c for c in table.columns if c != "segment_start"]
    scaled = robust_scale(table, cols).select("segment_start", F.array(*cols).alias("x"))
    points = cut(embed_2d(scaled, "segment_start", "x", method, neighbours))
    clusters = density_cluster(
        points, "id", "y", min_cluster_size, min_samples, neighbours
    ).select(F.col("id").alias("segment_start"), F.col("cluster").alias("regime"))
    labelled = cut(
        table.join(points.withColumnRenamed("id", "segment_start"), "segment_start").join(clusters, "segment_start")
    )
    merged = check_guards(merge_regimes(labelled, cols, target))
    segments = cut(merge_small(merged, "y"))
    rows = asof_labels(clean, segments.select("segment_start", "regime"))
    return segments, rows
