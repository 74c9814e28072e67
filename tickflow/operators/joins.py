"""Lookups: constants, thresholds, parameters, nearest centroid."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.schemas import FEATURES, Z_DEFAULT, Z_FEATURE, Z_FEATURE_SYMBOL
from tickflow.session import cut

BROADCAST_ROWS = 100_000


def bounded_join(df: DataFrame, small: DataFrame, on, how: str = "inner", written: bool = False, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a summary table (a row per key).  It is computed once and counted: up to
    ``rows`` rows it is broadcast, so the big side is not shuffled by a possibly hot
    key; beyond, it is an ordinary shuffle join."""
    small = small if written else cut(small)
    few = small.limit(rows + 1).count() <= rows
    return df.join(F.broadcast(small) if few else small, on, how)


def literal_map(pairs: Mapping[Any, Any], kind: str) -> Column:
    flat = [F.lit(v) for kv in pairs.items() for v in kv]
    return F.create_map(*flat) if flat else F.create_map().cast(kind)


def lookup(pairs: Mapping[Any, Any], key: Column, kind: str = "map<string,double>") -> Column:
    """Value of a small constant map, null where absent."""
    return F.try_element_at(literal_map(pairs, kind), key)


def threshold(
    symbol: Column, feature: Column,
    overrides: Mapping[tuple[str, str], float] = Z_FEATURE_SYMBOL,
    features: Mapping[str, float] = Z_FEATURE, default: float = Z_DEFAULT,
) -> Column:
    """(feature, symbol) override, else the feature's threshold, else the default."""
    ids = {name: f"f{i}" for i, name in FEATURES.items()}
    special = {f"{ids[f]}|{s}": v for (f, s), v in overrides.items()}
    plain = {ids[f]: v for f, v in features.items()}
    return F.coalesce(
        lookup(special, F.concat_ws("|", feature, symbol)), lookup(plain, feature), F.lit(default)
    )


def with_threshold(df: DataFrame, overrides=Z_FEATURE_SYMBOL) -> DataFrame:
    return df.withColumn("threshold", threshold(F.col("symbol"), F.col("feature"), overrides))


def with_regime_params(
    df: DataFrame, params: Mapping[int, Mapping[str, float]], regime: str = "regime"
) -> DataFrame:
    """Add one column per strategy parameter of the row's regime."""
    names = sorted({n for p in params.values() for n in p})
    return df.withColumns(
        {
            n: lookup({r: p[n] for r, p in params.items() if n in p}, F.col(regime), "map<int,double>")
            for n in names
        }
    )


def centroids(points: DataFrame, label: str, x: str) -> DataFrame:
    """Mean vector per label, element by element."""
    parts = points.select(label, F.posexplode(x).alias("_i", "_v"))
    means = parts.groupBy(label, "_i").agg(F.avg("_v").alias("_m"), F.count(F.lit(1)).alias("_n"))
    return means.groupBy(label).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_i", "_m"))), lambda e: e["_m"]).alias("centroid"),
        F.max("_n").alias("members"),
    )


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(
        F.aggregate(
            F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, d: acc + d
        )
    )


def nearest_centroid(
    points: DataFrame, centers: DataFrame, id_col: str, x: str, label: str,
    block: int = 10_000,
) -> DataFrame:
    """Closest centre per point (smallest label on ties), with its distance.

    Centres travel to the points as arrays of about ``block`` each; more centres make more arrays,
    compared one after the other in the same pass over the points.
    """
    blocks = max(1, -(-centers.count() // block))
    placed, bests = points, []
    for i in range(blocks):
        own = centers if blocks == 1 else centers.where(F.pmod(F.xxhash64(label), F.lit(blocks)) == i)
        table = own.agg(F.array_sort(F.collect_list(F.struct(F.col(label).alias("label"), F.col("centroid")))))
        placed = placed.withColumn(f"_c{i}", table.scalar())
        bests.append(
            F.array_min(
                F.transform(
                    F.col(f"_c{i}"),
                    lambda c: F.struct(distance(F.col(x), c["centroid"]).alias("d"), c["label"].alias("l")),
                )
            )
        )
    best = bests[0] if blocks == 1 else F.least(*bests)
    return placed.withColumn("_b", best).select(
        *points.columns, F.col("_b.l").alias("nearest"), F.col("_b.d").alias("distance")
    )
