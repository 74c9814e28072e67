"""Scaling with statistics that match the usual definitions exactly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.operators.quantiles import wide_quantiles


def robust_scale(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - median) / (q75 - q25) from exact quantiles; a zero range divides by 1."""
    q = wide_quantiles(df, [], cols, {"a": 0.25, "m": 0.5, "b": 0.75})
    width = F.col("b") - F.col("a")
    entry = F.struct(F.col("m"), F.when(width > 0, width).otherwise(1.0).alias("w"))
    # One map of len(cols) entries, read as a scalar by the projection.
    stats = q.agg(F.map_from_entries(F.collect_list(F.struct("name", entry))).alias("s")).scalar()
    placed = df.withColumn("_s", stats)
    return placed.withColumns(
        {c: (F.col(c) - F.col("_s")[c]["m"]) / F.col("_s")[c]["w"] for c in cols}
    ).drop("_s")


def time_split(df: DataFrame, at: Column, ts: str = "ts") -> tuple[DataFrame, DataFrame]:
    """Rows before the split time, rows from it on."""
    return df.where(F.col(ts) < at), df.where(F.col(ts) >= at)


def standard_scale(train: DataFrame, df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(x - mean) / population std, both taken from the training rows only."""
    stats = train.agg(
        F.struct(
            *[F.avg(c).alias(c + "_m") for c in cols],
            *[F.stddev_pop(c).alias(c + "_s") for c in cols],
        ).alias("s")
    ).scalar()
    placed = df.withColumn("_s", stats)

    def scaled(c):
        std = F.col("_s")[c + "_s"]
        return (F.col(c) - F.col("_s")[c + "_m"]) / F.when(std > 0, std).otherwise(1.0)

    return placed.withColumns({c: scaled(c) for c in cols}).drop("_s")
