"""Exact quantiles that do not gather a group in one task.

The built-in ``percentile`` keeps every distinct value of a group in one aggregation buffer.
Here equal values are first folded to counts, the (key, column, value) order is cut in even
chunks, and only the values standing at the wanted positions are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickflow.functions.guards import finite
from tickflow.operators.ordered import range_chunks


def unpivot_values(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """(keys, name, value) rows, finite values only."""
    pairs = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in cols]
    )
    long = df.select(*keys, F.explode(pairs).alias("_p")).select(*keys, "_p.*")
    return long.where(finite("value").isNotNull())


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], probs: Sequence[float]
) -> DataFrame:
    """(keys, name, prob, value): linear-interpolated quantiles of the finite values."""
    group = [*keys, "name"]
    counts = unpivot_values(df, keys, cols).groupBy(*group, "value").agg(
        F.count(F.lit(1)).alias("_c")
    )
    placed = range_chunks(counts, group, ["value"], name="_chunk")
    ends = placed.groupBy(*group, "_chunk").agg(F.sum("_c").alias("_c"))
    w = Window.partitionBy(*group)
    base = ends.select(
        *group, "_chunk",
        F.coalesce(
            F.sum("_c").over(w.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ).alias("_base"),
        F.sum("_c").over(w).alias("_n"),
    )
    inside = Window.partitionBy(*group, "_chunk").orderBy("value").rowsBetween(
        Window.unboundedPreceding, 0
    )
    ranked = (
        placed.withColumn("_hi", F.sum("_c").over(inside))
        .join(base, [*group, "_chunk"])
        .withColumn("_hi", F.col("_hi") + F.col("_base"))
        .withColumn("_lo", F.col("_hi") - F.col("_c"))
    )
    want = F.array(*[F.lit(float(p)) for p in probs])
    at = ranked.withColumn("prob", F.explode(want)).withColumn(
        "_p", F.col("prob") * (F.col("_n") - 1)
    )

    def stands(p):
        return (F.col("_lo") <= p) & (p < F.col("_hi"))

    low, high = F.floor("_p"), F.ceil("_p")
    hit = at.where(stands(low) | stands(high))
    picked = hit.groupBy(*group, "prob").agg(
        F.max(F.when(stands(low), F.col("value"))).alias("_a"),
        F.max(F.when(stands(high), F.col("value"))).alias("_b"),
        F.max(F.col("_p") - low).alias("_f"),
    )
    return picked.select(
        *group, "prob", (F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_f")).alias("value")
    )


def wide_quantiles(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], probs: dict[str, float]
) -> DataFrame:
    """(keys, name, one column per named quantile)."""
    long = exact_quantiles(df, keys, cols, list(probs.values()))
    return long.groupBy(*keys, "name").agg(
        *[
            F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("value"))).alias(label)
            for label, p in probs.items()
        ]
    )
