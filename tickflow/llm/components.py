"""Connected components of an edge table, by alternating star contractions (all joins, no collect)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.llm.frames import stage


def _toward_smallest(edges: DataFrame, both: bool) -> DataFrame:
    """One star step over rows (u, v), u > v.

    ``both``: every node hangs its larger neighbours on the smallest of all its neighbours and itself;
    otherwise it hangs itself and its smaller neighbours there.  The minimum is aggregated before the
    shuffle, and the join back may be split, so a star of any size is dealt over tasks.
    """
    if both:
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        out = around.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        low = edges.groupBy("u").agg(F.min("v").alias("low"))
        hung = edges.join(low, "u")
        out = hung.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
            low.select("u", F.col("low").alias("v"))
        )
    return out.where("u != v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); the root is the component's smallest node."""
    now = stage(
        edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
        now = stage(_toward_smallest(_toward_smallest(now, both=True), both=False), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
