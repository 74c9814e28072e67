"""Segments: fixed-length summaries of features, and selections from the wide table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.schemas import CLUSTER_FEATURES, SEGMENT

STATS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def symbols_of(wide: DataFrame) -> list[str]:
    """Symbols named in ``{symbol}_f{n}`` columns."""
    return sorted({c.rsplit("_f", 1)[0] for c in wide.columns if c.rsplit("_f", 1)[-1].isdigit()})


def select_features(wide: DataFrame, names: Sequence[str], ts: str = "ts") -> DataFrame:
    """The named features of every symbol found."""
    cols = [f"{s}_{n}" for s in symbols_of(wide) for n in names]
    return wide.select(ts, *[c for c in cols if c in wide.columns])


def segment_stats(
    wide: DataFrame, cols: Sequence[str], interval: str = SEGMENT, ts: str = "ts"
) -> DataFrame:
    """mean / std / min / max per segment; segments with any null drop out."""
    aggs = [fn(c).alias(f"{c}_{name}") for c in cols for name, fn in STATS.items()]
    out = wide.groupBy(F.window(ts, interval).start.alias("segment_start")).agg(*aggs)
    return out.na.drop()


def cluster_columns(symbols: Sequence[str], rank: str = "f6") -> list[str]:
    return [f"{s}_f{i}" for s in symbols for i in CLUSTER_FEATURES if f"f{i}" != rank]
