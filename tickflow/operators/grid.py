"""Time grid: bin aggregates, dense grids, as-of values.

Bins are epoch microseconds (long).  Binning is a plain aggregation with map-side combine, so hot
bins are folded before the shuffle; afterwards a symbol-day holds at most one row per bin, which
bounds every window below.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.functions.clock import ceil_us, floor_us, from_us, to_us
from tickflow.operators.joins import bounded_join
from tickflow.operators.ordered import carry_after, ffill, range_chunks

DAY_US = 86_400_000_000
BLOCK_BINS = 100_000


def _bins(df: DataFrame, low: Column, high: Column, step: int, name: str) -> DataFrame:
    """A row for each bin low, low + step, .. high, in blocks: no array holds more than a block or
    one element for each block."""
    block = step * BLOCK_BINS
    starts = df.withColumn("_high", high).withColumn("_block", F.explode(F.sequence(low, F.col("_high"), F.lit(block))))
    last = F.least(F.col("_high"), F.col("_block") + (block - step))
    return starts.withColumn(name, F.explode(F.sequence(F.col("_block"), last, F.lit(step)))).drop("_high", "_block")


def _next_bin(df: DataFrame, keys: Sequence[str], bin: str) -> DataFrame:
    """Add ``_next``, the bin of the following row of the key.

    Keys without a day may have a long history: rows are ordered within days, and the first bin of
    a later day comes from one small row for each (keys, day).
    """
    if "day" in keys:
        return df.withColumn("_next", F.lead(bin).over(Window.partitionBy(*keys).orderBy(bin)))
    days = df.withColumn("_day", F.floor(F.col(bin) / DAY_US))
    firsts = days.groupBy(*keys, "_day").agg(F.min(bin).alias("_first"))
    later = firsts.select(*keys, "_day", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_day")).alias("_later"))
    inner = Window.partitionBy(*keys, "_day").orderBy(bin)
    met = days.withColumn("_next", F.lead(bin).over(inner)).join(later, [*keys, "_day"])
    return met.withColumn("_next", F.coalesce("_next", "_later")).drop("_day", "_later")


def densify(
    df: DataFrame, keys: Sequence[str], step: int, bin: str = "bin", keep: Column | None = None
) -> DataFrame:
    """Insert a row of nulls for each empty bin between the first and last of a key.

    Each row fills its own gap up to the next row, so there is no join with a grid and no second
    scan.
    """
    values = [c for c in df.columns if c not in [*keys, bin]]
    upto = F.coalesce(F.col("_next") - step, F.col(bin))
    filled = _bins(_next_bin(df, keys, bin), F.col(bin), upto, step, "_bin")
    own = F.col("_bin") == F.col(bin)
    out = filled.select(
        *keys, F.col("_bin").alias(bin), *[F.when(own, F.col(c)).alias(c) for c in values]
    )
    return out if keep is None else out.where(keep)


def _fill_bins(dense: DataFrame, name: str, keys: Sequence[str], bin: str = "bin") -> DataFrame:
    """Forward fill in windows of a day; one small row for each day carries values over."""
    days = dense.withColumn("_day", F.floor(F.col(bin) / DAY_US))
    return ffill(days, [name], keys, [bin], "_day").drop("_day")


def bin_sum(
    df: DataFrame, value: str | Column, step: int, keys=("symbol",), ts="ts", name="total",
    grid_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Sum per bin; empty bins inside the range of a key are 0."""
    value = F.col(value) if isinstance(value, str) else value
    sums = df.withColumn("bin", floor_us(to_us(ts), step)).groupBy(*keys, "bin").agg(
        F.sum(value).alias(name)
    )
    dense = densify(sums, grid_keys or list(keys), step)
    return dense.withColumn(name, F.coalesce(name, F.lit(0)))


def bin_last(
    df: DataFrame, value: str, step: int, keys=("symbol",), ts="ts", order=("ts", "seq"),
    name="last", fill: bool = False,
) -> DataFrame:
    """Last non-null value per [start, end) bin; empty bins null, or filled forward."""
    lasts = df.withColumn("bin", floor_us(to_us(ts), step)).groupBy(*keys, "bin").agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*order))).alias(name)
    )
    dense = densify(lasts, list(keys), step)
    return _fill_bins(dense, name, list(keys)) if fill else dense


def bin_asof(
    df: DataFrame, value: str, step: int, keys=("symbol",), ts="ts", order=("ts", "seq"),
    name="asof",
) -> DataFrame:
    """Value of the last row at or before each bin start, on the bins the rows span.

    An event first counts at the bin start at or after it (ceil); the last per bin is kept and
    filled forward.  The first bin is null unless a row falls exactly on it.
    """
    us = to_us(ts)
    seen = (
        df.where(F.col(value).isNotNull())
        .withColumn("bin", ceil_us(us, step))
        .groupBy(*keys, "bin")
        .agg(F.max_by(value, F.struct(*order)).alias(name))
    )
    span = (
        df.groupBy(*keys)
        .agg(F.min(floor_us(us, step)).alias("_lo"), F.max(floor_us(us, step)).alias("_hi"))
    )
    edges = span.select(*keys, F.explode(F.array("_lo", "_hi")).alias("bin")).distinct()
    # A value of the last, unfinished bin counts after the grid's end.
    inside = seen.join(span.select(*keys, "_hi"), list(keys)).where(F.col("bin") <= F.col("_hi")).drop("_hi")
    both = (
        inside.unionByName(edges, allowMissingColumns=True).groupBy(*keys, "bin").agg(F.max(name).alias(name))
    )
    return _fill_bins(densify(both, list(keys), step), name, list(keys))


def dense_grid(df: DataFrame, step: int, keys=("symbol",), ts="ts") -> DataFrame:
    """All bins from floor(min) to floor(max) per key."""
    us = floor_us(to_us(ts), step)
    span = df.groupBy(*keys).agg(F.min(us).alias("_lo"), F.max(us).alias("_hi"))
    return _bins(span, F.col("_lo"), F.col("_hi"), step, "bin").select(*keys, "bin")


def last_in_interval(
    df: DataFrame, intervals: DataFrame, value: str, keys=("symbol",), ts="ts",
    order=("ts", "seq"), name="last", pieces: int | None = None,
) -> DataFrame:
    """Last non-null value in each [start_ts, end_ts) interval; null where all its rows have none, and
    no row for an interval without rows.  Equal intervals give one row.

    A sweep: rows and interval ends stand in one order, cut in even chunks, and an end reads the last
    value before it.  The cost does not depend on how long intervals are or how many overlap.
    """
    by = [f"_o{i}" for i in range(len(order))]
    us = to_us(ts)
    rows = df.where(F.col(ts).isNotNull()).select(
        *keys, us.alias("_us"), F.lit(1).alias("_kind"), *[F.col(c).alias(b) for c, b in zip(order, by)], us.alias("_seen"),
        F.when(F.col(value).isNotNull(), F.struct(us.alias("us"), F.col(value).alias("value"))).alias("_last"),
    )
    # An end comes before the rows of its own time: intervals are open there.
    ends = intervals.select(*keys, "start_ts", "end_ts").distinct().select(
        *keys, to_us("end_ts").alias("_us"), F.lit(0).alias("_kind"), "start_ts", "end_ts"
    ).where(F.col("start_ts").isNotNull() & F.col("end_ts").isNotNull())
    line = ["_us", "_kind", *by, "start_ts"]
    swept = range_chunks(rows.unionByName(ends, allowMissingColumns=True), list(keys), line, pieces, "_chunk")
    at = ffill(swept, ["_seen", "_last"], list(keys), line, "_chunk").where(F.col("_kind") == 0)
    start = to_us("start_ts")
    return at.where(F.col("_seen") >= start).select(
        *keys, "start_ts", "end_ts", F.when(F.col("_last.us") >= start, F.col("_last.value")).alias(name)
    )


def asof_labels(
    rows: DataFrame, labels: DataFrame, label: str = "regime", ts: str = "ts",
    start: str = "segment_start",
) -> DataFrame:
    """Latest label at or before each row; rows before the first label take the first one, and
    without any label every row has a null one.

    Labels become [from, until) intervals, repeated for the hours they touch, and meet the rows on
    the hour: an equi-join, broadcast while the intervals are few.
    """
    per_day = labels.select(
        F.col(label).alias("_label"), F.col(start).alias("_from"), F.to_date(start).alias("_day")
    )
    next_day = carry_after(per_day, ["_from"], [], ["_from"], "_day")
    inside = Window.partitionBy("_day").orderBy("_from")
    spans = per_day.withColumn("_lead", F.lead("_from").over(inside)).join(next_day, ["_day"], "left")
    first = labels.agg(F.min(start).alias("s")).scalar()
    low = rows.agg(F.min(ts).alias("s")).scalar()
    high = rows.agg(F.max(ts).alias("s")).scalar()
    until = F.coalesce("_lead", "_after__from")
    hour = 3_600_000_000
    placed = (
        spans.withColumn("_until", until)
        .withColumn("_a", F.when(F.col("_from") == first, F.least(low, F.col("_from"))).otherwise(F.col("_from")))
        .withColumn("_b", F.coalesce("_until", F.greatest(high, F.col("_from"))))
        .select(
            "_label", "_a", "_until",
            F.explode(
                F.sequence(floor_us(to_us("_a"), hour), floor_us(to_us("_b"), hour), F.lit(hour))
            ).alias("_h"),
        )
    )
    ok = (F.col(ts) >= F.col("_a")) & (F.col("_until").isNull() | (F.col(ts) < F.col("_until")))
    # Labels, where there are any, cover the whole range of the rows: only an empty table misses.
    return (
        bounded_join(rows.withColumn("_h", floor_us(to_us(ts), hour)), placed, ["_h"], how="left")
        .where(F.col("_a").isNull() | ok)
        .select(F.col("_label").alias(label), *rows.columns)
    )


def bin_ts(df: DataFrame, bin: str = "bin", name: str = "ts") -> DataFrame:
    """Bins as timestamps."""
    return df.withColumn(name, from_us(bin)).drop(bin) if name != bin else df.withColumn(
        name, from_us(bin)
    )
