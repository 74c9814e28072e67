"""Ordered (window) operators.

Two situations, told apart by the ``chunk`` argument:

* ``chunk=None``: each ``keys`` group is bounded by construction, e.g. one symbol-day on a time
  grid (at most 864,000 rows at 100 ms).  A plain window does the work.
* ``chunk="..."``: the group may be as large as the table (one symbol holding a third of all
  ticks).  ``range_chunks`` cuts the order into even contiguous pieces; windows run inside a
  piece and one small row per (keys, chunk) carries the state across pieces.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.functions.guards import clip
from tickflow.schemas import EMA_SPAN, RANK_MIN, RANK_WINDOW, RETURN_CLIP, VOL_WINDOW
from tickflow.session import cut


def range_chunks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], pieces: int | None = None,
    name: str = "chunk",
) -> DataFrame:
    """Add a chunk number: chunks are contiguous in (keys, order) and evenly sized.

    Range partitioning samples the whole sort key, so a hot key is split like any other.  The
    partition number only means something for one execution of the shuffle, so the result is
    written once before anything is computed from it.
    """
    by = [F.col(c) for c in [*keys, *order]]
    parts = df.repartitionByRange(pieces, *by) if pieces else df.repartitionByRange(*by)
    # Without a number AQE merges small pieces; with one, the caller knows better.
    return cut(parts.withColumn(name, F.spark_partition_id().cast("long")))


PIECE_ROWS = 1_000_000


def many_pieces(df: DataFrame, factor: int = 4, rows: int = PIECE_ROWS) -> int:
    """Chunks of at most about ``rows`` rows, so that a chunk fits one task whatever the table.

    At least several per core: chunks are hashed to tasks afterwards, and with one per core on
    average a third of the cores would stay idle while a few work off several.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    spread = max(int(spark.conf.get("spark.sql.shuffle.partitions")), factor * cores)
    return max(spread, -(-df.count() // rows))


def _window(keys, order, chunk=None):
    return Window.partitionBy(*keys, *([chunk] if chunk else [])).orderBy(*order)


def _join_key(keys, chunk):
    return [*keys, chunk]


def carry_before(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str], chunk: str,
    prefix: str = "_before_",
) -> DataFrame:
    """Per (keys, chunk): the last non-null value of each column in earlier chunks."""
    ends = df.groupBy(*keys, chunk).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in cols]
    )
    w = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    return ends.select(
        *keys, chunk, *[F.last(c, ignorenulls=True).over(w).alias(prefix + c) for c in cols]
    )


def carry_after(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str], chunk: str,
    prefix: str = "_after_",
) -> DataFrame:
    """Per (keys, chunk): the first non-null value of each column in later chunks."""
    ends = df.groupBy(*keys, chunk).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in cols]
    )
    w = Window.partitionBy(*keys).orderBy(F.desc(chunk)).rowsBetween(Window.unboundedPreceding, -1)
    return ends.select(
        *keys, chunk, *[F.last(c, ignorenulls=True).over(w).alias(prefix + c) for c in cols]
    )


def ffill(df, cols, keys, order, chunk=None) -> DataFrame:
    """Replace nulls by the last earlier non-null value."""
    w = _window(keys, order, chunk).rowsBetween(Window.unboundedPreceding, 0)
    local = {c: F.last(c, ignorenulls=True).over(w) for c in cols}
    if chunk is None:
        return df.withColumns(local)
    carried = carry_before(df, cols, keys, order, chunk)
    out = df.withColumns(local).join(carried, _join_key(keys, chunk), "left")
    filled = {c: F.coalesce(F.col(c), F.col("_before_" + c)) for c in cols}
    return out.withColumns(filled).select(*df.columns)


def bfill(df, cols, keys, order, chunk=None) -> DataFrame:
    """Replace nulls by the first later non-null value.

    Runs as a forward fill of the reversed order: Spark evaluates a frame that ends at the last
    row anew for every row.
    """
    back = Window.partitionBy(*keys, *([chunk] if chunk else [])).orderBy(*[F.desc(c) for c in order])
    w = back.rowsBetween(Window.unboundedPreceding, 0)
    local = {c: F.last(c, ignorenulls=True).over(w) for c in cols}
    if chunk is None:
        return df.withColumns(local)
    carried = carry_after(df, cols, keys, order, chunk)
    out = df.withColumns(local).join(carried, _join_key(keys, chunk), "left")
    filled = {c: F.coalesce(F.col(c), F.col("_after_" + c)) for c in cols}
    return out.withColumns(filled).select(*df.columns)


def ffill_zero(df, cols, keys, order, chunk=None) -> DataFrame:
    """Forward fill where zero counts as missing too; rows before any value stay as they are."""
    work = df.withColumns({"_z_" + c: F.nullif(F.col(c), F.lit(0)) for c in cols})
    out = ffill(work, ["_z_" + c for c in cols], keys, order, chunk)
    return out.withColumns(
        {c: F.coalesce(F.col("_z_" + c), F.col(c)) for c in cols}
    ).select(*df.columns)


def with_previous_valid(df, col, keys, order, chunk=None, name="prev_valid") -> DataFrame:
    """Add the last non-null value strictly before each row."""
    w = _window(keys, order, chunk).rowsBetween(Window.unboundedPreceding, -1)
    out = df.withColumn(name, F.last(col, ignorenulls=True).over(w))
    if chunk is None:
        return out
    carried = carry_before(df, [col], keys, order, chunk)
    return (
        out.join(carried, _join_key(keys, chunk), "left")
        .withColumn(name, F.coalesce(F.col(name), F.col("_before_" + col)))
        .select(*df.columns, name)
    )


def log_returns(
    df, price, keys, order, chunk=None, name="log_return", limit=RETURN_CLIP
) -> DataFrame:
    """ln(price / previous valid price) clipped to +-limit; 0 where either is missing."""
    valid = df.withColumn("_valid", F.when(F.col(price) > 0, F.col(price)))
    out = with_previous_valid(valid, "_valid", keys, order, chunk, name="_prev")
    value = clip(F.log(F.col("_valid") / F.col("_prev")), -limit, limit)
    return out.withColumn(name, F.coalesce(value, F.lit(0.0))).drop("_valid", "_prev")


def rolling_std(df, col, keys, order, window=VOL_WINDOW, name="rolling_std") -> DataFrame:
    """Population standard deviation over the last ``window`` rows, 0 before a full window.

    Keys must be bounded (a symbol-day of grid rows); ``in_blocks`` serves others.  Spark re-reads a sliding frame for every
    row, so the window is put together from two growing ones: rows are cut in blocks of
    ``window``, and a window is the end of one block and the start of the next.  Means and squared
    deviations of both parts merge without cancellation.
    """
    size = int(window)
    by_row = Window.partitionBy(*keys).orderBy("_n")
    start = Window.partitionBy(*keys, "_b").orderBy("_n").rowsBetween(Window.unboundedPreceding, 0)
    end = Window.partitionBy(*keys, "_b").orderBy(F.desc("_n")).rowsBetween(Window.unboundedPreceding, 0)

    def part(w):
        x = F.col(col).cast("double")
        return F.struct(F.count(x).over(w).alias("c"), F.avg(x).over(w).alias("m"), F.var_pop(x).over(w).alias("v"))

    pos = df.withColumn("_n", F.row_number().over(_window(keys, order)) - 1).withColumn(
        "_b", F.floor(F.col("_n") / size)
    )
    parts = pos.withColumn("_e", part(end)).withColumn("_s", part(start)).withColumn(
        "_e", F.when(F.col("_n") % size != size - 1, F.lag("_e", size - 1).over(by_row)) if size > 1 else F.lit(None).cast("struct<c:bigint,m:double,v:double>")
    )
    c1, m1, v1 = F.col("_s.c"), F.coalesce("_s.m", F.lit(0.0)), F.coalesce("_s.v", F.lit(0.0))
    c2 = F.coalesce("_e.c", F.lit(0))
    m2, v2 = F.coalesce("_e.m", F.lit(0.0)), F.coalesce("_e.v", F.lit(0.0))
    total = c1 + c2
    spread = v1 * c1 + v2 * c2 + (m1 - m2) * (m1 - m2) * c1 * c2 / total
    full = (F.col("_n") >= size - 1) & (total > 0)
    return parts.withColumn(name, F.when(full, F.sqrt(spread / total)).otherwise(0.0)).select(*df.columns, name)


def ema(df, col, keys, order, span=EMA_SPAN, name="ema", block: int | None = None) -> DataFrame:
    """y0 = x0, y = (1-a) y' + a x with a = 2/(span+1), restarting per ``keys``.

    A linear recurrence is not a window function, so rows are cut in blocks.  Inside a block it
    is a weighted running sum.  Across blocks the state decays by q^block per step, so the last
    few block ends, found by fixed row offsets, determine it to below double precision.  All
    windows work on the layout by ``keys``; nothing is shuffled again.  Inputs must not be null.
    Keys must be bounded; ``in_blocks`` with ``ema_reach`` rows serves others.
    """
    alpha = 2.0 / (span + 1.0)
    q = 1.0 - alpha
    if q <= 0.0:
        return df.withColumn(name, F.col(col).cast("double"))
    # q^-block stays near e^2 for block <= span, so the weights neither over- nor underflow.
    size = int(block or max(1, span))
    reach = int(np.ceil(45.0 / (-np.log(q) * size))) + 1
    rows = _window(keys, order)
    inside = Window.partitionBy(*keys, "_b").orderBy("_n").rowsBetween(
        Window.unboundedPreceding, 0
    )
    by_row = Window.partitionBy(*keys).orderBy("_n")
    pos = df.withColumn("_n", F.row_number().over(rows) - 1).withColumns(
        {"_b": F.floor(F.col("_n") / size), "_i": F.col("_n") % size}
    )
    # Row 0 is the seed: weight 1 instead of a.
    x = F.when(F.col("_n") == 0, F.col(col) / alpha).otherwise(F.col(col).cast("double"))
    weighted = F.sum(x * F.pow(F.lit(q), -F.col("_i").cast("double"))).over(inside)
    local = pos.withColumn("_y", F.lit(alpha) * F.pow(F.lit(q), F.col("_i").cast("double")) * weighted)
    entry = F.lit(0.0)
    for j in range(reach):
        entry = entry + F.coalesce(F.lag("_y", 1 + j * size).over(by_row), F.lit(0.0)) * F.lit(q ** (size * j))
    started = local.withColumn("_s", F.when(F.col("_i") == 0, entry))
    state = F.first("_s").over(inside)
    return (
        started.withColumn(name, F.col("_y") + F.pow(F.lit(q), F.col("_i").cast("double") + 1) * state)
        .select(*df.columns, name)
    )


def ordered_index(
    df, order, keys=(), name="idx", pieces: int | None = None, chunk: str | None = None
) -> DataFrame:
    """Zero-based row position in the total order (per ``keys``), without a one-task window.

    ``chunk`` keeps the chunk number under that name, for chunked operators that follow.
    """
    chunked = range_chunks(df, keys, order, pieces, name="_chunk")
    counts = chunked.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(
        *[F.col(k).alias("_k" + k) for k in keys], F.col("_chunk").alias("_k"),
        F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_base"),
    )
    # Rows with a null key form a group like any other.
    same = F.col("_chunk") == F.col("_k")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col("_k" + k))
    local = F.row_number().over(_window(keys, order, "_chunk")) - 1
    return (
        chunked.withColumn("_r", local)
        .join(base, same)
        .withColumn(name, (F.col("_r") + F.col("_base")).cast("long"))
        .select(*df.columns, name, *([F.col("_chunk").alias(chunk)] if chunk else []))
    )


HALO_BLOCK = 1 << 16
"""Rows of a block, at least, where blocks carry the rows before them."""


def in_blocks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], halo: int,
    fn: Callable[[DataFrame, list[str]], DataFrame], block: int | None = None,
) -> DataFrame:
    """``fn(rows, keys)`` over blocks of consecutive rows of a key, each with the ``halo`` rows before it.

    For windows that look back over a fixed number of rows, where a key may be as large as the table:
    no window holds more than ``block + halo`` rows.  ``fn`` may add columns, and keeps the rows.
    """
    size = int(block or max(4 * halo, HALO_BLOCK))
    pos = ordered_index(df, order, keys, name="_idx")
    touched = F.sequence(F.floor(F.col("_idx") / size), F.floor((F.col("_idx") + halo) / size))
    placed = pos.withColumn("_block", F.explode(touched))
    return fn(placed, [*keys, "_block"]).where(F.floor(F.col("_idx") / size) == F.col("_block")).drop("_idx", "_block")


def ema_reach(span: int) -> int:
    """Rows after which a state has decayed below double precision."""
    q = 1.0 - 2.0 / (span + 1.0)
    return 1 if q <= 0.0 else int(np.ceil(45.0 / -np.log(q)))


RANK_BLOCK = 1 << 13
"""Rows ranked at once, at least."""


def _count_below(rank: np.ndarray, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """How many of rank[low:high] are below ``bound``, for all queries at once.

    A wavelet matrix: the ranks are parted bit by bit from the top, and a query follows its bound's bits,
    so each costs the number of bits whatever the width of its range.
    """
    found = np.zeros(len(low), np.int64)
    low, high = low.astype(np.int64), high.astype(np.int64)
    for bit in reversed(range(max(1, int(max(rank.max(initial=0), bound.max(initial=0))).bit_length()))):
        ones = (rank >> bit) & 1
        zeros = np.zeros(len(rank) + 1, np.int64)
        np.cumsum(1 - ones, out=zeros[1:])
        up = (bound >> bit) & 1 == 1
        zl, zh = zeros[low], zeros[high]
        found += np.where(up, zh - zl, 0)
        low = np.where(up, zeros[-1] + low - zl, zl)
        high = np.where(up, zeros[-1] + high - zh, zh)
        rank = np.concatenate([rank[ones == 0], rank[ones == 1]])
    return found


def _ranks(values: np.ndarray, first: int, window: int, least: int, strict: bool, start: int):
    """Rolling rank of values[first:], each against its window; ``start`` is values[0]'s index."""
    n = len(values)
    known = ~np.isnan(values)
    ordered = np.unique(values[known])
    # A missing value is above all others, and nothing is below it.
    rank = np.where(known, np.searchsorted(ordered, values), len(ordered))
    at = np.arange(first, n)
    bound = np.where(known[first:], rank[first:] + (not strict), 0)
    below = _count_below(rank, np.maximum(0, at - window + 1), at + 1, bound)
    seen = np.minimum(start + at + 1, window)
    return np.where(seen >= least, below / seen, np.nan)


def rolling_rank(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str], order: Sequence[str],
    window: int = RANK_WINDOW, min_periods: int | None = RANK_MIN, inclusive: bool = False,
    before: float | None = None, suffix: str = "_rank", block: int | None = None,
    index: str | None = None,
) -> DataFrame:
    """Share of the last ``window`` rows below each row (``inclusive``: at or below).

    ``before`` fills rows with fewer than ``min_periods`` rows (null by default).  Blocks of rows
    go to separate tasks together with the ``window - 1`` rows before them, so no task sees more
    than ``block + window`` rows whatever the size of a key.
    """
    least = window if min_periods is None else min_periods
    size = int(block or max(4 * window, RANK_BLOCK))
    pos = df if index else ordered_index(df, order, keys, name="_idx")
    idx = index or "_idx"
    placed = pos.withColumn(
        "_block",
        F.explode(
            F.sequence(
                F.floor(F.col(idx) / size), F.floor((F.col(idx) + (window - 1)) / size)
            )
        ),
    )
    fields = [f for f in pos.schema.fields if f.name != "_idx"]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in fields]
        + [f"`{c}{suffix}` double" for c in cols]
    )
    names = [f.name for f in fields]

    def rank(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(idx, kind="stable")
        lo = int(pdf["_block"].iloc[0]) * size
        own = (pdf[idx] >= lo).to_numpy()
        first = int(len(pdf) - own.sum())
        out = pdf.loc[own, names].copy()
        for c in cols:
            got = _ranks(
                pdf[c].to_numpy(dtype=float), first, window, least, not inclusive,
                int(pdf[idx].iloc[0]),
            )
            out[c + suffix] = got if before is None else np.where(np.isnan(got), before, got)
        return out

    ranked = placed.groupBy(*keys, "_block").applyInPandas(rank, schema)
    return ranked.select(
        *[c for c in ranked.columns if c not in [x + suffix for x in cols]],
        *[F.nanvl(F.col(c + suffix), F.lit(None).cast("double")).alias(c + suffix) for c in cols],
    )


def interpolate(df, cols, keys, order, position, chunk=None) -> DataFrame:
    """Linear interpolation by row position; both ends take the nearest valid value."""
    work = df.withColumns(
        {
            "_p_" + c: F.when(
                F.col(c).isNotNull(),
                F.struct(F.col(position).cast("long").alias("p"), F.col(c).cast("double").alias("v")),
            )
            for c in cols
        }
    )
    marks = ["_p_" + c for c in cols]
    left = ffill(work, marks, keys, order, chunk)
    # The fill to the right needs the marks as they were, so keep a second copy.
    both = left.withColumns(
        {
            "_q_" + c: F.when(
                F.col(c).isNotNull(),
                F.struct(F.col(position).cast("long").alias("p"), F.col(c).cast("double").alias("v")),
            )
            for c in cols
        }
    )
    both = bfill(both, ["_q_" + c for c in cols], keys, order, chunk)

    def value(c: str) -> Column:
        a, b, at = F.col("_p_" + c), F.col("_q_" + c), F.col(position)
        line = a["v"] + (b["v"] - a["v"]) * (at - a["p"]) / (b["p"] - a["p"])
        return (
            F.when(F.col(c).isNotNull(), F.col(c).cast("double"))
            .when(a.isNull(), b["v"])
            .when(b.isNull(), a["v"])
            .otherwise(line)
        )

    return both.withColumns({c: value(c) for c in cols}).select(*df.columns)


def warmup_trim(df: DataFrame, ts: str = "ts", interval: str = "60 minutes") -> DataFrame:
    """Drop the first stretch of the whole data set."""
    start = df.agg((F.min(ts) + F.expr(f"INTERVAL {interval}")).alias("_start")).scalar()
    return df.where(F.col(ts) >= start)


def tail_window(
    df: DataFrame, keys: Sequence[str] = (), ts: str = "ts", interval: str = "240 minutes"
) -> DataFrame:
    """Keep the last stretch of each ``keys`` group."""
    back = F.expr(f"INTERVAL {interval}")
    if not keys:
        return df.where(F.col(ts) > df.agg((F.max(ts) - back).alias("_from")).scalar())
    ends = df.groupBy(*keys).agg((F.max(ts) - back).alias("_from"))
    return df.join(ends, list(keys)).where(F.col(ts) > F.col("_from")).select(*df.columns)
