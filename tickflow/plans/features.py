"""Feature plan: four feeds -> one long table (symbol, ts, f0..f6, volume24h, mid_price).

Per feed one aggregation to bins (folded before its shuffle), one union of the reduced rows laid
out by (symbol, day), and everything after that - dense grid, fills, EMA, rolling windows - works
on that layout.  A (symbol, day) holds at most one row per bin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.functions.clock import ceil_us, floor_us, from_us, to_us
from tickflow.functions.depth import depth_imbalance, depth_wap
from tickflow.functions.guards import finite, guarded_div, signed_log
from tickflow.operators import book as bk
from tickflow.operators.dedup import dedup_last
from tickflow.operators.grid import densify
from tickflow.operators.ordered import ema, ema_reach, ffill, in_blocks, rolling_std, with_previous_valid
from tickflow.schemas import (
    DEPTH, EMA_SPAN, RETURN_CLIP, STEP_MS, TICK_WEIGHTS, VOL_WINDOW,
)

KEYS = ["symbol", "day"]
FEATURE_COLS = ["f0", "f1", "f2", "f3", "f4", "f5", "f6", "volume24h", "mid_price"]


def tick_weight(direction: Column | str = "tickDirection") -> Column:
    pairs = [F.lit(v) for kv in TICK_WEIGHTS.items() for v in kv]
    c = F.col(direction) if isinstance(direction, str) else direction
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), F.lit(1.0))


def signed_flow() -> Column:
    """Buys add |notional| x weight (negative on minus ticks), sells subtract |notional| x |weight|."""
    size, w = F.abs("foreignNotional"), tick_weight()
    return F.when(F.col("side") == "Buy", size * w).when(
        F.col("side") == "Sell", -size * F.abs(w)
    ).otherwise(F.lit(0.0))


def _day(ts: str = "ts") -> Column:
    return F.to_date(ts).alias("day")


def trade_bins(trades: DataFrame, step: int) -> DataFrame:
    return trades.select(
        "symbol", _day(), floor_us(to_us("ts"), step).alias("bin"), signed_flow().alias("flow")
    ).groupBy(*KEYS, "bin").agg(F.sum("flow").alias("flow"))


def taker_imbalance(trades: DataFrame, step: int = STEP_MS * 1000) -> DataFrame:
    """f4 on the dense grid of the trades of each symbol-day."""
    dense = densify(trade_bins(dedup_last(trades, ["symbol", "trdMatchID"], ident="trdMatchID"), step), KEYS, step)
    return dense.select(
        "symbol", from_us("bin").alias("ts"),
        signed_log(F.coalesce("flow", F.lit(0.0))).alias("f4"),
    )


def book_tick_table(
    orderbook: DataFrame, step: int, depth: int, snapshot: str, returns: str,
    reset_daily: bool, limit: float = RETURN_CLIP,
) -> tuple[DataFrame, DataFrame]:
    """Ticks with depth, and ticks with returns; the book starts empty each day unless ``reset_daily`` is off."""
    rows = orderbook.withColumn("day", F.to_date("ts")) if reset_daily else orderbook
    keys = KEYS if reset_daily else ["symbol"]
    ticks = bk.book_ticks(
        bk.chunk_book(rows, keys), keys, depth=depth, snapshot=snapshot, depth_every_us=step
    )
    moves = bk.tick_returns(ticks.drop("bids", "asks"), keys, returns=returns, limit=limit)
    if not reset_daily:
        ticks, moves = (df.withColumn("day", F.to_date("ts")) for df in (ticks, moves))
    return ticks, moves


def book_bins(ticks: DataFrame, moves: DataFrame, step: int, depth: int = DEPTH) -> DataFrame:
    """Per bin: sum of returns and last mid inside it.  Per bin start: best quotes, imbalance and
    weighted price of the last book at or before it, as numbers - the levels end here."""
    inside = moves.groupBy(*KEYS, floor_us("us", step).alias("bin")).agg(
        F.sum("log_return").alias("ret"),
        F.max_by("mid", F.when(F.col("mid").isNotNull(), F.col("us"))).alias("mid_end"),
        F.lit(True).alias("in_book"),
    )
    bids, asks = F.col("bids"), F.col("asks")
    state = F.struct(
        F.get(bids, F.lit(0))["price"].alias("bid"), F.get(asks, F.lit(0))["price"].alias("ask"),
        depth_imbalance(bids, asks, depth).alias("obi"),
        depth_wap(bids, asks, F.lit(None).cast("double"), depth).alias("wap"),
    )
    at = ticks.where(F.col("bids").isNotNull()).select(
        *KEYS, "us", ceil_us("us", step).alias("bin"), state.alias("quote")
    ).groupBy(*KEYS, "bin").agg(F.max_by("quote", "us").alias("quote"))
    return inside.unionByName(at, allowMissingColumns=True)


def instrument_bins(instruments: DataFrame, step: int, zero_is_missing: bool = True) -> DataFrame:
    """Last known mark, index and volume at or before each bin start."""
    prices = {
        c: F.when(F.col(c) != 0, F.col(c)) if zero_is_missing else F.coalesce(c, F.lit(0.0))
        for c in ("markPrice", "indexPrice")
    }
    us = to_us("ts")
    rows = instruments.select(
        "symbol", _day(), us.alias("us"), "seq",
        prices["markPrice"].alias("mark"), prices["indexPrice"].alias("index"),
        F.col("volume24h").cast("double").alias("volume"),
    )

    def last(c):
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("us", "seq"))).alias(c)

    at = rows.groupBy(*KEYS, ceil_us("us", step).alias("bin")).agg(
        last("mark"), last("index"), last("volume")
    )
    span = rows.groupBy(*KEYS).agg(
        F.min(floor_us("us", step)).alias("lo"), F.max(floor_us("us", step)).alias("hi")
    )
    edges = span.select(*KEYS, F.explode(F.array("lo", "hi")).alias("bin"), F.lit(True).alias("in_instr"))
    return at.unionByName(edges, allowMissingColumns=True)


STATE = ["mid_end", "quote", "mark", "index", "volume"]
FEED_COLS = {"in_book": ["quote"], "in_instr": ["mark", "index", "volume"], "flow": []}
EVENTS = {"ret": "in_book", "flow": "flow"}


def align(parts: Sequence[DataFrame], step: int, ffill_events: bool = False) -> DataFrame:
    """Full outer alignment on (symbol, day, bin) of the reduced feeds, on the dense grid.

    The rows are laid out once by (symbol, day), folded, and filled while still sparse.  Then each
    row repeats itself up to the next one: state is copied, event sums are 0 in the gap.  A gap is
    filled only where some feed's own range covers it, as an outer join of the feeds would.
    """
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    # A fixed number of partitions: what is small here grows when the gaps are filled.
    spark = rows.sparkSession
    count = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    laid = rows.repartition(count, *KEYS)
    values = [c for c in laid.columns if c not in [*KEYS, "bin"]]
    folded = laid.groupBy(*KEYS, "bin").agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in values]
    )
    whole, ordered = Window.partitionBy(*KEYS), Window.partitionBy(*KEYS).orderBy("bin")
    ranges = {}
    for flag in FEED_COLS:
        here = F.when(F.col(flag).isNotNull(), F.col("bin"))
        ranges |= {"_lo_" + flag: F.min(here).over(whole), "_hi_" + flag: F.max(here).over(whole)}
    sparse = folded.withColumns(ranges)

    def covers(first, last):
        hit = F.lit(False)
        for flag in FEED_COLS:
            inside = (F.col("_lo_" + flag) <= first) & (F.col("_hi_" + flag) >= last)
            hit = hit | F.coalesce(inside, F.lit(False))
        return hit

    # As-of values past the last bin of their own feed drop out; the fill carries the one before.
    own = {
        c: F.when(F.col("bin") <= F.col("_hi_" + flag), F.col(c))
        for flag, cols in FEED_COLS.items() for c in cols
    }
    sparse = sparse.withColumns(own).where(covers(F.col("bin"), F.col("bin")))
    quoted = (F.col("quote.bid") + F.col("quote.ask")) / 2
    sparse = ffill(sparse.withColumn("mid", quoted), [*STATE, "mid"], KEYS, ["bin"])
    after = F.lead("bin").over(ordered)
    sparse = sparse.withColumn("_after", after).withColumn(
        "_n", F.when(covers(F.col("bin"), F.col("_after")), ((F.col("_after") - F.col("bin")) / step).cast("long")).otherwise(1)
    )
    # Before the first two-sided book the mid is the day's median over the grid, each row counted
    # as often as it will repeat.
    median = F.percentile("mid", F.lit(0.5), F.when(F.col("mid").isNotNull(), F.col("_n")).otherwise(1)).over(whole)
    sparse = sparse.withColumn("mid", F.coalesce("mid", median, F.lit(1.0)))
    if ffill_events:
        sparse = sparse.withColumns(
            {
                "_tail_" + c: F.max(F.when(F.col("bin") == F.col("_hi_" + flag), F.col(c))).over(whole)
                for c, flag in EVENTS.items()
            }
        )
    dense = sparse.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
    at = F.col("bin") + F.col("_k") * step

    def event(c, flag):
        value = F.coalesce(F.when(F.col("_k") == 0, F.col(c)), F.lit(0.0))
        if ffill_events:
            # Parity: the last value of a feed goes on past its end.
            value = F.when(at > F.col("_hi_" + flag), F.coalesce("_tail_" + c, F.lit(0.0))).otherwise(value)
        return value.alias(c)

    return dense.select(
        *KEYS, at.alias("bin"), *[event(c, flag) for c, flag in EVENTS.items()], "mid_end", "mid",
        "quote.*", "mark", "index", "volume",
    )


def aligned_feeds(
    orderbook: DataFrame, trades: DataFrame, instruments: DataFrame,
    step: int = STEP_MS * 1000, depth: int = DEPTH, snapshot: str = "batch",
    returns: str = "tick", reset_daily: bool = True, null_policy: str = "keep",
    ffill_events: bool = False,
) -> DataFrame:
    """All feeds on the dense grid: ret, mid_end, mid, bid, ask, obi, wap, mark, index, volume, flow."""
    ticks, moves = book_tick_table(orderbook, step, depth, snapshot, returns, reset_daily)
    return align(
        [
            book_bins(ticks, moves, step, depth),
            # Updates of one time carry different fields; the bins take the last value of each field.
            instrument_bins(instruments, step, null_policy == "keep"),
            trade_bins(dedup_last(trades, ["symbol", "trdMatchID"], ident="trdMatchID"), step),
        ],
        step,
        ffill_events,
    )


def relative_spread(bid: Column, ask: Column, mid: Column, mark: Column, index: Column) -> Column:
    quoted = F.coalesce(guarded_div(F.abs(ask - bid), mid), F.lit(0.0))
    basis = F.coalesce(F.when(index > 0, F.abs((mark - index) / index)), F.lit(0.0))
    return quoted + basis


def base_features(
    grid: DataFrame, span: int = EMA_SPAN, vol_window: int = VOL_WINDOW, carry_days: bool = False,
) -> DataFrame:
    """Seven features from the aligned grid."""
    both = (F.col("bid") + F.col("ask")) / 2
    now = grid.select(
        *KEYS, "bin", F.col("ret").alias("f1"),
        relative_spread(F.col("bid"), F.col("ask"), both, F.col("mark"), F.col("index")).alias("f2"),
        F.coalesce("obi", F.lit(0.0)).alias("f3"), signed_log(F.col("flow")).alias("f4"),
        F.coalesce("wap", "mid").alias("f6"), F.coalesce("volume", F.lit(0.0)).alias("volume24h"),
        F.coalesce("mid_end", F.lit(0.0)).alias("mid_price"),
    )
    def windows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        vol = rolling_std(rows, "f1", keys, ["bin"], vol_window, name="f5")
        return ema(vol, "f6", keys, ["bin"], span, name="_ema")

    # A symbol-day is bounded by its bins; a symbol's whole history goes in blocks.
    halo = max(vol_window - 1, ema_reach(span))
    smooth = in_blocks(now, ["symbol"], ["bin"], halo, windows) if carry_days else windows(now, KEYS)
    out = smooth.withColumn("f0", F.when(F.col("_ema") > 0, F.col("f6") / F.col("_ema") - 1).otherwise(0.0))
    return out.select(
        "symbol", from_us("bin").alias("ts"),
        *[F.coalesce(finite(c), F.lit(0.0)).alias(c) for c in FEATURE_COLS],
    )


def features_long(
    orderbook: DataFrame, trades: DataFrame, instruments: DataFrame,
    step: int = STEP_MS * 1000, depth: int = DEPTH, span: int = EMA_SPAN,
    vol_window: int = VOL_WINDOW, carry_days: bool = False, **options,
) -> DataFrame:
    grid = aligned_feeds(orderbook, trades, instruments, step, depth, **options)
    return base_features(grid, span, vol_window, carry_days)


def widen(
    features: DataFrame, symbols: Sequence[str], cols: Sequence[str] = FEATURE_COLS
) -> DataFrame:
    """One row per ts, columns ``{symbol}_{feature}``; a symbol without a row at ts reads 0."""
    aggs = [
        F.coalesce(F.max(F.when(F.col("symbol") == s, F.col(c))), F.lit(0.0)).alias(f"{s}_{c}")
        for s in symbols for c in cols
    ]
    return features.where(F.col("symbol").isin(list(symbols))).groupBy("ts").agg(*aggs)


def oi_log_return(instruments: DataFrame, step: int, keys=("symbol",)) -> DataFrame:
    """f7: open interest at each bin start, floored at 1, log difference, first 0."""
    from tickflow.operators.grid import DAY_US, bin_asof

    keys = list(keys)
    grid = bin_asof(instruments, "openInterest", step, keys, name="oi")
    level = F.greatest(F.coalesce("oi", F.lit(0)).cast("double"), F.lit(1.0))
    days = grid.withColumns({"_l": F.log(level), "_day": F.floor(F.col("bin") / DAY_US)})
    stepped = with_previous_valid(days, "_l", keys, ["bin"], "_day", name="_p")
    return stepped.withColumn("f7", F.coalesce(F.col("_l") - F.col("_p"), F.lit(0.0))).drop("_l", "_p", "_day", "oi")


def liquidation_volume(liquidations: DataFrame, step: int, keys=("symbol",)) -> DataFrame:
    """f8: sells add, buys subtract the open quantity."""
    from tickflow.operators.grid import bin_sum

    qty = F.coalesce("leavesQty", F.lit(0)).cast("double")
    signed = F.when(F.col("side") == "Sell", qty).when(F.col("side") == "Buy", -qty).otherwise(0.0)
    return bin_sum(liquidations, signed, step, keys, name="f8")


def funding_feature(funding: Column | str, indicative: Column | str) -> Column:
    """f9: funding + half its distance to the indicative rate."""
    f = F.col(funding) if isinstance(funding, str) else funding
    i = F.col(indicative) if isinstance(indicative, str) else indicative
    return f + (f - i) * 0.5
