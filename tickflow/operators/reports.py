"""Reports over feeds, features and regime labels.

All of them are aggregations with map-side combine; quantiles go through ``quantiles`` and ordered
gaps through per-second buckets, so no task sees a whole symbol.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.functions.clock import floor_us, from_us, to_us
from tickflow.operators.joins import bounded_join
from tickflow.operators.ordered import with_previous_valid
from tickflow.operators.quantiles import unpivot_values, wide_quantiles
from tickflow.schemas import QUALITY_RULES
from tickflow.session import cut

N = F.count


def recent_sample(
    trades: DataFrame, liquidations: DataFrame, symbol: str, cutoff: Column, last: int = 100,
    levels: DataFrame | None = None,
) -> DataFrame:
    """The newest ``last`` trades and all liquidations of a symbol since the cutoff, and the live
    book levels if given (their id in place of the row number)."""
    def since(df):
        return df.where((F.col("symbol") == symbol) & (F.col("ts") >= cutoff))

    newest = since(trades).orderBy(F.col("ts").desc(), F.col("seq").desc()).limit(last)
    out = newest.select(F.lit("trades").alias("feed"), "ts", "seq").unionByName(
        since(liquidations).select(F.lit("liquidations").alias("feed"), "ts", "seq")
    )
    if levels is None:
        return out
    now = levels.where(F.col("symbol") == symbol)
    return out.unionByName(
        now.select(F.lit("orderbook").alias("feed"), F.lit(None).cast("timestamp_ntz").alias("ts"), F.col("id").alias("seq"))
    )


def first_rows(
    df: DataFrame, keep: Column, source: Sequence[str], order: Sequence[str] = ("ts", "seq"), n: int = 3
) -> DataFrame:
    """First ``n`` kept rows per source, with the number kept in the source."""
    kept = df.where(keep)
    rank = F.row_number().over(Window.partitionBy(*source).orderBy(*order))
    top = kept.withColumn("_r", rank).where(F.col("_r") <= n).drop("_r")
    return top.join(kept.groupBy(*source).agg(N(F.lit(1)).alias("matches")), list(source))


def whale_trades(trades: DataFrame, limit: float = 1e6) -> DataFrame:
    return trades.where(F.abs("foreignNotional") > limit)


def funding_alerts(instruments: DataFrame, limit: float = 0.001) -> DataFrame:
    """Large funding rates, with the yearly rate (three payments a day)."""
    rate = F.col("fundingRate")
    return instruments.where(F.abs(rate) > limit).withColumn("annualised", rate * 365 * 3)


def executed_liquidations(liquidations: DataFrame, qty: str = "cumQty") -> DataFrame:
    return liquidations.where(F.col(qty) > 0)


def trade_stats(trades: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    usd = F.col("foreignNotional")
    stats = trades.groupBy(*keys).agg(
        N(F.lit(1)).alias("trades"), F.sum(usd).alias("volume_usd"),
        F.min("price").alias("min_price"), F.max("price").alias("max_price"),
        F.sum(F.when(F.col("side") == "Buy", usd)).alias("_b"),
        F.sum(F.when(F.col("side") == "Sell", usd)).alias("_s"),
    )
    return stats.withColumn("buy_sell_ratio", F.try_divide("_b", "_s")).drop("_b", "_s")


def long_short_liquidations(liqs: DataFrame, qty: str = "leavesQty", keys=("symbol",)) -> DataFrame:
    """A sell closes a long, a buy closes a short."""
    out = []
    for name, side in (("long", "Sell"), ("short", "Buy")):
        here = F.col("side") == side
        out += [
            N(F.when(here, 1)).alias(f"{name}_count"),
            F.coalesce(F.sum(F.when(here, F.col(qty))), F.lit(0)).cast("long").alias(f"{name}_qty"),
        ]
    return liqs.groupBy(*keys).agg(*out)


def profile(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("symbol", "day")) -> DataFrame:
    """Count, mean, std, min, max, quartiles and bias-corrected skew per key and column."""
    group = [*keys, "name"]
    n = F.col("count")
    stats = unpivot_values(df, keys, cols).groupBy(*group).agg(
        N(F.lit(1)).alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"), F.skewness("value").alias("_g"),
    )
    fix = F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2)
    skew = F.when(n < 3, F.lit(None)).when(F.col("max") == F.col("min"), 0.0).otherwise(F.col("_g") * fix)
    quarts = wide_quantiles(df, keys, cols, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return stats.withColumn("skew", skew).drop("_g").join(quarts, group)


def histogram(df: DataFrame, col: str, keys=("symbol",), bins: int = 50) -> DataFrame:
    """Equal-width density histogram between min and max, all bins present."""
    values = unpivot_values(df, keys, [col])
    span = values.groupBy(*keys).agg(
        F.min("value").alias("_a"), F.max("value").alias("_b"), N(F.lit(1)).alias("_n")
    )
    flat = F.col("_a") == F.col("_b")
    span = span.select(
        *keys, "_n", F.when(flat, F.col("_a") - 0.5).otherwise(F.col("_a")).alias("_lo"),
        F.when(flat, F.lit(1.0 / bins)).otherwise((F.col("_b") - F.col("_a")) / bins).alias("_w"),
    )
    span = cut(span)
    at = F.least(F.floor((F.col("value") - F.col("_lo")) / F.col("_w")), F.lit(bins - 1))
    # Equal values fold before the join with the spans.
    folded = values.groupBy(*keys, "value").agg(N(F.lit(1)).alias("_c"))
    counts = bounded_join(folded, span, list(keys), written=True).groupBy(*keys, at.cast("int").alias("bin")).agg(
        F.sum("_c").alias("count")
    )
    every = span.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    out = every.join(counts, [*keys, "bin"], "left").withColumn("count", F.coalesce("count", F.lit(0)))
    return out.select(
        *keys, "bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("low"), "count",
        (F.col("count") / (F.col("_n") * F.col("_w"))).alias("density"),
    )


def kde(
    df: DataFrame, col: str, keys=("symbol",), points: int = 1000, least: int = 11
) -> DataFrame:
    """Gaussian density (Scott bandwidth) on a grid half a range wider than the data each side.

    Equal values are folded first, and a value only touches grid points within nine bandwidths:
    beyond, its weight is under 1e-17 of its peak.
    """
    values = unpivot_values(df, keys, [col])
    stats = values.groupBy(*keys).agg(
        N(F.lit(1)).alias("_n"), F.stddev_samp("value").alias("_s"),
        F.min("value").alias("_a"), F.max("value").alias("_b"),
    ).where((F.col("_n") >= least) & (F.col("_s") > 0))
    width = F.col("_b") - F.col("_a")
    grid = stats.select(
        *keys, "_n", (F.col("_s") * F.pow(F.col("_n").cast("double"), F.lit(-0.2))).alias("_h"),
        (F.col("_a") - width * 0.5).alias("_lo"), (width * 2 / (points - 1)).alias("_dx"),
    )
    grid = cut(grid)
    folded = values.groupBy(*keys, "value").agg(N(F.lit(1)).alias("_c"))
    reach = F.col("_h") * 9
    first = F.greatest(F.ceil((F.col("value") - reach - F.col("_lo")) / F.col("_dx")), F.lit(0))
    last = F.least(F.floor((F.col("value") + reach - F.col("_lo")) / F.col("_dx")), F.lit(points - 1))
    near = bounded_join(folded, grid, list(keys), written=True).withColumns({"_f": first, "_l": last}).where("_f <= _l")
    z = (F.col("_lo") + F.col("point") * F.col("_dx") - F.col("value")) / F.col("_h")
    mass = near.withColumn("point", F.explode(F.sequence("_f", "_l"))).groupBy(*keys, "point").agg(
        F.sum(F.col("_c") * F.exp(z * z * -0.5)).alias("_m")
    )
    every = grid.withColumn("point", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(points - 1).cast("long"))))
    return every.join(mass, [*keys, "point"], "left").select(
        *keys, "point", (F.col("_lo") + F.col("point") * F.col("_dx")).alias("x"),
        (F.coalesce("_m", F.lit(0.0)) / (F.col("_n") * F.col("_h") * math.sqrt(2 * math.pi))).alias("density"),
    )


def boxplot(df: DataFrame, cols: Sequence[str], keys=("symbol",), reach: float = 1.5) -> DataFrame:
    """Quartiles, whiskers at the last value within ``reach`` IQRs, number of outliers."""
    group = [*keys, "name"]
    q = wide_quantiles(df, keys, cols, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    iqr = F.col("q75") - F.col("q25")
    q = q.withColumns({"_lo": F.col("q25") - iqr * reach, "_hi": F.col("q75") + iqr * reach})
    folded = unpivot_values(df, keys, cols).groupBy(*group, "value").agg(N(F.lit(1)).alias("_c"))
    v, inside = F.col("value"), F.col("value").between(F.col("_lo"), F.col("_hi"))
    return bounded_join(folded, q, group).groupBy(*group, "q25", "q50", "q75").agg(
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.sum(F.when(inside, 0).otherwise(F.col("_c"))).cast("long").alias("outliers"),
    )


def value_counts(df: DataFrame, cols: Sequence[str], keys=("symbol",)) -> DataFrame:
    pairs = F.array(
        *[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in cols]
    )
    long = df.select(*keys, F.explode(pairs).alias("_p")).select(*keys, "_p.*")
    return long.where(F.col("value").isNotNull()).groupBy(*keys, "name", "value").agg(
        N(F.lit(1)).alias("count")
    )


# --- regime reports -----------------------------------------------------------------------------


def regime_distribution(labels: DataFrame, regime: str = "regime") -> DataFrame:
    counts = labels.groupBy(regime).agg(N(F.lit(1)).alias("segments"))
    total = labels.agg(N(F.lit(1)).alias("n")).scalar()
    return counts.withColumn("pct", F.col("segments") * 100.0 / total)


def regime_summary(
    labels: DataFrame, minutes: float = 10, step_ms: int = 100, regime: str = "regime"
) -> DataFrame:
    """Segments, hours and samples per regime, noise left out."""
    n = F.col("segments")
    return (
        labels.where(F.col(regime) != -1).groupBy(regime).agg(N(F.lit(1)).alias("segments"))
        .withColumns(
            {"hours": n * F.lit(minutes / 60.0), "samples": (n * int(minutes * 60_000 // step_ms)).cast("long")}
        )
    )


def regime_characteristics(
    segments: DataFrame, features: Mapping[str, str], regime: str = "regime"
) -> DataFrame:
    """Mean over symbols of each symbol's mean; input is long: (regime, symbol, feature means)."""
    per_symbol = segments.where(F.col(regime) != -1).groupBy(regime, "symbol").agg(
        *[F.avg(col).alias(name) for name, col in features.items()], N(F.lit(1)).alias("_n")
    )
    return per_symbol.groupBy(regime).agg(
        F.max("_n").alias("segments"), *[F.avg(name).alias(name) for name in features]
    )


def regime_transitions(
    labels: DataFrame, start: str = "segment_start", regime: str = "regime"
) -> DataFrame:
    """How often each regime follows each other one."""
    rows = labels.select(regime, start, F.date_trunc("month", start).alias("_chunk"))
    step = with_previous_valid(rows, regime, [], [start], "_chunk", name="from_regime")
    return (
        step.where(F.col("from_regime").isNotNull())
        .groupBy("from_regime", F.col(regime).alias("to_regime")).agg(N(F.lit(1)).alias("transitions"))
    )


# --- feed health --------------------------------------------------------------------------------


def feed_rates(rows: DataFrame, keys: Sequence[str] = ("feed",)) -> DataFrame:
    """Rows, errors and rates per feed; input: keys, ts, is_error."""
    secs = (to_us("_hi") - to_us("_lo")) / 1e6
    return (
        rows.groupBy(*keys)
        .agg(
            N(F.lit(1)).alias("rows"), N(F.when(F.col("is_error"), 1)).alias("errors"),
            F.min("ts").alias("_lo"), F.max("ts").alias("_hi"),
        )
        .withColumn("seconds", secs)
        .withColumns(
            {
                "rows_per_sec": F.when(F.col("seconds") > 0, F.col("rows") / F.col("seconds")).otherwise(0.0),
                "error_rate": F.col("errors") / F.greatest(F.col("rows"), F.lit(1)),
            }
        )
        .drop("_lo", "_hi")
    )


def second_gaps(rows: DataFrame, keys: Sequence[str], step: int) -> DataFrame:
    """(keys, bin, n, errors, max_gap): longest silence ending in each interval, in seconds.

    Rows are first folded to one per second with the longest silence inside it (of at most a million
    different times), so ordering works on at most 86,400 rows per key and day.  Intervals begin at whole
    seconds.
    """
    us = to_us("ts")
    per = rows.groupBy(*keys, floor_us(us, 1_000_000).alias("_sec")).agg(
        N(F.lit(1)).alias("n"), N(F.when(F.col("is_error"), 1)).alias("errors"),
        F.sort_array(F.collect_set(us)).alias("_at"),
    ).select(
        *keys, "_sec", "n", "errors", floor_us("_sec", 86_400_000_000).alias("_day"),
        F.col("_at")[0].alias("_lo"), F.element_at("_at", -1).alias("_hi"),
        F.array_max(F.transform("_at", lambda t, i: F.when(i > 0, t - F.get("_at", i - 1)))).alias("_inner"),
    )
    seen = with_previous_valid(per, "_hi", list(keys), ["_sec"], "_day", name="_before")
    gap = F.greatest(F.coalesce(F.col("_lo") - F.col("_before"), F.lit(0)), F.coalesce("_inner", F.lit(0))) / 1e6
    return seen.groupBy(*keys, floor_us("_sec", step).alias("bin")).agg(
        F.sum("n").alias("n"), F.sum("errors").alias("errors"), F.max(gap).alias("max_gap")
    )


def feed_quality(
    rows: DataFrame, keys=("feed", "symbol"), step: int = 60_000_000, poor_rate: float = 0.05,
    degraded_rate: float = 0.01, poor_gap: float = 30.0, silent_gap: float = 60.0,
) -> DataFrame:
    """Quality tier per key and interval from the error rate and the longest silence."""
    rate = F.col("errors") / F.greatest(F.col("n"), F.lit(1))
    tier = (
        F.when((rate > poor_rate) | (F.col("max_gap") > poor_gap), "poor")
        .when(rate > degraded_rate, "degraded").otherwise("good")
    )
    return second_gaps(rows, keys, step).select(
        *keys, from_us("bin").alias("ts"), "n", "errors", "max_gap", tier.alias("tier"),
        (F.col("max_gap") > silent_gap).alias("silent"),
    )


def dq_violations(
    feeds: Mapping[str, DataFrame], step: int = 60_000_000,
    rules: Mapping[str, tuple[str, float]] = QUALITY_RULES,
) -> DataFrame:
    """Violated rules per symbol and interval: (rule, symbol, ts, value, limit).

    ``feeds`` may hold trades, orderbook, spreads (symbol, ts, spread_pct), liquidations and
    instruments; rules whose columns are absent are skipped.
    """
    out = []
    for feed, df in feeds.items():
        have = set(df.columns)
        latency = F.max((to_us("received") - to_us("ts")) / 1000.0) if "received" in have else None
        n = N(F.lit(1)).cast("double")
        aggs: dict[str, Column | None] = {}
        if feed == "trades":
            aggs = {
                "min_trades_per_minute": n,
                "max_price_change_pct": (F.max("price") / F.min("price") - 1) * 100.0,
                "max_trade_latency_ms": latency,
            }
        elif feed == "orderbook":
            aggs = {"min_updates_per_minute": n, "max_book_latency_ms": latency}
        elif feed == "spreads":
            aggs = {"max_spread_pct": F.max("spread_pct")}
        elif feed == "liquidations":
            aggs = {"max_liquidations_per_minute": n, "min_liquidation_size": F.min("leavesQty").cast("double")}
        elif feed == "instruments":
            aggs = {"max_funding_rate": F.max(F.abs("fundingRate"))}
        aggs = {name: a.alias(name) for name, a in aggs.items() if a is not None}
        binned = df.withColumn("_bin", floor_us(to_us("ts"), step))
        table = binned.groupBy("symbol", "_bin").agg(*aggs.values())
        if feed == "trades":
            # Surplus copies per interval, via one folded row per id.
            copies = binned.groupBy("symbol", "_bin", "trdMatchID").agg(N(F.lit(1)).alias("c")).groupBy(
                "symbol", "_bin"
            ).agg(F.sum(F.col("c") - 1).cast("double").alias("duplicate_trade_threshold"))
            table = table.join(copies, ["symbol", "_bin"])
            aggs["duplicate_trade_threshold"] = None
        if feed == "instruments":
            gaps = second_gaps(df.withColumn("is_error", F.lit(False)), ["symbol"], step)
            table = table.join(
                gaps.select("symbol", F.col("bin").alias("_bin"), F.col("max_gap").alias("min_update_interval")),
                ["symbol", "_bin"],
            )
            aggs["min_update_interval"] = None
        checks = F.array(
            *[F.struct(F.lit(r).alias("rule"), F.col(r).cast("double").alias("value"), F.lit(rules[r][1]).alias("limit")) for r in aggs]
        )
        out.append(table.select("symbol", from_us("_bin").alias("ts"), F.explode(checks).alias("_c")).select("symbol", "ts", "_c.*"))
    rows = out[0]
    for more in out[1:]:
        rows = rows.unionByName(more)
    # A rule named min_ bounds from below, except the update interval, which bounds the silence.
    low = F.col("rule").startswith("min_") & (F.col("rule") != "min_update_interval")
    broken = F.when(low, F.col("value") < F.col("limit")).otherwise(F.col("value") > F.col("limit"))
    return rows.where(broken)


def coverage_matrix(
    rows: DataFrame, feeds: Sequence[str], symbols: Sequence[str], days: tuple | None = None
) -> DataFrame:
    """Rows and rows without a time, per expected (feed, symbol, day); input: feed, symbol, day, ts.

    ``days`` is the first and last expected day, by default those that occur; every day between is
    expected, also one on which all feeds were silent.
    """
    counts = rows.groupBy("feed", "symbol", "day").agg(
        N(F.lit(1)).alias("_n"), N(F.when(F.col("ts").isNull(), 1)).alias("_bad")
    )

    def names(values):
        return F.explode(F.array(*[F.lit(v) for v in values]))

    ends = counts.agg(F.min("day").alias("a"), F.max("day").alias("b")).where("a IS NOT NULL")
    if days is not None:
        ends = rows.sparkSession.range(1).select(*[F.lit(d).cast("date").alias(c) for d, c in zip(days, "ab")])
    expected = (
        ends.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("day"))
        .withColumn("feed", names(feeds)).withColumn("symbol", names(symbols))
    )
    return expected.join(counts, ["feed", "symbol", "day"], "left").select(
        "feed", "symbol", "day", F.coalesce("_n", F.lit(0)).alias("rows"),
        F.coalesce("_bad", F.lit(0)).alias("bad_times"),
    )


def coverage_gaps(matrix: DataFrame, required: Sequence[str] = ("trades", "orderbook")) -> DataFrame:
    """Expected (feed, symbol, day) cells with no rows or with rows lacking a time."""
    empty = F.col("feed").isin(list(required)) & (F.col("rows") == 0)
    return matrix.where(empty | (F.col("bad_times") > 0)).select("feed", "symbol", "day")
