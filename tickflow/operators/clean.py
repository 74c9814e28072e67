"""Outliers and sanitising of feature tables in long form (symbol, ts, f0..f6, ...)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.functions.guards import clip, finite
from tickflow.operators.joins import bounded_join
from tickflow.operators.ordered import interpolate, ordered_index, warmup_trim
from tickflow.operators.quantiles import wide_quantiles
from tickflow.operators.typing import fix_nonpositive
from tickflow.schemas import FEATURES, Z_DEFAULT, Z_FEATURE, Z_FEATURE_SYMBOL, Z_FEATURES, Z_ROUNDS
from tickflow.session import cut

TINY = 1e-10


def outlier_bounds(
    df: DataFrame, col: str, keys: Sequence[str], method: str = "mad", n: float = 5.0
) -> DataFrame:
    """(keys, lo, hi) by median absolute deviation, interquartile range or standard deviation."""
    keys = list(keys)
    if method == "mad":
        mid = wide_quantiles(df, keys, [col], {"m": 0.5}).select(*keys, "m")
        far = bounded_join(df, mid, keys).select(*keys, "m", F.abs(F.col(col) - F.col("m")).alias("_d"))
        mad = wide_quantiles(far, keys, ["_d"], {"d": 0.5}).select(*keys, "d")
        half = F.col("d") * 1.4826
        table, lo, hi = mid.join(mad, keys), F.col("m") - half * n, F.col("m") + half * n
        ok = half >= TINY
    elif method == "iqr":
        table = wide_quantiles(df, keys, [col], {"a": 0.25, "b": 0.75})
        width = F.col("b") - F.col("a")
        lo, hi, ok = F.col("a") - width * n, F.col("b") + width * n, F.lit(True)
    elif method == "std":
        table = df.groupBy(*keys).agg(F.avg(col).alias("m"), F.stddev_samp(col).alias("s"))
        lo, hi = F.col("m") - F.col("s") * n, F.col("m") + F.col("s") * n
        ok = F.col("s") >= TINY
    else:
        raise ValueError(f"unknown method {method!r}")
    return table.select(*keys, F.when(ok, lo).alias("_lo"), F.when(ok, hi).alias("_hi"))


def clip_outliers(
    df: DataFrame, col: str, keys: Sequence[str] = ("symbol",), method: str = "mad", n: float = 5.0
) -> DataFrame:
    """Clip to the bounds of the key; unchanged where the spread is nil."""
    bounds = outlier_bounds(df, col, keys, method, n)
    clipped = clip(F.col(col), F.col("_lo"), F.col("_hi"))
    return (
        bounded_join(df, bounds, list(keys), "left")
        .withColumn(col, F.when(F.col("_lo").isNull(), F.col(col)).otherwise(clipped))
        .select(*df.columns)
    )


def default_thresholds() -> dict[str, float]:
    return {f"f{i}": Z_FEATURE.get(FEATURES[i], Z_DEFAULT) for i in Z_FEATURES}


def default_overrides() -> dict[tuple[str, str], float]:
    ids = {name: f"f{i}" for i, name in FEATURES.items()}
    return {(ids[f], s): v for (f, s), v in Z_FEATURE_SYMBOL.items()}


def zscore_bounds(
    df: DataFrame, thresholds: Mapping[str, float] | None = None,
    overrides: Mapping[tuple[str, str], float] | None = None, key: str = "symbol",
    rounds: int = Z_ROUNDS,
) -> DataFrame:
    """Per key the interval of each feature that survives up to ``rounds`` z-score rounds.

    A value removed in one round is outside the statistics of the next.  Being kept means lying
    in the interval of every round, so only the intervals (one row per key) go from round to
    round; the data is aggregated once per round and never rewritten.
    """
    thresholds = default_thresholds() if thresholds is None else dict(thresholds)
    overrides = default_overrides() if overrides is None else dict(overrides)
    cols = list(thresholds)
    inf = float("inf")

    def limit(c):
        out = F.lit(float(thresholds[c]))
        for (feature, symbol), v in overrides.items():
            if feature == c:
                out = F.when(F.col(key) == symbol, float(v)).otherwise(out)
        return out

    bounds = None
    for _ in range(rounds):
        rows = df.select(key, *cols)
        if bounds is not None:
            rows = bounded_join(rows, bounds, key, written=True)
        aggs = []
        for c in cols:
            kept = F.col(c)
            if bounds is not None:
                kept = F.when(F.col(c).between(F.col(f"{c}_lo"), F.col(f"{c}_hi")), F.col(c))
                aggs += [F.first(f"{c}_lo").alias(f"{c}_lo0"), F.first(f"{c}_hi").alias(f"{c}_hi0"), F.first(f"{c}_n").alias(f"{c}_n0")]
            else:
                aggs += [F.lit(-inf).alias(f"{c}_lo0"), F.lit(inf).alias(f"{c}_hi0"), F.lit(None).cast("long").alias(f"{c}_n0")]
            aggs += [F.avg(kept).alias(f"{c}_m"), F.stddev_samp(kept).alias(f"{c}_s"), F.count(kept).alias(f"{c}_n")]
        out = [F.col(key)]
        same = F.lit(True)
        for c in cols:
            spread = F.when(F.col(f"{c}_s") > 0, F.col(f"{c}_s") * limit(c))
            out += [
                F.greatest(f"{c}_lo0", F.coalesce(F.col(f"{c}_m") - spread, F.lit(-inf))).alias(f"{c}_lo"),
                F.least(f"{c}_hi0", F.coalesce(F.col(f"{c}_m") + spread, F.lit(inf))).alias(f"{c}_hi"),
                F.col(f"{c}_n"),
            ]
            same = same & F.col(f"{c}_n").eqNullSafe(F.col(f"{c}_n0"))
        fresh = cut(rows.groupBy(key).agg(*aggs).select(*out, same.alias("_same")))
        changed = fresh.where(~F.col("_same")).limit(1).count()
        bounds = fresh.drop("_same")
        if not changed:
            break
    return bounds


def zscore_clean(df: DataFrame, thresholds=None, overrides=None, key="symbol", rounds=Z_ROUNDS) -> DataFrame:
    """Null every feature value outside its surviving interval."""
    cols = list(default_thresholds() if thresholds is None else thresholds)
    bounds = zscore_bounds(df, thresholds, overrides, key, rounds)
    kept = {
        c: F.when(F.col(c).between(F.col(f"{c}_lo"), F.col(f"{c}_hi")), F.col(c)) for c in cols
    }
    return bounded_join(df, bounds, key, written=True).withColumns(kept).select(*df.columns)


def sanitize_features(df: DataFrame, cols: Sequence[str], price: str = "f6", key: str = "symbol") -> DataFrame:
    """Non-finite to null, non-positive prices to the median of the positive ones, null to 0."""
    cleaned = df.withColumns({c: finite(c) for c in cols})
    if price in cols:
        cleaned = fix_nonpositive(cleaned, [price], [key])
    return cleaned.na.fill(0.0, list(cols))


def sanitize(
    df: DataFrame, cols: Sequence[str], warmup: str = "60 minutes", price: str = "f6",
    thresholds=None, overrides=None, key: str = "symbol", ts: str = "ts",
) -> DataFrame:
    """Warm-up trim, clean-up, z-score removal, interpolation of the removed values, then 0."""
    base = cut(sanitize_features(warmup_trim(df, ts, warmup), cols, price, key))
    removed = zscore_clean(base, thresholds, overrides, key)
    touched = [c for c in (thresholds or default_thresholds()) if c in cols]
    placed = ordered_index(removed, [ts], [key], name="_pos", chunk="_ck")
    filled = interpolate(placed, touched, [key], [ts], "_pos", "_ck")
    return filled.select(*df.columns).na.fill(0.0, list(cols))
