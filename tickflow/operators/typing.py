"""Typing, timestamp normalisation and value clean-up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.functions.guards import finite
from tickflow.operators.joins import bounded_join
from tickflow.operators.quantiles import exact_quantiles


def _default(kind: T.DataType):
    return "" if isinstance(kind, T.StringType) else 0


def enforce_schema(df: DataFrame, schema: T.StructType, null_policy: str = "keep") -> DataFrame:
    """Select exactly the declared columns with the declared types.

    ``keep`` leaves missing, null and unparseable values null; ``zero`` replaces them by a typed
    default (0 or '').
    """
    if null_policy not in ("keep", "zero"):
        raise ValueError(f"unknown null_policy {null_policy!r}")

    def column(field: T.StructField) -> Column:
        kind = field.dataType
        value = F.lit(None).cast(kind)
        if field.name in df.columns:
            raw = F.col(field.name)
            if isinstance(kind, (T.IntegerType, T.LongType)):
                # A number text such as "3.0" is an integer too.
                raw = raw.try_cast("double")
            value = raw.try_cast(kind)
        if null_policy == "zero":
            value = F.coalesce(value, F.lit(_default(kind)).cast(kind))
        return value.alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def epoch_seconds(value: Column | str) -> Column:
    """Number, number text or timestamp text to epoch seconds, rounded to milliseconds."""
    c = F.col(value) if isinstance(value, str) else value
    text = c.cast("string")
    number = text.try_cast("double")
    parsed = F.unix_micros(F.try_to_timestamp(text)) / F.lit(1e6)
    return F.round(F.coalesce(number, parsed), 3)


def epoch_to_ts(value: Column | str) -> Column:
    """Epoch seconds to TIMESTAMP_NTZ (UTC), to the microsecond."""
    c = F.col(value) if isinstance(value, str) else value
    return F.timestamp_micros(F.round(c * F.lit(1e6)).cast("long")).cast("timestamp_ntz")


def clamp_ts(ts: Column, ref: Column, hours: int = 24) -> Column:
    """The timestamp when within ``hours`` of the reference time, else the reference time."""
    span = F.expr(f"INTERVAL {hours} HOURS")
    return F.when((ts >= ref - span) & (ts <= ref + span), ts).otherwise(ref)


def zero_nonfinite(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Infinite, NaN and null to 0, all columns in one projection."""
    return df.withColumns({c: F.coalesce(finite(c), F.lit(0.0)) for c in cols})


def fix_nonpositive(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("symbol",)
) -> DataFrame:
    """Replace values <= 0 by the exact median of the positive ones of the key (1.0 if none)."""
    positive = df.select(
        *keys, *[F.when(F.col(c) > 0, F.col(c).cast("double")).alias(c) for c in cols]
    )
    medians = exact_quantiles(positive, list(keys), list(cols), [0.5])
    wide = medians.groupBy(*keys).agg(
        *[F.max(F.when(F.col("name") == c, F.col("value"))).alias("_m_" + c) for c in cols]
    )
    fixed = {
        c: F.when(F.col(c) <= 0, F.coalesce("_m_" + c, F.lit(1.0))).otherwise(F.col(c))
        for c in cols
    }
    return bounded_join(df, wide, list(keys), "left").withColumns(fixed).select(*df.columns)
