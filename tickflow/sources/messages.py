"""Raw exchange messages (one JSON text per row) to typed feed rows, batch or streaming.

Input: ``offset`` (long, ingest position of the message) and ``value`` (text).  A row's ``seq`` is
(offset, position in the message), which is the tie-break for equal timestamps everywhere.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.functions.clock import to_us
from tickflow.operators.typing import clamp_ts, epoch_seconds
from tickflow.schemas import FEEDS, MESSAGE_TABLES

SEQ_STRIDE = 1_000_000
CONTROL_KINDS = ("info", "subscribe", "error", "success")

# Data fields are read as text and cast by the projections, so that one bad field costs one row.
_FIELDS = sorted({f for s in FEEDS.values() for f in s.fieldNames()} - {"action"})
_ROW = T.StructType([T.StructField(f, T.StringType()) for f in _FIELDS])
MESSAGE = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("action", T.StringType()),
        T.StructField("data", T.ArrayType(_ROW)),
        *[T.StructField(k, T.StringType()) for k in CONTROL_KINDS],
        T.StructField("_corrupt", T.StringType()),
    ]
)


def parse_messages(raw: DataFrame) -> DataFrame:
    """Add the parsed message ``m`` and its ``kind``: data, a control kind, other or malformed."""
    parsed = raw.withColumn(
        "m",
        F.from_json("value", MESSAGE, {"columnNameOfCorruptRecord": "_corrupt", "mode": "PERMISSIVE"}),
    )
    kind = F.when(F.col("m").isNull() | F.col("m._corrupt").isNotNull(), "malformed").when(
        F.col("m.table").isNotNull(), "data"
    )
    for name in CONTROL_KINDS:
        kind = kind.when(F.col(f"m.{name}").isNotNull(), name)
    return parsed.withColumn("kind", kind.otherwise("other"))


def control_counts(parsed: DataFrame) -> DataFrame:
    """Messages per kind."""
    return parsed.groupBy("kind").agg(F.count(F.lit(1)).alias("messages"))


def route(
    parsed: DataFrame, feeds: Sequence[str] | None = None, symbols: Sequence[str] | None = None
) -> DataFrame:
    """One row per data element: offset, pos, feed, action and the text fields."""
    table = F.col("m.table")
    feed = F.lit(None).cast("string")
    for name, target in MESSAGE_TABLES.items():
        feed = F.when(table == name, target).otherwise(feed)
    received = ["received"] if "received" in parsed.columns else []
    rows = (
        parsed.where(F.col("kind") == "data")
        .withColumn("feed", feed)
        .where(F.col("feed").isNotNull())
        .select("offset", *received, "feed", F.col("m.action").alias("action"), F.posexplode("m.data").alias("pos", "d"))
    )
    if feeds is not None:
        rows = rows.where(F.col("feed").isin(list(feeds)))
    out = rows.select("offset", "pos", *received, "feed", "action", "d.*").withColumn(
        "seq", F.col("offset") * SEQ_STRIDE + F.col("pos")
    )
    return out if symbols is None else out.where(F.col("symbol").isin(list(symbols)))


def _cast(name: str, kind: str) -> Column:
    """A number from its text.  Whole numbers may be written ``100.0`` or ``1e9``; null if it is none."""
    if kind == "double":
        return F.col(name).try_cast(kind)
    exact = F.col(name).try_cast("decimal(38,10)")
    return F.when(exact == F.floor(exact), exact.try_cast(kind))


def _broken() -> Column:
    """The first number field, by name, that does not parse as what it is stored as, else null."""
    bad = F.lit(None).cast("string")
    numbers = {
        f.name: f.dataType.simpleString()
        for s in FEEDS.values() for f in s.fields
        if not isinstance(f.dataType, T.StringType) and "imestamp" not in f.name
    }
    for name, kind in sorted(numbers.items()):
        broken = F.col(name).isNotNull() & _cast(name, "double" if kind in ("float", "double") else kind).isNull()
        bad = F.when(broken, F.lit(f"bad {name}")).otherwise(bad)
    return bad


def good_rows(rows: DataFrame) -> DataFrame:
    """The routed rows whose numbers all parse; the others are those of ``quarantine``."""
    return rows.where(_broken().isNull())


def _event_time(ref: Column | None) -> Column:
    """Epoch seconds; outside 24 h of ``ref`` the reference time, without ``ref`` as given."""
    seconds = epoch_seconds("timestamp")
    if ref is None:
        return seconds
    ts = F.timestamp_micros((seconds * 1e6).cast("long")).cast("timestamp_ntz")
    return F.round(to_us(clamp_ts(ts, ref)) / F.lit(1e6), 3)


def trades(rows: DataFrame, ref: Column | None = None) -> DataFrame:
    return rows.where(F.col("feed") == "trades").select(
        "seq", _event_time(ref).alias("timestamp"), "trdMatchID", "symbol",
        _cast("price", "double").alias("price"), _cast("size", "int").alias("size"),
        F.coalesce(_cast("homeNotional", "double"), F.lit(0.0)).alias("homeNotional"),
        F.coalesce(_cast("foreignNotional", "double"), F.lit(0.0)).alias("foreignNotional"),
        "side", "tickDirection",
        F.coalesce(_cast("grossValue", "bigint"), F.lit(0)).alias("grossValue"),
    )


def liquidations(rows: DataFrame, ref: Column | None = None) -> DataFrame:
    """``orderQty`` is the executed quantity ``cumQty``."""
    executed = F.coalesce(_cast("cumQty", "int"), F.lit(0))
    return rows.where(F.col("feed") == "liquidations").select(
        "seq", _event_time(ref).alias("timestamp"), "orderID", "symbol", "side",
        executed.alias("orderQty"), _cast("price", "double").alias("price"),
        F.coalesce(_cast("leavesQty", "int"), F.lit(0)).alias("leavesQty"),
        executed.alias("cumQty"), "ordType", "timeInForce",
    )


def instruments(rows: DataFrame, ref: Column | None = None) -> DataFrame:
    """Absent fields stay null: an update carries only what changed."""
    doubles = ["fundingRate", "indicativeFundingRate", "markPrice", "indexPrice", "settlementPrice", "turnover24h"]
    return rows.where(F.col("feed") == "instruments").select(
        "seq", _event_time(ref).alias("timestamp"), "symbol",
        _cast("openInterest", "bigint").alias("openInterest"),
        *[_cast(c, "double").alias(c) for c in doubles],
        epoch_seconds("fundingTimestamp").alias("fundingTimestamp"),
        _cast("volume24h", "bigint").alias("volume24h"),
    )


def book_deltas(rows: DataFrame, received: Column | None = None) -> DataFrame:
    """Rows without id or symbol are dropped; time is the time of receipt."""
    ident = _cast("id", "bigint")
    time = epoch_seconds("timestamp") if received is None else received
    return (
        rows.where(F.col("feed") == "orderbook")
        .where(ident.isNotNull() & (ident != 0) & F.col("symbol").isNotNull() & (F.col("symbol") != ""))
        .select(
            "seq", time.alias("timestamp"), ident.alias("id"), "symbol", "side",
            _cast("price", "double").alias("price"), _cast("size", "int").alias("size"), "action",
        )
    )


def quarantine(parsed: DataFrame) -> DataFrame:
    """Malformed messages, and data rows whose number fields do not parse, with a reason."""
    messages = parsed.where(F.col("kind") == "malformed").select(
        "offset", F.lit(-1).alias("pos"), F.lit(None).cast("string").alias("feed"),
        F.lit("malformed message").alias("reason"),
    )
    rows = route(parsed)
    flagged = rows.withColumn("reason", _broken()).where(F.col("reason").isNotNull())
    return messages.unionByName(flagged.select("offset", "pos", "feed", "reason"))
