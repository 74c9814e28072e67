"""Structured Streaming forms of the feed operators.

Sinks go through ``foreachBatch`` and write each batch to its own place, so a batch repeated after
a failure replaces itself.  Keyed state is either a native streaming aggregation (one small state
row per trade id, book level or window) or a table carried from batch to batch, so that a hot
symbol is never one task's state.
"""

from __future__ import annotations

import functools
import json
import logging
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tickflow.functions.clock import to_us
from tickflow.operators import book as bk
from tickflow.operators.dedup import throttle
from tickflow.operators.typing import epoch_to_ts
from tickflow.plans.features import signed_flow
from tickflow.schemas import DEDUP_KEYS, DEPTH
from tickflow.session import cut
from tickflow.sources import messages as ms
from tickflow.sources.parquet import write_batch

log = logging.getLogger("tickflow")
Hook = Callable[[DataFrame, int], None]
MESSAGES = T.StructType(
    [T.StructField("offset", T.LongType()), T.StructField("value", T.StringType()), T.StructField("received", T.DoubleType())]
)
"""``received``: epoch seconds at which the message arrived."""
PROJECTIONS = {
    "trades": ms.trades, "orderbook": ms.book_deltas, "liquidations": ms.liquidations,
    "instruments": ms.instruments,
}


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files: int | None = None) -> DataFrame:
    """A folder of Parquet files as a stream; a message bus delivers the same columns."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    return reader.parquet(path)


def _start(stream: DataFrame, fn: Hook, checkpoint: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).outputMode(mode)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def ingest(
    messages: DataFrame, root: str, checkpoint: str, feeds: Sequence[str] | None = None,
    symbols: Sequence[str] | None = None, hooks: Mapping[str, Sequence[Hook]] | None = None,
    every: str | None = None, dedup_us: int | None = None,
    throttles: Mapping[str, tuple[Column, int]] | None = None, book: bool = False,
) -> StreamingQuery:
    """Raw messages to one partitioned Parquet folder per feed, bad rows to ``quarantine``.

    With ``dedup_us`` rows that repeat an earlier row's keys (``DEDUP_KEYS``) are not stored: of one
    batch the first passes, and keys of earlier batches are remembered for so many microseconds of
    event time (``seen`` beside the feeds), also over restarts.  Then ``throttles`` (feed to (rows that
    always pass, gap in microseconds)) thins feeds, and with ``book`` the live book is kept in ``live``
    and kills of the order book are stored as deletes (``advance_book``).

    Book rows carry the time of receipt, and the other feeds' times are held within 24 hours of
    it, where the messages tell it (``received``).  Rows whose numbers do not parse are not stored.

    ``hooks`` maps a feed to callables that get each batch of it; one that fails is logged and
    does not stop the stream.  ``every`` is the flush interval; without it the query drains what
    is there and stops.
    """
    wanted = list(feeds or PROJECTIONS)
    hooks = hooks or {}

    def flush(batch: DataFrame, number: int) -> None:
        parsed = ms.parse_messages(batch).persist()
        try:
            rows = ms.good_rows(ms.route(parsed, wanted, symbols))
            told = F.col("received") if "received" in rows.columns else None
            for feed in wanted:
                time = told if told is None or feed == "orderbook" else epoch_to_ts(told)
                typed = PROJECTIONS[feed](rows, time).withColumn("ts", epoch_to_ts("timestamp"))
                if dedup_us is not None:
                    typed = first_arrivals(typed, DEDUP_KEYS[feed], f"{root}/seen/{feed}", number, dedup_us)
                if feed in (throttles or {}):
                    typed = advance_throttle(typed, f"{root}/throttle/{feed}", number, *throttles[feed])
                if book and feed == "orderbook":
                    typed = advance_book(typed, f"{root}/live", number)
                write_batch(typed, f"{root}/{feed}", number)
                for hook in hooks.get(feed, ()):
                    run_hook(hook, typed, number)
            bad = ms.quarantine(parsed).withColumn("batch", F.lit(number))
            bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{root}/quarantine")
        finally:
            parsed.unpersist()

    return _start(messages, flush, checkpoint, every=every)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``; None before anything was written there."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def first_arrivals(batch: DataFrame, keys: Sequence[str], seen: str, number: int, horizon_us: int) -> DataFrame:
    """The rows of a batch whose keys no row of the last ``horizon_us`` had; of equal keys the first by ``seq``.

    Rows with a null or empty key are no copies of each other.  Keys that pass are written to ``seen``, a
    folder for each batch: a batch that is repeated after a failure replaces its own and does not meet
    itself.  Only keys within the horizon are read again, so what is joined does not grow with the history.
    """
    spark = batch.sparkSession
    known = functools.reduce(lambda a, b: a & b, [F.coalesce(F.col(k).cast("string") != "", F.lit(False)) for k in keys])
    rest = [c for c in batch.columns if c not in keys]
    first = (
        batch.where(known).groupBy(*keys).agg(F.min_by(F.struct(*rest), "seq").alias("_r"))
        .select(*keys, "_r.*").select(*batch.columns)
    )
    before = _stored(spark, seen)
    if before is not None:
        low = batch.agg(F.min(to_us("ts"))).first()[0]
        recent = before.where((F.col("batch") < number) & (F.col("us") >= F.lit((low or 0) - horizon_us)))
        first = first.join(recent.select(*keys).distinct(), list(keys), "left_anti")
    # Computed once: what is stored and what is remembered are the same rows.
    first = cut(first)
    _own_folder(first.select(*keys, to_us("ts").alias("us")), number, seen)
    return first.unionByName(batch.where(~known))


def run_hook(hook: Hook, batch: DataFrame, number: int) -> bool:
    """Call a user hook; a failure is logged, not raised."""
    try:
        hook(batch, number)
        return True
    except Exception:  # noqa: BLE001 - any user error
        log.exception("hook %s failed on batch %s", getattr(hook, "__name__", hook), number)
        return False


def _event_time(rows: DataFrame, ts: str) -> DataFrame:
    """Watermarks need TIMESTAMP; the session time zone is UTC, so the wall clock is the same."""
    return rows.withColumn(ts, F.col(ts).cast("timestamp"))


def dedup_stream(rows: DataFrame, key: str, ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """First arrival of each id; ids are forgotten once the watermark has passed them.

    Rows without an id are no copies of each other and all pass.
    """
    timed = _event_time(rows, ts).withWatermark(ts, delay)
    has_id = F.coalesce(F.col(key) != "", F.lit(False))
    first = timed.where(has_id).dropDuplicatesWithinWatermark([key])
    return first.unionByName(timed.where(~has_id)).withColumn(ts, F.col(ts).cast("timestamp_ntz"))


def _own_folder(rows: DataFrame, number: int, path: str) -> None:
    rows.withColumn("batch", F.lit(number)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("batch").parquet(path)


def write_rows(
    rows: DataFrame, path: str, checkpoint: str, mode: str = "append",
    metrics: tuple[str, str, Column] | None = None,
) -> StreamingQuery:
    """Each batch to its own ``batch=n`` folder.

    ``metrics`` (path, name, error condition) keeps one row for every batch in a table of their own:
    name, rows, errors, seconds.  They are counted while the batch is written.
    """

    def save(batch: DataFrame, number: int) -> None:
        if metrics is None:
            _own_folder(batch, number, path)
            return
        target, name, bad = metrics
        seen, began = Observation(f"{name}_{number}"), time.time()
        _own_folder(
            batch.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(bad, 1)).alias("errors")), number, path
        )
        got = seen.get
        row = [(name, got["rows"], got["errors"], time.time() - began)]
        _own_folder(
            batch.sparkSession.createDataFrame(row, "name string, rows long, errors long, seconds double"), number, target
        )

    return _start(rows, save, checkpoint, mode)


def latest(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Newest version of each key in an update-mode output."""
    df = spark.read.parquet(path)
    rest = [c for c in df.columns if c not in [*keys, "batch"]]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_r")).select(*keys, "_r.*")


def _slot(path: str, number: int) -> str:
    """Where the state after batch ``number`` lies.

    Two places take turns: a batch reads what the one before it left and overwrites the older one, so
    state does not pile up, and a batch repeated after a failure still finds its start.
    """
    return f"{path}/slot={number % 2}"


def _state(spark: SparkSession, path: str, number: int) -> DataFrame | None:
    """The state before batch ``number``; None before the first."""
    return spark.read.parquet(_slot(path, number - 1)) if number > 0 else None


def _newest(table: DataFrame, start: DataFrame | None, keys: Sequence[str], facts: Sequence[str]) -> DataFrame:
    """Both tables' facts by key, the greatest of each."""
    both = table if start is None else table.unionByName(start, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*[F.max(c).alias(c) for c in facts])


LEVEL_KEYS = ["symbol", "side", "id"]


def _as_rows(levels: DataFrame, epochs: DataFrame, like: DataFrame) -> DataFrame:
    """Live levels as the delta rows that would build them."""
    # Levels of the snapshot in force stay snapshot rows: more rows of its time are no new snapshot.
    of_snapshot = F.coalesce(F.col("born.us") == F.col("epoch.us"), F.lit(False))
    rows = levels.join(epochs, ["symbol"], "left").select(
        *LEVEL_KEYS, F.when(of_snapshot, "partial").otherwise("insert").alias("action"), F.col("born.us").alias("us"),
        F.col("born.seq").alias("seq"), F.col("priced.price").alias("price"), F.col("sized.size").alias("size"),
    )
    return rows.select(*[F.col(c).cast(like.schema[c].dataType) for c in like.columns])


def advance_book(batch: DataFrame, root: str, number: int, depth: int = DEPTH) -> DataFrame:
    """Bring the live book at ``root`` past a batch of deltas; the batch with kills relabelled.

    The state holds a row for each live level and one for each symbol's snapshot, nothing else: removed
    levels leave it and a snapshot clears it.  ``top`` takes the best ``depth`` prices of the symbols
    whose best prices the batch changed.  An ``update`` to size 0 that removes a level of the live book
    becomes a ``delete``.  Batches must arrive in time order for each symbol, as feed messages do.
    """
    spark = batch.sparkSession
    level_path, epoch_path = f"{root}/levels", f"{root}/epochs"
    levels, epochs = _state(spark, level_path, number), _state(spark, epoch_path, number)
    rows = batch.withColumn("us", to_us("ts"))
    need = [*LEVEL_KEYS, "action", "us", "seq", "price", "size"]
    replayed = rows.select(*need)
    if levels is not None:
        replayed = replayed.unionByName(_as_rows(levels, epochs, replayed))
    kills = bk.relabel_kills(bk.chunk_book(replayed)).distinct().withColumn("_kill", F.lit(True))
    told = cut(
        rows.join(kills, ["symbol", "us", "seq"], "left")
        .withColumn("action", F.when(F.col("_kill") & (F.col("action") == "update"), "delete").otherwise(F.col("action")))
        .select(*batch.columns)
    )
    facts = ["born", "died", "sized", "priced"]
    merged = _newest(bk.live_facts(batch), levels, LEVEL_KEYS, facts)
    now_epochs = _newest(bk.epoch_marks(batch), epochs, ["symbol"], ["mark"])
    now_epochs = now_epochs.withColumn("epoch", bk.epoch_of("mark"))
    now_epochs.write.mode("overwrite").parquet(_slot(epoch_path, number))
    now_epochs = spark.read.parquet(_slot(epoch_path, number))
    alive = bk.alive_levels(merged, now_epochs).select(*LEVEL_KEYS, "born", "sized", "priced")
    alive.write.mode("overwrite").parquet(_slot(level_path, number))

    def best(state: DataFrame) -> DataFrame:
        tops = bk.top_levels(bk.level_values(state), depth)
        return tops.groupBy("symbol").agg(
            F.array_sort(F.collect_list(F.struct("side", "level", "price", "size", "levels"))).alias("top")
        )

    new = best(spark.read.parquet(_slot(level_path, number)))
    if levels is None:
        changed = new
    else:
        # Only symbols of the batch can have changed; one that lost its last level has an empty top.
        touched = rows.select("symbol").distinct()
        old = best(levels.join(touched, ["symbol"], "left_semi")).withColumnRenamed("top", "before")
        both = new.join(touched, ["symbol"], "left_semi").join(old, ["symbol"], "full")
        changed = both.where(~F.col("top").eqNullSafe(F.col("before"))).select(
            "symbol", F.coalesce("top", F.slice("before", 1, 0)).alias("top")
        )
    _own_folder(changed, number, f"{root}/top")
    # Last: from here on readers take this batch's state.
    spark.createDataFrame([(number,)], "number long").write.mode("overwrite").parquet(_slot(f"{root}/head", number))
    return told


def book_stream(deltas: DataFrame, path: str, checkpoint: str, depth: int = DEPTH) -> StreamingQuery:
    """Keep the live book (``advance_book``) and store the deltas with kills relabelled in ``rows``."""

    def flush(batch: DataFrame, number: int) -> None:
        _own_folder(advance_book(batch, path, number, depth), number, f"{path}/rows")

    return _start(deltas, flush, checkpoint)


def live_book(spark: SparkSession, path: str) -> DataFrame:
    """The book as the last whole batch left it."""
    number = spark.read.parquet(f"{path}/head").agg(F.max("number")).first()[0]
    return bk.level_values(spark.read.parquet(_slot(f"{path}/levels", number)))


def advance_throttle(batch: DataFrame, state: str, number: int, always: Column, gap_us: int) -> DataFrame:
    """The rows of a batch that pass the throttle after those of earlier batches; ``state`` keeps the last
    accepted time of each symbol."""
    start = _state(batch.sparkSession, state, number)
    kept = cut(throttle(batch.withColumn("us", to_us("ts")), always, gap_us=gap_us, start=start))
    last = _newest(kept.select("symbol", F.col("us").alias("last")), start, ["symbol"], ["last"])
    last.write.mode("overwrite").parquet(_slot(state, number))
    return kept.drop("us")


def throttle_stream(
    rows: DataFrame, path: str, checkpoint: str, always: Column, gap_us: int = 1_000_000,
) -> StreamingQuery:
    """Throttle by symbol across batches; the last accepted time per symbol is a table.

    Batches must arrive in time order per symbol, as feed messages do.
    """

    def flush(batch: DataFrame, number: int) -> None:
        _own_folder(advance_throttle(batch, f"{path}/state", number, always, gap_us), number, f"{path}/rows")

    return _start(rows, flush, checkpoint)


def taker_imbalance_stream(
    trades: DataFrame, interval: str, delay: str = "10 minutes"
) -> DataFrame:
    """Signed notional per symbol and tumbling bin; update or append mode."""
    flow = _event_time(trades, "ts").withWatermark("ts", delay).groupBy("symbol", F.window("ts", interval).alias("w")).agg(
        F.sum(signed_flow()).alias("flow")
    )
    value = F.signum("flow") * F.log1p(F.abs("flow"))
    return flow.select("symbol", F.col("w.start").cast("timestamp_ntz").alias("ts"), value.alias("f4"))


def observed(rows: DataFrame, name: str, error: Column | None = None) -> DataFrame:
    """Attach row and error counts to a stream; they show up in its progress."""
    bad = F.lit(False) if error is None else error
    return rows.observe(name, F.count(F.lit(1)).alias("rows"), F.count(F.when(bad, 1)).alias("errors"))


def progress_rows(query: StreamingQuery, name: str) -> list[tuple]:
    """(batch, rows, errors, rows per second) of the recent batches of an observed query."""
    out = []
    for p in query.recentProgress:
        p = p if isinstance(p, dict) else json.loads(p.json)
        got = (p.get("observedMetrics") or {}).get(name)
        if got:
            out.append((p["batchId"], got["rows"], got["errors"], float(p.get("processedRowsPerSecond") or 0.0)))
    return out


class MetricsListener(StreamingQueryListener):
    """Passes (name, batch, rows, errors, rows per second) of each batch to a callable."""

    def __init__(self, name: str, report: Callable[..., None]):
        self.name, self.report = name, report

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        p = event.progress
        got = p.observedMetrics.get(self.name)
        if got is not None:
            self.report(self.name, p.batchId, got["rows"], got["errors"], p.processedRowsPerSecond)

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass
