"""Order book from level deltas.

Input columns: the key columns (``symbol``, or ``symbol`` and ``day`` when the book restarts each
day), ``ts``, ``seq``, ``id``, ``side``, ``action``, ``price``, ``size``.  Order is (ts, seq).

The state of the book at any time is an aggregation: a level lives when its last valid insert is
newer than its last removal and not older than the last snapshot.  That gives the book at a time
(``book_state``) and the live levels at the start of each chunk of the tick order
(``checkpoints``) without replaying anything.  Only the per-tick top of book needs a replay, and
each chunk replays on its own from its checkpoint (``operators.replay``, array-wise), so one symbol
spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_type
from pyspark.sql.types import StructField, StructType

from tickflow.functions.clock import from_us, to_us
from tickflow.functions.guards import clip
from tickflow.operators import replay
from tickflow.operators.ordered import carry_before, many_pieces, range_chunks, with_previous_valid
from tickflow.schemas import DEPTH, RETURN_CLIP
from tickflow.session import cut

ORDER = ["us", "seq"]


def _inserts() -> Column:
    return (
        F.col("action").isin("insert", "partial") & (F.col("price") > 0) & (F.col("size") > 0)
    )


def _kills() -> Column:
    return (F.col("action") == "delete") | ((F.col("action") == "update") & (F.col("size") <= 0))


def _sizes() -> Column:
    return _inserts() | ((F.col("action") == "update") & (F.col("size") > 0))


def _level_facts() -> list[Column]:
    at = F.struct(*ORDER)
    return [
        F.max(F.when(_inserts(), F.struct(*ORDER, "price"))).alias("born"),
        F.max(F.when(_kills(), at)).alias("died"),
        F.max(F.when(_sizes(), F.struct(*ORDER, "size"))).alias("sized"),
    ]


def _at(fact: str) -> Column:
    return F.struct(F.col(fact)["us"].alias("us"), F.col(fact)["seq"].alias("seq"))


def _alive(epoch: str) -> Column:
    """Born, not removed since, and not swept away by a later snapshot."""
    return (
        F.col("born").isNotNull()
        & (F.col("died").isNull() | (F.col("died") < _at("born")))
        & (F.col(epoch).isNull() | (_at("born") >= F.col(epoch)))
    )


def snapshot_starts(events: DataFrame, keys: Sequence[str], snapshot: str = "batch") -> DataFrame:
    """(keys, us, seq) of each snapshot start.

    ``batch``: the partial rows of one timestamp are one snapshot.  ``row``: each partial row
    clears the book again.
    """
    rows = events.where(F.col("action") == "partial")
    if snapshot == "row":
        return rows.select(*keys, *ORDER)
    return rows.groupBy(*keys, "us").agg(F.min("seq").alias("seq"))


def _with_us(events: DataFrame) -> DataFrame:
    return events if "us" in events.columns else events.withColumn("us", to_us("ts"))


def book_state(
    events: DataFrame, at: Column | None = None, keys: Sequence[str] = ("symbol",),
    snapshot: str = "batch",
) -> DataFrame:
    """Live levels (keys, side, id, price, size) at a time, or after all rows."""
    rows = _with_us(events)
    if at is not None:
        rows = rows.where(F.col("ts") <= at)
    epochs = snapshot_starts(rows, keys, snapshot).groupBy(*keys).agg(
        F.max(F.struct(*ORDER)).alias("epoch")
    )
    levels = rows.groupBy(*keys, "side", "id").agg(*_level_facts())
    return (
        levels.join(epochs, list(keys), "left")
        .where(_alive("epoch"))
        .select(*keys, "side", "id", F.col("born.price").alias("price"), F.col("sized.size").alias("size"))
    )


def live_facts(events: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Per level the facts its live state follows from: a pure aggregation, so it also runs as a
    streaming aggregation with one small state row per level.

    In the live state an update also moves the level to the update's price when it carries one.
    """
    priced = _inserts() | ((F.col("action") == "update") & (F.col("price") > 0))
    return _with_us(events).groupBy(*keys, "side", "id").agg(
        *_level_facts(), F.max(F.when(priced, F.struct(*ORDER, "price"))).alias("priced")
    )


def epoch_marks(events: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Per key the ``mark`` of its newest snapshot: greatest time, then smallest seq.  Marks of several
    sets of rows are merged by their maximum."""
    mark = F.struct(F.col("us").alias("us"), (-F.col("seq")).alias("neg"))
    return _with_us(events).where(F.col("action") == "partial").groupBy(*keys).agg(F.max(mark).alias("mark"))


def epoch_of(mark: str) -> Column:
    """Snapshot start of a mark."""
    return F.when(F.col(mark).isNotNull(), F.struct(F.col(mark)["us"].alias("us"), (-F.col(mark)["neg"]).alias("seq")))


def live_epochs(events: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Per key the start of its newest snapshot."""
    return epoch_marks(events, keys).select(*keys, epoch_of("mark").alias("epoch"))


def alive_levels(facts: DataFrame, epochs: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """The facts of live levels, given the snapshot starts."""
    return facts.join(epochs, list(keys), "left").where(_alive("epoch"))


def level_values(facts: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    return facts.select(
        *keys, "side", "id", F.col("priced.price").alias("price"), F.col("sized.size").alias("size")
    )


def live_levels(facts: DataFrame, epochs: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Live levels from their facts and the snapshot starts."""
    return level_values(alive_levels(facts, epochs, keys), keys)


def book_by_price(levels: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Size and number of levels per price."""
    return levels.groupBy(*keys, "side", "price").agg(
        F.sum("size").cast("long").alias("size"), F.count(F.lit(1)).alias("levels")
    )


def top_levels(
    levels: DataFrame, depth: int = DEPTH, keys: Sequence[str] = ("symbol",)
) -> DataFrame:
    """Best ``depth`` prices per side with their rank; bids descending, asks ascending."""
    rank = Window.partitionBy(*keys, "side").orderBy(
        F.when(F.col("side") == "Buy", -F.col("price")).otherwise(F.col("price"))
    )
    return (
        book_by_price(levels, keys)
        .withColumn("level", F.row_number().over(rank))
        .where(F.col("level") <= depth)
    )


def market_summary(levels: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Best quotes, level counts, spread (absolute and basis points) and mid per key."""
    buy, sell = F.col("side") == "Buy", F.col("side") == "Sell"
    best = levels.groupBy(*keys).agg(
        F.max(F.when(buy, F.col("price"))).alias("best_bid"),
        F.min(F.when(sell, F.col("price"))).alias("best_ask"),
        F.count(F.when(buy, 1)).alias("bid_levels"),
        F.count(F.when(sell, 1)).alias("ask_levels"),
    )
    mid = (F.col("best_bid") + F.col("best_ask")) / 2
    spread = F.col("best_ask") - F.col("best_bid")
    return best.withColumns(
        {"mid": mid, "spread": spread, "spread_bps": F.when(mid > 0, spread / mid * 10000)}
    )


def chunk_book(
    events: DataFrame, keys: Sequence[str] = ("symbol",), pieces: int | None = None
) -> DataFrame:
    """Cut the book rows in even contiguous chunks; input of the replay operators."""
    need = [*keys, "us", "seq", "id", "side", "action", "price", "size"]
    return range_chunks(_with_us(events).select(*need), keys, ORDER, pieces or many_pieces(events))


def _chunk_epochs(chunked: DataFrame, keys, snapshot) -> DataFrame:
    """Per (keys, chunk): snapshot start in force at its end and before it, the next chunk with
    a snapshot, and the last chunk of the key."""
    # The newest snapshot time of a chunk with its first row (per-row mode: its last row).
    sign = 1 if snapshot == "row" else -1
    mark = F.when(
        F.col("action") == "partial",
        F.struct(F.col("us").alias("us"), (F.col("seq") * sign).alias("seq")),
    )
    per = chunked.groupBy(*keys, "chunk").agg(
        F.max(mark).alias("own"), F.min("us").alias("first_us")
    )
    order = Window.partitionBy(*keys).orderBy("chunk")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    past = order.rowsBetween(Window.unboundedPreceding, 0)
    later = Window.partitionBy(*keys).orderBy(F.desc("chunk")).rowsBetween(Window.unboundedPreceding, -1)
    own = F.struct(F.col("own.us").alias("us"), (F.col("own.seq") * sign).alias("seq"))
    # A snapshot cut by a chunk edge goes on in the next chunk: same time, no new start.
    before = F.last("own", ignorenulls=True).over(earlier)
    fresh = F.col("own").isNotNull()
    if snapshot != "row":
        fresh = fresh & (F.col("_before").isNull() | (F.col("own.us") != F.col("_before.us")))
    starts = per.withColumn("_before", before).withColumn("start", F.when(fresh, own))
    return starts.select(
        *keys, "chunk",
        F.last("start", ignorenulls=True).over(past).alias("epoch"),
        F.last("start", ignorenulls=True).over(earlier).alias("epoch_before"),
        F.min(F.when(F.col("start").isNotNull(), F.col("chunk"))).over(later).alias("next_snapshot"),
        F.max("chunk").over(Window.partitionBy(*keys)).alias("last_chunk"),
        F.lead("first_us").over(order).alias("next_us"),
    )


def checkpoints(
    chunked: DataFrame, keys: Sequence[str] = ("symbol",), snapshot: str = "batch",
    epochs: DataFrame | None = None,
) -> DataFrame:
    """Live levels at the start of each chunk: (keys, chunk, side, id, price, size)."""
    epochs = _chunk_epochs(chunked, keys, snapshot) if epochs is None else epochs
    facts = chunked.groupBy(*keys, "side", "id", "chunk").agg(*_level_facts())
    level = Window.partitionBy(*keys, "side", "id").orderBy("chunk")
    past = level.rowsBetween(Window.unboundedPreceding, 0)
    state = facts.withColumns(
        {
            **{c: F.last(c, ignorenulls=True).over(past) for c in ("born", "died", "sized")},
            "_next": F.lead("chunk").over(level),
        }
    )
    alive = state.join(epochs, [*keys, "chunk"]).where(_alive("epoch"))
    upto = F.least(
        F.coalesce("_next", "last_chunk"), F.coalesce("next_snapshot", "last_chunk")
    )
    return (
        alive.withColumn("_upto", upto)
        .where(F.col("_upto") > F.col("chunk"))
        .select(
            *keys, F.explode(F.sequence(F.col("chunk") + 1, F.col("_upto"))).alias("chunk"),
            "side", "id", F.col("born.price").alias("price"), F.col("sized.size").alias("size"),
        )
    )


NONE = -(1 << 63)
"""Stands for a missing integer between Spark and numpy: a column with nulls would turn to floats
there, which do not hold every integer."""


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(NONE)).alias(name.lstrip("_"))


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    return column.to_numpy()


def _equals(column: pa.ChunkedArray, value: str) -> np.ndarray:
    return pc.fill_null(pc.equal(column, value), False).to_numpy()


def _sides(column: pa.ChunkedArray) -> np.ndarray:
    return pc.fill_null(pc.index_in(column, pa.array(replay.SIDES)), -1).to_numpy().astype(np.int64)


def _deltas(rows: pa.Table) -> replay.Deltas:
    action = rows["action"]
    return replay.Deltas(
        *(_numbers(rows[c]) for c in ORDER), _sides(rows["side"]), *(_numbers(rows[c]) for c in ("id", "price", "size")),
        *(_equals(action, name) for name in ("insert", "update", "delete", "partial")),
    )


def _by_key(table: pa.Table, keys: Sequence[str]) -> dict[tuple, pa.Table]:
    """Rows of each key in a table sorted by the keys; rows with a null key are left out."""
    if not table.num_rows:
        return {}
    edge = np.zeros(table.num_rows, bool)
    edge[0] = True
    for k in keys:
        codes = pc.fill_null(table[k].combine_chunks().dictionary_encode().indices, -1).to_numpy()
        edge[1:] |= codes[1:] != codes[:-1]
    at = np.flatnonzero(edge)
    out = {}
    for lo, hi in zip(at, np.r_[at[1:], table.num_rows]):
        key = tuple(table[k][int(lo)].as_py() for k in keys)
        if None not in key:
            out[key] = table.slice(int(lo), int(hi - lo))
    return out


def _replay(chunked: DataFrame, keys, snapshot, fn, fields: dict[str, pa.DataType]) -> DataFrame:
    """cogroup(checkpoint, chunk) by chunk and run ``fn(rows, lives, clears, next time)`` per key in it."""
    epochs = _chunk_epochs(chunked, keys, snapshot)
    # One marker row per (keys, chunk) tells the snapshot in force and the next chunk's first time;
    # it travels with the checkpoint, so the events themselves are shuffled only once.
    marks = epochs.select(
        *keys, "chunk", F.lit(None).cast("string").alias("side"), F.lit(NONE).alias("id"),
        F.lit(None).cast("double").alias("price"), F.lit(None).cast("double").alias("size"), F.lit(True).alias("mark"),
        F.coalesce("epoch_before.us", F.lit(NONE)).alias("snap_us"), F.coalesce("next_us", F.lit(NONE)).alias("next_us"),
    )
    levels = checkpoints(chunked, keys, snapshot, epochs).select(
        *keys, "chunk", "side", _filled("id"), F.col("price").cast("double").alias("price"), F.col("size").cast("double").alias("size"),
        F.lit(False).alias("mark"), F.lit(NONE).alias("snap_us"), F.lit(NONE).alias("next_us"),
    )
    start = levels.unionByName(marks)
    events = chunked.withColumns(
        {"id": _filled("id"), "price": F.col("price").cast("double"), "size": F.col("size").cast("double")}
    )
    ids = [*keys, "chunk"]
    given = {f.name: f.dataType for f in chunked.schema.fields}
    types = {k: to_arrow_type(given[k]) for k in ids}
    schema = pa.schema([*types.items(), *fields.items()])
    ddl = StructType([StructField(k, given[k]) for k in ids] + [StructField(k, from_arrow_type(t)) for k, t in fields.items()])

    def run(levels: pa.Table, rows: pa.Table) -> pa.Table:
        # A chunk is a contiguous piece of the (keys, time) order: usually one key, or the end of
        # one and the start of the next; with small keys, many whole ones.
        live = _by_key(levels.sort_by([(k, "ascending") for k in keys]), keys)
        ordered = rows.sort_by([(k, "ascending") for k in [*keys, *ORDER]])
        parts = [schema.empty_table()]
        for key, piece in _by_key(ordered, keys).items():
            now = live[key]
            mark = _equals_true(now["mark"])
            marker = now.filter(pa.array(mark)).slice(0, 1)
            now = now.filter(pa.array(~mark))
            known, following = (int(_numbers(marker[c])[0]) for c in ("snap_us", "next_us"))
            d = _deltas(piece)
            before = replay.Levels(_sides(now["side"]), *(_numbers(now[c]) for c in ("id", "price", "size")))
            clears = replay.clearings(d, snapshot, None if known == NONE else known)
            out = fn(d, replay.lives(d, before, clears), None if following == NONE else following)
            size = len(next(iter(out.values())))
            same = [pa.array([piece[k][0].as_py()] * size, types[k]) for k in ids]
            parts.append(pa.Table.from_arrays([*same, *out.values()], schema=schema))
        return pa.concat_tables(parts)

    # Both sides stem from the same chunks; fresh column names keep them apart.
    start, events = start.toDF(*start.columns), events.toDF(*events.columns)
    return start.groupBy("chunk").cogroup(events.groupBy("chunk")).applyInArrow(run, ddl)


def _equals_true(column: pa.ChunkedArray) -> np.ndarray:
    return pc.fill_null(column, False).to_numpy()


def _nullable(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.float64(), from_pandas=True)


LEVELS = pa.list_(pa.struct({"price": pa.float64(), "size": pa.float64()}))


def _levels(best: replay.Best, given: np.ndarray) -> pa.Array:
    """The best levels as lists at the places ``given``, null elsewhere."""
    lengths = np.zeros(len(given), np.int64)
    lengths[given] = best.lengths
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    values = pa.StructArray.from_arrays([pa.array(best.prices), pa.array(best.sizes)], fields=list(LEVELS.value_type))
    return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array(~given))


def book_ticks(
    chunked: DataFrame, keys: Sequence[str] = ("symbol",), depth: int = DEPTH,
    snapshot: str = "batch", depth_every_us: int | None = None,
) -> DataFrame:
    """One row per distinct time: mid and the best ``depth`` levels of both sides.

    Several rows of one time collapse to the state after the last.  With ``depth_every_us`` the
    levels are given only on the last time of each interval (start, start + step], which is all
    that an as-of-bin-start grid reads; other rows have null levels.  ``prev_row_mid`` is the
    valid mid before the last row of the time, for per-row returns.
    """

    def fn(d: replay.Deltas, lives: replay.Lives, following):
        n = len(d.us)
        last = np.flatnonzero(np.r_[d.us[1:] != d.us[:-1], True])
        # A time cut by the chunk edge is reported by the chunk that holds its last row.
        if d.us[-1] == following:
            last = last[:-1]
        us = d.us[last]
        full = np.full(len(last), depth > 0)
        if depth and depth_every_us:
            ends = -(-us // depth_every_us)
            after = np.r_[d.us, 0][np.minimum(last + 1, n)]
            full = (last == n - 1) | (ends != -(-after // depth_every_us))
        rows = np.arange(-1, n)
        bids, asks = (replay.sweep(replay.changes(lives, s, n), rows, last[full], depth) for s in (0, 1))
        # The state before the first row stands at 0, that after row i at i + 1.
        mid = (bids.top + asks.top) / 2
        valid = replay.last_valid(mid)
        # One row more: the last valid mid of the chunk's rows, for a time that goes on in a later chunk.
        given = np.r_[full, False]
        return {
            "us": pa.array(np.r_[us, d.us[-1]], pa.int64()),
            "mid": _nullable(np.r_[mid[last + 1], valid[-1]]),
            "prev_row_mid": _nullable(np.r_[valid[last], np.nan]),
            "bids": _levels(bids, given),
            "asks": _levels(asks, given),
            "leaving": pa.array(np.r_[np.zeros(len(last), bool), True]),
        }

    ticks = _replay(
        chunked, keys, snapshot, fn,
        {"us": pa.int64(), "mid": pa.float64(), "prev_row_mid": pa.float64(), "bids": LEVELS, "asks": LEVELS,
         "leaving": pa.bool_()},
    )
    # Read twice: the ticks, and what each chunk hands on.
    ticks = cut(ticks)
    hands = carry_before(
        ticks.where("leaving").select(*keys, "chunk", "us", F.col("mid").alias("mid")), ["mid"], keys, ["us"], "chunk"
    )
    ticks = (
        ticks.where("NOT leaving").join(hands, [*keys, "chunk"], "left")
        .withColumn("prev_row_mid", F.coalesce("prev_row_mid", "_before_mid"))
    )

    return ticks.select(
        *keys, "chunk", "us", from_us("us").alias("ts"), "mid", "prev_row_mid", "bids", "asks",
    )


def relabel_kills(
    chunked: DataFrame, keys: Sequence[str] = ("symbol",), snapshot: str = "batch"
) -> DataFrame:
    """(keys, seq) of each ``update`` to size 0 that removed a live level, to be read as delete."""

    def fn(d: replay.Deltas, lives: replay.Lives, following):
        at = np.sort(lives.pos[lives.was_alive & ~lives.alive])
        at = at[d.update[at]]
        return {"us": pa.array(d.us[at], pa.int64()), "seq": pa.array(d.seq[at], pa.int64())}

    return _replay(chunked, keys, snapshot, fn, {"us": pa.int64(), "seq": pa.int64()}).drop("chunk")


def tick_returns(
    ticks: DataFrame, keys: Sequence[str] = ("symbol",), returns: str = "tick",
    limit: float = RETURN_CLIP, chunk: str | None = "chunk",
) -> DataFrame:
    """Add ``log_return``: ln(mid / previous valid mid) clipped; 0 where undefined.

    ``returns='row'`` compares with the valid mid before the last row of the same time.
    """
    out = with_previous_valid(ticks, "mid", keys, ["us"], chunk, name="_prev")
    prev = F.col("_prev")
    if returns == "row":
        prev = F.coalesce("prev_row_mid", "_prev")
    value = clip(F.log(F.col("mid") / prev), -limit, limit)
    return out.withColumn("log_return", F.coalesce(value, F.lit(0.0))).drop("_prev")


def flatten_levels(ticks: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Wide form: bid/ask price/size of level 1..depth as columns, 0 where absent."""
    cols = []
    for side in ("bid", "ask"):
        for field in ("price", "size"):
            cols += [
                F.coalesce(F.get(F.col(side + "s"), F.lit(i))[field], F.lit(0.0)).alias(
                    f"{side}_{field}_L{i + 1}"
                )
                for i in range(depth)
            ]
    keep = [c for c in ticks.columns if c not in ("bids", "asks")]
    return ticks.select(*keep, *cols)
