"""Dedup and throttling.

Dedup is an aggregation by key (max_by / min_by over a struct), never a ranking window: partial
aggregation folds copies before the shuffle, so one key holding a third of all rows is no problem.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickflow.operators.ordered import many_pieces, range_chunks
from tickflow.session import cut


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(
        pick(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return kept.select(*keys, "_row.*").select(*df.columns)


def dedup_first(df: DataFrame, key: str, order: Sequence[str] = ("seq",)) -> DataFrame:
    """First row per id wins; rows with a null or empty id all pass."""
    has_id = F.col(key).isNotNull() & (F.col(key) != "")
    kept = _pick(df.where(has_id), [key], order, F.min_by)
    return kept.unionByName(df.where(~has_id | F.col(key).isNull()))


def dedup_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("seq",), ident: str | None = None
) -> DataFrame:
    """Last row per key wins.  Null key values form one group, as in a merge by key.

    ``ident`` names a key that is an id: rows where it is null or empty are no copies of each
    other and all pass.
    """
    if ident is None:
        return _pick(df, list(keys), order, F.max_by)
    has_id = F.coalesce(F.col(ident) != "", F.lit(False))
    return _pick(df.where(has_id), list(keys), order, F.max_by).unionByName(df.where(~has_id))


def duplicate_report(df: DataFrame, key: str, by: Sequence[str] = ("symbol",)) -> DataFrame:
    """Rows, distinct ids and surplus rows per group."""
    per_id = df.groupBy(*by, key).agg(F.count(F.lit(1)).alias("n"))
    return per_id.groupBy(*by).agg(
        F.sum("n").alias("rows"),
        F.count(key).alias("distinct_ids"),
        F.sum(F.when(F.col(key).isNotNull(), F.col("n") - 1).otherwise(0)).alias("duplicates"),
    )


def _next_accepted(us: np.ndarray, always: np.ndarray, gap: int) -> np.ndarray:
    """For each row taken as accepted the place of the next accepted one, ``len(us)`` if none."""
    n = len(us)
    at = np.arange(n)
    must = np.minimum.accumulate(np.r_[np.where(always, at, n), n][::-1])[::-1]
    return np.minimum(np.maximum(np.searchsorted(us, us + gap, side="left"), at + 1), must[1:])


def _first_accepted(us: np.ndarray, always: np.ndarray, gap: int, last: int | None) -> int:
    """Place of the first accepted row after an accepted time, ``len(us)`` if none."""
    if last is None:
        return 0
    must = np.flatnonzero(always)
    far = int(np.searchsorted(us, last + gap, side="left"))
    return min(far, int(must[0])) if len(must) else far


def _greedy(us: np.ndarray, always: np.ndarray, gap: int, last: int | None):
    """Accepted flags of one ordered run, given the last accepted time before it."""
    keep = np.zeros(len(us), dtype=bool)
    follow = _next_accepted(us, always, gap)
    i = _first_accepted(us, always, gap, last)
    while i < len(us):
        keep[i] = True
        i = int(follow[i])
    return keep


def _exits(us: np.ndarray, always: np.ndarray, gap: int) -> np.ndarray:
    """For each row taken as accepted: time of the last row accepted in this run."""
    n = len(us)
    follow = _next_accepted(us, always, gap)
    ends = np.where(follow < n, follow, np.arange(n))
    while True:
        further = ends[ends]
        if np.array_equal(further, ends):
            return us[ends].astype("int64")
        ends = further


def _candidates(us: np.ndarray, always: np.ndarray, gap: int) -> int:
    """How many leading rows can be the first one accepted, whatever was accepted before them: up to the
    first that must be, or that lies a gap behind the first row."""
    must = np.flatnonzero(always)
    stop = int(np.searchsorted(us, us[0] + gap, side="left"))
    return min(stop, int(must[0]) if len(must) else stop, len(us) - 1) + 1


FOLD = 64
"""Runs composed at once when the maps of the chunks are chained."""


def _compose(parts: list[pd.DataFrame], gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entry, must, exit) of consecutive runs taken as one."""
    entry, must, leave = (np.zeros(0, "int64"), np.zeros(0, bool), np.zeros(0, "int64"))
    for part in reversed(parts):
        e, m, x = (part[c].to_numpy() for c in ("entry", "must", "exit"))
        if len(entry):
            # Where a row leaves this run decides where the later ones are entered.
            at = np.searchsorted(entry, x + gap, side="left")
            hits = np.flatnonzero(must)
            at = np.minimum(at, hits[0]) if len(hits) else at
            x = np.where(at < len(entry), np.r_[leave, 0][at], x)
        entry, must, leave = np.r_[e, entry], np.r_[m.astype(bool), must], np.r_[x, leave]
        n = _candidates(entry, must, gap)
        entry, must, leave = entry[:n], must[:n], leave[:n]
    return entry, must, leave


def _chunk_entries(maps: DataFrame, key: str, gap: int, chunks: int) -> DataFrame:
    """(key, _c, _entry): the last accepted time before each chunk.

    ``maps`` has (key, _c, entry, must, exit, _start).  Maps of ``FOLD`` consecutive runs are composed
    to one, level by level, until one run is left for a key; the entry times then go down the same
    levels.  No task sees more than ``FOLD`` runs, and a run is described by the rows of one gap.
    """
    shape = f"{key} string, _c long, entry long, must boolean, exit long, _start long"

    def up(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [part for _, part in pdf.sort_values(["_c", "entry"], kind="stable").groupby("_c", sort=True)]
        entry, must, leave = _compose(parts, gap)
        first = pdf.iloc[0]
        start = pd.array([pdf["_start"].iloc[0]] * len(entry), dtype="Int64")
        return pd.DataFrame(
            {key: first[key], "_c": int(first["_c"]) // FOLD, "entry": entry, "must": must, "exit": leave, "_start": start}
        )

    def down(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_c", "entry"], kind="stable")
        given = pdf["_entry"].iloc[0]
        last, rows = None if pd.isna(given) else int(given), []
        for c, part in pdf.groupby("_c", sort=True):
            rows.append((part[key].iloc[0], int(c), last))
            entry = part["entry"].to_numpy()
            at = _first_accepted(entry, part["must"].to_numpy(bool), gap, last)
            if at < len(entry):
                last = int(part["exit"].iloc[at])
        return pd.DataFrame(rows, columns=[key, "_c", "_entry"]).astype({"_entry": "Int64"})

    levels = [maps]
    width = chunks
    while width > 1:
        levels.append(cut(levels[-1].groupBy(key, F.floor(F.col("_c") / FOLD)).applyInPandas(up, shape)))
        width = -(-width // FOLD)
    entries = levels.pop().groupBy(key, "_c").agg(F.first("_start").alias("_entry"))
    while levels:
        runs = levels.pop().withColumn("_g", F.floor(F.col("_c") / FOLD))
        into = entries.select(key, F.col("_c").alias("_g"), "_entry")
        entries = runs.join(into, [key, "_g"]).groupBy(key, "_g").applyInPandas(down, f"{key} string, _c long, _entry long")
    return entries


def throttle(
    df: DataFrame, always, key: str = "symbol", us: str = "us", order: Sequence[str] = ("seq",),
    gap_us: int = 1_000_000, chunk: str | None = None, start: DataFrame | None = None,
) -> DataFrame:
    """Drop a row closer than ``gap_us`` to the last accepted one unless ``always`` holds.

    ``always`` is a boolean column.  Which rows are accepted depends on the whole past, so the
    order is cut in chunks.  Pass one finds, for every row of a chunk that could be the first one
    accepted there, the last row accepted in the chunk.  Those maps (the rows of one gap) are
    composed over the chunks of a symbol in levels, and pass two marks each chunk from its entry state.
    Chunk numbers count from 0 over the whole table, as ``range_chunks`` gives them.

    ``start`` (key, last) gives the last accepted time before these rows, for incremental use.
    """
    marked = df.withColumn("_always", F.coalesce(always, F.lit(False)))
    if chunk is None:
        marked = range_chunks(marked, [key], [us, *order], many_pieces(marked), name="_chunk")
        chunk = "_chunk"
    by = [us, *order]

    def first_pass(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(by, kind="stable")
        t = pdf[us].to_numpy("int64")
        must = pdf["_always"].to_numpy(bool)
        exits = _exits(t, must, gap_us)
        part = slice(0, _candidates(t, must, gap_us))
        return pd.DataFrame(
            {key: pdf[key].iloc[0], "_c": int(pdf[chunk].iloc[0]), "entry": t[part],
             "must": must[part], "exit": exits[part]}
        )

    maps = marked.groupBy(key, chunk).applyInPandas(
        first_pass, f"{key} string, _c long, entry long, must boolean, exit long"
    )

    if start is None:
        maps = maps.withColumn("_start", F.lit(None).cast("long"))
    else:
        maps = maps.join(start.select(key, F.col("last").alias("_start")), key, "left")

    maps = cut(maps)
    last = maps.agg(F.max("_c")).first()[0]
    entries = _chunk_entries(maps, key, gap_us, 0 if last is None else last + 1).withColumnRenamed("_c", chunk)
    names = df.columns
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def second_pass(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(by, kind="stable")
        last = pdf["_entry"].iloc[0]
        keep = _greedy(
            pdf[us].to_numpy("int64"), pdf["_always"].to_numpy(bool), gap_us,
            None if pd.isna(last) else int(last),
        )
        return pdf.loc[keep, names]

    return (
        marked.join(entries, [key, chunk], "left")
        .groupBy(key, chunk).applyInPandas(second_pass, fields)
    )
