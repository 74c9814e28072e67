"""Exact k nearest neighbours as a pruned partition join, and the fuzzy graph on top of it.

Points are placed in cells around pivots.  From the cell radii and the few smallest distances
per cell an upper bound of every neighbour distance of a cell follows; a point travels only to
cells it could matter to (triangle inequality).  Cells are dealt to groups of bounded size, so a
cell holding a third of the points is many tasks.  A task holds the points of one group and reads the
points sent there once, batch by batch: a matrix product tells which pairs can be near enough, and only
these are measured.  Identical vectors are folded before.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.session import cut

BLOCK = 1 << 14
"""Points of a group."""
MAX_PIVOTS = 256
TASKS = 48
"""Tasks of a small join, at most; groups that are fewer read the points in several shares."""
SHARE = 1024
SUB, CHUNK = 1024, 4096
PAIRS = 1 << 17
"""Pairs measured at once."""


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty((len(a), len(b)))
    step = max(1, 8_000_000 // max(1, b.size))
    for i in range(0, len(a), step):
        diff = a[i: i + step, None, :] - b[None, :, :]
        out[i: i + step] = np.sqrt((diff * diff).sum(axis=2))
    return out


def _smallest(rows: DataFrame, keys, by, k: int) -> DataFrame:
    """First k rows per key; Spark keeps at most k per key and task before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*by)
    return rows.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)


def _place(points: DataFrame, pivots: np.ndarray, id_type: str) -> DataFrame:
    def assign(batches):
        for pdf in batches:
            if not len(pdf):
                continue
            d = _distances(np.stack(pdf["x"].to_numpy()), pivots)
            cell = d.argmin(axis=1)
            yield pd.DataFrame(
                {"id": pdf["id"], "x": pdf["x"], "cell": cell.astype("int32"), "d": d[np.arange(len(d)), cell]}
            )

    return points.mapInPandas(assign, f"id {id_type}, x array<double>, cell int, d double")


def _plan(pivots: np.ndarray, cells: dict, k: int) -> list[tuple]:
    """(from cell, to cell, nearest, farthest) for every pair of cells that may hold neighbours.

    ``cells`` maps a cell to (count, radius, its k+1 smallest distances); everything here is one
    small table per cell.
    """
    ids = sorted(cells)
    at = pivots[ids]
    apart = _distances(at, at)
    out = []
    for a, i in enumerate(ids):
        _, radius, _ = cells[i]
        reach = np.concatenate([radius + apart[a, b] + np.array(cells[j][2]) for b, j in enumerate(ids)])
        bound = np.partition(reach, k)[k] if len(reach) > k else math.inf
        slack = 1e-9 * (1.0 + (bound if math.isfinite(bound) else 0.0) + radius)
        for b, j in enumerate(ids):
            low = apart[a, b] - radius - bound - slack
            if low <= cells[j][1]:
                high = apart[a, b] + radius + bound + slack
                out.append((j, i, float(low), float(min(high, 1e300))))
    return out


def chain(at: np.ndarray) -> list[int]:
    """The pivots in an order in which each one's nearest of those left comes next."""
    left, order = list(range(1, len(at))), [0]
    while left:
        d = ((at[left] - at[order[-1]]) ** 2).sum(axis=1)
        order.append(left.pop(int(d.argmin())))
    return order


def deal(counts: dict[int, int], size: int) -> tuple[dict[int, list[int]], int, int]:
    """The groups of each cell, of about ``size`` points in the order given; how many; shares of the points for each."""
    out, at = {}, 0
    for cell, n in counts.items():
        out[cell] = list(range(at // size, (at + n - 1) // size + 1))
        at += n
    groups = -(-at // size)
    return out, groups, max(1, -(-TASKS // max(1, groups)))


def grouped(cell_groups: dict[int, list[int]], shares: int, asks: DataFrame) -> DataFrame:
    """``asks`` (with their cell) with ``pid`` for every share of their group."""
    table = asks.sparkSession.createDataFrame(list(cell_groups.items()), "cell int, _groups array<int>")
    # One row for each cell.
    held = asks.join(F.broadcast(table), "cell")
    own = F.get("_groups", F.pmod(F.xxhash64("id", F.lit(1)), F.size("_groups")).cast("int"))
    return held.withColumn("_g", own).withColumn("_h", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).withColumn(
        "pid", F.col("_g") * shares + F.col("_h")
    ).drop("_groups", "_g", "_h")


def share(group: str, shares: int) -> Column:
    """``pid`` of a point sent to a group."""
    return F.col(group) * shares + F.pmod(F.xxhash64("id", F.lit(2)), F.lit(shares)).cast("int")


def met(asks: DataFrame, sent: DataFrame, tasks: int) -> DataFrame:
    """Both sides by ``pid``, the points that ask first."""
    both = asks.withColumn("asks", F.lit(True)).unionByName(sent.withColumn("asks", F.lit(False)))
    return both.repartitionById(tasks, F.col("pid")).sortWithinPartitions("pid", F.desc("asks"), "cell")


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bool, pa.RecordBatch]]:
    """(pid, whether they ask, rows): the batches of ``met`` by task and side."""
    for batch in batches:
        if not batch.num_rows:
            continue
        pid, asks = batch.column("pid").to_numpy(), batch.column("asks").to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero((pid[1:] != pid[:-1]) | (asks[1:] != asks[:-1])) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            for i in range(a, b, CHUNK):
                yield int(pid[a]), bool(asks[a]), batch.slice(i, min(CHUNK, b - i))


def narrowed(points: DataFrame) -> DataFrame:
    """``x`` as floats where that loses nothing."""
    narrow = F.col("x").cast("array<float>")
    return points.withColumn("x", narrow) if points.where(~narrow.cast("array<double>").eqNullSafe(F.col("x"))).isEmpty() else points


class Side:
    """Points as rows of a matrix, with what bounds of their distances need."""

    def __init__(self, x: np.ndarray, middle: np.ndarray) -> None:
        self.x = x
        with np.errstate(all="ignore"):
            y = x - middle
            self.norm = (y * y).sum(axis=1)
            kind = np.float32 if self.norm.max(initial=0.0) < 1e30 else np.float64
            one = np.ones(len(x))
            self.left = np.column_stack([y, one, self.norm]).astype(kind)
            self.right = np.column_stack([-2 * y, self.norm, one]).astype(kind)
            self.centre = x.mean(axis=0)
            self.radius = float(self.reach(self.centre).max(initial=0.0))
        self.high = float(np.abs(x).max(initial=0.0))

    def reach(self, centre: np.ndarray) -> np.ndarray:
        diff = self.x - centre
        return np.sqrt((diff * diff).sum(axis=1))

    def beside(self, other: Side, bound: np.ndarray) -> np.ndarray:
        """The rows that may have a point of ``other`` within their bound."""
        with np.errstate(all="ignore"):
            reach = self.reach(other.centre)
            return np.flatnonzero(~(reach - other.radius - 1e-9 * (reach + other.radius) > bound))


def squares(a: Side, rows: np.ndarray, b: Side, cols: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by a matrix product, and by how much those of a row may be off."""
    right, norm = (b.right, b.norm) if cols is None else (b.right[cols], b.norm[cols])
    with np.errstate(all="ignore"):
        m, top = a.x.shape[1], norm.max()
        err = 4e-16 * math.sqrt(m) * (a.high + b.high)
        off = (2 * m + 32) * np.finfo(np.float32).eps * (a.norm[rows] + top) + 1e-36
        off = off + 2 * (np.sqrt(a.norm[rows]) + np.sqrt(top)) * err + err * err
        return a.left[rows] @ right.T, off


def within(d2: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places at or below a row's limit; what is not a number counts as below."""
    flat = np.flatnonzero(~(d2 > limit[:, None].astype(d2.dtype)))
    return np.divmod(flat, d2.shape[1])


def measured(a: np.ndarray, r: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Distances of pairs of rows."""
    out = np.empty(len(r))
    for i in range(0, len(r), PAIRS):
        diff = a[r[i: i + PAIRS]] - b[c[i: i + PAIRS]]
        out[i: i + PAIRS] = np.sqrt((diff * diff).sum(axis=1))
    return out


def matrix(column: pa.Array) -> np.ndarray:
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    if not (sizes == sizes[0]).all():
        raise ValueError("vectors must have the same length")
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _names(column: pa.Array) -> np.ndarray:
    got = column.to_numpy(zero_copy_only=False)
    return got.astype(str) if got.dtype == object else got


class _Nearest:
    """The nearest points so far of up to ``SUB`` rows."""

    def __init__(self, rows: pa.Table, k: int, middle: np.ndarray) -> None:
        self.ids, self.side, self.k = _names(rows.column("id").combine_chunks()), Side(matrix(rows.column("x").combine_chunks()), middle), k
        self.far = np.full((len(self.ids), k), np.inf)
        self.near = np.zeros((len(self.ids), k), self.ids.dtype)

    def meet(self, ids: np.ndarray, other: Side) -> None:
        k, kth = self.k, self.far[:, -1]
        rows = self.side.beside(other, kth)
        if not len(rows):
            return
        d2, off = squares(self.side, rows, other)
        mine = self.ids[rows]
        # A point is no neighbour of itself, nor of one with its id.
        own = np.flatnonzero(np.isin(ids, mine))
        if len(own):
            d2[:, own] = np.where(mine[:, None] == ids[own], np.inf, d2[:, own])
        limit = kth[rows] ** 2 * (1 + 1e-9) + off
        new = np.flatnonzero(~np.isfinite(limit))
        if len(new) and len(ids) > k:
            limit[new] = np.partition(d2[new], k - 1, axis=1)[:, k - 1] + 2 * off[new]
        r, c = within(d2, limit)
        r = rows[r]
        d = measured(self.side.x, r, other.x, c)
        ok = np.isfinite(d) & (d <= kth[r]) & (self.ids[r] != ids[c])
        if ok.any():
            self._merge(r[ok], d[ok], ids[c[ok]])

    def _merge(self, r: np.ndarray, d: np.ndarray, ids: np.ndarray) -> None:
        self.near = self.near.astype(np.promote_types(self.near.dtype, ids.dtype), copy=False)
        touched = np.unique(r)
        r = np.concatenate([np.repeat(touched, self.k), r])
        d = np.concatenate([self.far[touched].ravel(), d])
        ids = np.concatenate([self.near[touched].ravel(), ids])
        order = np.lexsort((ids, d, r))
        r, d, ids = r[order], d[order], ids[order]
        first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        rank = np.arange(len(r)) - np.repeat(first, np.diff(np.r_[first, len(r)]))
        keep = rank < self.k
        self.far[r[keep], rank[keep]], self.near[r[keep], rank[keep]] = d[keep], ids[keep]

    def found(self, schema: pa.Schema) -> pa.RecordBatch:
        r, c = np.nonzero(np.isfinite(self.far))
        return pa.RecordBatch.from_arrays(
            [pa.array(v).cast(f.type) for v, f in zip((self.ids[r], self.near[r, c], self.far[r, c]), schema, strict=True)], schema=schema
        )


def _join(k: int, middle: np.ndarray):
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked, parts, schema = None, [], [], None
        for pid, asks, rows in runs(batches):
            kind = rows.schema.field("id").type
            schema = pa.schema([("id", kind), ("neighbour", kind), ("distance", pa.float64())])
            if pid != now:
                yield from (p.found(schema) for p in parts)
                now, asked, parts = pid, [], []
            if asks:
                asked.append(rows)
                continue
            if asked:
                table = pa.Table.from_batches(asked)
                parts = [_Nearest(table.slice(i, SUB), k, middle) for i in range(0, table.num_rows, SUB)]
                asked = []
            if not parts:
                continue
            ids, other = _names(rows.column("id")), Side(matrix(rows.column("x")), middle)
            for p in parts:
                p.meet(ids, other)
        yield from (p.found(schema) for p in parts)

    return join


def _knn_distinct(points: DataFrame, k: int, block: int) -> DataFrame:
    """kNN of distinct points (id, x): (id, neighbour, distance)."""
    spark = points.sparkSession
    id_type = points.schema["id"].dataType.simpleString()
    n = points.count()
    schema = f"id {id_type}, neighbour {id_type}, distance double"
    if n < 2:
        return spark.createDataFrame([], schema)
    pivot_rows = points.orderBy(F.xxhash64("x"), "id").limit(max(1, min(MAX_PIVOTS, int(math.sqrt(n) / 2)))).collect()
    pivots = np.array([r["x"] for r in pivot_rows], dtype=float)
    placed = cut(_place(points, pivots, id_type))
    near = _smallest(placed.select("cell", "d", "id"), ["cell"], ["d", "id"], k + 1)
    rows = (
        placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("r"))
        .join(near.groupBy("cell").agg(F.collect_list("d").alias("ds")), "cell").collect()
    )
    cells = {r["cell"]: (r["n"], r["r"], sorted(r["ds"])) for r in rows}
    places, groups, shares = deal({i: cells[i][0] for i in chain(pivots) if i in cells}, block)
    shares = min(shares, -(-n // SHARE))
    moves: dict[tuple[int, int], tuple[float, float]] = {}
    for j, i, low, high in _plan(pivots, cells, k):
        for g in places[i]:
            a, b = moves.get((j, g), (math.inf, -math.inf))
            moves[j, g] = min(a, low), max(b, high)
    # A row for each cell and group.
    table = spark.createDataFrame([(*key, *span) for key, span in moves.items()], "cell int, target int, low double, high double")
    narrow = narrowed(placed)
    asks = grouped(places, shares, narrow.select("id", "x", "cell"))
    sent = narrow.join(F.broadcast(table), "cell").where((F.col("d") >= F.col("low")) & (F.col("d") <= F.col("high"))).select(
        "cell", "id", "x", share("target", shares).alias("pid")
    )
    part = met(asks, sent, groups * shares).mapInArrow(_join(k, pivots.mean(axis=0)), schema)
    return _smallest(part, ["id"], ["distance", "neighbour"], k).drop("_r")


def knn(points: DataFrame, k: int, id_col: str = "id", x: str = "x", block: int = BLOCK) -> DataFrame:
    """(id, neighbour, distance, rank): the k nearest other points, ties by smaller id."""
    pts = points.select(F.col(id_col).alias("id"), F.col(x).cast("array<double>").alias("x"))
    groups = cut(
        _smallest(pts, ["x"], ["id"], k + 1).groupBy("x").agg(
            F.array_sort(F.collect_list("id")).alias("ids")
        ).withColumn("rep", F.col("ids")[0])
    )
    near = _knn_distinct(groups.select(F.col("rep").alias("id"), "x"), k, block)
    other = groups.select(F.col("rep").alias("neighbour"), F.col("ids").alias("_ids"))
    found = near.join(other, "neighbour").groupBy("id").agg(
        F.flatten(
            F.collect_list(
                F.transform("_ids", lambda i: F.struct(F.col("distance").alias("d"), i.alias("i")))
            )
        ).alias("far")
    )
    own = F.transform("ids", lambda i: F.struct(F.lit(0.0).alias("d"), i.alias("i")))
    none = F.array().cast(T.ArrayType(groups.select(own.alias("o")).schema["o"].dataType.elementType))
    lists = groups.join(found, groups["rep"] == found["id"], "left").select(
        groups["x"], F.slice(F.array_sort(F.concat(own, F.coalesce("far", none))), 1, k + 1).alias("near")
    )
    mine = pts.join(lists, "x").select(
        "id", F.slice(F.filter("near", lambda e: e["i"] != F.col("id")), 1, k).alias("near")
    )
    return mine.select("id", F.posexplode("near").alias("rank", "e")).select(
        "id", F.col("e.i").alias("neighbour"), F.col("e.d").alias("distance"), (F.col("rank") + 1).alias("rank")
    )


def _weights(d: np.ndarray) -> np.ndarray:
    """Membership of each neighbour: rows of sorted distances, all rows at once."""
    rho = np.where(d > 0, d, np.inf).min(axis=1, initial=np.inf)
    rho = np.where(np.isfinite(rho), rho, 0.0)[:, None]
    target = np.log2(d.shape[1])
    gap = np.maximum(d - rho, 0.0)
    lo, hi = np.zeros((len(d), 1)), np.full((len(d), 1), np.inf)
    sigma = np.ones((len(d), 1))
    for _ in range(64):
        total = np.exp(-gap / sigma).sum(axis=1, keepdims=True)
        high = total > target
        hi = np.where(high, sigma, hi)
        lo = np.where(high, lo, sigma)
        sigma = np.where(np.isinf(hi), sigma * 2, (lo + np.where(np.isinf(hi), 0, hi)) / 2)
        sigma = np.maximum(sigma, 1e-12)
    return np.exp(-gap / sigma)


def fuzzy_graph(neighbours: DataFrame) -> DataFrame:
    """Symmetric neighbour weights (id, neighbour, weight): a + b - ab of both directions."""
    id_type = neighbours.schema["id"].dataType.simpleString()
    lists = neighbours.groupBy("id").agg(
        F.array_sort(F.collect_list(F.struct("distance", "neighbour"))).alias("e")
    ).select("id", F.col("e.neighbour").alias("n"), F.col("e.distance").alias("d"))

    def weigh(batches):
        for pdf in batches:
            for _, part in pdf.groupby(pdf["d"].map(len)):
                w = _weights(np.stack(part["d"].to_numpy()))
                yield pd.DataFrame({"id": part["id"], "n": part["n"], "w": list(w)})

    weights = lists.mapInPandas(weigh, f"id {id_type}, n array<{id_type}>, w array<double>")
    one = weights.select("id", F.explode(F.arrays_zip("n", "w")).alias("e")).select(
        "id", F.col("e.n").alias("neighbour"), F.col("e.w").alias("w")
    )
    back = one.select(F.col("neighbour").alias("id"), F.col("id").alias("neighbour"), "w")
    both = one.unionByName(back).groupBy("id", "neighbour").agg(
        F.sum("w").alias("s"), F.min("w").alias("a"), F.max("w").alias("b"), F.count(F.lit(1)).alias("c")
    )
    return both.select(
        "id", "neighbour", (F.col("s") - F.when(F.col("c") == 2, F.col("a") * F.col("b")).otherwise(0.0)).alias("weight")
    )
