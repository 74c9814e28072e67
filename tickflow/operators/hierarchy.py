"""The exact density hierarchy: a spanning tree over mutual reachability, its condensed tree, excess of mass.

* Tree: Boruvka rounds.  Each component takes its smallest outgoing edge, ties by (weight, smaller id,
  larger id).  Edges of the neighbour lists come first; a point whose list ends before its component's
  best edge looks further, in the cells (around pivots) that the best edge so far leaves possible.
* Condensed tree: tree edges, ordered by weight, are cut into blocks.  Contracting the lower half of the
  blocks relabels the upper half, level by level for all halves at once; after that every block merges
  its own edges alone.  What a block cannot know of (which branch a component has been since an earlier
  block) it names by the component, and the names are resolved by pointer jumping.
* Excess of mass: leaves are folded into their parents round by round until few branches are left;
  only those reach the driver.
"""

from __future__ import annotations

import functools
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickflow.operators import neighbours as nb
from tickflow.operators.neighbours import MAX_PIVOTS, _distances
from tickflow.operators.ordered import ordered_index
from tickflow.session import cut

BLOCK = 1 << 14
"""Points that ask together."""
ALIKE = 64
"""Asking points of one component that are compared with the other components alone."""
EDGES = 1 << 20
"""Tree edges one task merges."""
REST = 100_000
"""Components or branches few enough for the driver."""

_EDGE = "a long, b long, w double, ca long, cb long"


def _least(edges: DataFrame) -> DataFrame:
    """(c, w, a, b, other): the smallest edge of every component on either side."""
    both = edges.select(F.col("ca").alias("c"), "w", "a", "b", F.col("cb").alias("other")).unionByName(
        edges.select(F.col("cb").alias("c"), "w", "a", "b", F.col("ca").alias("other"))
    )
    return both.groupBy("c").agg(F.min(F.struct("w", "a", "b", "other")).alias("e")).select("c", "e.*")


def _both_least(edges: DataFrame) -> DataFrame:
    """The edges of which one side's component has none smaller."""
    least = edges.groupBy("ca").agg(F.min(F.struct("w", "a", "b", "cb")).alias("e")).select("e.a", "e.b", "e.w", "ca", "e.cb")
    other = edges.groupBy("cb").agg(F.min(F.struct("w", "a", "b", "ca")).alias("e")).select("e.a", "e.b", "e.w", "e.ca", "cb")
    return least.unionByName(other)


def _settled(df: DataFrame, few: bool) -> DataFrame:
    """``df`` computed once: through the driver where it has at most ``REST`` rows, else written."""
    return F.broadcast(df.sparkSession.createDataFrame(df.toArrow(), df.schema)) if few else cut(df)


def _first_by_component(c, w, a, b, other) -> pd.DataFrame:
    """The smallest edge of each component ``c``."""
    low, high = np.minimum(a, b), np.maximum(a, b)
    flip = low != a
    order = np.lexsort((high, low, w, c))
    order = order[np.r_[True, c[order][1:] != c[order][:-1]]] if len(order) else order
    ca, cb = np.where(flip, other, c), np.where(flip, c, other)
    return pd.DataFrame({"a": low[order], "b": high[order], "w": w[order], "ca": ca[order], "cb": cb[order]})


class _Space:
    """Points in cells around pivots; the driver holds one small row for each pivot."""

    def __init__(self, points: DataFrame, n: int) -> None:
        rows = points.orderBy(F.xxhash64("id"), "id").limit(max(1, min(MAX_PIVOTS, int(math.sqrt(n) / 2)))).collect()
        self.ids = np.array([r["id"] for r in rows], np.int64)
        self.core = np.array([r["core"] for r in rows])
        self.at = at = np.array([r["x"] for r in rows], dtype=float)

        def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    d = _distances(np.stack(pdf["x"].to_numpy()), at)
                    cell = d.argmin(axis=1)
                    yield pdf.assign(cell=cell.astype("int32"), d=d[np.arange(len(d)), cell])

        self.placed = nb.narrowed(cut(points.mapInPandas(place, "id long, x array<double>, core double, beyond double, cell int, d double")))

    def search(self, labels: DataFrame, best: DataFrame, block: int, few: bool) -> DataFrame:
        """The smallest outgoing edges of components with points whose list ends before the component's ``best``.

        A component that holds all pivots gets no bound and finds nothing in this round; others then find it.
        """
        spark = labels.sparkSession
        at, core, ids = self.at, self.core, self.ids
        held = self.placed.join(labels, "id")
        asks = held.where(F.col("beyond") < math.inf).join(best.select("c", "w"), "c", "left").where(
            F.col("w").isNull() | (F.col("beyond") <= F.col("w"))
        ).select("id", "x", "core", "beyond", "c", "cell", "d")
        pivot = F.col("id").isin([int(i) for i in ids])
        cells = {
            r["cell"]: r for r in held.groupBy("cell").agg(
                F.count(F.lit(1)).alias("n"), F.max("d").alias("r"), F.min("c").alias("low"), F.max("c").alias("high"),
                F.collect_list(F.when(pivot, F.struct("id", "c"))).alias("own"),
            ).collect()
        }
        by_id = {x["id"]: x["c"] for r in cells.values() for x in r["own"]}
        own = np.array([by_id[i] for i in ids.tolist()], np.int64)

        def to_pivots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                c = pdf["c"].to_numpy(np.int64)
                if not len(c):
                    continue
                w = np.maximum(np.maximum(_distances(np.stack(pdf["x"].to_numpy()), at), core), pdf["core"].to_numpy()[:, None])
                w = np.where(c[:, None] == own, np.inf, w)
                j = w.argmin(axis=1)
                far = w[np.arange(len(w)), j]
                ok = np.isfinite(far)
                yield _first_by_component(c[ok], far[ok], pdf["id"].to_numpy(np.int64)[ok], ids[j][ok], own[j][ok])

        guess = _settled(_both_least(asks.mapInPandas(to_pivots, _EDGE)), few)
        bound = best.select("c", "w").unionByName(_least(guess).select("c", "w")).groupBy("c").agg(F.min("w").alias("bound"))
        bound = F.broadcast(bound) if few else bound
        asked = cut(asks.join(bound, "c").where(F.col("beyond") <= F.col("bound")).select("id", "x", "core", "c", "bound", "cell", "d"))
        # One row for each pivot's cell.
        seen = {r["cell"]: r for r in asked.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("r"), F.max("bound").alias("bound")).collect()}
        if not seen:
            return guess.select("a", "b", "w", "ca", "cb")
        places, groups, shares = nb.deal({i: seen[i]["n"] for i in nb.chain(at) if i in seen}, block)
        shares = min(shares, max(1, -(-sum(r["n"] for r in cells.values()) // nb.SHARE)))
        apart = _distances(at, at)
        visits = {
            (j, g) for i, r in seen.items() for j, have in cells.items() for g in places[i]
            if not (apart[i, j] - r["r"] - r["bound"]) * (1 - 1e-9) - 1e-9 * (apart[i, j] + r["bound"]) > have["r"]
        }
        table = spark.createDataFrame(list(visits), "cell int, target int")
        cols = ["cell", "id", "x", "core", "c", "pid"]
        ask = nb.grouped(places, shares, asked).select(*cols, "bound")
        sent = held.join(F.broadcast(table), "cell").withColumn("pid", nb.share("target", shares)).select(*cols, F.lit(None).cast("double").alias("bound"))
        found = nb.met(ask, sent, groups * shares).mapInArrow(_outgoing(at.mean(axis=0)), _EDGE)
        return guess.unionByName(_both_least(found))


class _Asking:
    """Up to ``SUB`` points that look for the smallest edge out of their component."""

    def __init__(self, rows: pa.Table, middle: np.ndarray) -> None:
        one = {c: rows.column(c).combine_chunks() for c in ("id", "x", "core", "c", "bound")}
        self.side = nb.Side(nb.matrix(one["x"]), middle)
        self.id, self.core, self.c, self.bound = (one[c].to_numpy(zero_copy_only=False) for c in ("id", "core", "c", "bound"))
        self.bound = self.bound.copy()
        names, self.which, many = np.unique(self.c, return_inverse=True, return_counts=True)
        self.alone = np.flatnonzero(many >= ALIKE)
        self.names = names

    def meet(self, ids: np.ndarray, core: np.ndarray, comp: np.ndarray, other: nb.Side) -> Iterator[pd.DataFrame]:
        near = self.side.beside(other, self.bound)
        near = near[self.core[near] <= self.bound[near]]
        if not len(near):
            return
        mixed = near[~np.isin(self.which[near], self.alone)]
        jobs = [(mixed, None)] if len(mixed) else []
        for k in self.alone.tolist():
            rows = near[self.which[near] == k]
            cols = np.flatnonzero(comp != self.names[k])
            if len(rows) and len(cols):
                jobs.append((rows, cols if len(cols) < len(comp) else None))
        for rows, cols in jobs:
            d2, off = nb.squares(self.side, rows, other, cols)
            r, c = nb.within(d2, self.bound[rows] ** 2 * (1 + 1e-9) + off)
            r, c = rows[r], c if cols is None else cols[c]
            out = self.c[r] != comp[c]
            r, c = r[out], c[out]
            w = np.maximum(np.maximum(nb.measured(self.side.x, r, other.x, c), core[c]), self.core[r])
            ok = np.isfinite(w) & (w <= self.bound[r])
            if ok.any():
                r, c, w = r[ok], c[ok], w[ok]
                best = np.full(len(self.names), np.inf)
                np.minimum.at(best, self.which[r], w)
                self.bound = np.minimum(self.bound, best[self.which])
                yield _first_by_component(self.c[r], w, self.id[r], ids[c], comp[c])


def _outgoing(middle: np.ndarray):
    """For the points that ask, edges out of their component, the smallest ones among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, asked, parts = None, [], []
        for pid, asks, rows in nb.runs(batches):
            if pid != now:
                now, asked, parts = pid, [], []
            if asks:
                asked.append(rows)
                continue
            if asked:
                table = pa.Table.from_batches(asked)
                parts = [_Asking(table.slice(i, nb.SUB), middle) for i in range(0, table.num_rows, nb.SUB)]
                asked = []
            if not parts:
                continue
            ids, core, comp = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("id", "core", "c"))
            other = nb.Side(nb.matrix(rows.column("x")), middle)
            for p in parts:
                for edges in p.meet(ids, core, comp, other):
                    yield pa.RecordBatch.from_pandas(edges, preserve_index=False)

    return run


def _merged(best: DataFrame, few: bool) -> tuple[DataFrame, int | None]:
    """(c, root) of the components joined by the chosen edges, and how many fewer that makes (None: not known)."""
    if not few:
        from tickflow.operators.density import connected_components

        nodes = best.select(F.col("c").alias("node")).unionByName(best.select(F.col("other").alias("node"))).distinct()
        return connected_components(best.select(F.col("c").alias("a"), F.col("other").alias("b")), nodes).select(
            F.col("node").alias("c"), F.col("component").alias("root")
        ), None
    parent: dict[int, int] = {}

    def find(c: int) -> int:
        while (up := parent.setdefault(c, c)) != c:
            parent[c] = parent[up]
            c = up
        return c

    fewer = 0
    for r in best.collect():
        a, b = find(r["c"]), find(r["other"])
        parent[max(a, b)] = min(a, b)
        fewer += a != b
    nodes = list(parent)
    table = pa.table({"c": pa.array(nodes, pa.int64()), "root": pa.array([find(c) for c in nodes], pa.int64())})
    return F.broadcast(best.sparkSession.createDataFrame(table)), fewer


def spanning_tree(points: DataFrame, near: DataFrame, min_samples: int, block: int = BLOCK) -> DataFrame:
    """(a, b, w): the smallest spanning tree over mutual reachability.

    ``points`` (id long, x), ``near`` (id, neighbour, distance, rank): lists of nearest neighbours, at least
    ``min_samples`` long where there are so many points.
    """
    n = points.count()
    rank = max(1, min_samples)
    facts = near.groupBy("id").agg(
        F.max(F.when(F.col("rank") <= rank, F.col("distance"))).alias("core"), F.max("distance").alias("far"), F.count(F.lit(1)).alias("m")
    )
    # Beyond its list a point has no edge below this.
    known = cut(points.join(facts, "id", "left").select(
        "id", F.col("x").cast("array<double>").alias("x"), F.coalesce("core", F.lit(0.0)).alias("core"),
        F.when(F.coalesce("m", F.lit(0)) < n - 1, F.greatest(F.coalesce("far", F.lit(0.0)), F.coalesce("core", F.lit(0.0)))).otherwise(F.lit(math.inf)).alias("beyond"),
    ))
    core = known.select("id", "core")
    pairs = near.select(F.least("id", "neighbour").alias("a"), F.greatest("id", "neighbour").alias("b"), "distance").groupBy("a", "b").agg(
        F.min("distance").alias("distance")
    )
    edges = cut(
        pairs.join(core.select(F.col("id").alias("a"), F.col("core").alias("ca")), "a")
        .join(core.select(F.col("id").alias("b"), F.col("core").alias("cb")), "b")
        .select("a", "b", F.greatest("distance", "ca", "cb").alias("w"))
    )
    edges = edges.withColumns({"ca": F.col("a"), "cb": F.col("b")})
    space = _Space(known, n)
    labels = cut(known.select("id", F.col("id").alias("c")))
    tree: list[DataFrame] = []
    count = n
    while count > 1:
        few = count <= REST
        best = _settled(_least(edges), few)
        found = _settled(space.search(labels, best, block, few), few)
        if not found.isEmpty():
            edges = edges.unionByName(found)
            again = best.unionByName(_least(found)).groupBy("c").agg(F.min(F.struct("w", "a", "b", "other")).alias("e"))
            best = _settled(again.select("c", "e.*"), few)
        tree.append(best.select("a", "b", "w").distinct())
        joined, fewer = _merged(best, few)
        labels = labels.join(joined, "c", "left").select("id", F.coalesce("root", "c").alias("c"))
        for side in ("ca", "cb"):
            renamed = joined.select(F.col("c").alias(side), F.col("root").alias("_root"))
            edges = edges.join(renamed, side, "left").withColumn(side, F.coalesce("_root", side)).drop("_root")
        # Edges inside a component never matter again.
        edges = cut(edges.where("ca != cb").select("a", "b", "w", "ca", "cb"))
        if few:
            count -= fewer
        else:
            labels = cut(labels)
            count = labels.select("c").distinct().count()
    if not tree:
        return points.sparkSession.createDataFrame([], "a long, b long, w double")
    return functools.reduce(DataFrame.unionByName, tree)


def _contracted(tree: DataFrame, block: int) -> tuple[DataFrame, int]:
    """(blk, idx, w, a, na, b, nb): each edge's ends as the components (smallest id, size) that all earlier blocks make of them."""
    from tickflow.operators.density import connected_components

    edges = ordered_index(tree, ["w", "a", "b"], name="idx").select(
        (F.col("idx") / block).cast("long").alias("blk"), "idx", "w", "a", F.lit(1).cast("long").alias("na"), "b", F.lit(1).cast("long").alias("nb")
    )
    edges = cut(edges)
    blocks = -(-edges.count() // block)
    for level in reversed(range(max(0, blocks - 1).bit_length())):
        seg = F.shiftright("blk", level + 1)
        high = F.shiftright("blk", level).bitwiseAND(1) == 1
        low = cut(edges.where(~high).select(seg.alias("seg"), "a", "na", "b", "nb"))
        nodes = low.select("seg", F.col("a").alias("v"), F.col("na").alias("n")).unionByName(
            low.select("seg", F.col("b").alias("v"), F.col("nb").alias("n"))
        ).distinct().select(F.struct("seg", "v").alias("node"), "n")
        comp = connected_components(
            low.select(F.struct("seg", F.col("a").alias("v")).alias("a"), F.struct("seg", F.col("b").alias("v")).alias("b")), nodes
        )
        sized = comp.join(nodes, "node").groupBy("component").agg(F.sum("n").alias("n"))
        known = comp.join(sized, "component").select(
            F.col("node.seg").alias("seg"), F.col("node.v").alias("v"), F.col("component.v").alias("root"), "n"
        )
        known = cut(known)
        up = edges.withColumn("seg", F.when(high, seg))
        for end in ("a", "b"):
            named = known.select("seg", F.col("v").alias(end), F.col("root").alias(f"_{end}"), F.col("n").alias(f"_n{end}"))
            up = up.join(named, ["seg", end], "left")
        edges = cut(up.select(
            "blk", "idx", "w", F.coalesce("_a", "a").alias("a"), F.coalesce("_na", "na").alias("na"),
            F.coalesce("_b", "b").alias("b"), F.coalesce("_nb", "nb").alias("nb"),
        ))
    return edges, blocks


_POINTER, _ADD, _END = 0, 1, 2
_FACTS = "kind int, r long, s long, pr long, ps long, value double, n long"


def _merge_block(least: int):
    """Merges the edges of a block in order; components are named (smallest id, size).

    Out come pointers from components to the branch (or earlier component) they join, the mass that
    joins branches, and the ends of branches in a merge of two.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        ends = pdf[["a", "b"]].to_numpy(np.int64)
        rep, first, place = np.unique(ends.ravel(), return_index=True, return_inverse=True)
        size = pdf[["na", "nb"]].to_numpy(np.int64).ravel()[first].tolist()
        rep, entered = rep.tolist(), list(zip(rep.tolist(), size, strict=True))
        parent, small = list(range(len(rep))), list(range(len(rep)))
        branch = [k if k[1] >= least else None for k in entered]
        joined: dict[int, tuple] = {}
        out: list[tuple] = []
        adds: dict[tuple, float] = defaultdict(float)

        def find(up: list[int], v: int) -> int:
            while up[v] != v:
                up[v] = up[up[v]]
                v = up[v]
            return v

        pairs = place.reshape(-1, 2).tolist()
        for (va, vb), w in zip(pairs, pdf["w"].tolist(), strict=True):
            a, b, lam = find(parent, va), find(parent, vb), 1.0 / max(w, 1e-12)
            both = (min(rep[a], rep[b]), size[a] + size[b])
            if branch[a] and branch[b]:
                out += [(_END, *branch[x], *both, lam, size[x]) for x in (a, b)]
                now = both
            elif branch[a] or branch[b]:
                big, bit = (a, b) if branch[a] else (b, a)
                now = branch[big]
                adds[now] += size[bit] * lam
                joined[find(small, bit)] = now
            else:
                x, y = find(small, a), find(small, b)
                small[max(x, y)] = min(x, y)
                now = both if both[1] >= least else None
                if now:
                    joined[min(x, y)] = now
            if now == both:
                adds[now] += both[1] * lam
                out.append((_POINTER, *now, *now, 0.0, 0))
            parent[max(a, b)] = top = min(a, b)
            rep[top], size[top], branch[top] = *both, now
        for v, key in enumerate(entered):
            top = find(parent, v)
            if key[1] < least:
                out.append((_POINTER, *key, *(joined.get(find(small, v)) or (rep[top], size[top])), 0.0, 0))
            if top == v and branch[v] and branch[v] != (rep[v], size[v]):
                out.append((_POINTER, rep[v], size[v], *branch[v], 0.0, 0))
        out += [(_ADD, *key, 0, 0, mass, 0) for key, mass in adds.items()]
        return pd.DataFrame(out, columns=["kind", "r", "s", "pr", "ps", "value", "n"])

    return run


def condensed_tree(tree: DataFrame, min_cluster_size: int, block: int = EDGES) -> tuple[DataFrame, DataFrame]:
    """(members, branches) of the condensed tree.

    members (id, r, s): the branch a point joins first.  branches (r, s, pr, ps, mass): each branch, named by the
    smallest id and the size it began with, its parent (null: the root) and its excess of mass.
    """
    least = max(2, min_cluster_size)
    edges, blocks = _contracted(tree, block)
    facts = cut(edges.groupBy("blk").applyInPandas(_merge_block(least), _FACTS))
    pointer = facts.where(F.col("kind") == _POINTER).select("r", "s", "pr", "ps")
    if blocks > 1:
        pointer = cut(pointer)
        for _ in range((2 * blocks).bit_length()):
            onto = pointer.select(F.col("r").alias("pr"), F.col("s").alias("ps"), F.col("pr").alias("_r"), F.col("ps").alias("_s"))
            pointer = cut(pointer.join(onto, ["pr", "ps"], "left").select("r", "s", F.coalesce("_r", "pr").alias("pr"), F.coalesce("_s", "ps").alias("ps")))
    # Names of components stand for the branch they are.
    adds = facts.where(F.col("kind") == _ADD).join(pointer.withColumnsRenamed({"pr": "_r", "ps": "_s"}), ["r", "s"]).groupBy(
        F.col("_r").alias("r"), F.col("_s").alias("s")
    ).agg(F.sum("value").alias("gained"))
    ends = facts.where(F.col("kind") == _END).join(pointer.withColumnsRenamed({"pr": "_r", "ps": "_s"}), ["r", "s"]).select(
        F.col("_r").alias("r"), F.col("_s").alias("s"), "pr", "ps", (F.col("value") * F.col("n")).alias("lost")
    )
    branches = adds.join(ends, ["r", "s"], "left").select("r", "s", "pr", "ps", (F.col("gained") - F.coalesce("lost", F.lit(0.0))).alias("mass"))
    # Only a branch is as large as a cluster; points that join none stay out.
    members = pointer.where((F.col("s") == 1) & (F.col("ps") >= least)).select(F.col("r").alias("id"), F.col("pr").alias("r"), F.col("ps").alias("s"))
    return members, cut(branches)


def _select(rows: list) -> list[tuple]:
    """(r, s, cr, cs): the outermost branch with more mass than its descendants, over each of the branches given."""
    inner: dict[tuple, float] = {(x["r"], x["s"]): x["inner"] for x in rows}
    take: dict[tuple, bool] = {}
    for x in sorted(rows, key=lambda x: x["s"]):
        key = (x["r"], x["s"])
        take[key] = x["pr"] is not None and x["mass"] >= inner[key]
        if x["pr"] is not None:
            inner[x["pr"], x["ps"]] += max(x["mass"], inner[key])
    found: dict[tuple, tuple | None] = {}
    for x in sorted(rows, key=lambda x: -x["s"]):
        key = (x["r"], x["s"])
        above = found[x["pr"], x["ps"]] if x["pr"] is not None else None
        found[key] = above or (key if take[key] else None)
    return [(*k, *(v or (None, None))) for k, v in found.items()]


def clusters(members: DataFrame, branches: DataFrame, rest: int = REST) -> DataFrame:
    """(id, r, s): the chosen branch over each point that has one.  The root, which holds all points, is never chosen."""
    spark = members.sparkSession
    now, folded = branches.withColumn("inner", F.lit(0.0)), []
    while now.count() > rest:
        parents = now.where("pr IS NOT NULL").select(F.col("pr").alias("r"), F.col("ps").alias("s")).distinct()
        leaves = cut(now.join(parents, ["r", "s"], "left_anti"))
        folded.append(leaves)
        given = leaves.groupBy(F.col("pr").alias("r"), F.col("ps").alias("s")).agg(F.sum(F.greatest("mass", "inner")).alias("more"))
        now = cut(now.join(parents, ["r", "s"], "left_semi").join(given, ["r", "s"], "left").select(
            "r", "s", "pr", "ps", "mass", (F.col("inner") + F.coalesce("more", F.lit(0.0))).alias("inner")
        ))
    chosen = spark.createDataFrame(_select(now.collect()), "r long, s long, cr long, cs long")
    for leaves in reversed(folded):
        above = chosen.withColumnsRenamed({"r": "pr", "s": "ps"})
        take = (F.col("mass") >= F.col("inner")) & F.col("pr").isNotNull()
        now = cut(leaves.join(above, ["pr", "ps"], "left").select(
            "r", "s", F.when(F.col("cr").isNotNull(), F.col("cr")).when(take, F.col("r")).alias("cr"),
            F.when(F.col("cs").isNotNull(), F.col("cs")).when(take, F.col("s")).alias("cs"),
        ))
        chosen = cut(chosen.unionByName(now))
    return members.join(chosen.where("cr IS NOT NULL"), ["r", "s"]).select("id", F.col("cr").alias("r"), F.col("cs").alias("s"))
