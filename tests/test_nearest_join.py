"""The joins behind nearest neighbours and the spanning tree: one pass over the points sent, bounded output."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from tickflow.operators import hierarchy as hi
from tickflow.operators import neighbours as nb


def _batches(asks: pd.DataFrame, sent: pd.DataFrame, size: int):
    both = pd.concat([asks.assign(asks=True), sent.assign(asks=False)], ignore_index=True).assign(pid=0)
    table = pa.Table.from_pandas(both, preserve_index=False)
    return iter(table.to_batches(max_chunksize=size))


def _points(scale: float, n: int = 400) -> pd.DataFrame:
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(n, 6)), 1) * scale + 100 * scale
    return pd.DataFrame({"id": np.arange(n) * 3 + 5, "x": list(x)})


@pytest.mark.parametrize("scale", [1.0, 1e-20, 1e140])
def test_join_keeps_k_of_all_batches(scale):
    """Many batches give k neighbours for a point, not k for each batch; ties by id."""
    pts = _points(scale)
    out = pa.Table.from_batches(nb._join(5, np.zeros(6))(_batches(pts, pts, 37))).to_pandas()
    assert len(out) == 5 * len(pts)
    x, ids = np.stack(pts["x"]), pts["id"].to_numpy()
    d = nb._distances(x, x)
    for i, part in out.groupby("id"):
        at = int(np.flatnonzero(ids == i)[0])
        order = [j for j in np.lexsort((ids, d[at])) if ids[j] != i][:5]
        part = part.sort_values(["distance", "neighbour"])
        assert part["neighbour"].tolist() == ids[order].tolist()
        assert part["distance"].tolist() == d[at][order].tolist()


def test_join_with_vectors_that_are_not_finite():
    pts = _points(1.0, 50)
    pts.at[7, "x"] = np.array([np.nan] * 6)
    out = pa.Table.from_batches(nb._join(3, np.zeros(6))(_batches(pts, pts, 20))).to_pandas()
    bad = pts["id"][7]
    assert bad not in set(out["id"]) | set(out["neighbour"]) and (out.groupby("id").size() == 3).all() and out["id"].nunique() == 49


@pytest.mark.parametrize("parts", [2, 40])
def test_search_finds_the_smallest_edge_out_of_each_component(parts):
    pts = _points(1.0)
    rng = np.random.default_rng(5)
    pts["core"] = rng.choice([0.0, 0.5, 1.0], len(pts))
    pts["c"] = rng.integers(0, parts, len(pts))
    x, ids, c, core = np.stack(pts["x"]), pts["id"].to_numpy(), pts["c"].to_numpy(), pts["core"].to_numpy()
    w = np.maximum(np.maximum(nb._distances(x, x), core), core[:, None])
    w[c[:, None] == c] = np.inf
    want = {}
    for k in range(parts):
        want[k] = min((w[a, b], min(ids[a], ids[b]), max(ids[a], ids[b])) for a in np.flatnonzero(c == k) for b in range(len(ids)))
    asks = pts.assign(bound=[want[k][0] * 1.2 for k in c])
    found = pa.Table.from_batches(hi._outgoing(np.zeros(6))(_batches(asks, pts.assign(bound=np.nan), 37))).to_pandas()
    # Each batch hands on one edge at most for a component and group of asking points.
    assert len(found) <= parts * 11 * 2
    got = {k: min(found[(found["ca"] == k) | (found["cb"] == k)][["w", "a", "b"]].itertuples(index=False, name=None)) for k in range(parts)}
    assert got == want
