"""The search for near copies across components: which sets it reads, and how it cuts sorted partitions."""

from __future__ import annotations

import random
from itertools import combinations, groupby
from types import SimpleNamespace

import brute
import numpy as np
import pyarrow as pa
import pytest

from tickflow.llm import near_dedup
from tickflow.llm.frames import strings, whole_groups

N, PERCENT = 4, 80


def family(size: int, changes: tuple[int, int]) -> list[str]:
    """Texts that each differ from one base, which is not among them, in words of their own."""
    base, pick = brute.prose(9, 300, 3000), random.Random(size)
    out = []
    for _ in range(size):
        text = list(base)
        for at in pick.sample(range(0, 300, 5), pick.randint(*changes)):
            text[at] = f"e{pick.randrange(10**9)}"
        out.append(" ".join(text))
    return out


def sets(texts: list[str]) -> list[set]:
    return [{tuple(w[i : i + N]) for i in range(len(w) - N + 1)} for w in map(str.split, texts)]


def tops(n: int, links: list[tuple[int, int]]) -> list[int]:
    top = list(range(n))
    for a, b in links:
        x, y = top[a], top[b]
        top = [min(x, y) if t in (x, y) else t for t in top]
    return top


def searched(texts: list[str], folder: str) -> list[tuple[int, int]]:
    """What the search across components links, where each text is a component of its own."""
    made = near_dedup._signatures(N)(strings(pa.array(texts)))
    batch = pa.RecordBatch.from_pydict({"text": texts, "node": list(range(len(texts))), "root": list(range(len(texts)))})
    rarity = np.zeros(1 << near_dedup.RARITY_BITS, np.int64)
    for b in near_dedup._counted(N)(iter([batch.select(["text"])])):
        rarity[b.column(0).to_numpy()] = b.column(1).to_numpy()
    rows = [r for b in near_dedup._rarest(N, PERCENT, SimpleNamespace(value=rarity), folder)(iter([batch])) for r in b.to_pylist()]
    rows.sort(key=lambda r: r["token"])
    rows = [r | {"part": 1, "i": 0, "j": 0, "side": False, "inside": False, "block": 0, "signature": made["signature"][r["node"]]} for r in rows]
    links = near_dedup._across(PERCENT, folder)(iter(pa.Table.from_pylist(rows).to_batches(max_chunksize=97)))
    return [(r["a"], r["b"]) for b in links for r in b.to_pylist()]


@pytest.mark.parametrize("changes", [(9, 12), (1, 12), (1, 3)])
def test_only_sets_that_can_be_similar_are_read(tmp_path, monkeypatch, changes):
    texts, read = family(70, changes), []
    common = near_dedup._common
    monkeypatch.setattr(near_dedup, "_common", lambda a, b: read.append(1) or common(a, b))
    links = searched(texts, str(tmp_path))
    held = sets(texts)
    similar = [(a, b) for a, b in combinations(range(len(texts)), 2) if 100 * len(held[a] & held[b]) >= PERCENT * len(held[a] | held[b])]
    assert tops(len(texts), links) == tops(len(texts), similar)
    assert set(links) <= set(similar)
    assert bool(similar) == (changes[0] == 1)
    # All pairs of the family share tokens and are within the distance or close to it: 2,415 pairs.
    assert len(read) <= 3 * len(texts)


@pytest.mark.parametrize("bits", [64, 512])
def test_bits_never_say_more_than_the_difference(bits, monkeypatch):
    monkeypatch.setattr(near_dedup, "PARITIES", bits)
    pick = np.random.default_rng(4)
    pool = near_dedup.mix(np.arange(400, dtype=np.uint64))
    held = [np.unique(pick.choice(pool, k)) for k in (0, 1, 30, 200, 390) for _ in range(8)]
    rows = near_dedup._parities(held)
    assert rows.shape == (40, bits // 8)
    for a, b in combinations(range(40), 2):
        differ = int(np.bitwise_count(rows[a] ^ rows[b]).sum())
        assert differ <= len(np.setxor1d(held[a], held[b])) and (differ - len(held[a]) - len(held[b])) % 2 == 0


@pytest.mark.parametrize("chunk", [1, 2, 5, 100])
def test_groups_stay_whole_over_batches(chunk):
    pick = random.Random(chunk)
    keys = sorted((pick.randrange(12), pick.randrange(2)) for _ in range(60))
    table = pa.Table.from_pylist([{"k": k, "l": m, "x": i} for i, (k, m) in enumerate(keys)])
    empty = table.slice(0, 0).to_batches() or [pa.RecordBatch.from_pylist([], schema=table.schema)]
    got = []
    for rows, cuts in whole_groups(iter([*empty, *table.to_batches(max_chunksize=chunk), *empty]), ["k", "l"]):
        x = rows.column("x").to_pylist()
        got += [x[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    assert got == [[i for i, _ in g] for _, g in groupby(enumerate(keys), key=lambda r: r[1])]
    assert list(whole_groups(iter(empty), ["k", "l"])) == []
