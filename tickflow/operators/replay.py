"""Replay of one book chunk with numpy, without a Python step for each delta.

1. Every delta that touches a level gives the level a state that holds until the level's next delta or
   the next clearing of the book (``lives``).
2. Lives are folded by price: size and number of live levels of a price after each change (``changes``).
3. A sweep over blocks of changes finds the best prices (``sweep``).  In a block only the touched prices
   and the best untouched ones can be among the best, so a block needs a small table of its own: states
   down, candidate prices across.  The cost of a change does not depend on the size of the book.

Sizes at a price are running sums: exact for whole sizes below 2**53, to rounding otherwise.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

BLOCK = 128
SIDES = ("Buy", "Sell")


class Deltas(NamedTuple):
    """Rows of one key in order, as arrays.  ``side`` is the place in ``SIDES``, -1 for any other."""

    us: np.ndarray
    seq: np.ndarray
    side: np.ndarray
    id: np.ndarray
    price: np.ndarray
    size: np.ndarray
    insert: np.ndarray
    update: np.ndarray
    delete: np.ndarray
    partial: np.ndarray


class Levels(NamedTuple):
    """Live levels before the first row."""

    side: np.ndarray
    id: np.ndarray
    price: np.ndarray
    size: np.ndarray


class Lives(NamedTuple):
    """Touches of levels in the order (side, id, pos); ``alive`` from ``pos`` to before ``end``."""

    pos: np.ndarray
    end: np.ndarray
    side: np.ndarray
    price: np.ndarray
    size: np.ndarray
    alive: np.ndarray
    was_alive: np.ndarray


def clearings(d: Deltas, snapshot: str, known: int | None) -> np.ndarray:
    """Positions of the rows that empty the book first: each snapshot row, or the first of each snapshot
    time other than ``known``, whose snapshot began before these rows."""
    at = np.flatnonzero(d.partial)
    if snapshot == "row" or not len(at):
        return at
    us = d.us[at]
    fresh = np.r_[True, us[1:] != us[:-1]]
    if known is not None:
        fresh &= us != known
    return at[fresh]


def _latest(flag: np.ndarray) -> np.ndarray:
    """Place of the last set flag up to each place, -1 if none."""
    return np.maximum.accumulate(np.where(flag, np.arange(len(flag)), -1))


def lives(d: Deltas, start: Levels, clears: np.ndarray) -> Lives:
    """State of the touched level after each touch; levels of ``start`` are touched at -1."""
    put = (d.insert | d.partial) & (d.price > 0) & (d.size > 0)
    kill = d.delete | (d.update & (d.size <= 0))
    touch = np.flatnonzero((d.side >= 0) & (put | kill | (d.update & (d.size > 0))))
    n, given = len(d.us), len(start.id)
    pos = np.concatenate([np.full(given, -1), touch])
    side, ident, price, size = (
        np.concatenate([a, b[touch]])
        for a, b in ((start.side, d.side), (start.id, d.id), (start.price, d.price), (start.size, d.size))
    )
    put = np.concatenate([np.ones(given, bool), put[touch]])
    kill = np.concatenate([np.zeros(given, bool), kill[touch]])

    order = np.lexsort((pos, ident, side))
    pos, side, ident, price, size, put, kill = (a[order] for a in (pos, side, ident, price, size, put, kill))
    if not len(pos):
        none = np.zeros(0, bool)
        return Lives(pos, pos, side, price, size, none, none)
    first = np.r_[True, (side[1:] != side[:-1]) | (ident[1:] != ident[:-1])]
    born, epoch = _latest(put), np.searchsorted(clears, pos, side="right")
    alive = (born >= _latest(first)) & (born > _latest(kill)) & (epoch[born] == epoch)
    was_alive = np.r_[False, alive[:-1] & (epoch[1:] == epoch[:-1])] & ~first
    follow = np.where(np.r_[first[1:], True], n, np.r_[pos[1:], n])
    end = np.minimum(follow, np.r_[clears, n][epoch])
    return Lives(pos, end, side, price[born], size, alive, was_alive)


class Changes(NamedTuple):
    """Changes at the prices of one side in order of ``pos``; ``rank`` points into ``prices``, best first."""

    prices: np.ndarray
    pos: np.ndarray
    rank: np.ndarray
    size: np.ndarray
    live: np.ndarray


def changes(lv: Lives, side: int, n: int) -> Changes:
    pick = lv.alive & (lv.side == side)
    sign = -1.0 if SIDES[side] == "Buy" else 1.0
    price, rank = np.unique(sign * lv.price[pick], return_inverse=True)
    size, begin, end = lv.size[pick], lv.pos[pick], lv.end[pick]
    closed = end < n
    pos = np.concatenate([begin, end[closed]])
    rank = np.concatenate([rank, rank[closed]])
    by = np.concatenate([size, -size[closed]])
    step = np.concatenate([np.ones(len(size), np.int64), np.full(int(closed.sum()), -1)])
    order = np.lexsort((pos, rank))
    pos, rank = pos[order], rank[order]
    total, count = np.cumsum(by[order]), np.cumsum(step[order])
    if len(pos):
        first = np.flatnonzero(np.r_[True, rank[1:] != rank[:-1]])
        length = np.diff(np.r_[first, len(pos)])
        total = total - np.repeat(np.r_[0.0, total][first], length)
        count = count - np.repeat(np.r_[0, count][first], length)
        last = np.r_[(rank[1:] != rank[:-1]) | (pos[1:] != pos[:-1]), True]
        pos, rank, total, count = pos[last], rank[last], total[last], count[last]
    order = np.argsort(pos, kind="stable")
    live = (count > 0)[order]
    return Changes(sign * price, pos[order], rank[order], np.where(live, total[order], 0.0), live)


class Best(NamedTuple):
    """Best price of the states asked for (NaN: none), and ragged lists of the best levels."""

    top: np.ndarray
    lengths: np.ndarray
    prices: np.ndarray
    sizes: np.ndarray


def _ragged(lengths: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Places of the lists ``rows`` in the flat values of lists of ``lengths``."""
    start = np.cumsum(lengths) - lengths
    size = lengths[rows]
    offset = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(start[rows] - offset, size)


def sweep(ch: Changes, at: np.ndarray, deep: np.ndarray, depth: int) -> Best:
    """Best price after each position of ``at``, best ``depth`` levels after each of ``deep`` (ascending)."""
    given = int(np.searchsorted(ch.pos, 0))
    live, size = np.zeros(len(ch.prices), bool), np.zeros(len(ch.prices))
    live[ch.rank[:given]], size[ch.rank[:given]] = ch.live[:given], ch.size[:given]
    pos, rank, c_live, c_size = (a[given:] for a in (ch.pos, ch.rank, ch.live, ch.size))
    m = len(pos)
    wanted, back = np.unique(np.searchsorted(pos, deep, side="right"), return_inverse=True)
    if not depth:
        wanted, back = wanted[:0], back[:0]
    best = np.full(m + 1, -1)
    lengths, ranks, sizes = [], [], []
    # State i is the book after i changes; a block holds the states from b on.
    for b in range(0, m + 1, BLOCK):
        rows = min(BLOCK, m + 1 - b)
        part = slice(b, min(b + BLOCK, m))
        touched = np.unique(rank[part])
        before = live[touched]
        live[touched] = False
        others = np.flatnonzero(live)[: max(depth, 1)]
        live[touched] = before
        cand = np.sort(np.concatenate([touched, others]))
        wide = len(cand)
        asked = wanted[np.searchsorted(wanted, b): np.searchsorted(wanted, b + rows)] - b
        if not wide:
            lengths.append(np.zeros(len(asked), np.int64))
            continue
        # Each cell points at the value in force: the price's before the block, or that of its last change.
        source = np.zeros((rows, wide), np.int32)
        source[0] = np.arange(wide)
        inner = np.arange(rows - 1)
        source[inner + 1, np.searchsorted(cand, rank[b: b + rows - 1])] = wide + inner
        np.maximum.accumulate(source, axis=0, out=source)
        table = np.concatenate([live[cand], c_live[part]])[source]
        lead = table.argmax(axis=1)
        best[b: b + rows] = np.where(table[np.arange(rows), lead], cand[lead], -1)
        if len(asked):
            chosen = table[asked]
            chosen &= np.cumsum(chosen, axis=1, dtype=np.int32) <= depth
            row, col = np.nonzero(chosen)
            lengths.append(chosen.sum(axis=1))
            ranks.append(cand[col])
            sizes.append(np.concatenate([size[cand], c_size[part]])[source[asked[row], col]])
        # Of several changes of a price the last one stays.
        live[rank[part]], size[rank[part]] = c_live[part], c_size[part]
    prices = np.r_[ch.prices, np.nan]
    top = prices[best[np.searchsorted(pos, at, side="right")]]
    if not len(wanted):
        return Best(top, np.zeros(0, np.int64), np.zeros(0), np.zeros(0))
    lens = np.concatenate(lengths)
    flat = _ragged(lens, back)
    px = ch.prices[np.concatenate(ranks)] if ranks else np.zeros(0)
    sz = np.concatenate(sizes) if sizes else np.zeros(0)
    return Best(top, lens[back], px[flat], sz[flat])


def last_valid(values: np.ndarray) -> np.ndarray:
    """Each value, or where it is NaN the last one before it that is not."""
    at = _latest(~np.isnan(values))
    return np.where(at >= 0, values[at], np.nan)
