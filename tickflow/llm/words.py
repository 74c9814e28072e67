"""Words, word hashes and k-gram hashes of whole Arrow batches, without a Python step per word.

Texts are cut into words by a table over the 256 byte values: in UTF-8 every byte of a non-ASCII
character is 0x80 or more, so the word rules of this package (which name ASCII characters only) hold
byte by byte.  Hashes are polynomials over byte (or word) values modulo 2**64, taken from prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
"""Bytes of text handled at once; a longer text is a chunk of its own."""

U = np.uint64
_BASE, _GRAM = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# The word classes of the operators' contracts.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
NOT_ALNUM = (*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80))


def _class(excluded: tuple[int, ...]) -> np.ndarray:
    out = np.ones(256, bool)
    out[list(excluded)] = False
    return out


BY_SPACE = _class(SPACES)
BY_ALNUM = _class(NOT_ALNUM)


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads every bit."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_VALUES = mix(np.arange(1, 257, dtype=U) * U(_BASE))
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, CHUNK + 1)
        up, down = np.full(size, base, U), np.full(size, pow(base, -1, 1 << 64), U)
        up[0] = down[0] = 1
        have = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        if size <= 4 * CHUNK:
            _powers[base] = have
    return have


def _prefix(values: np.ndarray) -> np.ndarray:
    out = np.zeros(len(values) + 1, U)
    np.cumsum(values, out=out[1:])
    return out


@dataclass
class Words:
    """The words of consecutive texts: byte ranges, the first word of each text, hashes."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    """first[r] .. first[r + 1]: the words of text r."""
    hash: np.ndarray
    _sums: np.ndarray | None = field(default=None, repr=False)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def row(self) -> np.ndarray:
        """The text each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def stop(self) -> np.ndarray:
        """For each word, the end of its text's words."""
        return np.repeat(self.first[1:], self.counts)

    def grams(self, at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        """Hashes of the ``n`` words from each position; they must lie in one text."""
        up, down = powers(_GRAM, len(self.hash) + 1)
        if self._sums is None:
            self._sums = _prefix(self.hash * up[: len(self.hash)])
        return mix((self._sums[at + n] - self._sums[at]) * down[at] + np.asarray(n).astype(U))


def ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges."""
    up, down = powers(_BASE, len(data) + 1)
    sums = _prefix(_VALUES[data] * up[: len(data)])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U))


def cut(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, lower: bool) -> Words:
    """Words of the texts data[offsets[r]:offsets[r + 1]]."""
    if lower:
        data = _LOWER[data]
    word = inside[data]
    before, after = np.zeros(len(word), bool), np.zeros(len(word), bool)
    before[1:], after[:-1] = word[:-1], word[1:]
    full = offsets[:-1][offsets[1:] > offsets[:-1]]
    before[full] = False
    after[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = False
    start, end = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    up, down = powers(_BASE, len(data) + 1)
    sums = _prefix(_VALUES[data] * up[: len(data)])
    hashed = mix((sums[end] - sums[start]) * down[start] + (end - start).astype(U))
    return Words(data, start, end, np.searchsorted(start, offsets), hashed)


def chunks(texts: pa.Array, inside: np.ndarray, lower: bool, size: int = CHUNK) -> Iterator[tuple[int, int, Words]]:
    """(first row, row after the last, words) of runs of texts of about ``size`` bytes."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield a, b, cut(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], inside, lower)
        a = b


def winnow(words: Words, k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Winnowing: of every ``w`` consecutive k-gram hashes of a text the smallest, rightmost of ties.

    Returns for each selected k-gram its hash, its position, and the first and last of the
    (w + k - 1)-word windows that selected it.  Equal windows select equal k-grams, in any text.
    """
    span, n = w + k - 1, len(words.hash)
    none = np.zeros(0, np.int64)
    if n < span:
        return np.zeros(0, U), none, none, none
    low, at = words.grams(np.arange(n - k + 1), k), np.arange(n - k + 1)

    def merge(low, at, by):
        a, b = low[: len(low) - by], low[by:]
        right = b <= a
        return np.where(right, b, a), np.where(right, at[by:], at[: len(at) - by])

    whole, size = low, 1
    while 2 * size <= w:
        low, at = merge(low, at, size)
        size *= 2
    if size < w:
        low, at = merge(low, at, w - size)
    windows = np.flatnonzero(np.arange(n - span + 1) + span <= words.stop()[: n - span + 1])
    if not len(windows):
        return np.zeros(0, U), none, none, none
    # Windows of one text follow each other, and so do those that select one position.
    chosen = at[windows]
    new = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    last = np.r_[new[1:], len(windows)] - 1
    p = chosen[new]
    return whole[p], p, windows[new], windows[last]


def spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges first..last (inclusive), and the range each comes from."""
    n = last - first + 1
    origin = np.repeat(np.arange(len(first)), n)
    begin = np.repeat(np.cumsum(n) - n, n)
    return np.arange(len(origin)) - begin + first[origin], origin


def contains(ordered: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each ``x`` is in the sorted array, and where."""
    if not len(ordered):
        return np.zeros(len(x), bool), np.zeros(len(x), np.int64)
    at = np.searchsorted(ordered, x)
    at[at == len(ordered)] = 0
    return ordered[at] == x, at


def runs(covered: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of covered words within each text: text, first word, word after the last."""
    before, after = np.zeros(len(covered), bool), np.zeros(len(covered), bool)
    before[1:], after[:-1] = covered[:-1], covered[1:]
    inner = first[1:-1]
    before[inner[inner < len(covered)]] = False
    after[inner[inner > 0] - 1] = False
    a, b = np.flatnonzero(covered & ~before), np.flatnonzero(covered & ~after) + 1
    return np.searchsorted(first, a, "right") - 1, a, b
