"""Alignment of two public tokenizers by interval coalescing, and corpus-wide counts of linked ids.

Each text is encoded by a byte-level BPE (A) and a piece BPE (B); a token is the range of bytes it
covers of the text with one space before it.  All tokens of a run of texts, A's and B's together, are
sorted by where they start; the running maximum of their ends tells where a new group begins: at a start
that reaches it.  Within a group every A token is expanded to the B tokens whose ranges overlap its own
(its links).

The number of documents that hold a pair of ids linked is counted over the whole corpus: tasks fold
pairs to counts before the shuffle, the counts are written as sorted arrays to the shared folder, and
workers memory-map them to look up the links of their texts.  A pair of vocabularies has at most
``len(A) * len(B)`` pairs, whatever the corpus; no table of them is collected or broadcast.

Defined results: null and empty texts, and texts whose A or B bytes are not those of space + text, have
no tokens; their counts are 0 and the digest is ''.  Every row is a document of its own, also where rows
repeat an id or a text.  Rows without an id are aligned alike.  An empty table gives no rows.  Texts of
any length are handled whole.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.llm.frames import ROW, annotate, stage
from tickflow.llm.shards import mapped, save
from tickflow.llm.words import spread
from tickflow.session import work_path

FOLDER = "/opt/tokenizers"
A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SHARD = 1 << 20
"""Pairs in a file of counts."""
RUN = 1 << 18
"""Bytes of text, or tokens, a worker aligns at once; a longer text is a run of its own."""
HELD = 1 << 20
"""Pairs a task folds before it hands them on."""
PLAIN = 0xCD
"""Texts of bytes below this (code points under U+0340) are cut alike by both BPE libraries, and take the faster one."""

# How the byte-level vocabulary file spells bytes, and the pattern that cuts texts before merging.
PRINTED = (*range(33, 127), *range(161, 173), *range(174, 256))
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@dataclass
class Vocabulary:
    """The bytes of each id, one after the other."""

    data: np.ndarray
    begin: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, tokens: list[bytes]) -> Vocabulary:
        size = np.array([len(t) for t in tokens], np.int64)
        return cls(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids in a row."""
        first = self.begin[ids]
        at, _ = spread(first, first + self.size[ids] - 1)
        return self.data[at]


class Tokenizers:
    """Both tokenizers of a worker, loaded once."""

    def __init__(self, folder: str) -> None:
        import sentencepiece
        import tiktoken

        self.folder = folder
        with open(f"{folder}/{A_FILE}", encoding="utf-8") as file:
            file_of = json.load(file)
        vocabulary = file_of["model"]["vocab"]
        moved = [b for b in range(256) if b not in set(PRINTED)]
        spelt = {chr(b): b for b in PRINTED} | {chr(256 + i): b for i, b in enumerate(moved)}
        special = {t["content"] for t in file_of["added_tokens"]}
        coded = {w: bytes(spelt[c] for c in w) for w in vocabulary if w not in special}
        self.fast = tiktoken.Encoding(
            "a", pat_str=PATTERN, mergeable_ranks={coded[w]: i for w, i in vocabulary.items() if w in coded}, special_tokens={}
        )
        raw = [b""] * (max(vocabulary.values()) + 1)
        for word, i in vocabulary.items():
            raw[i] = coded.get(word, word.encode())
        self.a = Vocabulary.of(raw)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{B_FILE}")
        raw = []
        for i in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(i)
            raw.append(bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode())
        self.b = Vocabulary.of(raw)

    @functools.cached_property
    def exact(self):
        import tokenizers

        coder = tokenizers.Tokenizer.from_file(f"{self.folder}/{A_FILE}")
        coder.encode_special_tokens = True
        return coder

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The ids of A and B of each text; none where they do not spell the text."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        out = []
        for text, ids in zip(texts, self.pieces.encode(texts, num_threads=1), strict=True):
            want = np.frombuffer(b" " + text.encode(), np.uint8)
            b = np.array(ids, np.int64)
            if not text or not np.array_equal(self.b.joined(b), want):
                out.append(none)
                continue
            plain = want.max() < PLAIN
            a = np.array(self.fast.encode_ordinary(" " + text) if plain else self.exact.encode(" " + text, add_special_tokens=False).ids, np.int64)
            out.append((a, b) if np.array_equal(self.a.joined(a), want) else none)
        return out


_loaded: dict[str, Tokenizers] = {}


def tokenizers(folder: str) -> Tokenizers:
    if folder not in _loaded:
        _loaded[folder] = Tokenizers(folder)
    return _loaded[folder]


@dataclass
class Aligned:
    """Tokens of a run of texts laid end to end, A's first, then B's; groups; links (A token, B token)."""

    ids: np.ndarray
    row: np.ndarray
    kind: np.ndarray
    start: np.ndarray
    end: np.ndarray
    group: np.ndarray
    order: np.ndarray
    """Tokens by group, then kind, then place."""
    link_a: np.ndarray
    link_b: np.ndarray


def coalesce(pairs: list[tuple[np.ndarray, np.ndarray]], a: Vocabulary, b: Vocabulary) -> Aligned:
    ids = [np.concatenate([p[k] for p in pairs]) if pairs else np.zeros(0, np.int64) for k in (0, 1)]
    row = [np.repeat(np.arange(len(pairs)), [len(p[k]) for p in pairs]) for k in (0, 1)]
    sizes = [v.size[i] for v, i in zip((a, b), ids, strict=True)]
    # Both sides spell the same bytes of each text, so one running sum places them alike.
    ends = [np.cumsum(s) for s in sizes]
    starts = [e - s for e, s in zip(ends, sizes, strict=True)]
    start, end = np.concatenate(starts), np.concatenate(ends)
    kind = np.repeat([0, 1], [len(i) for i in ids])
    by_start = np.lexsort((kind, start))
    reach = np.maximum.accumulate(end[by_start])
    new = np.ones(len(start), bool)
    new[1:] = start[by_start][1:] >= reach[:-1]
    group = np.empty(len(start), np.int64)
    group[by_start] = np.cumsum(new) - 1
    # Overlaps within a group: the B tokens that end after an A token starts and start before it ends.
    low = np.searchsorted(ends[1], starts[0], "right")
    high = np.searchsorted(starts[1], ends[0], "left")
    link_b, link_a = spread(low, high - 1)
    return Aligned(
        np.concatenate(ids), np.concatenate(row), kind, start, end, group, np.lexsort((start, kind, group)), link_a, link_b + len(ids[0])
    )


_DIGITS: list[np.ndarray] = []


def _spelt(x: Aligned, rows: int) -> list[str]:
    """SHA-256 of a1,a2|b1;a3|b2,b3 for each text."""
    if not len(x.ids):
        return [""] * rows
    n = int(x.ids.max()) + 1
    if not _DIGITS or len(_DIGITS[1]) < n:
        decimal = [str(i).encode() for i in range(max(n, 1 << 16))]
        size = np.array([len(d) for d in decimal], np.int64)
        _DIGITS[:] = [np.frombuffer(b"".join(decimal), np.uint8), size, np.cumsum(size) - size]
    data, size, begin = _DIGITS
    ids, group, kind, row = (c[x.order] for c in (x.ids, x.group, x.kind, x.row))
    mark = np.full(len(ids), ord(";"), np.uint8)
    same = group[1:] == group[:-1]
    mark[:-1][same] = np.where(kind[1:] == kind[:-1], ord(","), ord("|"))[same]
    at, _ = spread(begin[ids], begin[ids] + size[ids] - 1)
    last = np.cumsum(size[ids] + 1) - 1
    flat = np.empty(int(last[-1]) + 1, np.uint8)
    where = np.ones(len(flat), bool)
    where[last] = False
    flat[where], flat[last] = data[at], mark
    stop = np.cumsum(np.bincount(row, minlength=rows))
    out, begun = [], 0
    for r in range(rows):
        if not stop[r] or stop[r] == (stop[r - 1] if r else 0):
            out.append("")
            continue
        out.append(hashlib.sha256(flat[begun : last[stop[r] - 1]].tobytes()).hexdigest())
        begun = last[stop[r] - 1] + 1
    return out


_TOKENS = [
    T.StructField("a_ids", T.BinaryType()),
    T.StructField("b_ids", T.BinaryType()),
    *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")],
    T.StructField("groups_sha256", T.StringType()),
]


def _width(v: Vocabulary) -> np.dtype:
    return np.min_scalar_type(len(v.size))


def _runs(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Rows from a to before b, of about ``RUN`` in all."""
    at = total = 0
    for r, n in enumerate(sizes):
        if total and total + n > RUN:
            yield at, r
            at = r
            total = 0
        total += n
    if at < len(sizes):
        yield at, len(sizes)


def _encoded(folder: str):
    def fn(texts: pa.Array) -> dict:
        t = tokenizers(folder)
        out: dict[str, list] = {f.name: [] for f in _TOKENS}
        for a, b in _runs(pc.binary_length(texts).to_pylist()):
            pairs = t.encode(texts.slice(a, b - a).to_pylist())
            x, n = coalesce(pairs, t.a, t.b), len(pairs)
            first = x.order[np.r_[True, np.diff(x.group[x.order]) > 0]] if len(x.ids) else x.order
            out["a_ids"] += [p[0].astype(_width(t.a)).tobytes() for p in pairs]
            out["b_ids"] += [p[1].astype(_width(t.b)).tobytes() for p in pairs]
            for name, row in (("n_a", x.row[x.kind == 0]), ("n_b", x.row[x.kind == 1]), ("n_groups", x.row[first]), ("n_links", x.row[x.link_a])):
                out[name] += np.bincount(row, minlength=n).tolist()
            out["groups_sha256"] += _spelt(x, n)
        return out

    return fn


def encoded(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """``_row`` with the columns of ``docs``, the ids of both tokenizers, counts and the digest of the groups."""
    return annotate(docs, _TOKENS, _encoded(folder))


_GROUPS = [
    T.StructField(
        "groups",
        T.ArrayType(
            T.StructType(
                [T.StructField(c, T.LongType()) for c in ("begin", "end")]
                + [T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("a", "b")]
            )
        ),
    )
]


def _listed(folder: str):
    def fn(texts: pa.Array) -> dict:
        t = tokenizers(folder)
        out = []
        for pair in t.encode(texts.to_pylist()):
            x = coalesce([pair], t.a, t.b)
            groups: list[dict] = []
            for i in x.order.tolist():
                if x.group[i] == len(groups):
                    groups.append({"begin": int(x.start[i]), "end": 0, "a": [], "b": []})
                groups[-1]["end"] = max(groups[-1]["end"], int(x.end[i]))
                groups[-1]["ab"[x.kind[i]]].append(int(x.ids[i]))
            out.append(groups)
        return {"groups": out}

    return fn


def aligned(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """``_row`` with the columns of ``docs`` and ``groups``: the bytes of space + text, and the ids of A and B, of each group."""
    return annotate(docs, _GROUPS, _listed(folder))


def _ids(batch: pa.RecordBatch, t: Tokenizers) -> Iterator[tuple[int, int, Aligned]]:
    """The rows of a batch in runs, aligned again from their ids."""
    sides = [(batch.column(c), _width(v)) for c, v in (("a_ids", t.a), ("b_ids", t.b))]
    for a, b in _runs((pc.binary_length(sides[0][0]).to_numpy(zero_copy_only=False) // sides[0][1].itemsize).tolist()):
        ids = [[np.frombuffer(x.as_buffer(), width).astype(np.int64) for x in column.slice(a, b - a)] for column, width in sides]
        yield a, b, coalesce(list(zip(*ids, strict=True)), t.a, t.b)


def _pairs(x: Aligned, t: Tokenizers) -> np.ndarray:
    return x.ids[x.link_a] * len(t.b.size) + x.ids[x.link_b]


def _folded(folder: str):
    """(pair, documents) of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(folder)
        span = len(t.a.size) * len(t.b.size)
        held, size = [], 0

        def fold() -> tuple[np.ndarray, np.ndarray]:
            pair, at = np.unique(np.concatenate([h[0] for h in held]), return_inverse=True)
            n = np.zeros(len(pair), np.int64)
            np.add.at(n, at, np.concatenate([h[1] for h in held]))
            return pair, n

        for batch in batches:
            for _, _, x in _ids(batch, t):
                once = np.unique(x.row[x.link_a] * span + _pairs(x, t))
                held.append(np.unique(once % span, return_counts=True))
                size += len(held[-1][0])
                if size > HELD:
                    held = [fold()]
                    size = len(held[0][0])
                    if 2 * size > HELD:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in held[0]], names=["pair", "n"])
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in fold()], names=["pair", "n"])

    return run


_PAIR = T.StructType([T.StructField(c, T.LongType()) for c in ("pair", "n")])
_FILE = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("uri", T.StringType())])


def _saved(folder: str, width: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        pair, n = (table.column(c).to_numpy() for c in ("pair", "n"))
        order = np.argsort(pair)
        pair, n = pair[order], n[order]
        # All pairs of an A id are in one shard, one after the other: its highest count is there.
        new = np.flatnonzero(np.r_[True, np.diff(pair // width) > 0])
        best = n == np.repeat(np.maximum.reduceat(n, new), np.diff(np.r_[new, len(n)]))
        uri = save(folder, "pairs", np.stack([pair, n, best.astype(np.int64)]))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "uri": [uri]})

    return run


_SUMS = [T.StructField(c, T.LongType()) for c in ("n_best", "count_sum")]


def _looked_up(folder: str, files: list[str | None], names: list[str]):
    """Links that are their A id's best, and the sum of the links' counts, of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizers(folder)
        width = len(t.b.size)
        for batch in batches:
            best, total = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for a, b, x in _ids(batch, t):
                pair, at = np.unique(_pairs(x, t), return_inverse=True)
                n, top = np.zeros(len(pair), np.int64), np.zeros(len(pair), np.int64)
                shard = (pair // width) % len(files)
                for s in np.unique(shard).tolist():
                    mine = np.flatnonzero(shard == s)
                    table = mapped(files[s])
                    where = np.searchsorted(table[0], pair[mine])
                    n[mine], top[mine] = table[1][where], table[2][where]
                row = x.row[x.link_a]
                np.add.at(total[a:b], row, n[at])
                np.add.at(best[a:b], row, top[at])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(best), pa.array(total)], names=[*names, "n_best", "count_sum"]
            )

    return run


def report(docs: DataFrame, folder: str = FOLDER) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    coded = encoded(docs.select("doc_id", "text"), folder)
    base = stage(coded.select(f"{ROW}.doc_id", *[f.name for f in _TOKENS]), "tokens")
    width = len(tokenizers(folder).b.size)
    counts = stage(base.select("a_ids", "b_ids").mapInArrow(_folded(folder), _PAIR).groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    shards = max(1, -(-counts.count() // SHARD))
    kept = work_path(docs.sparkSession, "counts")
    dealt = counts.withColumn("shard", (F.floor(F.col("pair") / width) % shards).cast("int"))
    files: list[str | None] = [None] * shards
    for row in dealt.groupBy("shard").applyInArrow(_saved(kept, width), _FILE).collect():
        files[row.shard] = row.uri
    schema = T.StructType([*[base.schema[c] for c in names], *_SUMS])
    return base.mapInArrow(_looked_up(folder, files, names), schema)
