"""Benchmark decontamination by winnowing.

A window is ``span`` consecutive words of a benchmark item (an item of fewer words, but not none, is
one window).  Of every item the minimum k-gram hash of each winnowing window is kept; documents are
winnowed alike, their fingerprints are joined with those of the benchmark, and every hit is extended
over the windows it stands for: any shared run of ``span`` words selects one fingerprint in both, so
none is missed.  The benchmark is the small side by nature.  It reaches the tasks in blocks of at most
``block`` windows, each broadcast by itself; more items mean more blocks in the same single pass over
the documents, which are never shuffled.

Defined results: a null or empty text has no words, no hits and no items; a null text of an item gives
no window; an item without an id is listed as ``null``; repeated documents are judged row by row;
repeated item ids count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.llm.frames import ROW, annotate
from tickflow.llm.words import BY_ALNUM, U, chunks, contains, runs, spread, winnow

SPAN = 10
K = 5
BLOCK = 1 << 20

_WINDOWS = T.StructType(
    [
        T.StructField("item", T.StringType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("windows", T.ArrayType(T.LongType())),
        T.StructField("prints", T.ArrayType(T.LongType())),
    ]
)


def _windows(span: int, k: int, block: int):
    """Rows of at most ``block`` windows of an item, with the item's fingerprints among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1).fill_null("").cast(pa.large_string())
            for a, _, words in chunks(texts, BY_ALNUM, lower=True):
                prints, at, _, _ = winnow(words, k, span - k + 1)
                for r, (lo, hi) in enumerate(zip(words.first[:-1], words.first[1:], strict=True)):
                    if lo == hi:
                        continue
                    n = min(span, int(hi - lo))
                    starts = np.arange(lo, hi - n + 1)
                    hashes = words.grams(starts, n)
                    for b in range(0, len(hashes), block):
                        piece = hashes[b : b + block]
                        # Every window selects a fingerprint among its own words.
                        within = (at >= lo + b) & (at < lo + b + len(piece) + n - 1)
                        own = prints[within] if n == span else piece
                        yield pa.RecordBatch.from_pydict(
                            {
                                "item": pa.array([str(ids[a + r]) if ids[a + r] is not None else "null"]),
                                "n": pa.array([n], pa.int32()),
                                "windows": pa.array([piece.view(np.int64)], pa.list_(pa.int64())),
                                "prints": pa.array([own.view(np.int64)], pa.list_(pa.int64())),
                            }
                        )

    return run


class _Block:
    """Windows of some items by hash, the items of each, and the fingerprints to look for."""

    def __init__(self, rows: list) -> None:
        self.items = sorted({r["item"] for r in rows})
        number = {x: i for i, x in enumerate(self.items)}
        self.lengths = sorted({r["n"] for r in rows})
        keys = np.concatenate([np.array(r["windows"], np.int64).view(U) for r in rows])
        owner = np.concatenate([np.full(len(r["windows"]), number[r["item"]]) for r in rows])
        both = np.unique(np.rec.fromarrays([keys, owner]))
        self.keys, self.begin = np.unique(both["f0"], return_index=True)
        self.begin = np.append(self.begin, len(both))
        self.owner = both["f1"].astype(np.int32)
        self.prints = np.unique(np.concatenate([np.array(r["prints"], np.int64).view(U) for r in rows]))


def blocks(benchmark: DataFrame, span: int, k: int, block: int) -> Iterator[_Block]:
    """The benchmark in blocks; one block at a time is in the driver."""
    rows: list = []
    size = 0
    prepared = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string"))
    for row in prepared.mapInArrow(_windows(span, k, block), _WINDOWS).toLocalIterator():
        if rows and size + len(row["windows"]) > block:
            yield _Block(rows)
            rows, size = [], 0
        rows.append(row)
        size += len(row["windows"])
    if rows:
        yield _Block(rows)


def _search(block: _Block, texts: pa.Array, span: int, k: int) -> Iterator[tuple]:
    for a, b, words in chunks(texts, BY_ALNUM, lower=True):
        starts, lengths = [], []
        if span in block.lengths:
            prints, _, lo, hi = winnow(words, k, span - k + 1)
            seed, _ = contains(block.prints, prints)
            at, _ = spread(lo[seed], hi[seed])
            starts.append(at)
            lengths.append(np.full(len(at), span))
        for n in block.lengths:
            if n < span:
                at = np.arange(max(0, len(words.hash) - n + 1))
                at = at[at + n <= words.stop()[at]]
                seed, _ = contains(block.prints, words.grams(at, n))
                starts.append(at[seed])
                lengths.append(np.full(int(seed.sum()), n))
        at = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        n = np.concatenate(lengths) if lengths else np.zeros(0, np.int64)
        hit, window = contains(block.keys, words.grams(at, n))
        at, n, window = at[hit], n[hit], window[hit]
        change = np.zeros(len(words.hash) + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + n, -1)
        row = np.searchsorted(words.first, at, "right") - 1
        pairs = np.unique(np.rec.fromarrays([row, window])) if len(row) else None
        found: dict[int, list[str]] = {}
        if pairs is not None:
            index, origin = spread(block.begin[pairs["f1"]], block.begin[pairs["f1"] + 1] - 1)
            who = np.unique(np.rec.fromarrays([pairs["f0"][origin], block.owner[index]]))
            for r, i in who.tolist():
                found.setdefault(r, []).append(block.items[i])
        yield a, b, words, np.cumsum(change[:-1]) > 0, found


def _merge(old: list, new: list) -> list:
    """The union of two sorted lists of disjoint ranges."""
    out: list = []
    for x in sorted([*old, *new], key=lambda x: x["start"]):
        if out and x["start"] <= out[-1]["end"]:
            out[-1] = {"start": out[-1]["start"], "end": max(out[-1]["end"], x["end"])}
        else:
            out.append(x)
    return out


FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField(
        "hits",
        T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])),
    ),
    T.StructField("items", T.ArrayType(T.StringType())),
]


def find(
    docs: DataFrame, benchmark: DataFrame, span: int = SPAN, k: int = K, block: int = BLOCK, columns: list[str] | None = None
) -> DataFrame:
    """``_row`` (the columns of ``docs``, or ``columns`` of them), ``n_words``, ``hits`` (ranges of words
    inside an occurring window, end exclusive) and ``items`` (ids of the items with such windows)."""
    sc = docs.sparkSession.sparkContext
    docs = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*(columns or docs.columns), "text"])])

    def mapper(shared):
        def fn(texts: pa.Array) -> dict:
            counts, hits, items = [], [], []
            for a, b, words, covered, found in _search(shared.value, texts, span, k):
                counts.append(words.counts)
                own: list[list] = [[] for _ in range(b - a)]
                for r, lo, hi in zip(*runs(covered, words.first), strict=True):
                    own[r].append({"start": int(lo - words.first[r]), "end": int(hi - words.first[r])})
                hits += own
                items += [found.get(r, []) for r in range(b - a)]
            return {"n_words": np.concatenate(counts) if counts else [], "hits": hits, "items": items}

        return fn

    def empty(texts: pa.Array) -> dict:
        counts = [w.counts for _, _, w in chunks(texts, BY_ALNUM, lower=True)]
        none: list[list] = [[] for _ in range(len(texts))]
        return {"n_words": np.concatenate(counts) if counts else [], "hits": none, "items": none}

    merge_hits = F.udf(_merge, FIELDS[1].dataType)
    out = None
    for part in blocks(benchmark, span, k, block):
        fn = mapper(sc.broadcast(part))
        if out is None:
            out = annotate(docs, FIELDS, fn)
            continue
        # A further block: the ranges and items found so far ride along in the row.
        before = out.select(F.col(f"{ROW}.text").alias("text"), F.struct(ROW, "hits", "items").alias("old"))
        out = annotate(before, FIELDS, fn).select(
            F.col(f"{ROW}.old.{ROW}").alias(ROW),
            "n_words",
            F.when(F.size("hits") == 0, F.col(f"{ROW}.old.hits"))
            .when(F.size(f"{ROW}.old.hits") == 0, F.col("hits"))
            .otherwise(merge_hits(f"{ROW}.old.hits", "hits"))
            .alias("hits"),
            F.array_union(f"{ROW}.old.items", "items").alias("items"),
        )
    return out if out is not None else annotate(docs, FIELDS, empty)


def clean(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The documents without any benchmark window, with their own columns."""
    return find(docs, benchmark, **how).where(F.size("items") == 0).select(f"{ROW}.*")


def report(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """One row per document: counts, the digest of the items found, the verdict."""
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda s, x: s + (x["end"] - x["start"]).cast("long"))
    return find(docs, benchmark, columns=["doc_id"], **how).select(
        f"{ROW}.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )
