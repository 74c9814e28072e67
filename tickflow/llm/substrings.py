"""Repeated passages by seed and extend.

A window is ``span`` consecutive words.  A word goes when it lies in a window whose word sequence also
starts in a document with a smaller id.  Documents are winnowed to anchors (k-grams, about two for every
42 words); every window belongs to the one anchor it selects, and equal windows select equal anchors.
Anchors are joined across documents, and a shared anchor is extended both ways over its windows:

* first as a whole: the words of all its windows are one hash.  Where all occurrences agree, or an
  earlier document agrees with the whole, nothing finer is needed;
* else window by window, at the borders of a repeat only.

Neighbouring covered windows join to maximal repeats.  Groups are only ever folded to a minimum id,
before the shuffle, and joined back; no pairs of documents are made.

Defined results: a null or empty text has no words.  A row without an id counts as later than every
id (and not as earlier than another row without one).  Rows with one id are one document, which never
repeats itself.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.llm.frames import ROW, annotate, stage
from tickflow.llm.words import BY_SPACE, chunks, runs, spread, winnow

SPAN, K = 50, 10
LAST = (1 << 63) - 1
"""Stands for a missing id: later than all others."""

_ANCHORS = T.ArrayType(
    T.StructType(
        [T.StructField("anchor", T.LongType()), T.StructField("whole", T.LongType())]
        + [T.StructField(c, T.IntegerType()) for c in ("lo", "hi")]
    )
)
_SEEDED = [
    T.StructField("n_words", T.LongType()),
    T.StructField("sha", T.StringType()),
    T.StructField("anchors", _ANCHORS),
]
_FINE = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("window", "ord", "name")] + [T.StructField("at", T.IntegerType())]
)


def _seeds(span: int, k: int):
    def fn(texts: pa.Array) -> dict:
        counts, shas, sizes, parts = [], [], [], []
        for text in texts:
            shas.append(hashlib.sha256(b" ".join(text.as_buffer().to_pybytes().split())).hexdigest())
        for _, _, words in chunks(texts, BY_SPACE, lower=False):
            counts.append(words.counts)
            anchor, p, lo, hi = winnow(words, k, span - k + 1)
            whole = words.grams(lo, hi + span - lo)
            row = np.searchsorted(words.first, p, "right") - 1
            sizes.append(np.bincount(row, minlength=len(words.counts)))
            base = words.first[row]
            parts.append((anchor.view(np.int64), whole.view(np.int64), (lo - base).astype(np.int32), (hi - base).astype(np.int32)))
        if not counts:
            return {"n_words": [], "sha": [], "anchors": []}
        offsets = np.r_[0, np.cumsum(np.concatenate(sizes))].astype(np.int32)
        columns = [pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)]
        anchors = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(columns, ["anchor", "whole", "lo", "hi"]))
        return {"n_words": np.concatenate(counts), "sha": shas, "anchors": anchors}

    return fn


def _ranges(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists of (lo, hi) as flat arrays: the begin of each row's part, all lo, all hi."""
    begin = np.r_[0, np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))].astype(np.int64)
    flat = column.flatten()
    return begin, *(flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("lo", "hi"))


def _windows(span: int):
    """The hash of every window in the ranges of a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order, name = batch.column("ord").to_numpy(), batch.column("name").to_numpy()
            begin, low, high = _ranges(batch.column("fine"))
            texts = batch.column("text").fill_null("").cast(pa.large_string())
            for a, b, words in chunks(texts, BY_SPACE, lower=False):
                own = slice(begin[a], begin[b])
                base = np.repeat(words.first[:-1], np.diff(begin[a : b + 1]))
                at, _ = spread(low[own] + base, high[own] + base)
                row = np.searchsorted(words.first, at, "right") - 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(words.grams(at, span).view(np.int64)), pa.array(order[a + row]), pa.array(name[a + row]),
                        pa.array((at - words.first[row]).astype(np.int32)),
                    ],
                    names=["window", "ord", "name", "at"],
                )

    return run


_CUT = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("kept_sha256", T.StringType()),
    T.StructField("repeats", T.ArrayType(T.ArrayType(T.IntegerType()))),
]


def _remove(span: int):
    """Cover the words of the windows found, and describe what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            whole, single = _ranges(batch.column("solved")), _ranges(batch.column("found"))
            texts = batch.column("text").fill_null("").cast(pa.large_string())
            for a, b, words in chunks(texts, BY_SPACE, lower=False):
                n = len(words.hash)
                change = np.zeros(n + 1, np.int64)
                for begin, low, high in (whole, single):
                    own = slice(begin[a], begin[b])
                    base = np.repeat(words.first[:-1], np.diff(begin[a : b + 1]))
                    np.add.at(change, low[own] + base, 1)
                    np.add.at(change, high[own] + base + span, -1)
                gone = np.cumsum(change[:-1]) > 0
                repeats: list[list] = [[] for _ in range(b - a)]
                for r, x, y in zip(*runs(gone, words.first), strict=True):
                    repeats[r].append([int(x - words.first[r]), int(y - words.first[r])])
                shas, removed = [], []
                for r in range(b - a):
                    own = slice(words.first[r], words.first[r + 1])
                    raw = texts[a + r].as_buffer().to_pybytes().split()
                    kept = [w for w, g in zip(raw, gone[own].tolist(), strict=True) if not g]
                    shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
                    removed.append(len(raw) - len(kept))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, b - a), pa.array(words.counts), pa.array(removed, pa.int64()), pa.array(shas),
                        pa.array(repeats, pa.list_(pa.list_(pa.int32()))),
                    ],
                    names=["doc_id", *[f.name for f in _CUT]],
                )

    return run


def find(docs: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and ``repeats``: the maximal ranges of words to remove."""
    named = docs.select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(LAST)).alias("ord"), F.xxhash64("text").alias("name")
    )
    base = stage(
        annotate(named, _SEEDED, _seeds(span, k)).select(f"{ROW}.doc_id", f"{ROW}.ord", f"{ROW}.name", "n_words", "sha", "anchors"),
        "anchors",
    )
    seeds = base.select("ord", "name", F.explode("anchors").alias("x")).select("ord", "name", "x.*")
    # Folded sides are written before they are joined back: both sides of such a join are then plain
    # shuffles, and the engine can split a hot anchor over tasks.
    met = stage(seeds.groupBy("anchor").agg(
        F.min("ord").alias("first"), F.max("ord").alias("last"),
        F.min("whole").alias("low"), F.max("whole").alias("high"),
    ).where("first < last"), "met")
    shared = stage(seeds.join(met, "anchor").selectExpr("anchor", "whole", "ord", "name", "lo", "hi", "first", "low = high AS alike"), "seeds")
    mixed = shared.where("NOT alike")
    earliest = stage(mixed.groupBy("anchor", "whole").agg(F.min("ord").alias("first")), "met")
    judged = shared.where("alike").select("ord", "name", "lo", "hi", (F.col("ord") > F.col("first")).alias("gone"), F.lit(False).alias("open")).unionByName(
        mixed.drop("first").join(earliest, ["anchor", "whole"]).select(
            "ord", "name", "lo", "hi", (F.col("ord") > F.col("first")).alias("gone"), (F.col("ord") == F.col("first")).alias("open")
        )
    )
    # One row per document, of at most as many ranges as it has anchors.
    ranges = judged.where("gone OR open").groupBy("ord", "name").agg(
        F.collect_list(F.when(F.col("gone"), F.struct("lo", "hi"))).alias("solved"),
        F.collect_list(F.when(F.col("open"), F.struct("lo", "hi"))).alias("fine"),
    )
    flagged = stage(named.join(ranges, ["ord", "name"]), "flagged")
    fine = stage(
        flagged.where(F.size("fine") > 0).select("ord", "name", "fine", "text").mapInArrow(_windows(span), _FINE), "windows"
    )
    twice = stage(fine.groupBy("window").agg(F.min("ord").alias("first"), F.max("ord").alias("last")).where("first < last"), "met")
    found = fine.join(twice, "window").where("ord > first").groupBy("ord", "name").agg(F.collect_set(F.struct(F.col("at").alias("lo"), F.col("at").alias("hi"))).alias("found"))
    schema = T.StructType([docs.schema["doc_id"], *_CUT])
    changed = flagged.join(found, ["ord", "name"], "left").select("doc_id", "text", "solved", "found").mapInArrow(_remove(span), schema)
    untouched = base.join(ranges.select("ord", "name"), ["ord", "name"], "left_anti").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256"),
        F.array().cast(_CUT[3].dataType).alias("repeats"),
    )
    return changed.unionByName(untouched)


def report(docs: DataFrame, span: int = SPAN, k: int = K) -> DataFrame:
    return find(docs, span, k).select("doc_id", "n_words", "n_removed", "kept_sha256")
