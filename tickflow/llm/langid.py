"""Language identification, word first with n-gram backoff.

Words are runs of letters (with their marks), lower-cased.  A known word is scored by its log frequency in each language.
An unseen word is scored at each of its positions by the longest known character n-gram that starts
there, falling back to ever shorter ones, and counts with the mean over its positions.  The text's
language has the largest sum; the score is its posterior under equal priors.

The model is fitted on a bounded sample of labelled rows (``per_language`` documents of each language
on average, taken by a hash of the row, never by order) and knows every label.  Its words and n-grams
are bounded in number (``words``, ``grams``) and taken in turns by their rank within each language, so a
rare language keeps as many as a frequent one.  Prediction reads every text in whole, and a text's score
does not depend on the texts beside it.

Defined results: a null text or one without letters is ``und`` with score 0.  A text of letters of
which none is known gets the first language by name and the uniform score.  A row without an id has no
remainder: it is not held out and may be learned from.  Without labelled rows everything is ``und``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.llm.frames import ROW, annotate, remainder, stage
from tickflow.llm.words import U, contains, mix, powers
from tickflow.operators.joins import bounded_join

MOD, HELD_OUT = 5, 0
PER_LANGUAGE = 4000
WORDS, GRAMS = 100_000, 30_000
LONGEST = 5
UNKNOWN = "und"
_BASE = 0x9E3779B97F4A7C15
_CHARS = 1 << 17


@cache
def _letters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every code point: what a letter or mark is lower-cased to (0: neither), whether it is a
    letter, and a hash value."""
    low, letter = np.zeros(0x110000, np.uint32), np.zeros(0x110000, bool)
    for c in range(0x32400):  # no letters are assigned beyond
        x = chr(c)
        if (kind := unicodedata.category(x)[0]) in "LM":
            y = x.lower()
            low[c] = ord(y) if len(y) == 1 else c
            letter[c] = kind == "L"
    return low, letter, mix(np.arange(1, 0x110001, dtype=U) * U(_BASE))


@dataclass
class Text:
    """Code points of consecutive texts, 0 where no letter is; the words; the texts' ends."""

    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    sums: np.ndarray
    down: np.ndarray

    def hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((self.sums[b] - self.sums[a]) * self.down[a] + (b - a).astype(U))


def _read(texts: list[str]) -> Text:
    low, letters, values = _letters()
    points = np.frombuffer(("\n" + "\n".join(texts) + "\n").encode("utf-32-le"), np.uint32)
    chars = low[points]
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    offsets = np.r_[1, 1 + np.cumsum(lengths)]
    inside = chars > 0
    start = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    end = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
    # Marks belong to the word they stand in; marks alone are no word.
    seen = np.r_[0, np.cumsum(letters[points])]
    real = seen[end] > seen[start]
    start, end = start[real], end[real]
    up, down = powers(_BASE, len(chars) + 1)
    sums = np.zeros(len(chars) + 1, U)
    np.cumsum(values[chars] * up[: len(chars)], out=sums[1:])
    return Text(start, end, np.searchsorted(start, offsets), sums, down)


def _parts(texts: list[str]) -> Iterator[tuple[int, int, Text]]:
    a, size = 0, 0
    for i, t in enumerate(texts):
        if i > a and size + len(t) > _CHARS:
            yield a, i, _read(texts[a:i])
            a, size = i, 0
        size += len(t) + 1
    if texts:
        yield a, len(texts), _read(texts[a:])


def _positions(text: Text, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start positions inside the given words (with the place before each), the word, the place after."""
    a, b = text.start[words] - 1, text.end[words]
    n = b - a
    word = np.repeat(np.arange(len(words)), n)
    at = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n) + a[word]
    return at, word, b[word] + 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(size, language, hash, count): words have size 0, character n-grams their length."""
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for a, b, text in _parts(batch.column(1).to_pylist()):
            own = np.repeat(np.arange(a, b), np.diff(text.first))
            for lang in sorted(set(langs[a:b])):
                words = np.flatnonzero(langs[own] == lang)
                sides = {0: text.hash(text.start[words], text.end[words])}
                at, _, stop = _positions(text, words)
                for n in range(1, LONGEST + 1):
                    fits = at + n <= stop
                    sides[n] = text.hash(at[fits], at[fits] + n)
                for n, hashes in sides.items():
                    keys, counts = np.unique(hashes, return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(keys), n, np.int32)), pa.array([lang] * len(keys), pa.string()),
                         pa.array(keys.view(np.int64)), pa.array(counts)],
                        names=["size", "lang", "key", "n"],
                    )


@dataclass
class Model:
    langs: list[str]
    keys: dict[int, np.ndarray]
    """By size (0: words): sorted hashes."""
    scores: dict[int, np.ndarray]
    """By size: log frequencies, a column for each language."""


def sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` rows of each language, chosen by a hash of the row."""
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    share = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    return bounded_join(labelled, sizes, ["lang"]).where(share * F.col("rows") < per_language).select("lang", "text")


def _first(counts: DataFrame, most: int) -> pa.Table:
    """The first ``most`` rows by rank, then key.  What reaches the driver is a number for each rank and these rows, as arrays."""
    ranks = counts.where(F.col("rank") <= most).groupBy("rank").agg(F.count(F.lit(1)).alias("n")).orderBy("rank").toArrow()
    if ranks.num_rows:
        enough = np.searchsorted(np.cumsum(ranks["n"].to_numpy()), most)
        counts = counts.where(F.col("rank") <= int(ranks["rank"][min(int(enough), ranks.num_rows - 1)].as_py()))
    rows = counts.select("key", "rank", "by").toArrow()
    return rows.take(np.lexsort((rows["key"].to_numpy(), rows["rank"].to_numpy()))[:most])


def train(labelled: DataFrame, per_language: int = PER_LANGUAGE, words: int = WORDS, grams: int = GRAMS) -> Model:
    """Fit on rows (doc_id, lang, text).  The model has at most ``words`` words, ``grams`` n-grams of a length."""
    usable = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", "text")
    counted = (
        sample(usable, per_language).mapInArrow(_count, "size int, lang string, key long, n long")
        .groupBy("size", "key", "lang").agg(F.sum("n").alias("n"))
    )
    rank = F.row_number().over(Window.partitionBy("size", "lang").orderBy(F.desc("n"), "key"))
    counts = stage(
        counted.withColumn("rank", rank).groupBy("size", "key")
        .agg(F.min("rank").alias("rank"), F.collect_list(F.struct("lang", "n")).alias("by")),
        "languages",
    )
    found = {size: _first(counts.where(F.col("size") == size), grams if size else words) for size in range(LONGEST + 1)}
    by = {size: pc.list_flatten(rows["by"]) for size, rows in found.items()}
    names = {size: pc.struct_field(x, "lang").combine_chunks() for size, x in by.items()}
    model = Model(sorted(set().union(*[pc.unique(x).to_pylist() for x in names.values()])), {}, {})
    for size, rows in found.items():
        n = np.zeros((len(rows), len(model.langs)))
        row = np.repeat(np.arange(len(rows)), pc.list_value_length(rows["by"]).to_numpy())
        n[row, pc.index_in(names[size], pa.array(model.langs, pa.string())).to_numpy(zero_copy_only=False)] = pc.struct_field(by[size], "n").to_numpy()
        keys = rows["key"].to_numpy().view(U)
        order = np.argsort(keys)
        n = n[order]
        model.keys[size] = keys[order]
        model.scores[size] = np.log((n + 0.5) / (n.sum(axis=0) + 0.5 * (len(rows) + 1)) if len(rows) else n).astype(np.float32)
    return model


def _classify(model: Model, texts: list[str]) -> tuple[list[str], list[float]]:
    names, scores = [], []
    for _, _, text in _parts(texts):
        total = np.zeros((len(text.start), len(model.langs)))
        known, at = contains(model.keys[0], text.hash(text.start, text.end))
        total[known] = model.scores[0][at[known]]
        unseen = np.flatnonzero(~known)
        if len(unseen):
            at, word, stop = _positions(text, unseen)
            value = np.zeros((len(at), len(model.langs)))
            left = np.arange(len(at))
            for n in range(LONGEST, 0, -1):
                fits = at[left] + n <= stop[left]
                tried = left[fits]
                hit, place = contains(model.keys[n], text.hash(at[tried], at[tried] + n))
                value[tried[hit]] = model.scores[n][place[hit]]
                left = np.concatenate([left[~fits], tried[~hit]])
            begin = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            total[unseen] = np.add.reduceat(value, begin) / np.diff(np.r_[begin, len(at)])[:, None]
        sums = np.zeros((len(text.first) - 1, len(model.langs)))
        some = np.flatnonzero(np.diff(text.first))
        if len(some):
            sums[some] = np.add.reduceat(total, text.first[some])
        best = sums.argmax(axis=1)
        share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        for empty, b, s in zip((np.diff(text.first) == 0).tolist(), best.tolist(), share.tolist(), strict=True):
            names.append(UNKNOWN if empty else model.langs[b])
            scores.append(0.0 if empty else s)
    return names, scores


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``_row`` (the columns of ``docs``), ``lang_pred`` and ``score``, from the text alone."""
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def fn(texts: pa.Array) -> dict:
        if not shared.value.langs:
            return {"lang_pred": [UNKNOWN] * len(texts), "score": [0.0] * len(texts)}
        names, scores = _classify(shared.value, texts.to_pylist())
        return {"lang_pred": names, "score": scores}

    return annotate(docs, fields, fn)


def learned(docs: DataFrame, **how) -> Model:
    """The model of the rows that are not held out."""
    return train(docs.where(F.coalesce(remainder(F.col("doc_id"), MOD) != HELD_OUT, F.lit(True))), **how)


def report(docs: DataFrame, **how) -> DataFrame:
    model = learned(docs.select("doc_id", "text", "lang"), **how)
    return predict(docs.select("doc_id", "text"), model).select(
        f"{ROW}.doc_id",
        F.coalesce(remainder(F.col(f"{ROW}.doc_id"), MOD) == HELD_OUT, F.lit(False)).alias("held_out"),
        "lang_pred", "score",
    )


def accept(docs: DataFrame, min_score: float = 0.5, **how) -> DataFrame:
    """The documents whose language is told with at least ``min_score``, with their own columns."""
    return predict(docs, learned(docs, **how)).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select(f"{ROW}.*")
