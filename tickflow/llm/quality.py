"""Quality rules and a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Rules count words, symbols, repeated lines and repeated 8-word windows of each whole text.  The model
compares two multinomials over ``BUCKETS`` hashed token n-grams (one and two tokens): the trusted target
(all documents labelled good and not toxic) and the raw corpus (all documents).  A document's score is its
mean log ratio, so length does not matter; one threshold decides every document.

The threshold is the score, on a grid of 1/1000, that best separates the labelled good from the labelled
bad (balanced accuracy, the lowest of ties, midway to the next score below); without labels of both kinds it is 0: no less
like the target than the corpus is.

Defined results: a null or empty text has no words and fails the rules.  Repeated documents are judged row
by row (and counted as often as they occur); documents without an id have no label.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow.llm.frames import stage
from tickflow.operators.joins import bounded_join
from tickflow.session import cut

BUCKETS = 1 << 14
SAMPLE = 20_000
"""Labelled documents of either kind where a sample is asked for; queries learn from all."""
KNOWN = 1_000_000
"""Trusted ids (some 30 MB) up to which the texts are not shuffled to meet them."""
SMOOTHING = 1.0
GRID = 1000
WINDOW = 8

# White space and symbols of the rules.
_SPACE = r"[ \t\n\x0B\f\r]+"
_SYMBOL = "[#*$%&|<>]"
_TOKEN = r"[\p{L}\p{M}\p{N}_]++|[^\p{L}\p{M}\p{N}_\s]++"


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, also where ``use`` reads it inside other lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _grams(hashes: Column, n: int) -> Column:
    """The hash of every ``n`` consecutive elements; none where there are fewer."""
    return _bind(
        hashes,
        lambda h: F.transform(
            F.slice(h, F.lit(1), F.greatest(F.size(h) - (n - 1), F.lit(0))),
            lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, n)]),
        ),
    )


def _repeat_words(windows: Column) -> Column:
    """How many words lie in windows of eight that occur twice or more, from the windows' hashes."""

    def covered(windows: Column) -> Column:
        order = F.array_sort(F.transform(windows, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        again = _bind(
            order,
            lambda s: F.filter(
                s,
                lambda e, i: F.coalesce(e["h"] == F.get(s, i - 1)["h"], F.lit(False)) | F.coalesce(e["h"] == F.get(s, i + 1)["h"], F.lit(False)),
            ),
        )
        places = F.array_sort(F.transform(again, lambda e: e["i"]))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(
            places, start, lambda a, x: F.struct((a["n"] + F.least(F.lit(WINDOW), x - a["last"])).cast("long").alias("n"), x.alias("last")), lambda a: a["n"]
        )

    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), covered(windows)).otherwise(F.lit(0).cast("long"))


def _without(text: Column, characters: str) -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def rules(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The columns of ``docs`` (or those of ``keep``) in ``_row``, and the rules' counts.

    Words and windows are a column of their own, computed once, so that what reads them is compiled and not a lambda.
    """
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep)]).alias("_row"), _text().alias("text"))
    words = F.transform(F.filter(F.split("text", _SPACE), lambda w: w != ""), lambda w: F.xxhash64(w))
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\f\r")) != "")
    spaces = F.octet_length("text") - F.octet_length(_without(F.col("text"), " \n\t\r\x0b\f"))
    counted = (
        row.select("*", _bind(words, lambda h: F.struct(F.size(h).cast("long").alias("n_words"), _grams(h, WINDOW).alias("windows"))).alias("w"))
        .select(
            "_row",
            "w.n_words",
            (F.char_length("text") - spaces).cast("long").alias("word_chars"),
            F.regexp_count("text", F.lit(_SYMBOL)).cast("long").alias("n_symbols"),
            _bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeat_words(F.col("w.windows")).alias("n_repeat_words"),
            "text",
        )
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.select("_row", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "text")


def grams(text: Column) -> Column:
    """The hash of every token and of every two neighbouring tokens."""
    hashes = F.transform(F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0)), lambda t: F.xxhash64(t))
    return _bind(hashes, lambda h: F.concat(h, _grams(h, 2)))


def _bucket(gram: Column) -> Column:
    return F.pmod(gram, F.lit(BUCKETS)).cast("int")


def buckets(text: Column) -> Column:
    """The bucket of every token and of every two neighbouring tokens."""
    return F.transform(grams(text), _bucket)


def _labelled(labels: DataFrame, good: bool, trusted: bool = False, most: int | None = SAMPLE) -> DataFrame:
    """``most`` labelled ids of one kind, those of smallest hash; all with None.

    ``trusted`` leaves out ids that a row calls toxic.
    """
    ids = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
    kind = ids.where(F.col("quality") == int(good))
    if trusted:
        kind = kind.where(F.coalesce("toxic", F.lit(0)) != 1)
    kind = kind.select("doc_id")
    if most is not None:
        # The share of this kind's own ids, so that a rare kind is not thinned out.
        share = min(1.0, 2 * most / max(1, kind.count()))
        kind = kind.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
        kind = kind.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return kind.withColumn("good", F.lit(good))


def labelled(labels: DataFrame, most: int | None = None) -> DataFrame:
    """(doc_id, good, trusted) of the labelled ids, of all unless ``most`` bounds each kind."""
    trusted = _labelled(labels, True, True, most).select("doc_id", F.lit(True).alias("good"), F.lit(True).alias("trusted"))
    judged = _labelled(labels, True, most=most).unionByName(_labelled(labels, False, most=most)).withColumn("trusted", F.lit(False))
    return judged.unionByName(trusted).groupBy("doc_id").agg(F.min("good").alias("good"), F.max("trusted").alias("trusted"))


def _score(weights: list[float], text: Column) -> Column:
    """The mean weight of a text's n-grams; 0 without any."""
    table = F.split(F.lit(",".join(f"{w:.6f}" for w in weights)), ",").cast("array<double>")

    def use(g: Column) -> Column:
        total = F.aggregate(g, F.lit(0.0), lambda s, x: s + F.get(table, _bucket(x)))
        return F.when(F.size(g) > 0, total / F.size(g)).otherwise(F.lit(0.0))

    return _bind(grams(text), use)


def counts(docs: DataFrame, known: DataFrame) -> DataFrame:
    """How often each bucket occurs in all documents (raw) and in the trusted ones (target); ``known`` are the labelled ids."""
    marked = bounded_join(docs.select("doc_id", _text().alias("text")), known.where("trusted").select("doc_id", "trusted"), "doc_id", "left", rows=KNOWN)
    # The n-grams are a column before they become rows: rows made from a lambda are not compiled.  Without "outer", Spark
    # filters by the size of that column first, and computes it twice.
    listed = marked.select(grams(F.col("text")).alias("grams"), F.coalesce("trusted", F.lit(False)).cast("long").alias("trusted"))
    return (
        listed.select(F.explode_outer("grams").alias("gram"), "trusted").where(F.col("gram").isNotNull())
        .groupBy(_bucket(F.col("gram")).alias("bucket")).agg(F.count(F.lit(1)).alias("raw"), F.sum("trusted").alias("target"))
    )


def _weights(docs: DataFrame, known: DataFrame) -> list[float]:
    """The log ratio of each bucket."""
    raw, target = [SMOOTHING] * BUCKETS, [SMOOTHING] * BUCKETS
    for r in counts(docs, known).collect():  # at most BUCKETS rows
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    if sum(target) == SMOOTHING * BUCKETS:
        return [0.0] * BUCKETS
    shift = math.log(sum(raw) / sum(target))
    return [math.log(t / r) + shift for t, r in zip(target, raw, strict=True)]


def cutoff(scored: DataFrame, known: DataFrame) -> float:
    """The threshold, from the scores (doc_id, llr) of all labelled documents."""
    step = F.floor(F.col("llr") * GRID).alias("step")
    steps = scored.join(known, "doc_id").select(step, "good").groupBy("step").agg(
        F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad")
    ).orderBy("step").collect()  # at most one row for each step of the grid
    good, bad = sum(r["good"] for r in steps), sum(r["bad"] for r in steps)
    if not good or not bad:
        return 0.0
    best, threshold, lost, caught, before = -1.0, 0.0, 0, 0, steps[0]["step"]
    for r in steps:
        gain = (good - lost) / good + caught / bad
        if gain > best:
            best, threshold = gain, (before + r["step"]) / 2 / GRID
        lost, caught, before = lost + r["good"], caught + r["bad"], r["step"]
    return threshold


def fit(docs: DataFrame, labels: DataFrame, most: int | None = None) -> tuple[list[float], float]:
    """The log ratio of each bucket and the threshold."""
    known = cut(labelled(labels, most))
    weights = _weights(docs, known)
    return weights, cutoff(docs.select("doc_id", _score(weights, _text()).alias("llr")), known)


def judge(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None, most: int | None = None) -> DataFrame:
    """``_row`` (the columns of ``docs``, or those of ``keep``), the rules' counts, ``llr`` and ``kept``.

    Texts are scored once: the rows are written with their scores before the threshold is found.
    """
    known = cut(labelled(labels, most))
    weights = _weights(docs, known)
    scored = stage(rules(docs, keep).withColumn("llr", _score(weights, F.col("text"))).drop("text"), "scored")
    threshold = cutoff(scored.select("_row.doc_id", "llr"), known)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return judge(docs.select("doc_id", "text"), labels, keep=["doc_id"]).select(
        "_row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
