"""Learning from all labels; the first entries of a model without a merge in the driver."""

from __future__ import annotations

import re
from collections import Counter

import brute
import pyspark.sql.functions as F

from tickflow.llm import langid, quality


def test_quality_learns_from_every_label(spark, monkeypatch):
    rows = [(i, " ".join(f"w{(i * 7 + j * (1 + i % 5)) % (40 + 20 * (i % 2))}" for j in range(30))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    whole = {r._row.doc_id: (r.llr, r.kept) for r in quality.judge(docs, labels).collect()}
    monkeypatch.setattr(quality, "SAMPLE", 1)
    assert {r._row.doc_id: (r.llr, r.kept) for r in quality.judge(docs, labels).collect()} == whole


def test_quality_takes_all_of_many_labels(spark):
    labels = spark.range(45_000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"), (F.col("id") % 10 == 1).cast("int").alias("toxic")
    )
    got = quality.labelled(labels).groupBy("good", "trusted").count().collect()
    assert {(r.good, r.trusted): r["count"] for r in got} == {(False, False): 22_500, (True, False): 4_500, (True, True): 18_000}


def test_quality_counts_ngrams_in_compiled_code(spark):
    """One compiled stage makes rows of n-grams and counts them; texts are cut once."""
    docs = spark.createDataFrame([(1, "a b a b"), (2, "b a"), (3, ""), (4, None), (2, "b a")], "doc_id long, text string")
    known = spark.createDataFrame([(2, True, True), (1, False, False)], "doc_id long, good boolean, trusted boolean")
    counted = quality.counts(docs, known)
    got = {r.bucket: (r["raw"], r["target"]) for r in counted.collect()}
    cut = docs.select("doc_id", quality.buckets(F.coalesce("text", F.lit(""))).alias("b")).collect()
    raw, target = (Counter(b for r in cut if r.doc_id in ids for b in r.b) for ids in ({1, 2, 3, 4}, {2}))
    assert got == {b: (n, target[b]) for b, n in raw.items()} and sum(target.values()) == 6
    plan = counted._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert re.search(r"\*\(\d+\) Generate explode\(grams", plan), plan
    assert plan.count("regexp_extract_all") == 1


def test_quality_rules_on_odd_characters(spark):
    """White space of other kinds, symbols in a row, lines of spaces, supplementary letters, windows that overlap."""
    some = " ".join(f"w{i}" for i in range(9))
    texts = [None, "", " ", "\t\n\x0b\f\r ", "a\u00a0b\u2028c\u3000d\x1ce\x85f", "##*$%&|<>\n \t\n\x0b\n#", "\U0001d400a \U0001f600\n\U0001d400a \U0001f600\n\u00a0\n\u00a0"]
    texts += ["x " * n for n in (7, 8, 9, 16, 40)] + [f"{some} {some}", f"{some}\n{some}\ty {some}", f"{some} {some[3:]}", " ".join(some.split()[:7] * 2)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in quality.rules(docs, ["doc_id"]).select("_row.*", "*").drop("_row", "text").collect()}
    assert got == {i: tuple(brute.rules(x)) for i, x in enumerate(texts)}


def test_first_entries_by_rank_then_key(spark):
    rows = [(i % 9 + 1, (i * 7919) % 1000 - 500, [("a", i)]) for i in range(100)]
    counts = spark.createDataFrame(rows, "rank int, key long, by array<struct<lang string, n long>>")
    want = sorted((r, k) for r, k, _ in rows)
    for most in (1, 11, 12, 30, 100, 500):
        got = langid._first(counts, most)
        assert list(zip(got["rank"].to_pylist(), got["key"].to_pylist(), strict=True)) == want[:most]
    assert langid._first(counts.limit(0), 5).num_rows == 0
