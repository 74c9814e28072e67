"""The training-data operators against plain versions, on small messy tables, and on empty ones."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import brute
from tickflow.llm import components, decontam, extract, frames, kneser, langid, mixing, near_dedup, pii, quality, substrings, warc

PASSAGE = " ".join(f"p{i}" for i in range(64))
ITEMS = [(1, " ".join(PASSAGE.split()[:30])), (2, "One  TWO three"), (3, None), (None, " ".join(PASSAGE.split()[5:40])), (1, " ".join(PASSAGE.split()[:30])), (20, "...")]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(brute.messy(PASSAGE), brute.DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], brute.DOCS)


@pytest.fixture(scope="module")
def plain(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def bag(rows) -> Counter:
    return Counter(tuple(r) for r in rows)


@pytest.mark.parametrize("block", [1 << 20, 20])
def test_decontamination(spark, docs, plain, block):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert bag(decontam.report(docs, items, block=block).collect()) == bag(brute.decontamination(plain, ITEMS))


def test_decontamination_keeps_rows_and_columns(spark, docs, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = decontam.clean(docs, items)
    assert kept.schema == docs.schema
    clean = Counter(r[0] for r in brute.decontamination([(r.doc_id, r.text) for r in docs.collect()], ITEMS) if not r[5])
    assert Counter(r.doc_id for r in kept.collect()) == clean
    assert decontam.report(none, items).count() == 0
    assert decontam.clean(docs, items.limit(0)).count() == docs.count()


def test_substrings(docs, none, plain):
    assert bag(substrings.report(docs).collect()) == bag(brute.substrings(plain))
    assert substrings.report(none).count() == 0


@pytest.mark.parametrize("n", [4, 5])
def test_near_duplicates(docs, plain, n):
    assert bag(near_dedup.report(docs, n=n).collect()) == bag(brute.near_duplicates(plain, n))


def test_near_duplicates_of_many_families(spark):
    """Families of loosely related texts around the threshold, and a chain of near copies."""
    rows, pick = [], random.Random(3)
    for family in range(6):
        base = brute.prose(50 + family, 80, 3000)
        for _ in range(12):
            text = list(base)
            for _ in range(pick.randint(0, 9)):
                text[pick.randrange(len(text))] = f"e{pick.randrange(10**6)}"
            rows.append((len(rows), " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert bag(near_dedup.report(df, n=4).collect()) == bag(brute.near_duplicates(rows, 4))


def test_near_duplicates_keep_one(docs, none):
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    want = Counter(r[0] for r in brute.near_duplicates([(r.doc_id, r.text) for r in docs.collect()], 5) if r[3])
    assert Counter(r.doc_id for r in kept.collect()) == want
    assert near_dedup.keep_one(none).count() == 0


def test_signatures_find_all_pairs_within_the_distance():
    import numpy as np
    import pyarrow as pa

    pick = np.random.default_rng(1)
    one = pick.integers(0, 1 << 16, (200, near_dedup.SYMBOLS)).astype(np.uint16)
    two = one.copy()
    for row in two:
        at = pick.choice(near_dedup.SYMBOLS, near_dedup.DISTANCE, replace=False)
        row[at] += 1
    keys = []
    for side in (one, two):
        batch = pa.RecordBatch.from_arrays([pa.array(range(200)), pa.array([r.tobytes() for r in side], pa.binary())], names=["node", "signature"])
        found: list[set] = [set() for _ in range(200)]
        for b in near_dedup._keys(iter([batch])):
            for k, node in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found[node].add(k)
        keys.append(found)
    assert all(a & b for a, b in zip(*keys, strict=True))


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{x: 100 for x in range(100, 160)}, 200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_personal_data_grammars():
    pick = random.Random(5)
    pools = ["0123456789", "@.+- ()", "ab.Z_%", "12.34.5 6", "é٣ x"]
    for i in range(4000):
        text = "".join(pick.choice(pick.choice(pools)) for _ in range(pick.randint(0, 60)))
        text = text.replace("ab", "4111111111111111") if i % 3 == 0 else text
        assert [x for x in pii.spans(text) if x[2] in pii.KINDS[:4]] == brute.personal(text), text


def test_personal_data(spark, docs, none):
    made = "mail a.b+c@d-e.example.org or 10.0.0.256 10.0.0.1, card 4111 1111-1111 1111, +1 (743) 555-3824; account no. 123456789, https://x.org/a?b=1. "
    text = "é" + made + 'token = "24be64439e3e49cf46b2"'
    df = docs.limit(3).unionByName(docs.limit(1).withColumn("text", F.lit(text)).withColumn("doc_id", F.lit(99).cast("long")))
    row = {r.doc_id: r for r in pii.report(df).collect()}[99]
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 1)
    assert row.base_sha256 == brute.sha(",".join(f"{k}:{a}:{b}" for a, b, k in brute.personal(text)))
    assert [x.split(":")[0] for x in row.spans.split(",")] == ["email", "ip", "card", "phone", "account", "url", "secret"]
    clean = pii.redact(df)
    assert clean.schema == df.schema
    got = {r.doc_id: r for r in clean.collect()}[99]
    assert got.text == 'é' + 'mail <EMAIL> or 10.0.0.256 <IP>, card <CARD>, <PHONE>; account no. <ACCOUNT>, <URL>. token = "<SECRET>"'
    assert got.n_chars == len(got.text)
    assert pii.redact(none).count() == 0 and pii.report(none).count() == 0
    assert pii.report(docs).count() == docs.count()
    assert pii.masked("the token of love, an account of the secret: nothing") == "the token of love, an account of the secret: nothing"


@pytest.mark.parametrize(
    "text, value, kind",
    [
        ("Account Number: 12345678", "12345678", "account"),
        ("Account No. 12345678", "12345678", "account"),
        ("Account No 12345678.", "12345678", "account"),
        ("ACCOUNT NUMBER 12345678", "12345678", "account"),
        ("Passport No: X1234567", "X1234567", "account"),
        ("ssn is 123-45-6789", "123-45-6789", "account"),
        ("Ssn Is: 123-45-6789", "123-45-6789", "account"),
        ("account number is 12345678", "12345678", "account"),
        ("Account number is: 12345678", "12345678", "account"),
        ("My Social Security Number is 123-45-6789", "123-45-6789", "account"),
        ("SOCIAL SECURITY NO. 123-45-6789", "123-45-6789", "account"),
        ("İé Social Security: 123-45-6789", "123-45-6789", "account"),
        ("account no1234567", "1234567", "account"),
        ("IBAN NO93 8601 1117 947", "NO93 8601 1117 947", "account"),
        ("Iban IS140159260076545510730339", "IS140159260076545510730339", "account"),
        ("Api_Key: 24be64439e3e", "24be64439e3e", "secret"),
        ("Password Is: 24be64439e3e", "24be64439e3e", "secret"),
        ("PASSWORD NO.: 24be64439e3e", "24be64439e3e", "secret"),
        ("HTTPS://x.org/a", "HTTPS://x.org/a", "url"),
        ("Https://x.org/a", "Https://x.org/a", "url"),
    ],
)
def test_personal_data_cues_in_any_case(text, value, kind):
    at = text.index(value)
    assert (at, at + len(value), kind) in pii.spans(text)
    assert value not in pii.masked(text)


@pytest.mark.parametrize("text", ["Account Number none", "My Account Is Closed", "the Secret Is out: nothing", "Accounting No. 1234567"])
def test_prose_after_cues_stays(text):
    assert pii.spans(text) == []


def test_quality_rules(spark, docs, none):
    labels = spark.createDataFrame([(0, 1, 0), (7, 0, 0), (None, 1, 0), (9, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.report(docs, labels).collect()
    want = Counter((r.doc_id, *brute.rules(r.text)) for r in docs.collect())
    assert Counter(tuple(r)[:7] for r in got) == want
    assert not any(r.kept and r.base_failed for r in got)
    assert quality.report(none, labels).count() == 0
    # Without labels nothing is less like the target than the corpus is.
    assert all(r.kept != r.base_failed for r in quality.report(docs, labels.limit(0)).collect())


def test_quality_tells_labelled_kinds_apart(spark):
    docs, labels = (frames.table(spark, SF, t) for t in ("documents", "labels"))
    got = quality.report(docs, labels).join(labels, "doc_id").where("NOT base_failed").collect()
    right = sum(r.kept == bool(r.quality) for r in got)
    assert right >= 0.97 * len(got)


def test_quality_samples_each_kind_whole_or_to_the_bound(spark):
    """A rare kind is taken whole, whatever the number of other labels, null ids and repeats."""
    good = spark.range(50_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    bad = spark.range(100_000, 100_300).select(F.col("id").alias("doc_id"), F.lit(0).alias("quality"), F.lit(0).alias("toxic"))
    lost = spark.range(30_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("quality"), F.lit(0).alias("toxic"))
    labels = good.unionByName(good).unionByName(bad).unionByName(lost)
    assert {r.doc_id for r in quality._labelled(labels, False).collect()} == set(range(100_000, 100_300))
    assert quality._labelled(labels, True).distinct().count() == quality.SAMPLE
    few = good.limit(25_000).unionByName(bad)
    assert quality._labelled(few, True).distinct().count() == quality.SAMPLE


def test_quality_target_has_no_toxic_documents(spark):
    """Words of toxic documents labelled good do not speak for the target, but the document counts for the threshold."""
    texts = [(i, f"plain words here {i}") for i in range(20)] + [(i, "nasty nasty nasty") for i in range(20, 30)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = [(i, int(i % 2 == 0), 0) for i in range(20)] + [(i, 1, 1) for i in range(20, 30)] + [(20, 1, None)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    weights, _ = quality.fit(docs, labels)
    bucket = docs.select(quality.buckets(F.lit("nasty"))[0]).first()[0]
    assert weights[bucket] < 0
    trusted = {r.doc_id for r in quality._labelled(labels, True, trusted=True).collect()}
    assert trusted == set(range(0, 20, 2))
    assert {r.doc_id for r in quality._labelled(labels, True).collect()} == trusted | set(range(20, 30))


@pytest.mark.parametrize("order", [2, 3])
def test_kneser_ney(docs, plain, order):
    got = sorted(kneser.report(docs, order).collect(), key=str)
    want = sorted(brute.kneser_ney(plain, order, kneser.discounts), key=str)
    known = {}
    for w in want:
        known.setdefault(w[0], []).append(w)
    assert len(got) == len(want)
    for r in got:
        assert any(tuple(r)[:5] == w[:5] and tuple(r)[5:] == pytest.approx(w[5:], rel=1e-9) for w in known[r.doc_id]), r


def test_kneser_ney_sums_to_one(spark):
    import numpy as np

    df = spark.createDataFrame([(i, " ".join(brute.prose(i, 60, 30))) for i in range(20)], "doc_id long, text string")
    model = kneser.train(df, 2)
    ids = np.r_[np.arange(model.vocabulary.size), kneser.UNKNOWN].astype(np.uint32)
    for context in (0, 3, int(kneser.BEGIN), int(kneser.UNKNOWN)):
        low = model.unigram(ids)
        assert low.sum() == pytest.approx(1)
        assert model.level(2, [np.full(len(ids), context, np.uint32), ids], low).sum() == pytest.approx(1)


def test_kneser_ney_of_nothing(none):
    assert kneser.report(none).count() == 0


def test_language(spark, docs, none):
    got = langid.report(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert 0 <= r.score <= 1
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by[4].lang_pred == by[5].lang_pred == by[6].lang_pred == "und" and by[4].score == 0
    assert {i for i, r in by.items() if r.held_out} == {i for i in by if zlib.crc32(str(i).encode()) % 5 == 0}
    assert langid.report(none).count() == 0
    assert langid.accept(docs).columns == docs.columns
    unlabelled = langid.report(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}


def test_language_held_out(spark):
    docs = frames.table(spark, "/root/testdata/sf0.01", "documents")
    got = langid.report(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 100
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)


def test_extraction(spark):
    pages = frames.table(spark, SF, "pages")
    chain = extract.train(pages)
    page = (
        '<html><head><title>T</title><style>p{}</style></head><body><div class="cookie-banner"><p>We use cookies, accept all of them now.</p></div>'
        "<header><h1>Site name</h1></header><nav><a href=/>Home</a></nav><main><h1>Real&nbsp;title</h1><p>Some real text here, with <a href=x>a link</a> &amp;amp; more.</p>"
        '<div class="ad-slot"><p>Buy this great product now, it is on sale.</p></div><p>Second<br>part of  it.<!-- no --></p><script>var x="</p>"</script></main>'
        '<aside><p>Related stories that you may like to read.</p></aside><div id="comments"><p>I think this is a great article, thanks for it.</p></div>'
        "<form><p>Subscribe to our newsletter for more.</p></form><footer><p>Copyright 2020.</p></footer></body></html>"
    )
    rows = [(1, "u", page), (2, None, None), (3, "", ""), (None, "x", "<p>a < b<p>c"), (1, "u", page), (5, "l", "<article>" + "<p>word one two. </p>" * 5000 + "</article>")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, main string")
    got = {(r._row.page_id, r.main) for r in extract.extract(df, chain).collect()}
    assert (1, "Real title\nSome real text here, with a link &amp; more.\nSecond part of it.") in got
    assert (2, "") in got and (3, "") in got
    assert len(next(x for p, x in got if p == 5).split("\n")) == 5000
    assert extract.report(df.limit(0)).count() == 0


def test_extraction_of_whole_pages(spark):
    import html
    import re

    for r in extract.report(frames.table(spark, SF, "pages")).join(frames.table(spark, SF, "pages").drop("url"), "page_id").collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article))
        want = "\n".join(b for b in parts if b)
        assert r.text == want and r.n_chars == len(want)


def test_extraction_without_telling_mark_up(spark):
    """Pages of div elements only: the chain is trained on the layouts and still tells the parts apart."""
    body = [" ".join(" ".join(brute.prose(7 + i, 12 + i)).split()) + "." for i in range(40)]

    def page(i: int) -> str:
        return (
            '<body><div class="menu"><a href="/">Home</a></div><div class="topbar">Site</div><div class="content">'
            f"<p>{body[i % 40]}</p><p>{body[(i + 3) % 40]}</p></div>"
            f'<div id="comments"><p>{body[(i + 5) % 40]}</p></div><div class="footer">Legal</div></body>'
        )

    df = spark.createDataFrame([(i, "u", page(i)) for i in range(40)], "page_id long, url string, html string")
    for how in ({}, {"chars": 60}):
        got = {r.page_id: r.text for r in extract.report(df, **how).collect()}
        right = sum(got[i] == f"{body[i % 40]}\n{body[(i + 3) % 40]}" for i in range(40))
        assert right >= 38, (how, right, got[0])
    assert len(extract.fit(extract.labelled(["", "<!-- -->"])).weights) > 10


def test_extraction_samples_distinct_pages(spark):
    """Long, null and copied pages take nothing from the sample."""
    fits = [f"<main><p>page {i}</p></main><p>menu</p>" for i in range(30)]
    rows = [(fits[i % 30],) for i in range(60)] + [(fits[0],)] * 500 + [("x" * 300 + str(i),) for i in range(2000)] + [(None,)] * 500
    df = spark.createDataFrame(rows, "html string").repartition(4)
    seen = []
    real, extract.labelled = extract.labelled, lambda pages: seen.extend(pages) or real(pages)
    try:
        extract.train(df, sample=20, chars=200)
        assert len(seen) == len(set(seen)) == 20 and set(seen) <= set(fits)
        seen.clear()
        extract.train(df, sample=100, chars=200)
        assert sorted(seen) == sorted(fits)
    finally:
        extract.labelled = real


@pytest.mark.parametrize("version", ["1", "2", "both"])
def test_archives(spark, version):
    import hashlib

    long = "é" * 600
    rows = [(1, "http://a/ b\n", long), (2, "http://b", long), (3, None, None), (4, "x", "short"), (5, "y", "short"), (2, "http://b", long), (None, "n", long), (6, "\r\n\r\n", "a\r\n\r\nb" * 300), (7, "z", "q" * 999), (8, "z", "q" * 999)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, record_type int").repartition(3)
    got = Counter(tuple(r)[:5] for r in warc.round_trip(spark, df, version).collect())
    want: Counter = Counter()
    for page, _, text in rows:
        raw = (text or "").encode()
        want[(page, len(raw), hashlib.sha1(raw).hexdigest())] += 1
    assert Counter({k: sum(n for g, n in got.items() if g[:3] == k) for k in want}) == want
    digest = hashlib.sha1(long.encode()).hexdigest()
    kinds = Counter(g[3:] for g in got.elements() if g[2] == digest)
    assert kinds == {("response", None): 1, ("revisit", 2): 3}
    assert all(g[3] == "response" for g in got if g[2] != digest)
    assert warc.round_trip(spark, df.limit(0), version).count() == 0


def test_archive_errors(spark, tmp_path):
    for name, raw in (("short", warc.arc_head("1") + b"http://a 0.0.0.0 2000 text/html 100\nonly this"), ("line", warc.arc_head("1") + b"http://a 100\n"), ("version", b"filedesc://x 0 0 text/plain 4\n9 0\n\n")):
        path = tmp_path / name
        path.write_bytes(raw)
        with pytest.raises(ValueError, match=name):
            list(warc.arc_records(str(path)))


def test_mixing_splits(spark):
    leaves = [("a", "en", "s1", 100), ("a", "en", "s2", 1000), ("a", "fr", "s3", 1000), ("b", "en", "s4", 10), ("b", "de", "s5", 5000)]
    df = spark.createDataFrame(leaves, "domain string, lang string, source string, tokens long")
    mix = mixing.Mix(budget=2000, max_epochs=1, sources={"s2": 3.0}, domains={"b": 1.0})
    got = {r.source: r.target for r in mixing.budgets(df, mix).collect()}
    # a and b get 1,000 each; en and fr 500 each; s1 is asked for 125 and gives 100, its sibling gives the rest.
    # b's English gives 10, its German sibling 990.
    assert got == {"s1": 100, "s2": 400, "s3": 500, "s4": 10, "s5": 990}
    all_of_it = mixing.budgets(df, mixing.Mix(budget=10**6, max_epochs=2)).collect()
    assert {r.source: r.target for r in all_of_it} == {x[2]: 2 * x[3] for x in leaves}


def test_mixing(spark, docs, none):
    mix = mixing.Mix(share=0.4, languages={"en": 2.0}, sources={"src1": 0.0})
    rows = mixing.report(docs, mix).collect()
    assert all(r.source != "src1" and r.epochs > 0 and r.n_tokens > 0 for r in rows)
    assert bag(rows) == bag(mixing.report(docs.repartition(5), mix).collect())
    taken = mixing.mixed(docs, mix)
    assert taken.columns == [*[c for c in docs.columns if c != "epochs"], "epochs"]
    assert Counter((r.doc_id, r.epochs) for r in taken.where("doc_id IS NOT NULL").collect()) == Counter((r.doc_id, r.epochs) for r in rows if r.doc_id is not None)
    assert mixing.report(none, mix).count() == 0 and mixing.mixed(none, mix).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    docs = frames.table(spark, SF, "documents")
    rows = docs.collect()
    out = corpus_pipeline.run(spark, SF)
    got = {r.doc_id: r for r in out.collect()}
    assert out.columns == [*docs.columns, "epochs"]
    items = [(r.item_id, r.text) for r in frames.table(spark, SF, "benchmark").collect()]
    kept = {r[0] for r in brute.near_duplicates([(r.doc_id, r.text) for r in rows], 5) if r[3]}
    dirty = {r[0] for r in brute.decontamination([(r.doc_id, r.text) for r in rows], items) if r[5]}
    assert set(got) <= kept - dirty
    before = docs.where(F.col("doc_id").isin(sorted(kept - dirty))).withColumn("text", F.udf(pii.masked)("text"))
    want = {r.doc_id: r.epochs for r in mixing.report(before, corpus_pipeline.MIX).collect()}
    assert {i: r.epochs for i, r in got.items()} == want
    assert all(not brute.personal(r.text) for r in got.values())


def test_archives_use_many_tasks(spark, tmp_path, monkeypatch):
    """The conversion of 50 small files is spread over tasks; versions and dates differ, digests and identifiers do not clash."""
    pages = spark.range(200).selectExpr("id AS page_id", "'http://p' AS url", "repeat(cast(id AS string), 20) AS html").repartition(25)
    arcs = frames.stage(warc.write_arc(pages, str(tmp_path / "arc"), "both"), "arc-files")
    assert arcs.count() == 50
    warcs = warc.convert(arcs, str(tmp_path / "warc"))
    tasks = warcs.withColumn("task", F.spark_partition_id()).select("task").distinct().count()
    assert tasks >= 8
    fields = [f for path in arcs.toPandas()["path"] for _, f, _ in warc.arc_records(path)]
    assert {len(f) for f in fields} == {5, 10}
    assert len({f["date"] for f in fields}) > 190
    read = warc.read_warc(warcs).collect()
    assert len({r.record_id for r in read}) == len(read) == 200


@pytest.mark.parametrize("page", ["<a " * 350_000, "<div>x" * 170_000, "<span>" * 80_000 + "</div>" * 90_000, "<a '" * 250_000 + ">", "<!--" * 250_000, "<x" + "<p>y" * 200_000])
def test_blocks_of_broken_pages_are_linear(page):
    import time

    began = time.time()
    got = extract.blocks(page)
    assert time.time() - began < 5
    assert all(len(b.tags) <= extract.DEPTH for b in got)
