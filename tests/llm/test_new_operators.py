"""Conversation trie, toxicity and tokenizer alignment against plain versions, on small messy tables and on empty ones."""

from __future__ import annotations

import hashlib
import itertools
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tickflow.llm import alignment, toxicity, trie

SF = "/root/testdata/sf0.01"


def bag(rows) -> Counter:
    return Counter(tuple(r) for r in rows)


@pytest.fixture(scope="module")
def docs(spark):
    rows = brute.messy("pass word " * 20)
    more = ["<|endoftext|> <s> </s> <unk>", " lead  two ", "▁x y▁", "tab\tnl\r\n\x00 é ü   漢字 🙂", "﻿bom", "áe  nbsp\u0085nel ​", "\x1c\x1d1²³½ ªº ΐ ß"]
    rows += [(500 + i, t, "en", "src1", len(t), "n", "r", "i", "e", 7) for i, t in enumerate(more)]
    return spark.createDataFrame(rows, brute.DOCS).repartition(3).cache()


# Conversations


def plain_trie(rows: list[tuple]) -> Counter:
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(v, key=lambda y: y[:2])] for c, v in turns.items()}
    built = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = own.get(c - int(math.fmod(c, 20)), [])[:h] + v[h:]
    nodes, below = defaultdict(list), defaultdict(set)
    for c, v in built.items():
        for d in range(len(v) + 1):
            nodes[tuple(v[:d])].append(c)
    for path in nodes:
        if path:
            below[path[:-1]].add(path)
    leaves, saved = {}, {}
    for path in sorted(nodes, key=len, reverse=True):
        words = len(brute.words(path[-1][1])) if path else 0
        leaves[path] = sum(leaves[x] for x in below[path]) or 1
        saved[path] = (len(nodes[path]) - 1) * words + sum(saved[x] for x in below[path])
    return Counter(
        (min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), len(below[p]), leaves[p], saved[p],
         brute.sha(",".join(map(str, sorted(c for c in m if len(built[c]) == len(p))))))
        for p, m in nodes.items()
    )


def conversations() -> list[tuple]:
    pick, rows = random.Random(5), []
    for c in [*range(90), 200, 1001, 1020, -3, -20, -41]:
        for t in range(pick.choice([1, 2, 2, 3, 4, 5, 9, 30])):
            role = pick.choice(["user", "assistant", None]) if t > 3 else "user"
            text = pick.choice(["a b c", "a", "", "x  y\tz", None]) if t else pick.choice(["hi there", "hello"])
            rows.append((c, t if t or c % 3 else None, role, text))
    rows += [(300 + i, t, "u", f"shared {t}") for i in range(30) for t in range(40)]
    rows += [(400 + i, t, "u", f"shared {t}" if t < 20 + i else f"own {i} {t}") for i in range(5) for t in range(60)]
    return [*rows, (None, 1, "u", "x"), (None, None, None, None), (77777, None, None, None), *[(88888, 5, "u", "same")] * 3, (9, 99, "ab", "c"), (10, 99, "a", "bc")]


TURNS = "conv_id long, turn long, role string, text string, at string, words string, `k.a` int"


@pytest.mark.parametrize(("part", "bound"), [(256, 50_000), (256, 30), (7, 20), (1, 1)])
def test_trie(spark, part, bound):
    rows = conversations()
    df = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], TURNS).repartition(5)
    assert bag(trie.report(df, part, bound).collect()) == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert trie.report(spark.createDataFrame([], TURNS)).count() == 0
    assert trie.report(spark.createDataFrame([(None, 1, "u", "x", "", "", 1)], TURNS)).count() == 0


def test_places_cross_pieces(spark, monkeypatch):
    """One conversation over many pieces is numbered without a gap."""
    monkeypatch.setattr(trie, "PIECE_ROWS", 50)
    df = spark.createDataFrame([(1 if i % 3 else 2, (i * 7919) % 3000, "u", f"t{i}") for i in range(3000)], "conv_id long, turn long, role string, text string")
    got = trie.ordered(df).groupBy("conv_id").agg(F.sort_array(F.collect_list("at")).alias("at")).collect()
    assert {r.conv_id: r["at"] for r in got} == {1: list(range(1, 2001)), 2: list(range(1, 1001))}


# Tokenizers


def plain_alignment(docs: list[tuple]) -> Counter:
    import sentencepiece
    from tokenizers import Tokenizer

    a_path = f"{alignment.FOLDER}/{alignment.A_FILE}"
    coder = Tokenizer.from_file(a_path)
    coder.encode_special_tokens = True
    with open(a_path) as file:
        vocabulary = json.load(file)["model"]["vocab"]
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spelt = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in kept)}
    a_bytes = {i: bytes(spelt[c] for c in w) for w, i in vocabulary.items() if w != "<|endoftext|>"}
    pieces = sentencepiece.SentencePieceProcessor(model_file=f"{alignment.FOLDER}/{alignment.B_FILE}")

    def b_bytes(i: int) -> bytes:
        piece = pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()

    held, out = Counter(), []
    for doc, text in docs:
        a = b = []
        if text:
            a, b = coder.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
            want = (" " + text).encode()
            if b"".join(map(a_bytes.get, a)) != want or b"".join(map(b_bytes, b)) != want:
                a = b = []
        ends = [list(itertools.accumulate(len(f(i)) for i in ids)) for ids, f in ((a, a_bytes.get), (b, b_bytes))]
        starts = [[0, *e[:-1]] for e in ends]
        links, low = [], 0
        for i in range(len(a)):
            while low < len(b) and ends[1][low] <= starts[0][i]:
                low += 1
            j = low
            while j < len(b) and starts[1][j] < ends[0][i]:
                links.append((a[i], b[j]))
                j += 1
        groups, i, j = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            x, y = i, j
            while i < len(a) and ends[0][i] <= cut:
                i += 1
            while j < len(b) and ends[1][j] <= cut:
                j += 1
            groups.append(",".join(map(str, a[x:i])) + "|" + ",".join(map(str, b[y:j])))
        held.update(set(links))
        out.append((doc, len(a), len(b), groups, links))
    best = Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return Counter(
        (d, na, nb, len(g), len(k), brute.sha(";".join(g)) if na else "", sum(held[x] == best[x[0]] for x in k), sum(held[x] for x in k))
        for d, na, nb, g, k in out
    )


def test_alignment(docs):
    want = plain_alignment([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert bag(alignment.report(docs).collect()) == want


def test_alignment_over_shards_and_runs(spark, monkeypatch):
    monkeypatch.setattr(alignment, "SHARD", 300)
    monkeypatch.setattr(alignment, "RUN", 900)
    df = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 150")
    want = plain_alignment([(r.doc_id, r.text) for r in df.collect()])
    assert bag(alignment.report(df).collect()) == want


def test_alignment_of_nothing(docs):
    assert alignment.report(docs.limit(0)).count() == 0
    groups = alignment.aligned(docs.where("doc_id = 501")).select("_row.*", "groups").first()
    assert groups["items"] == "i"
    assert [(g.begin, g.end) for g in groups.groups][0][0] == 0
    assert groups.groups[-1].end == len(" " + groups.text)


def test_both_libraries_cut_alike(spark):
    """Every character below the bound, alone and between others."""
    t = alignment.tokenizers(alignment.FOLDER)
    for point in range(1, 0x340):
        text = "".join(f"{x}{chr(point)}" for x in ("", "a", " ", "1", "\n", "'", "é"))
        text = f" {text} {chr(point)}{chr(point)}a"
        assert t.fast.encode_ordinary(text) == t.exact.encode(text, add_special_tokens=False).ids, point


# Toxicity

TOXIC = ["idiot", "loweient", "vequoir", "moron", "scum"]


def labelled(n: int) -> tuple[list[tuple], list[tuple]]:
    pick, rows, labels = random.Random(8), [], []
    for i in range(n):
        text = brute.prose(i, pick.randint(5, 80))
        bad = pick.random() < 0.2
        if bad:
            for _ in range(pick.randint(2, 5)):
                text.insert(pick.randrange(len(text)), pick.choice(TOXIC))
        rows.append((i, " ".join(text)))
        if pick.random() < 0.7:
            labels.append((i, 1, int(bad)))
    return rows, labels


def test_votes_equal_plain_rules(spark, docs):
    lexicon = toxicity.Lexicon(*(np.array(x, t) for x, t in (([], np.uint64), ([], np.int64))))
    words = toxicity._hash_of(["w7", "tie"])
    lexicon = toxicity.Lexicon(words, np.full(2, toxicity.AT["words_0"]))
    extra = [(900, "You total IDIOT!! shut up!! f**k", "en"), (901, "A" * 30 + " b", "en"), (902, "you and they and the idiot", "en"), (903, "sh*t *x y* f*", "en")]
    df = docs.select("doc_id", "text", "lang").unionByName(spark.createDataFrame(extra, "doc_id long, text string, lang string"))
    got = Counter()
    for r in toxicity.votes(df, lexicon).collect():
        got[(r.doc_id, r.state, tuple(r.terms))] += 1
    want = Counter()
    mined = {"w7": 0, "tie": 0}
    place = {w: int(np.searchsorted(words, toxicity._hash_of([w])[0])) for w in mined}
    for doc, text, _ in [tuple(r) for r in df.collect()]:
        text = text or ""
        w = brute.words(text, brute.ALNUM_WORD, True)
        term = [x in toxicity.INSULTS or x in toxicity.PROFANITY or x in mined for x in w]
        fires = {
            "insults": any(x in toxicity.INSULTS for x in w), "profanity": any(x in toxicity.PROFANITY for x in w),
            "threats": any(f"{x} {y}" in toxicity.THREATS for x, y in itertools.pairwise(w)), "words_0": any(x in mined for x in w),
            "addressed": any(w[i] in toxicity.ADDRESS and any(term[i + 1 : i + 4]) for i in range(len(w))),
            "shouting": (u := len(re.findall("[A-Z]", text))) >= 20 and u >= 2 * len(re.findall("[a-z]", text)),
            "exclaimed": len(re.findall("!(?=!)", text)) >= 2, "masked": bool(re.search(r"[A-Za-z]\*[*A-Za-z]", text)),
            "several": sum(term) >= 2, "dense": sum(term) > 0 and sum(term) * 100 >= len(w),
        }
        state = sum(1 << toxicity.AT[v] for v, on in fires.items() if on)
        want[(doc, state, tuple(sorted(place[x] for x in mined if x in w)))] += 1
    assert got == want


def test_mined_terms(spark):
    rows, labels = labelled(600)
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    lexicon = toxicity.mine(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert set(toxicity._hash_of(TOXIC).tolist()) <= set(lexicon.hash.tolist())
    assert len(lexicon.hash) < 3 * len(TOXIC)


def test_tables_keep_their_margins():
    """The fitted table has the singles and pairs asked for, and no other dependence."""
    rng = np.random.default_rng(1)
    target = rng.random(toxicity.STATES) * (rng.random(toxicity.STATES) < 0.02)
    scopes = [toxicity._BITS[:, i] for i in range(len(toxicity.VOTERS))] + [toxicity._BITS[:, 0] * 2 + toxicity._BITS[:, 3]]
    table = toxicity._loglinear(target, scopes, 60)
    for have, want in zip(toxicity._margins(table, scopes), toxicity._margins(target / target.sum(), scopes), strict=True):
        assert np.allclose(have, want, atol=1e-6)
    p = [float(table @ toxicity._BITS[:, i]) for i in (1, 2)]
    both = float(table @ (toxicity._BITS[:, 1] * toxicity._BITS[:, 2]))
    assert abs(both - p[0] * p[1]) < 1e-6


def test_label_model_recovers_accuracies_and_correlation():
    """Votes drawn from known rates, two voters being copies; one text in ten has a label."""
    rng, n = np.random.default_rng(2), 60_000
    y = rng.random(n) < 0.3
    state, rate = np.zeros(n, np.int64), {}
    for i, (hit, slip) in enumerate([(0.9, 0.05), (0.7, 0.1), (0.8, 0.02), (0.6, 0.05), (0.75, 0.08)]):
        state |= (rng.random(n) < np.where(y, hit, slip)).astype(np.int64) << i
        rate[i] = (slip, hit)
    state |= (state >> 1 & 1) << 5
    told = rng.random(n) < 0.1
    count = lambda which: np.bincount(state[which], minlength=toxicity.STATES).astype(float)
    model = toxicity.label_model(count(told & y), count(told & ~y), count(~told), rounds=80)
    assert (1, 5) in model.pairs
    assert abs(model.prior - 0.3) < 0.03
    for i, (slip, hit) in rate.items():
        assert abs(model.fires[1, i] - hit) < 0.05
        assert abs(model.fires[0, i] - slip) < 0.05
    assert np.mean((model.posterior[state] >= 0.5) == y) > 0.95


def test_classifier_is_at_the_optimum():
    rng = np.random.default_rng(3)
    state = rng.integers(0, toxicity.STATES, 200)
    lists = [np.flatnonzero(rng.random(4) < 0.3) for _ in state]
    begin, terms = np.r_[0, np.cumsum([len(x) for x in lists])], np.concatenate(lists)
    q, weight = rng.random(200), rng.random(200) + 0.5
    c = toxicity.train(state, begin, terms, q, weight, 4, rounds=5000, ridge=1e-2)
    p = c.score(state, begin, terms)
    x = np.hstack([toxicity._BITS[state], np.array([np.isin(np.arange(4), x) for x in lists])]).astype(float)
    w = weight / weight.sum()
    assert abs(w @ (p - q)) < 1e-5
    assert np.abs((w * (p - q)) @ x + 1e-2 * np.r_[c.voters, c.terms]).max() < 1e-4


def test_toxicity_on_held_out_rows(spark):
    rows, labels = labelled(1500)
    d = spark.createDataFrame([(*r, "en", 3) for r in rows], "doc_id long, text string, score string, state int").repartition(4)
    got = toxicity.report(d, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    truth = {i: t for i, _, t in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    # Labels of held-out rows are never read.
    turned = [(i, k, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, k, t in labels]
    again = toxicity.report(d.repartition(2), spark.createDataFrame(turned, "doc_id long, quality int, toxic int")).collect()
    assert sorted((r.doc_id, round(r.score, 9)) for r in again) == sorted((r.doc_id, round(r.score, 9)) for r in got)


def test_toxicity_of_messy_rows(spark, docs):
    labels = spark.createDataFrame([(1, None, 1), (None, 1, 1), (2, 1, None), (3, 0, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.report(docs, labels).collect()
    assert len(got) == docs.count()
    assert all(r.held_out is None for r in got if r.doc_id is None)
    assert toxicity.report(docs.limit(0), labels).count() == 0
    assert len(toxicity.report(docs, labels.limit(0)).collect()) == docs.count()


def test_sizes_of_digests():
    assert trie.NONE_SHA == hashlib.sha256(b"").hexdigest()


# The pipeline


def test_pipeline_stages_on_messy_rows(spark, docs):
    """Each stage on what the one before kept, against plain code; then every stage on a table without rows."""
    import corpus_pipeline
    from tickflow.llm.frames import stage, table

    sf = "/root/testdata/sf0.001"
    items = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    given = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        out = stage(step(spark, given, sf), name)
        assert out.columns == given.columns
        before, after = ([(r.doc_id, r.text) for r in x.select("doc_id", "text").collect()] for x in (given, out))
        assert not Counter(d for d, _ in after) - Counter(d for d, _ in before)
        if name == "language":
            assert after
            assert all(any(c.isalpha() for c in t) for _, t in after)
        if name == "near_duplicates":
            keep = {r[0] for r in brute.near_duplicates(before, 5) if r[3]}
            assert {d for d, _ in after if d is not None} == {d for d in keep if d is not None}
        if name == "decontamination":
            clean = Counter(r[0] for r in brute.decontamination(before, items) if not r[5])
            assert Counter(d for d, _ in after) == clean
        if name == "personal_data":
            assert Counter(d for d, _ in after) == Counter(d for d, _ in before)
        given = out
    assert "epochs" in corpus_pipeline.STAGES[-1][1](spark, given, sf).columns
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, docs.limit(0), sf).count() == 0
