"""Language identification against dictionaries, and what must not depend on frequency or batches."""

import math
import random
import unicodedata
from collections import Counter, defaultdict

import numpy as np

from tickflow.llm import langid

SCHEMA = "doc_id long, text string, lang string"


def words_of(text):
    out, word = [], ""
    for c in text + "\n":
        if unicodedata.category(c)[0] in "LM":
            word += c.lower() if len(c.lower()) == 1 else c
        elif word:
            if any(unicodedata.category(x)[0] == "L" for x in word):
                out.append(word)
            word = ""
    return out


def plain_model(rows, words, grams):
    counts = {n: defaultdict(Counter) for n in range(langid.LONGEST + 1)}
    for lang, text in rows:
        for w in words_of(text):
            counts[0][w][lang] += 1
            for n in range(1, langid.LONGEST + 1):
                # The place before and the one after a word count as characters of its n-grams; none starts after it.
                for i in range(min(len(w) + 1, len(w) + 3 - n)):
                    counts[n][(" " + w + " ")[i: i + n]][lang] += 1
    langs = sorted({lang for lang, _ in rows})
    model = {}
    for n, table in counts.items():
        assert len(table) <= (grams if n else words)
        total = {x: sum(c[x] for c in table.values()) for x in langs}
        model[n] = {k: [math.log((c[x] + 0.5) / (total[x] + 0.5 * (len(table) + 1))) for x in langs] for k, c in table.items()}
    return langs, model


def plain_sums(langs, model, text):
    sums = np.zeros(len(langs))
    for w in words_of(text):
        if w in model[0]:
            sums += model[0][w]
            continue
        padded, parts = " " + w + " ", np.zeros(len(langs))
        for i in range(len(w) + 1):
            for n in range(langid.LONGEST, 0, -1):
                gram = padded[i: i + n]
                if len(gram) == n and gram in model[n]:
                    parts += model[n][gram]
                    break
        sums += parts / (len(w) + 1)
    return sums


def corpus(seed=1):
    rnd = random.Random(seed)
    stock = {
        "aa": "ka mi to ru sen", "bb": "str ing wor ld the", "cc": "öl über mäß groß", "zz": "żół ćma éte",
    }
    rows = []
    for i in range(60):
        lang = rnd.choices(list(stock), [30, 20, 9, 1])[0] if i > 3 else list(stock)[i]
        text = " ".join("".join(rnd.choices(stock[lang].split(), k=rnd.randint(1, 3))) for _ in range(rnd.randint(1, 12)))
        rows.append((i, text + rnd.choice(["", " 42!", "\ń ", " İX"]), lang))
    return rows


def test_scores_equal_dictionaries(spark):
    rows = corpus()
    model = langid.train(spark.createDataFrame(rows, SCHEMA))
    langs, plain = plain_model([(lang, text) for _, text, lang in rows], langid.WORDS, langid.GRAMS)
    assert model.langs == langs
    texts = [t for _, t, _ in rows[:20]] + ["unseenword kamix", "über-new, stringen", "qqq", "", "12 34", "zzż ka"]
    names, scores = langid._classify(model, texts)
    for text, name, score in zip(texts, names, scores):
        if not words_of(text):
            assert (name, score) == ("und", 0.0)
            continue
        sums = plain_sums(langs, plain, text)
        share = np.exp(sums - sums.max())
        share /= share.sum()
        assert abs(share[langs.index(name)] - share.max()) < 1e-5 and abs(score - share.max()) < 1e-4


def test_score_of_a_text_stands_alone(spark):
    rows = corpus(2)
    model = langid.train(spark.createDataFrame(rows, SCHEMA))
    texts = [t for _, t, _ in rows] + ["", "7", "unseen wörds here"]
    together = langid._classify(model, texts)
    alone = [langid._classify(model, [t]) for t in texts]
    assert together == ([n[0] for n, _ in alone], [s[0] for _, s in alone])


def test_rare_languages_keep_their_words(spark):
    """Three hundred labels, one of them in half of all rows, and a model that holds four words for each."""
    rare = [(i, " ".join(chr(0x4E00 + 20 * i + j) * 2 for j in range(6)), f"l{i:03d}") for i in range(300)]
    much = [(1000 + i, " ".join(f"w{chr(97 + i % 26)}{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(40)), "big") for i in range(300)]
    model = langid.train(spark.createDataFrame(rare + much, SCHEMA), words=1200, grams=1200)
    assert len(model.langs) == 301 and len(model.keys[0]) == 1200
    names, _ = langid._classify(model, [t for _, t, _ in rare])
    assert names == [x for _, _, x in rare]
