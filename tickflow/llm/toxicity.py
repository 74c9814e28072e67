"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

* Voters.  Seed lexicons (insults, profanity, threats), lexicons of words and of word stems mined from
  labelled texts and dealt to several voters, and patterns (insults with address, shouting, runs of
  exclamation marks, masked words, several terms, dense terms).  A voter fires or it does not.
* Label model.  For each class a log-linear table over all combinations of votes, with a term for each
  voter (how often it fires: its accuracy) and one for each pair that stays dependent within the classes
  (its correlation).  Expectation maximisation over the counts of vote combinations of *all* documents;
  known labels of training rows are held.  Combinations are at most ``2 ** len(VOTERS)``, so the counts
  are bounded whatever the corpus.
* Classifier.  Logistic regression over the terms a text has and the voters that fire, on the label
  model's posteriors; a document's score is the classifier's probability.

Bounds: terms are mined from at most ``SAMPLE`` labelled ids of each class (those of smallest hash) and are
at most ``TERMS``; the classifier is fitted on at most ``SAMPLE`` documents from either side of a posterior of
one half.  Counts for the label model and scores cover all documents and whole texts.

Defined results: a null or empty text fires no voter and has the score of the intercept.  Rows that repeat
an id are scored alike when their texts are equal; rows without an id are scored, never learned from
with a label, and have a null ``held_out``.  An id with several labels is toxic if one of them says so; null
labels are none.  Without labels the seeds alone tell the classes.  An empty table gives no rows.  Ties in
the sample are broken by id.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.llm.frames import remainder, stage
from tickflow.llm.words import BY_ALNUM, U, Words, chunks, contains, cut, ranges

SAMPLE = 20_000
TERMS = 1 << 16
LEAST_DOCS, LEAST_LIFT, LEAST_G2 = 5, 5.0, 25.0
"""A mined term is in so many toxic texts, so many times likelier in them, with so much evidence (log-likelihood ratio)."""
STEM, STEM_WORD = 4, 6
"""Characters of a stem, of words of at least so many."""
WORD_VOTERS, STEM_VOTERS = 3, 2
NEAR = 3
"""An address is at most so many words before a term."""
HELD = 1 << 21

# Seed words of the lexicon voters, in English, German, French and Spanish.
INSULTS = """
    idiot idiots moron morons loser losers scum trash stupid pathetic worthless disgusting dumb imbecile fool vermin
    dummkopf trottel abschaum idioten versager crétin imbécile ordure minable idiota imbécil basura estúpido estúpida
""".split()
PROFANITY = """
    fuck fucking fucker shit bullshit bitch bastard asshole cunt dick piss whore slut
    scheisse scheiße arschloch hure merde putain salope connard mierda puta cabrón pendejo
""".split()
THREATS = [
    "kill you", "kill yourself", "hurt you", "beat you", "you deserve", "hate you", "shut up", "go die", "drop dead", "get lost",
]
ADDRESS = "you your u ur du dein deine ihr tu toi vous votre eres sois tú vosotros usted".split()

VOTERS = [
    "insults", "profanity", "threats", *[f"words_{i}" for i in range(WORD_VOTERS)], *[f"stems_{i}" for i in range(STEM_VOTERS)],
    "addressed", "shouting", "exclaimed", "masked", "several", "dense",
]
AT = {v: i for i, v in enumerate(VOTERS)}
STATES = 1 << len(VOTERS)


def _hash_of(phrases: list[str]) -> np.ndarray:
    """Sorted hashes of words, or of the two words of each phrase."""
    out = []
    for phrase in phrases:
        raw = np.frombuffer(phrase.encode(), np.uint8)
        words = cut(raw, np.array([0, len(raw)]), BY_ALNUM, lower=True)
        out.append(words.grams(np.array([0]), len(words.hash))[0] if len(words.hash) > 1 else words.hash[0])
    return np.sort(np.array(out, U))


_SEEDS = {v: _hash_of(x) for v, x in (("insults", INSULTS), ("profanity", PROFANITY), ("threats", THREATS), ("address", ADDRESS))}


def _stems(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words that have a stem, and the stems' hashes (apart from those of words)."""
    begins = (words.data & 0xC0) != 0x80
    number = np.cumsum(begins)
    starts = np.flatnonzero(begins)
    if not len(words.hash):
        return np.zeros(0, np.int64), np.zeros(0, U)
    length = number[words.end - 1] - number[words.start] + 1
    which = np.flatnonzero(length >= STEM_WORD)
    first = words.start[which]
    stop = starts[np.minimum(number[first] - 1 + STEM, len(starts) - 1)]
    return which, ranges(words.data, first, stop) ^ U(0xA5A5A5A5A5A5A5A5)


@dataclass
class Lexicon:
    """Mined terms: sorted hashes, and the voter (bit) each belongs to."""

    hash: np.ndarray = field(default_factory=lambda: np.zeros(0, U))
    bit: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


def _observed(texts: pa.Array, lexicon: Lexicon) -> tuple[np.ndarray, pa.Array]:
    """The votes of each text as bits, and the mined terms it has (places in the lexicon, each once)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw_all = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    votes, sizes, terms = [], [], []
    for a, b, words in chunks(texts, BY_ALNUM, lower=True):
        n, row = b - a, words.row()
        state = np.zeros(n, np.int64)

        def fire(voter: str, rows: np.ndarray) -> None:
            state[rows] |= 1 << AT[voter]  # noqa: B023

        hit, at = contains(lexicon.hash, words.hash)
        which, stem = _stems(words)
        stem_hit, stem_at = contains(lexicon.hash, stem)
        seeded = np.zeros(len(row), bool)
        for voter in ("insults", "profanity"):
            here = contains(_SEEDS[voter], words.hash)[0]
            fire(voter, row[here])
            seeded |= here
        two = np.flatnonzero(np.arange(len(row)) + 2 <= words.stop())
        here = two[contains(_SEEDS["threats"], words.grams(two, 2))[0]] if len(two) else two
        fire("threats", row[here])
        found = np.r_[at[hit], stem_at[stem_hit]]
        rows = np.r_[row[hit], row[which[stem_hit]]]
        if len(found):
            np.bitwise_or.at(state, rows, 1 << lexicon.bit[found])
        pair = np.unique(rows * np.int64(max(1, len(lexicon.hash))) + found)
        rows, found = np.divmod(pair, max(1, len(lexicon.hash)))
        term = seeded | hit
        term[which[stem_hit]] = True
        seen = np.flatnonzero(contains(_SEEDS["address"], words.hash)[0])
        for by in range(1, NEAR + 1):
            near = seen[seen + by < len(row)]
            near = near[(row[near + by] == row[near]) & term[near + by]]
            fire("addressed", row[near])
        hits, count = np.bincount(row[term], minlength=n), np.maximum(words.counts, 1)
        fire("several", np.flatnonzero(hits >= 2))
        fire("dense", np.flatnonzero((hits > 0) & (hits * 100 >= count)))

        raw = raw_all[offsets[a] : offsets[b]]
        text = np.repeat(np.arange(n), np.diff(offsets[a : b + 1]))
        upper, small = (raw >= 65) & (raw <= 90), (raw >= 97) & (raw <= 122)
        ups, lows = (np.bincount(text[m], minlength=n) for m in (upper, small))
        fire("shouting", np.flatnonzero((ups >= 20) & (ups >= 2 * lows)))
        bang = raw == 33
        run = np.flatnonzero(bang[1:] & bang[:-1] & (text[1:] == text[:-1]))
        fire("exclaimed", np.flatnonzero(np.bincount(text[run], minlength=n) >= 2))
        if len(raw) > 2:
            letter, star = upper | small, raw == 42
            masked = np.flatnonzero(letter[:-2] & star[1:-1] & (star[2:] | letter[2:]) & (text[:-2] == text[2:]))
            fire("masked", text[masked])
        votes.append(state)
        sizes.append(np.bincount(rows, minlength=n))
        terms.append(found)
    if not votes:
        return np.zeros(0, np.int64), pa.array([], pa.list_(pa.int32()))
    offsets = np.r_[0, np.cumsum(np.concatenate(sizes))].astype(np.int32)
    return np.concatenate(votes), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(terms).astype(np.int32)))


def _terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, stem, toxic, clean): in how many texts of a partition each word and stem is, by class."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def fold() -> tuple[np.ndarray, ...]:
        term, first, at = np.unique(np.concatenate([h[0] for h in held]), return_index=True, return_inverse=True)
        counts = [np.zeros(len(term), np.int64) for _ in (0, 1)]
        for i in (0, 1):
            np.add.at(counts[i], at, np.concatenate([h[2 + i] for h in held]))
        return term, np.concatenate([h[1] for h in held])[first], *counts

    def batch_of(columns: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(columns[0].view(np.int64)), *[pa.array(c) for c in columns[1:]]], names=["term", "stem", "toxic", "clean"])

    for batch in batches:
        toxic = batch.column("toxic").to_numpy().astype(np.int64)
        for a, _, words in chunks(batch.column("text").fill_null("").cast(pa.large_string()), BY_ALNUM, lower=True):
            which, stem = _stems(words)
            row = words.row()
            for stems, values, of in ((0, words.hash, row), (1, stem, row[which])):
                order = np.lexsort((of, values))
                values, of = values[order], of[order]
                once = np.ones(len(values), bool)
                once[1:] = (values[1:] != values[:-1]) | (of[1:] != of[:-1])
                values, label = values[once], toxic[a + of[once]]
                term, begin = np.unique(values, return_index=True)
                if not len(term):
                    continue
                count = np.add.reduceat(label, begin), np.diff(np.r_[begin, len(values)])
                held.append((term, np.full(len(term), stems), count[0], count[1] - count[0]))
                size += len(term)
        if size > HELD:
            held = [fold()]
            size = len(held[0][0])
            if 2 * size > HELD:
                yield batch_of(held[0])
                held, size = [], 0
    if held:
        yield batch_of(fold())


def known(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic): one label for each labelled id that is no held-out one."""
    return labels.where((remainder(F.col("doc_id"), 5) != 0) & F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic")
    )


def mine(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Lexicon:
    """The terms that tell toxic from clean labelled texts.  Equal texts count once."""
    ids = known(labels)
    few = [ids.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample) for c in (0, 1)]
    chosen = few[0].unionByName(few[1])
    # At most 2 * sample rows, by construction.
    texts = stage(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic").dropDuplicates(), "labelled")
    n = {r.toxic: r["count"] for r in texts.groupBy("toxic").count().collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    if not pos or not neg:
        return Lexicon()
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("term", "stem", "toxic", "clean")])
    counts = texts.mapInArrow(_terms_of, schema).groupBy("term").agg(
        F.max("stem").alias("stem"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    both, part = F.col("toxic") + F.col("clean"), lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    expected = [both * F.lit(pos / (pos + neg)), both * F.lit(neg / (pos + neg))]
    counts = counts.withColumns({
        "g2": 2 * (part(F.col("toxic").cast("double"), expected[0]) + part(F.col("clean").cast("double"), expected[1])),
        "lift": (F.col("toxic") / F.lit(float(pos))) / ((F.col("clean") + 0.5) / F.lit(float(neg))),
    }).where((F.col("toxic") >= LEAST_DOCS) & (F.col("lift") >= LEAST_LIFT) & (F.col("g2") >= LEAST_G2))
    rows = counts.orderBy(F.desc("g2"), "term").limit(TERMS).select("term", "stem").collect()
    if not rows:
        return Lexicon()
    term, stem = np.array([r.term for r in rows], np.int64).view(U), np.array([r.stem for r in rows], np.int64)
    order = np.argsort(term)
    term, stem = term[order], stem[order]
    dealt = (term >> U(32)).astype(np.int64)
    bit = np.where(stem == 1, AT["stems_0"] + dealt % STEM_VOTERS, AT["words_0"] + dealt % WORD_VOTERS)
    return Lexicon(term, bit)


def votes(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, held_out, state (the voters that fire, as bits), terms (the mined terms of the text)."""
    held = docs.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "text")
    schema = T.StructType(
        [*held.schema.fields[:2], T.StructField("state", T.IntegerType()), T.StructField("terms", T.ArrayType(T.IntegerType()))]
    )
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from tickflow.llm.frames import pieces, strings

        for batch in batches:
            for piece in pieces(batch, [batch.column(2)]):
                state, terms = _observed(strings(piece.column(2)), shared.value)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array(state.astype(np.int32)), terms], names=["doc_id", "held_out", "state", "terms"]
                )

    return held.mapInArrow(run, schema)


@dataclass
class LabelModel:
    """What the voters are worth: how often each fires on either class, the dependent pairs, and posteriors."""

    prior: float
    fires: np.ndarray
    """fires[y, i]: the chance that voter i fires on a text of class y."""
    pairs: list[tuple[int, int]]
    posterior: np.ndarray
    """For each combination of votes the probability of being toxic."""


_BITS = (np.arange(STATES)[:, None] >> np.arange(len(VOTERS))) & 1


def _margins(table: np.ndarray, scopes: list[np.ndarray]) -> list[np.ndarray]:
    return [np.bincount(s, table, minlength=4) for s in scopes]


def _loglinear(target: np.ndarray, scopes: list[np.ndarray], rounds: int) -> np.ndarray:
    """The table with the target's margins over ``scopes`` and no other dependence, by iterative proportional fitting."""
    want = _margins(target / target.sum(), scopes)
    table = np.full(len(target), 1 / len(target))
    for _ in range(rounds):
        for s, w in zip(scopes, want, strict=True):
            have = np.bincount(s, table, minlength=4)
            table = table * np.divide(w, have, out=np.zeros(4), where=have > 0)[s]
    return table


def _dependent(tables: list[np.ndarray], weight: list[float], most: int) -> list[tuple[int, int]]:
    """Pairs of voters with the most mutual information within the classes."""
    found = []
    for i in range(len(VOTERS)):
        for j in range(i):
            scope, gain = _BITS[:, i] * 2 + _BITS[:, j], 0.0
            for t, w in zip(tables, weight, strict=True):
                p = np.bincount(scope, t / t.sum(), minlength=4).reshape(2, 2)
                e = np.outer(p.sum(1), p.sum(0))
                gain += w * float(np.sum(np.where(p > 0, p * np.log(np.maximum(p, 1e-300) / np.maximum(e, 1e-300)), 0)))
            found.append((gain, j, i))
    return [(i, j) for gain, i, j in sorted(found, reverse=True)[:most] if gain > 1e-3]


def label_model(toxic: np.ndarray, clean: np.ndarray, unknown: np.ndarray, rounds: int = 30, pairs: int = 2 * len(VOTERS)) -> LabelModel:
    """Expectation maximisation over counts of vote combinations: of texts known to be toxic, known to be clean, unknown.

    The first half of the rounds takes the voters as independent; the pairs that stay dependent then join the
    model, which is fitted anew.
    """
    fired = _BITS.sum(1)
    guess = np.where(fired == 0, 0.02, np.where(fired == 1, 0.3, 0.9))
    q = first = (toxic + 2 * guess) / (toxic + clean + 2)
    singles = [_BITS[:, i] for i in range(len(VOTERS))]
    chosen: list[tuple[int, int]] | None = None
    prior, tables = 0.5, [np.zeros(0), np.zeros(0)]
    for rnd in range(rounds):
        # A little weight on independence keeps every combination possible in either class.
        counts = [clean + (1 - q) * unknown, toxic + q * unknown]
        mass = [c.sum() + 1 for c in counts]
        prior = mass[1] / sum(mass)
        smooth = []
        for c, m in zip(counts, mass, strict=True):
            rate = (c @ _BITS + 0.5) / (c.sum() + 1)
            smooth.append(c / m + np.prod(np.where(_BITS == 1, rate, 1 - rate), axis=1) / m)
        if chosen is None and 2 * rnd >= rounds:
            chosen = _dependent(smooth, [1 - prior, prior], pairs)
            # Independent rounds trust voters that repeat each other too much: the fit starts anew.
            q = first
            continue
        scopes = [*singles, *[_BITS[:, i] * 2 + _BITS[:, j] for i, j in chosen or []]]
        tables = [_loglinear(s, scopes, 8) for s in smooth]
        top = prior * tables[1]
        q = top / np.maximum(top + (1 - prior) * tables[0], 1e-300)
    fires = np.array([t @ _BITS for t in tables])
    return LabelModel(float(prior), fires, chosen or [], q)


@dataclass
class Classifier:
    intercept: float
    voters: np.ndarray
    terms: np.ndarray

    def score(self, state: np.ndarray, begin: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """Probabilities; the terms of text r are terms[begin[r]:begin[r + 1]]."""
        z = self.intercept + _BITS[state] @ self.voters
        part = np.r_[0, self.terms[terms]]
        row = np.repeat(np.arange(len(state)), np.diff(begin))
        z += np.bincount(row, part[1:], minlength=len(state))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def train(state: np.ndarray, begin: np.ndarray, terms: np.ndarray, q: np.ndarray, weight: np.ndarray, size: int, rounds: int = 400, ridge: float = 1e-4) -> Classifier:
    """Logistic regression on soft labels, by accelerated gradient steps."""
    row = np.repeat(np.arange(len(state)), np.diff(begin))
    bits = _BITS[state].astype(float)
    weight = weight / weight.sum()
    w = np.zeros(1 + len(VOTERS) + size)
    # A bound on the curvature: the largest sum of squared features.
    step = 1 / (0.25 * float(np.max(1 + bits.sum(1) + np.diff(begin))) + ridge)
    y, t = w.copy(), 1.0
    for _ in range(rounds):
        z = y[0] + bits @ y[1 : 1 + len(VOTERS)] + np.bincount(row, y[1 + len(VOTERS) :][terms], minlength=len(state))
        error = weight * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - q)
        g = np.r_[error.sum(), error @ bits, np.bincount(terms, error[row], minlength=size)]
        g[1:] += ridge * y[1:]
        nxt = y - step * g
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        y, w = nxt + (before - 1) / t * (nxt - w), nxt
    return Classifier(float(w[0]), w[1 : 1 + len(VOTERS)], w[1 + len(VOTERS) :])


def fit(voted: DataFrame, labels: DataFrame, size: int, sample: int = SAMPLE) -> tuple[LabelModel, Classifier]:
    """The label model of all votes, and the classifier of its posteriors."""
    # Only ids and votes meet the labels; equal combinations fold before the shuffle.
    learned = known(labels).join(voted.where("NOT held_out").select("doc_id", "state"), "doc_id")
    counts = np.zeros((3, STATES))
    for r in learned.groupBy("toxic", "state").count().collect():
        counts[r.toxic, r.state] = r["count"]
    for r in voted.groupBy("state").count().collect():
        counts[2, r.state] = r["count"]
    counts[2] -= counts[0] + counts[1]
    model = label_model(counts[1], counts[0], counts[2])
    sides = []
    toxic_states = F.array(*[F.lit(int(s)) for s in np.flatnonzero((model.posterior >= 0.5) & (counts.sum(0) > 0))]).cast("array<int>")
    free = voted.where("NOT held_out").withColumn("side", F.array_contains(toxic_states, F.col("state")))
    for side in (True, False):
        share = counts.sum(0)[(model.posterior >= 0.5) == side].sum()
        some = free.where(F.col("side") == side).orderBy(F.xxhash64("doc_id"), "doc_id", "state").limit(sample).select("state", "terms").toArrow()
        n = max(1, some.num_rows)
        sides.append((some, np.full(some.num_rows, share / n)))
    table = pa.concat_tables([s[0] for s in sides]).combine_chunks()
    if not table.num_rows:
        return model, Classifier(float(np.log(max(model.prior, 1e-6) / max(1 - model.prior, 1e-6))), np.zeros(len(VOTERS)), np.zeros(size))
    state = table.column("state").to_numpy()
    lists = table.column("terms").combine_chunks()
    begin = np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
    terms = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return model, train(state, begin, terms, model.posterior[state], np.concatenate([s[1] for s in sides]), size)


def scored(voted: DataFrame, classifier: Classifier) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    schema = T.StructType([*voted.schema.fields[:2], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = voted.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("terms")
            begin = np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
            score = shared.value.score(batch.column("state").to_numpy(), begin, lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=schema.names
            )

    return voted.mapInArrow(run, schema)


def report(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    lexicon = mine(docs, labels, sample)
    voted = stage(votes(docs, lexicon), "votes")
    _, classifier = fit(voted, labels, len(lexicon.hash), sample)
    return scored(voted, classifier)
