"""Interpolated modified Kneser-Ney n-gram model.

Counting runs in Spark.  Each task folds the n-grams of a few million tokens and sends sorted, deflated
arrays to the shards; a shard merges them and saves sorted arrays in the shared folder.  Scoring tasks
memory-map these arrays, so a worker's own memory holds one chunk of text.

* Level 1: token hash -> count; a token's place in the sorted arrays is its id.
* Level n = order .. 2: n-gram -> adjusted count, context -> (total, number of continuations seen once,
  twice, more often).  The highest level has raw counts; a lower one counts distinct left neighbours,
  taken from the level above (n-grams that begin a text keep raw counts).
* Shards are dealt by the hash of the context.  A context more frequent than a mean shard is spread
  over all shards by its continuation, and its totals are summed.

Every text is lower-cased (A-Z), cut at ASCII white space and closed by one end token.  Probability of
an unknown word: the interpolation ends in 1 / (V + 1).  Nothing is pruned.

Defined results: a null or empty text is its end token.  A row without an id has no remainder: it is
not held out and takes part in training.  Without training texts every score is that of the uniform
model.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.llm.frames import ROW, annotate, remainder, stage
from tickflow.llm.shards import mapped, pack, save, unpack
from tickflow.llm.words import BY_SPACE, U, Words, chunks, contains, mix
from tickflow.session import work_path

ORDER = 2
SHARD_BYTES = 16 << 20
"""Bytes of text for each shard of the vocabulary."""
MOD, HELD_OUT = 7, 2
END = U(0x1F83D9ABFB41BD6B)
"""The hash that stands for the end token."""
BEGIN = np.uint32(0xFFFFFFFF)
UNKNOWN = np.uint32(0xFFFFFFFE)
HELD = 1 << 21
"""Tokens a counting task folds at once."""
SHARD_TOKENS = 1 << 22


def _tokens(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes with the end tokens, and the first token of each text."""
    first = words.first + np.arange(len(words.first))
    out = np.empty(first[-1], U)
    ends = np.zeros(len(out), bool)
    ends[first[1:] - 1] = True
    out[ends] = END
    out[~ends] = words.hash
    return out, first


def _fold(keys: np.ndarray, weight: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their summed weights (counts)."""
    if weight is None:
        keys, n = np.unique(keys, return_counts=True)
        return keys, n.astype(np.int64)
    order = np.argsort(keys, kind="stable")
    keys, weight = keys[order], weight[order]
    new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[new], np.add.reduceat(weight, new) if len(keys) else weight


def _slot(key: np.ndarray, shards: int) -> np.ndarray:
    """The shard of a hash: equal ranges of its upper half."""
    return (((key >> U(32)) * U(shards)) >> U(32)).astype(np.int64)


def _payload(shard: np.ndarray, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    order = np.argsort(shard, kind="stable")
    ids, begin = np.unique(shard[order], return_index=True)
    for s, rows in zip(ids.tolist(), np.split(order, begin[1:]), strict=True):
        yield pa.RecordBatch.from_arrays(
            [pa.array([s], pa.int32()), pa.array([pack([c[rows] for c in columns])], pa.binary())], names=["shard", "blob"]
        )


_PAYLOAD = "shard int, blob binary"


def _small(n: np.ndarray) -> np.ndarray:
    return n.astype(np.uint32) if not len(n) or n.max() < 1 << 32 else n


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for batch in batches:
        for _, _, words in chunks(batch.column(0).fill_null("").cast(pa.large_string()), BY_SPACE, lower=True):
            yield words


def _count_tokens(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for words in _texts(batches):
            tokens, _ = _tokens(words)
            held.append(tokens)
            size += len(tokens)
            if size >= HELD:
                keys, n = _fold(np.concatenate(held), None)
                yield from _payload(_slot(keys, shards), [keys, _small(n)])
                held, size = [], 0
        if held:
            keys, n = _fold(np.concatenate(held), None)
            yield from _payload(_slot(keys, shards), [keys, _small(n)])

    return run


_TOKENS = "shard int, n long, total long, keys string, counts string, hot array<struct<at:long,n:long>>"


def _merge_tokens(folder: str):
    def run(rows: pa.Table) -> pa.Table:
        shard = rows.column("shard")[0].as_py()
        parts = [unpack(b) for b in rows.column("blob").to_pylist()]
        keys, n = _fold(np.concatenate([p[0] for p in parts]), np.concatenate([p[1].astype(np.int64) for p in parts]))
        often = np.flatnonzero(n >= n.sum() / 8)
        return pa.Table.from_pydict(
            {
                "shard": pa.array([shard], pa.int32()), "n": [len(keys)], "total": [int(n.sum())],
                "keys": [save(folder, f"token-{shard}", keys)], "counts": [save(folder, f"count-{shard}", n)],
                "hot": pa.array([[{"at": int(i), "n": int(n[i])} for i in often]], pa.list_(pa.struct([("at", pa.int64()), ("n", pa.int64())]))),
            }
        )

    return run


@dataclass
class Vocabulary:
    """Level 1: the shards of the sorted token hashes."""

    shards: int
    begin: np.ndarray
    """Id of the first token of each shard, and the number of ids at the end."""
    keys: list[str | None]
    counts: list[str | None]
    total: int
    hot: np.ndarray
    """Ids of tokens more frequent than a mean shard of the next level, in order; the text begin is one."""

    @property
    def size(self) -> int:
        return int(self.begin[-1])

    def ids(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Id and count of each distinct, sorted token hash; unknown ones have UNKNOWN and 0."""
        ids, n = np.full(len(tokens), UNKNOWN, np.uint32), np.zeros(len(tokens), np.int64)
        cuts = np.searchsorted(_slot(tokens, self.shards), np.arange(self.shards + 1))
        for s in range(self.shards):
            own = slice(cuts[s], cuts[s + 1])
            if own.start == own.stop or self.keys[s] is None:
                continue
            known, at = contains(mapped(self.keys[s]), tokens[own])
            ids[own] = np.where(known, at + self.begin[s], UNKNOWN)
            n[own] = np.where(known, mapped(self.counts[s])[at], 0)
        return ids, n


def _key(columns: list[np.ndarray]) -> np.ndarray:
    """A 64-bit name of id sequences; exact for one or two ids."""
    out = columns[0].astype(U)
    if len(columns) > 1:
        out = (out << U(32)) | columns[1].astype(U)
    for c in columns[2:]:
        out = mix(mix(out) * U(0x9E3779B97F4A7C15) + c.astype(U) + U(1))
    return out


def _context(columns: list[np.ndarray], hot: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context name, whether it is spread over the shards, and the shard of each n-gram."""
    name = _key(columns[:-1])
    spread = np.ones(len(name), bool)
    for c in columns[:-1]:
        spread &= contains(hot, c)[0]
    by = mix(name + U(1))
    by[spread] = mix(by[spread] + columns[-1][spread].astype(U) + U(1))
    return name, spread, _slot(by, shards)


def _sequence(words: Words, vocabulary: Vocabulary, order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Id columns of the n-gram at every token, the tokens' counts, the first token of each text."""
    tokens, first = _tokens(words)
    distinct, inverse = np.unique(tokens, return_inverse=True)
    ids, n = vocabulary.ids(distinct)
    ids, n = ids[inverse], n[inverse]
    at = np.arange(len(ids)) - np.repeat(first[:-1], np.diff(first))
    columns = []
    for back in range(order - 1, 0, -1):
        c = np.full(len(ids), BEGIN, np.uint32)
        inner = np.flatnonzero(at >= back)
        c[inner] = ids[inner - back]
        columns.append(c)
    return [*columns, ids], n, first


def _distinct(columns: list[np.ndarray], weight: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct id sequences in order, with summed weights."""
    if len(columns) == 2:
        keys, n = _fold(_key(columns), weight)
        return [(keys >> U(32)).astype(np.uint32), keys.astype(np.uint32)], n
    order = np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    at = np.flatnonzero(new)
    weight = np.ones(len(order), np.int64) if weight is None else weight[order]
    return [c[at] for c in columns], np.add.reduceat(weight, at) if len(at) else weight


def _sequences_payload(columns: list[np.ndarray], n: np.ndarray, hot: np.ndarray, shards: int) -> Iterator[pa.RecordBatch]:
    _, _, shard = _context(columns, hot, shards)
    head = [_key(columns)] if len(columns) == 2 else columns
    yield from _payload(shard, [*head, _small(n)])


def _count_sequences(vocabulary: Vocabulary, order: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        size = 0
        for words in _texts(batches):
            columns, _, _ = _sequence(words, vocabulary, order)
            held.append(columns)
            size += len(columns[0])
            if size >= HELD:
                yield from _sequences_payload(*_distinct([np.concatenate(c) for c in zip(*held, strict=True)], None), vocabulary.hot, shards)
                held, size = [], 0
        if held:
            yield from _sequences_payload(*_distinct([np.concatenate(c) for c in zip(*held, strict=True)], None), vocabulary.hot, shards)

    return run


_STAT = "struct<name:long,total:long,n1:long,n2:long,n3:long>"
_LEVEL = (
    "shard int, ones array<long>, keys string, counts string, names string, stats string, "
    f"spread array<{_STAT}>, lower array<struct<shard:int,blob:binary>>"
)
_LEVEL_ARROW = pa.schema(
    [
        ("shard", pa.int32()), ("ones", pa.list_(pa.int64())), ("keys", pa.string()), ("counts", pa.string()),
        ("names", pa.string()), ("stats", pa.string()),
        ("spread", pa.list_(pa.struct([(c, pa.int64()) for c in ("name", "total", "n1", "n2", "n3")]))),
        ("lower", pa.list_(pa.struct([("shard", pa.int32()), ("blob", pa.binary())]))),
    ]
)


def _stats(names: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per context name: total count, continuations of count 1, 2, more."""
    order = np.argsort(names, kind="stable")
    names, n = names[order], n[order]
    new = np.flatnonzero(np.r_[True, names[1:] != names[:-1]]) if len(names) else np.zeros(0, np.int64)
    if not len(new):
        return names, np.zeros((0, 4), np.int64)
    table = np.stack([np.add.reduceat(x.astype(np.int64), new) for x in (n, n == 1, n == 2, n > 2)], axis=1)
    return names[new], table


def _merge_level(folder: str, level: int, vocabulary: Vocabulary, shards: int):
    """Merge one shard of n-grams; save its arrays; send what the level below needs."""

    def run(rows: pa.Table) -> pa.Table:
        shard = rows.column("shard")[0].as_py()
        parts = [unpack(b) for b in rows.column("blob").to_pylist()]
        joined = [np.concatenate(c) for c in zip(*parts, strict=True)]
        if level == 2:
            joined[:1] = [(joined[0] >> U(32)).astype(np.uint32), joined[0].astype(np.uint32)]
        columns, n = _distinct(joined[:-1], joined[-1].astype(np.int64))
        name, spread, _ = _context(columns, vocabulary.hot, shards)
        keys = _key(columns)
        order = np.argsort(keys, kind="stable")
        names, stats = _stats(name[~spread], n[~spread])
        wide, sums = _stats(name[spread], n[spread])
        # Below: how many different words stand before each suffix; suffixes that begin a text keep counts.
        suffix = columns[1:]
        weight = np.where(suffix[0] == BEGIN, n, 1) if len(suffix) > 1 else np.ones(len(n), np.int64)
        if len(suffix) > 1:
            payload = _sequences_payload(*_distinct(suffix, weight), vocabulary.hot, shards)
        else:
            ids, left = _fold(suffix[0], weight)
            payload = _payload(np.searchsorted(vocabulary.begin, ids, "right") - 1, [ids, _small(left)])
        return pa.Table.from_pydict(
            {
                "shard": [shard], "ones": [[int((n == i).sum()) for i in (1, 2, 3, 4)]],
                "keys": [save(folder, f"gram{level}-{shard}", keys[order])],
                "counts": [save(folder, f"adjusted{level}-{shard}", _small(n[order]))],
                "names": [save(folder, f"context{level}-{shard}", names)],
                "stats": [save(folder, f"stats{level}-{shard}", stats)],
                "spread": [[dict(zip(("name", "total", "n1", "n2", "n3"), (int(w.view(np.int64)), *map(int, s)), strict=True)) for w, s in zip(wide, sums, strict=True)]],
                "lower": [[{"shard": b.column(0)[0].as_py(), "blob": b.column(1)[0].as_py()} for b in payload]],
            },
            schema=_LEVEL_ARROW,
        )

    return run


def _merge_ids(folder: str, begin: np.ndarray):
    def run(rows: pa.Table) -> pa.Table:
        shard = rows.column("shard")[0].as_py()
        out = np.zeros(int(begin[shard + 1] - begin[shard]), np.int64)
        for b in rows.column("blob").to_pylist():
            ids, n = unpack(b)
            out[ids.astype(np.int64) - begin[shard]] += n
        return pa.Table.from_pydict(
            {
                "shard": pa.array([shard], pa.int32()), "total": [int(out.sum())],
                "ones": pa.array([[int((out == i).sum()) for i in (1, 2, 3, 4)]], pa.list_(pa.int64())),
                "seen": [int((out > 2).sum())], "left": [save(folder, f"left-{shard}", out)],
            }
        )

    return run


def discounts(ones: np.ndarray) -> np.ndarray:
    """The discounts of counts 0, 1, 2 and more, from how many n-grams have count 1, 2, 3, 4."""
    n1, n2, n3, n4 = (int(x) for x in ones)
    if min(n1, n2, n3, n4) > 0:
        y = n1 / (n1 + 2 * n2)
        d = np.array([0, 1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3])
        if (d >= 0).all() and (d <= [0, 1, 2, 3]).all():
            return d
    return np.array([0, 0.5, 1.0, 1.5])


@dataclass
class Level:
    discount: np.ndarray
    keys: list[str | None]
    counts: list[str | None]
    names: list[str | None]
    stats: list[str | None]
    spread: np.ndarray
    sums: np.ndarray


@dataclass
class Model:
    """Where the arrays are; small, whatever the corpus."""

    order: int
    vocabulary: Vocabulary
    shards: int
    left: list[str | None]
    left_total: int
    left_discount: np.ndarray
    left_rest: float
    levels: dict[int, Level] = field(default_factory=dict)

    def unigram(self, ids: np.ndarray) -> np.ndarray:
        """Probabilities of ids at the lowest level."""
        v = self.vocabulary
        n = np.zeros(len(ids), np.int64)
        shard = np.where(ids == UNKNOWN, -1, np.searchsorted(v.begin, ids, "right") - 1)
        order = np.argsort(shard, kind="stable")
        found, begin = np.unique(shard[order], return_index=True)
        for s, rows in zip(found.tolist(), np.split(order, begin[1:]), strict=True):
            if s >= 0 and self.left[s] is not None:
                n[rows] = mapped(self.left[s])[ids[rows].astype(np.int64) - v.begin[s]]
        if not self.left_total:
            return np.full(len(ids), 1.0 / (v.size + 1))
        kept = np.maximum(n - self.left_discount[np.minimum(n, 3)], 0) / self.left_total
        return kept + self.left_rest / (v.size + 1)

    def level(self, n: int, columns: list[np.ndarray], below: np.ndarray) -> np.ndarray:
        """Interpolate level ``n`` over the probabilities of the level below."""
        at, v = self.levels[n], self.vocabulary
        packed = _key(columns)
        _, first, inverse = np.unique(packed, return_index=True, return_inverse=True)
        columns = [c[first] for c in columns]
        name, spread, shard = _context(columns, v.hot, self.shards)
        keys = packed[first]
        count, stats = np.zeros(len(keys), np.int64), np.zeros((len(keys), 4), np.int64)
        order = np.argsort(shard, kind="stable")
        found, begin = np.unique(shard[order], return_index=True)
        for s, rows in zip(found.tolist(), np.split(order, begin[1:]), strict=True):
            if at.keys[s] is None:
                continue
            known, place = contains(mapped(at.keys[s]), keys[rows])
            count[rows[known]] = mapped(at.counts[s])[place[known]]
            known, place = contains(mapped(at.names[s]), name[rows])
            stats[rows[known]] = mapped(at.stats[s])[place[known]]
        known, place = contains(at.spread, name)
        known &= spread
        stats[known] = at.sums[place[known]]
        total = np.maximum(stats[:, 0], 1)
        kept = np.maximum(count - at.discount[np.minimum(count, 3)], 0) / total
        rest = np.where(stats[:, 0] > 0, (stats[:, 1:] * at.discount[1:]).sum(axis=1) / total, 1.0)
        return kept[inverse] + rest[inverse] * below


def train(texts: DataFrame, order: int = ORDER) -> Model:
    """Count the column ``text`` of ``texts`` and save the model in the shared folder."""
    if order < 2:
        raise ValueError("the order is 2 or more")
    spark: SparkSession = texts.sparkSession
    folder = work_path(spark, "model")
    # As many shards as the shuffle has partitions, and more where texts are many: a shard's words sit in one worker.
    held = texts.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    shards = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held // SHARD_BYTES))
    source = texts.select(F.col("text").cast("string").alias("text"))
    tokens = source.mapInArrow(_count_tokens(shards), _PAYLOAD).groupBy("shard").applyInArrow(_merge_tokens(folder), _TOKENS)
    rows = {r["shard"]: r for r in stage(tokens, "tokens").collect()}  # one small row per shard
    sizes = [rows[s]["n"] if s in rows else 0 for s in range(shards)]
    begin = np.r_[0, np.cumsum(sizes)].astype(np.int64)
    total = sum(r["total"] for r in rows.values())
    deep = max(shards, -(-total // SHARD_TOKENS))
    hot = [int(begin[s]) + x["at"] for s, r in rows.items() for x in r["hot"] if x["n"] > total / deep]

    def places(found: dict, count: int, what: str) -> list[str | None]:
        return [found[s][what] if s in found else None for s in range(count)]

    vocabulary = Vocabulary(
        shards, begin, places(rows, shards, "keys"), places(rows, shards, "counts"), total,
        np.array(sorted([*hot, int(BEGIN)]), np.uint32),
    )
    payload = source.mapInArrow(_count_sequences(vocabulary, order, deep), _PAYLOAD)
    levels: dict[int, Level] = {}
    for n in range(order, 1, -1):
        merged = stage(payload.groupBy("shard").applyInArrow(_merge_level(folder, n, vocabulary, deep), _LEVEL), f"level{n}")
        found = {r["shard"]: r for r in merged.drop("lower", "spread").collect()}
        # Contexts above the mean shard: fewer than there are shards.
        sums = merged.select(F.explode("spread").alias("x")).select("x.*").groupBy("name").sum("total", "n1", "n2", "n3").toPandas()
        names = sums["name"].to_numpy(np.int64).view(U)
        rank = np.argsort(names)
        levels[n] = Level(
            discounts(np.sum([r["ones"] for r in found.values()], axis=0) if found else np.zeros(4)),
            *(places(found, deep, c) for c in ("keys", "counts", "names", "stats")),
            names[rank], sums.iloc[:, 1:].to_numpy(np.int64).reshape(-1, 4)[rank],
        )
        payload = merged.select(F.explode("lower").alias("x")).select("x.*")
    left = stage(
        payload.groupBy("shard").applyInArrow(_merge_ids(folder, begin), "shard int, total long, ones array<long>, seen long, left string"), "left"
    )
    found = {r["shard"]: r for r in left.collect()}
    ones = np.sum([r["ones"] for r in found.values()], axis=0) if found else np.zeros(4)
    discount = discounts(ones)
    sum_left = sum(r["total"] for r in found.values())
    seen = np.array([ones[0], ones[1], sum(r["seen"] for r in found.values())])
    rest = float((seen * discount[1:]).sum() / sum_left) if sum_left else 1.0
    return Model(order, vocabulary, deep, places(found, shards, "left"), sum_left, discount, rest, levels)


_SCORES = [
    T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
    T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``_row`` (the columns of ``docs``) and the scores of every text, in log10."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def fn(texts: pa.Array) -> dict:
        m: Model = shared.value
        v = m.vocabulary
        parts: list[list[np.ndarray]] = [[] for _ in _SCORES]
        for _, _, words in chunks(texts, BY_SPACE, lower=True, size=1 << 21):
            columns, n, first = _sequence(words, v, m.order)
            distinct, inverse = np.unique(columns[-1], return_inverse=True)
            p = m.unigram(distinct)[inverse]
            for level in range(2, m.order + 1):
                p = m.level(level, columns[m.order - level :], p)
            base = np.log10((n + 1) / (v.total + v.size + 1))
            at = first[:-1]
            for out, x in zip(parts, (np.ones(len(n), np.int64), (n > 0).astype(np.int64), base, np.log10(p)), strict=True):
                out.append(np.add.reduceat(x, at))
        return {f.name: np.concatenate(x) if x else [] for f, x in zip(_SCORES, parts, strict=True)}

    return annotate(docs, _SCORES, fn)


def report(docs: DataFrame, order: int = ORDER, mod: int = MOD, held_out: int = HELD_OUT) -> DataFrame:
    """Train on the documents that are not held out, score all of them."""
    held = F.coalesce(remainder(F.col("doc_id"), mod) == held_out, F.lit(False))
    model = train(docs.where(~held), order)
    return score(docs.select("doc_id", "text"), model).select(
        f"{ROW}.doc_id",
        F.coalesce(remainder(F.col(f"{ROW}.doc_id"), mod) == held_out, F.lit(False)).alias("held_out"),
        "n_tokens", "n_known", F.lit(model.vocabulary.total).cast("long").alias("train_tokens"), "base_score", "score",
    )
