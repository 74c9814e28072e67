"""MinHash near-duplicates by a multi-index Hamming join.

A document is the set of its distinct word shingles.  Its signature has ``SYMBOLS`` b-bit minhashes in
``PARTS`` chunks.  Two signatures that differ in at most ``DISTANCE = 2 * PARTS - 1`` symbols differ in
at most one symbol of some chunk (pigeonhole), so every chunk is looked up with each one of its symbols
left out: all pairs within the distance share a key.  At a similarity of 0.8 a pair differs in 8.8 of
44 symbols on average and in more than 21 with a chance of about 1 in 100,000.

* Equal sets are one class, found by a hash of the whole set and folded before the shuffle.
* Keys hold classes.  Each is first compared with the smallest class of its key (a star, never all
  pairs), so a large group of near copies costs a star.
* Classes of keys that still hold several components are compared across components, with one more
  necessary condition that keeps families of loosely related texts from meeting pairwise: similar
  sets share one of their rarest shingles (as many as the similarity lets a set lose, and one).  Rare is
  told by counts over a fixed table of hashed shingles; any common order keeps the condition exact.
* The place of a shared shingle in that order bounds what two sets can still share, and parity bits of
  the sets bound it again.  Both bounds are exact, so only pairs that cannot be similar go unread: the
  members of a large family that have too much of their own cost no reading of sets.
* Pairs within the distance are confirmed on the full shingle sets: those of the stars from the joined
  texts, those across components inside the comparing tasks, which memory-map the sets of the few
  classes concerned from the shared folder and send on links, never candidates.

Defined results: null or wordless texts have no shingles and are linked with nothing.  Rows that
repeat a doc_id are kept or dropped alike; a row without an id never names a component that has one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.llm.components import components
from tickflow.llm.frames import ROW, annotate, pieces, stage, whole_groups
from tickflow.llm.shards import mapped, save
from tickflow.llm.words import BY_SPACE, U, Words, chunks, mix, spread
from tickflow.session import work_path

PARTS, WIDTH = 11, 4
SYMBOLS = PARTS * WIDTH
DISTANCE = 2 * PARTS - 1
BLOCK = 512
RARITY_BITS = 18
KEPT = 1 << 20
"""Shingles in a file of sets."""
REMEMBERED = 1 << 20
"""Failed pairs a task remembers, so as not to compare them again."""
PARITIES = 512
"""Bits a set is told by before it is read."""
MEETING = 1 << 18
"""Pairs of rows a task holds at once."""
STEP = 1 << 10
"""Pairs a task looks at before it drops those joined meanwhile."""

_RANDOM = np.random.default_rng(20240229)
_A = (_RANDOM.integers(0, 1 << 31, SYMBOLS, dtype=np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _RANDOM.integers(0, 1 << 32, SYMBOLS, dtype=np.uint32)

_SIGNATURE = [
    T.StructField("n_shingles", T.LongType()),
    T.StructField("node", T.LongType()),
    T.StructField("signature", T.BinaryType()),
]
_PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def shingle_sets(words: Words, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer than ``n`` words are one shingle."""
    at = np.arange(len(words.hash))
    size = np.full(len(at), n)
    few = words.counts < n
    heads = words.first[:-1][few & (words.counts > 0)]
    fits = at + n <= words.stop()
    fits[heads] = True
    size[heads] = words.counts[few & (words.counts > 0)]
    at, size = at[fits], size[fits]
    grams = words.grams(at, size)
    cuts = np.searchsorted(at, words.first)
    return [np.unique(grams[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def set_hash(shingles: np.ndarray) -> int:
    """A 64-bit name of a set (a sum over its members, so order does not matter)."""
    total = mix(shingles ^ U(0x5851F42D4C957F2D)).sum(dtype=U) + U(len(shingles))
    return int(mix(np.array([total]))[0].view(np.int64))


def _minhash(sets: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(sets), SYMBOLS), np.uint16)
    rows = [i for i, s in enumerate(sets) if len(s)]
    if rows:
        lengths = np.array([len(sets[i]) for i in rows])
        low = (np.concatenate([sets[i] for i in rows]) >> U(32)).astype(np.uint32)
        begin = np.cumsum(lengths) - lengths
        for j in range(SYMBOLS):
            least = np.minimum.reduceat(low * _A[j] + _B[j], begin)
            out[rows, j] = (least * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return out


def _signatures(n: int):
    def fn(texts: pa.Array) -> dict:
        counts, nodes, signatures = [], [], []
        for _, _, words in chunks(texts, BY_SPACE, lower=True):
            sets = shingle_sets(words, n)
            counts += [len(s) for s in sets]
            nodes += [set_hash(s) for s in sets]
            signatures += [s.tobytes() for s in _minhash(sets)]
        return {"n_shingles": counts, "node": nodes, "signature": signatures}

    return fn


def signatures(docs: DataFrame, n: int, columns: list[str]) -> DataFrame:
    """``_row`` with the given columns, ``n_shingles``, ``node`` (the name of the set), ``signature``."""
    source = docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, "text"])])
    return annotate(source, _SIGNATURE, _signatures(n)).select(
        F.struct(*[F.col(f"{ROW}.`{c}`").alias(c) for c in columns]).alias(ROW), *[f.name for f in _SIGNATURE]
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SYMBOLS)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each class under every chunk with each one symbol left out."""
    for batch in batches:
        node, symbols = batch.column(0), _matrix(batch.column(1)).astype(U)
        for part in range(PARTS):
            for out in range(WIDTH):
                rest = [part * WIDTH + i for i in range(WIDTH) if i != out]
                key = np.full(len(symbols), part * WIDTH + out + 1, U)
                for i in rest:
                    key = (key << U(16)) | symbols[:, i]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mix(key).view(np.int64)), node.cast(pa.int64())], names=["key", "node"]
                )


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose signatures are within the distance."""
    for batch in batches:
        differ = (_matrix(batch.column(2)) != _matrix(batch.column(3))).sum(axis=1)
        yield batch.select([0, 1]).filter(pa.array(differ <= DISTANCE))


def _counted(n: int):
    """(bucket, count) of the shingles of a partition, each once per text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << RARITY_BITS, np.int64)
        for batch in batches:
            for _, _, words in chunks(batch.column(0).fill_null("").cast(pa.large_string()), BY_SPACE, lower=True):
                sets = shingle_sets(words, n)
                total += np.bincount(_bucket(np.concatenate(sets)), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    return run


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> U(64 - RARITY_BITS)).astype(np.int64)


def _parities(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``PARITIES`` bits for each set: whether it has an odd number of the shingles of each remainder.

    Two sets differ in at least as many shingles as their rows in bits.
    """
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    at = row * PARITIES + (np.concatenate(sets) % U(PARITIES)).astype(np.int64)
    odd = np.bincount(at, minlength=len(sets) * PARITIES).reshape(-1, PARITIES) & 1
    return np.packbits(odd.astype(np.uint8), axis=1)


def _rarest(n: int, percent: int, counts, folder: str):
    """(token, node, root, n, room, bits, file, begin): the shingles of a set of which a similar set must have one,
    and where the whole set is kept in the shared folder.

    The first shingle in this order that two sets share leaves each of them the shingles from there on to
    share: sets are similar only if ``percent`` times the size of either is within the other's ``room``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counts.value
        held: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            file = save(folder, "sets", np.concatenate([h[2] for h in held])).rpartition("/")[2]
            length = np.array([len(h[2]) for h in held], np.int64)
            each = np.array([len(h[3]) for h in held], np.int64)
            rows = [np.array(x, np.int64) for x in ([h[0] for h in held], [h[1] for h in held], length, np.cumsum(length) - length)]
            node, root, whole, begin = (np.repeat(x, each) for x in rows)
            token = np.concatenate([h[3] for h in held]).view(np.int64)
            before = np.arange(len(token)) - np.repeat(np.cumsum(each) - each, each)
            room = (100 + percent) * (whole - before) - percent * whole
            bits = pa.array([h[4] for h in held], pa.binary()).take(pa.array(np.repeat(np.arange(len(held)), each)))
            columns = [pa.array(x) for x in (token, node, root, whole, room)] + [bits, pa.array([file] * len(token), pa.string()), pa.array(begin)]
            yield pa.RecordBatch.from_arrays(columns, names=["token", "node", "root", "n", "room", "bits", "file", "begin"])

        for batch in batches:
            node, root = batch.column("node").to_pylist(), batch.column("root").to_pylist()
            texts = batch.column("text").fill_null("").cast(pa.large_string())
            for a, _, words in chunks(texts, BY_SPACE, lower=True):
                sets = shingle_sets(words, n)
                for r, (s, bits) in enumerate(zip(sets, _parities(sets), strict=True)):
                    # As many as a similar set may lack, and one.
                    k = len(s) + (-percent * len(s) // 100) + 1
                    held.append((node[a + r], root[a + r], s, s[np.lexsort((s, table[_bucket(s)]))[:k]], bits.tobytes()))
                    size += len(s)
                if size >= KEPT:
                    yield from flush()
                    held, size = [], 0
        if held:
            yield from flush()

    return run


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """The size of the intersection of two sorted sets."""
    both = np.concatenate([a, b])
    # This sort merges sorted runs.
    both.sort(kind="stable")
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _meeting(rows: pa.Table, cuts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of rows (left, right) that their groups bring together, in runs of about ``MEETING``."""
    side = rows.column("side").to_numpy()
    same = (rows.column("part").to_numpy() == 1) & (rows.column("i").to_numpy() == rows.column("j").to_numpy())
    size = np.diff(cuts)
    end = np.repeat(cuts[1:], size)
    row = np.arange(len(end))
    # The rows of the right side are the last of their group.
    first = np.where(same, row + 1, np.where(side, end, end - np.repeat(np.add.reduceat(side.astype(np.int64), cuts[:-1]), size)))
    ends = np.cumsum(end - first)
    a = 0
    while a < len(row):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + MEETING, "right")))
        right, left = spread(first[a:b], end[a:b] - 1)
        yield left + a, right
        a = b


def _across(percent: int, folder: str):
    """Links across components of block pairs: within the distance, then confirmed on the full sets.

    Part 0 holds outsiders and a block of the token's largest component, part 1 outsiders only.  Once
    a link joins two components, a task asks for no second one between them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        joined: dict[int, int] = {}
        failed: set[tuple[int, int]] = set()

        def top(x: int) -> int:
            while (y := joined.get(x, x)) != x:
                joined[x] = joined.get(y, y)
                x = y
            return x

        for rows, cuts in whole_groups(batches, ["token", "part", "i", "j"]):
            node, root, n, room, begin = (rows.column(c).to_numpy() for c in ("node", "root", "n", "room", "begin"))
            symbols, file = _matrix(rows.column("signature")), rows.column("file")
            bits = np.frombuffer(b"".join(rows.column("bits").to_pylist()), U).reshape(-1, PARITIES // 64)
            whole = lambda x: mapped(f"{folder}/{file[x].as_py()}")[begin[x] : begin[x] + n[x]]  # noqa: B023, E731
            roots, of = np.unique(root, return_inverse=True)
            found: list[tuple[int, int]] = []
            for left, right in _meeting(rows, cuts):
                fits = (root[left] != root[right]) & (percent * n[right] <= room[left]) & (percent * n[left] <= room[right])
                left, right = left[fits], right[fits]
                fits = 100 * np.minimum(n[left], n[right]) >= percent * np.maximum(n[left], n[right])
                left, right = left[fits], right[fits]
                # Shingles in which two sets differ are not common ones.
                size = n[left] + n[right]
                differ = np.bitwise_count(bits[left] ^ bits[right]).sum(axis=1, dtype=np.int64)
                fits = (100 + percent) * (size - differ) >= 2 * percent * size
                left, right = left[fits], right[fits]
                apart = (symbols[left] != symbols[right]).sum(axis=1)
                # The nearest first: they join components soonest.
                order = np.argsort(apart, kind="stable")[: int((apart <= DISTANCE).sum())]
                left, right = left[order], right[order]
                while len(left):
                    tops = np.array([top(x) for x in roots.tolist()])[of]
                    open_ = tops[left] != tops[right]
                    left, right = left[open_], right[open_]
                    for a, b in zip(left[:STEP].tolist(), right[:STEP].tolist(), strict=True):
                        one, two = top(int(root[a])), top(int(root[b]))
                        pair = (int(min(node[a], node[b])), int(max(node[a], node[b])))
                        if one == two or pair in failed:
                            continue
                        both = _common(whole(a), whole(b))
                        if 100 * both >= percent * int(n[a] + n[b] - both):
                            joined[one] = two
                            found.append(pair)
                        else:
                            if len(failed) >= REMEMBERED:
                                failed.clear()
                            failed.add(pair)
                    left, right = left[STEP:], right[STEP:]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], schema=_ARROW_PAIR)

    return run


_ARROW_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _confirm(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in pieces(whole, [whole.column("text_a"), whole.column("text_b")])):
            sides = []
            for name in ("text_a", "text_b"):
                texts = batch.column(name).fill_null("").cast(pa.large_string())
                sides.append([s for _, _, w in chunks(texts, BY_SPACE, lower=True) for s in shingle_sets(w, n)])
            a, b = (batch.column(c).to_pylist() for c in ("a", "b"))
            keep = []
            for x, y, p, q in zip(a, b, *sides, strict=True):
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(
                    100 * both >= percent * (len(p) + len(q) - both) and set_hash(p) == x and set_hash(q) == y
                )
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], schema=_ARROW_PAIR).filter(pa.array(keep, pa.bool_()))

    return run


def representatives(docs: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """(node, text) for rows (node, rep): the text of the class's smallest id."""
    named = docs.where("doc_id IS NOT NULL").select("doc_id", "text").join(
        nodes.where("rep IS NOT NULL"), F.col("doc_id") == F.col("rep")
    ).select("node", "text")
    # Rows without an id are found by their set.
    unnamed = (
        signatures(docs.where("doc_id IS NULL"), n, ["text"])
        .join(nodes.where("rep IS NULL"), "node")
        .select("node", F.col(f"{ROW}.text").alias("text"))
        .dropDuplicates(["node"])
    )
    return named.unionByName(unnamed)


def confirm(texts: DataFrame, pairs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs of classes (a, b) whose full shingle sets are similar enough; ``texts`` are (node, text)."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b"
    )
    return both.select("a", "b", "text_a", "text_b").mapInArrow(_confirm(n, percent), _PAIR)


def _between(docs: DataFrame, live: DataFrame, classes: DataFrame, roots: DataFrame, n: int, percent: int) -> DataFrame:
    """Confirmed links across the components ``roots`` of classes that share a key."""
    sc = docs.sparkSession.sparkContext
    rooted = live.where("size > 2").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = stage(rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high"), "several")
    left = rooted.join(several.select("key"), "key").select("node", "root").distinct().join(classes.select("node", "rep"), "node")
    texts = stage(representatives(docs, left.select("node", "rep"), n).join(left.select("node", "root"), "node"), "texts")
    # A table of fixed size, whatever the corpus.
    counts = texts.select("text").mapInArrow(_counted(n), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    rarity = np.zeros(1 << RARITY_BITS, np.int64)
    rarity[counts["bucket"].to_numpy(np.int64)] = counts["n"].to_numpy(np.int64)
    folder = work_path(docs.sparkSession, "sets")
    tokens = stage(
        texts.mapInArrow(
            _rarest(n, percent, sc.broadcast(rarity), folder), "token long, node long, root long, n long, room long, bits binary, file string, begin long"
        ),
        "tokens",
    )
    heads = stage(
        tokens.groupBy("token", "root").agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("low"), F.max("room").alias("high"))
        .groupBy("token").agg(
            F.max(F.struct("rows", "root")).alias("head"), F.sum("rows").alias("all"), F.min("low").alias("low"), F.max("high").alias("high")
        ).where("all > head.rows"),
        "heads",
    )
    parts = [F.ceil(x / BLOCK).cast("int") for x in (F.col("head.rows"), F.col("all") - F.col("head.rows"))]
    inside = F.col("root") == F.col("head.root")
    each = lambda k: F.sequence(F.lit(0), parts[k] - 1)
    at = lambda part, i, j: F.struct(F.lit(part).alias("part"), i.alias("i"), j.alias("j"))
    block = F.col("block")
    places = F.when(inside, F.transform(each(1), lambda x: at(0, block, x))).otherwise(
        F.concat(F.transform(each(0), lambda x: at(0, x, block)), F.transform(each(1), lambda x: at(1, F.least(block, x), F.greatest(block, x))))
    )
    members = (
        tokens.join(heads, "token")
        .where(f"{percent} * low <= room and {percent} * n <= high")
        .withColumn("inside", inside)
        .withColumn("block", F.pmod(F.xxhash64("node"), F.when(inside, parts[0]).otherwise(parts[1])).cast("int"))
        .withColumn("place", F.explode(places))
        .select("token", "node", "root", "n", "room", "bits", "inside", "file", "begin", "block", "place.*")
        .withColumn("side", F.when(F.col("part") == 0, F.col("inside")).otherwise((F.col("i") < F.col("j")) & (block == F.col("j"))))
        .drop("inside", "block")
        .join(classes.select("node", "signature"), "node")
    )
    grouped = members.repartition("token", "part", "i", "j").sortWithinPartitions("token", "part", "i", "j", "side")
    return grouped.mapInArrow(_across(percent, folder), _PAIR)


def link(docs: DataFrame, n: int = 5, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, n_shingles, node) of all documents, and (node, component_id) of all classes."""
    rows = stage(signatures(docs, n, ["doc_id"]).select(f"{ROW}.doc_id", "n_shingles", "node", "signature"), "signatures")
    classes = stage(
        rows.where("n_shingles > 0").groupBy("node").agg(
            F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.first("signature").alias("signature")
        ),
        "classes",
    )
    keys = classes.select("node", "signature").mapInArrow(_keys, "key long, node long")
    # Written before it is joined back, so that the engine can split a hot key over tasks.
    shared = stage(keys.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("size")).where("size > 1"), "shared")
    live = stage(keys.join(shared, "key"), "keys")

    def side(name: str) -> DataFrame:
        return classes.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("signature").alias(f"s_{name}"))

    star = (
        live.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
        .join(side("a"), "a").join(side("b"), "b")
        .where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        .select("a", "b", "s_a", "s_b").mapInArrow(_near, _PAIR)
    )
    pairs = stage(star, "pairs")
    reps = classes.select("node", "rep")
    met = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(reps, "node")
    first = stage(components(confirm(representatives(docs, met, n), pairs, n, percent)), "roots")
    more = _between(docs, live, classes, first, n, percent)
    roots = components(first.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    named = roots.join(classes.select("node", "rep"), "node")
    smallest = named.groupBy("root").agg(F.min("rep").alias("least_id"))
    linked = roots.join(smallest, "root").select("node", "least_id")
    all_classes = classes.select("node", "rep").join(linked, "node", "left").select(
        "node", F.coalesce("least_id", "rep").alias("component_id")
    )
    return rows.select("doc_id", "n_shingles", "node"), stage(all_classes, "classes")


def report(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: the size of its set, its component, whether it stays."""
    rows, classes = link(docs, n, percent)
    out = rows.join(classes, "node", "left").withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    )
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay, with their own columns: the smallest id of each group."""
    _, classes = link(docs, n, percent)
    marked = signatures(docs, n, docs.columns).select(ROW, "n_shingles", "node")
    stays = (F.col("n_shingles") == 0) | F.col(f"{ROW}.doc_id").eqNullSafe(F.col("component_id"))
    return marked.join(classes, "node", "left").where(stays).select(f"{ROW}.*")
