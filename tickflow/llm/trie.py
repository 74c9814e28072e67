"""Prefix trie of conversations as a distributed burst trie.

A node is a distinct sequence of first turns.  Turns are named by 128-bit hashes of (role, text); a path
is named by a 128-bit hash of its turns, so equal paths have equal names in any task.

* Order: rows are range-partitioned by (conversation, turn); each piece counts its own rows and small
  sums over pieces carry the count over.  A conversation of any length is spread over many tasks.
* Parts: a conversation is cut every ``part`` turns; a part hangs under the path before it.  Equal parts
  under one path are folded to one row (a count, the smallest id, sums) before the shuffle, so copies
  cost a row.
* Burst: a container holds the suffixes (parts) under one trie head.  While some hold more than ``bound``
  turns, each of these becomes a trie branch: the turns that all its suffixes share become one chain,
  and what is left is dealt to new containers by the next turn.
* Sweep: the other containers, and the chains, are sorted turn by turn and swept into nodes, many
  containers at a time in numpy.

Sums over subtrees need no walk up the tree.  A node's subtree is covered by its members' paths, so
``n_leaves`` and the subtree's words are sums over members of what each conversation owns (the nodes
of which it is the smallest member): owned words and leaves are found by a first sweep, folded to a row a
conversation, and summed over members by a second sweep.

Defined results: a null role or text is ''.  Rows that share a turn number are ordered by a hash of
role and text (equal rows stay two turns).  Rows without a conv_id belong to no conversation.  A null turn
number comes first.  A conversation without turns is a member of the root alone.  An empty table has no
nodes, not even a root.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow.llm.frames import groups, stage
from tickflow.llm.words import U, mix

PART = 256
"""Turns of a part."""
BOUND = 50_000
"""Turns a container may hold before it is burst."""
SWEEP = 200_000
"""Turns a task sweeps at once."""
PIECE_ROWS = 1_000_000
NONE_SHA = hashlib.sha256(b"").hexdigest()

# Odd factors that keep the two halves of a path's name apart.
_STEP = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_PLACE = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)


def _rows_per_piece(df: DataFrame) -> int:
    """Pieces of about a million rows, at least as many as the shuffle has partitions."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // PIECE_ROWS))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the piece, and each row's place among the rows of its conversation in the piece."""
    from pyspark import TaskContext

    piece = TaskContext.get().partitionId()
    last, seen = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column("conv_id").to_numpy()
        new = np.r_[conv[0] != last, conv[1:] != conv[:-1]]
        at = np.arange(len(conv))
        begin = np.maximum.accumulate(np.where(new, at, -1))
        place = at - np.maximum(begin, 0) + np.where(begin < 0, seen, 0) + 1
        last, seen = conv[-1], int(place[-1])
        yield pa.RecordBatch.from_arrays(
            [*batch.select(["conv_id", "a", "b", "words"]).columns, pa.array(np.full(len(conv), piece, np.int32)), pa.array(place)],
            names=["conv_id", "a", "b", "words", "piece", "place"],
        )


def ordered(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, a, b, words): the turns of every conversation, numbered from 1; a and b name role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    # The length keeps ("ab", "c") apart from ("a", "bc").
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    sha = F.sha2(named, 256)
    half = lambda i: F.conv(F.substring(sha, i, 16), 16, -10).cast("long")
    plain = stage(
        conversations.where("conv_id IS NOT NULL").select(
            F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), half(1).alias("a"), half(17).alias("b"),
            F.size(F.regexp_extract_all(text, F.lit("[^\\x20\\x09-\\x0D]+"), 0)).cast("long").alias("words"),
        ),
        "turns",
    )
    pieces = _rows_per_piece(plain)
    schema = T.StructType(
        [T.StructField(c, T.LongType()) for c in ("conv_id", "a", "b", "words")]
        + [T.StructField("piece", T.IntegerType()), T.StructField("place", T.LongType())]
    )
    order = ["conv_id", F.col("turn").asc_nulls_first(), "a", "b"]
    cut = stage(plain.repartitionByRange(pieces, *order).sortWithinPartitions(*order).mapInArrow(_numbered, schema), "pieces")
    # One row for each (conversation, piece): a running sum over the pieces a conversation crosses.
    counted = cut.groupBy("conv_id", "piece").agg(F.max("place").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = counted.withColumn("carry", F.sum("n").over(before)).where("carry IS NOT NULL").select("conv_id", "piece", "carry")
    return cut.join(carried, ["conv_id", "piece"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("carry", F.lit(0))).alias("at"), "a", "b", "words"
    )


def rebuilt(turns: DataFrame, every: int = 20, heads: int = 4) -> DataFrame:
    """Every conversation c gets the first h turns of conversation c - c % every, then its own after its first h.

    h = crc32(c as text) % heads.  A conversation without turns left keeps one row, with ``at`` 0 and no turn.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("long")
    convs = turns.groupBy("conv_id").agg(F.max("at").alias("own")).withColumns(
        {"h": h, "base": F.col("conv_id") - F.col("conv_id") % every}
    )
    first = turns.where((F.col("at") < heads) & (F.col("conv_id") % every == 0)).groupBy(F.col("conv_id").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("at", "a", "b", "words"))).alias("first")
    )
    plan = convs.join(first, "base", "left").withColumn("head", F.slice(F.coalesce("first", F.array().cast(first.schema["first"].dataType)), F.lit(1), F.col("h").cast("int")))
    plan = stage(plan.select("conv_id", "own", "h", F.size("head").cast("long").alias("k"), "head"), "plan")
    own = turns.withColumn("h", h).where("at > h").drop("h")
    moved = plan.where("h != k").select("conv_id", (F.col("k") - F.col("h")).alias("by"))
    own = own.join(moved, "conv_id", "left").select("conv_id", (F.col("at") + F.coalesce("by", F.lit(0))).alias("at"), "a", "b", "words")
    given = plan.select("conv_id", F.explode("head").alias("x")).select("conv_id", "x.*")
    bare = plan.where("k = 0 AND own <= h").select(
        "conv_id", F.lit(0).cast("long").alias("at"), *[F.lit(None).cast("long").alias(c) for c in ("a", "b", "words")]
    )
    return own.unionByName(given).unionByName(bare)


_KEYS = T.ArrayType(T.LongType())
_NAMED = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("conv_id", "s")] + [T.StructField(c, _KEYS) for c in ("ka", "kb", "w")]
)


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The names of the paths within each part, from its own start."""
    for batch in batches:
        turns = batch.column("turns")
        size = turns.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = turns.flatten()
        at, a, b, w = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("at", "a", "b", "words"))
        row = np.repeat(np.arange(len(size)), size)
        order = np.lexsort((at, row))
        ids, w = [x[order].view(U) for x in (a, b)], w[order]
        begin = np.cumsum(size) - size
        state = [np.zeros(len(size), U), np.zeros(len(size), U)]
        keys = [np.empty(len(row), U), np.empty(len(row), U)]
        place = batch.column("s").to_numpy().astype(U) + U(1)
        for i in range(int(size.max(initial=0))):
            on = np.flatnonzero(size > i)
            x = begin[on] + i
            for lane in (0, 1):
                # Each half depends on both halves of the turn's name.
                mixed = ids[lane][x] ^ (ids[1 - lane][x] * U(_STEP[1 - lane]))
                state[lane][on] = mix(state[lane][on] * U(_STEP[lane]) + mixed)
                keys[lane][x] = mix(state[lane][on] ^ (place[on] * U(_PLACE[lane])))
        offsets = pa.array(np.r_[0, np.cumsum(size)].astype(np.int32))
        lists = [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in (keys[0].view(np.int64), keys[1].view(np.int64), w)]
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("s"), *lists], names=_NAMED.names)


def _total(c: str) -> Column:
    return F.aggregate(c, F.lit(0).cast("long"), lambda x, y: x + y)


def _parts(sequences: DataFrame, part: int) -> DataFrame:
    """(conv_id, s, ka, kb, w, start names ha, hb, tail, is_last): the parts of every conversation."""
    s = F.greatest(F.lit(0), F.floor((F.col("at") - 1) / part)).alias("s")
    lists = sequences.groupBy("conv_id", s).agg(
        F.collect_list(F.when(F.col("at") > 0, F.struct("at", "a", "b", "words"))).alias("turns")
    )
    named = stage(lists.mapInArrow(_named, _NAMED), "named")
    # A running combination over the parts of a conversation: one row in ``part`` turns.
    end = named.select("conv_id", "s", F.try_element_at("ka", F.lit(-1)).alias("ea"), F.try_element_at("kb", F.lit(-1)).alias("eb"), _total("w").alias("sum"))
    along = Window.partitionBy("conv_id").orderBy("s")
    back = Window.partitionBy("conv_id").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    heads = end.select(
        "conv_id", "s",
        F.coalesce(F.expr("bit_xor(ea)").over(earlier), F.lit(0)).alias("ha"), F.coalesce(F.expr("bit_xor(eb)").over(earlier), F.lit(0)).alias("hb"),
        F.sum("sum").over(back).alias("tail"), F.lead("s").over(along).isNull().cast("long").alias("ends"),
    )
    shift = lambda keys, by: F.transform(keys, lambda k: k.bitwiseXOR(F.col(by)))
    return named.join(heads, ["conv_id", "s"]).select(
        "conv_id", "s", shift("ka", "ha").alias("ka"), shift("kb", "hb").alias("kb"), "w", "ha", "hb", "tail", "ends"
    )


_BOX = ["depth", "ba", "bb"]
"""A container: the depth its suffixes begin at, and the path of its head (with the next turn, once it was dealt by that)."""
_STATS = ["n", "lo", "lo_tail", "tails", "ends"]
"""Of the members of a part: number, smallest id, the words it has from the part on, such words of all, how many end with it."""


def _burst(parts: DataFrame, bound: int) -> tuple[DataFrame, DataFrame]:
    """Containers over ``bound`` turns become chains and smaller containers.

    Returns the final parts, and links from the parts given to the final ones each lies in; parts are
    named by the path at their end.
    """
    done, links = [], []
    now = parts
    while True:
        now = stage(now, "containers")
        box = now.groupBy(*_BOX).agg(F.sum(F.size("ka")).alias("turns"), F.count(F.lit(1)).alias("parts")).where(
            (F.col("turns") > bound) & (F.col("parts") > 1)
        ).select(*_BOX)
        box = stage(box, "oversized")
        if box.isEmpty():
            break
        hot = stage(now.join(box, _BOX, "left_semi"), "burst")
        rows = F.struct("ka", "kb", "w")
        least = F.struct("lo", "lo_tail")
        shape = hot.groupBy(*_BOX).agg(
            F.min(rows).alias("low"), F.max("ka").alias("high"), F.sum("n").alias("n"), F.min(least).alias("l"), F.sum("tails").alias("tails"),
            F.first("up").alias("up"), F.first("pa").alias("pa"), F.first("pb").alias("pb"),
        )
        same = F.aggregate(F.zip_with("low.ka", "high", lambda x, y: F.coalesce((x == y).cast("int"), F.lit(0))), F.lit(0), lambda x, y: x + y)
        shape = stage(shape.withColumn("shared", same), "shape")
        cutoff = shape.select(*_BOX, "shared", F.col("l.lo").alias("top"))
        met = hot.join(cutoff, _BOX)
        over = stage(met.where("size(ka) = shared").groupBy(*_BOX).agg(F.sum("ends").alias("ends")), "ends")
        head = lambda c: F.slice(c, F.lit(1), F.col("shared"))
        rest = lambda c: F.expr(f"slice({c}, shared + 1, greatest(size({c}) - shared, 0))")
        # The part every suffix of a container shares: one chain of nodes.
        chain = shape.where("shared > 0").join(over, _BOX, "left").select(
            F.expr("low.ka[shared - 1]").alias("fa"), F.expr("low.kb[shared - 1]").alias("fb"), *_BOX, "up", "pa", "pb",
            head("low.ka").alias("ka"), head("low.kb").alias("kb"), head("low.w").alias("w"),
            "n", F.col("l.lo").alias("lo"), F.col("l.lo_tail").alias("lo_tail"), "tails", F.coalesce("ends", F.lit(0)).cast("long").alias("ends"),
        )
        done.append(stage(chain, "chains"))
        links.append(stage(met.where("shared > 0").select("fa", "fb", F.expr("ka[shared - 1]").alias("ta"), F.expr("kb[shared - 1]").alias("tb")), "links"))
        gone = F.aggregate(head("w"), F.lit(0).cast("long"), lambda x, y: x + y)
        left = met.where("size(ka) > shared").select(
            "fa", "fb", (F.col("depth") + F.col("shared")).alias("depth"), F.expr("ka[shared]").alias("ba"), F.expr("kb[shared]").alias("bb"),
            F.when(F.col("shared") > 0, F.col("top")).otherwise(F.col("up")).alias("up"),
            F.when(F.col("shared") > 0, F.expr("ka[greatest(shared - 1, 0)]")).otherwise(F.col("pa")).alias("pa"),
            F.when(F.col("shared") > 0, F.expr("kb[greatest(shared - 1, 0)]")).otherwise(F.col("pb")).alias("pb"),
            rest("ka").alias("ka"), rest("kb").alias("kb"), rest("w").alias("w"),
            "n", "lo", (F.col("lo_tail") - gone).alias("lo_tail"), (F.col("tails") - F.col("n") * gone).alias("tails"), "ends",
        )
        now = now.join(box, _BOX, "left_anti").unionByName(left)
    final = now
    for chain in done:
        final = final.unionByName(chain)
    link = now.select("fa", "fb", F.col("fa").alias("ta"), F.col("fb").alias("tb"))
    for more in links:
        link = link.unionByName(more)
    return final, link


def _sweep(carried: list[str], inner: bool):
    """Containers to nodes.

    A node gets its name, its parent's smallest member and name where those lie in another container,
    the sums of ``carried`` over its members, and for ``inner`` all it needs to be put out.
    """

    def work(table: pa.Table) -> pa.RecordBatch:
        keys = [table.column(c).combine_chunks() for c in ("ka", "kb", "w")]
        size = keys[0].value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        ka, kb, w = (k.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for k in keys)
        begin = np.cumsum(size) - size
        col = {c: table.column(c).to_numpy().astype(np.int64) for c in ["depth", "up", "pa", "pb", "n", "lo", "lo_tail", "tails", "ends", *carried]}
        box = [table.column(c).to_numpy() for c in _BOX]
        order = np.lexsort((box[2], box[1], box[0]))
        order = order[size[order] > 0]
        new = np.ones(len(order), bool)
        new[1:] = np.any([b[order][1:] != b[order][:-1] for b in box], axis=0)
        group = np.cumsum(new) - 1
        up, pa_, pb = (col[c][order] for c in ("up", "pa", "pb"))
        spent = np.zeros(len(size), np.int64)
        out: list[dict] = []
        i = 0
        while len(order):
            x = begin[order] + i
            by = np.lexsort((col["lo"][order], kb[x], ka[x], group))
            order, x, group, up, pa_, pb = order[by], x[by], group[by], up[by], pa_[by], pb[by]
            new = np.ones(len(order), bool)
            new[1:] = (group[1:] != group[:-1]) | (ka[x][1:] != ka[x][:-1]) | (kb[x][1:] != kb[x][:-1])
            at = np.flatnonzero(new)
            total = lambda v: np.add.reduceat(v[order], at)  # noqa: B023, E731
            n, first = total(col["n"]), order[at]
            last = size[order] == i + 1
            got = {
                "ka": ka[x[at]], "kb": kb[x[at]], "depth": col["depth"][first] + i + 1, "lo": col["lo"][first], "n": n, "w": w[x[at]],
                "ends": np.add.reduceat(np.where(last, col["ends"][order], 0), at),
                "up": up[at], "pa": pa_[at], "pb": pb[at], "outer": np.full(len(at), int(i == 0)),
                "tails": total(col["tails"]) - n * spent[first], "lo_tail": col["lo_tail"][first] - spent[first],
                "parent": group[at],
            }
            for c in carried:
                got[c] = col[c][first] if c == "lo_owned" else total(col[c])
            got["children"] = np.zeros(len(at), np.int64)
            if out:
                np.add.at(out[-1]["children"], got["parent"], 1)
            out.append(got)
            spent[order] += w[x]
            group = np.cumsum(new) - 1
            up, pa_, pb = got["lo"][group], got["ka"][group], got["kb"][group]
            keep = ~last
            order, group, up, pa_, pb = order[keep], group[keep], up[keep], pa_[keep], pb[keep]
            i += 1
        names = _OUT if inner else ["lo", "n", "w", "ends"]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([o[c] for o in out]) if out else np.zeros(0, np.int64), pa.int64()) for c in names], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turns = [], 0
        for box in groups(batches, _BOX):
            held.append(box)
            turns += len(box.column("w").combine_chunks().flatten())
            if turns > SWEEP or len(held) > 20_000:
                yield work(pa.concat_tables(held))
                held, turns = [], 0
        if held:
            yield work(pa.concat_tables(held))

    return run


_OUT = ["ka", "kb", "depth", "lo", "n", "w", "ends", "up", "pa", "pb", "outer", "tails", "lo_tail", "children", "owned", "leaves", "lo_owned"]


def _longs(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.LongType()) for c in names])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the ids that end at each node; ids pass by in order, none is kept."""
    key, state, started = None, hashlib.sha256(), False

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]]), pa.array([state.hexdigest()])], names=["ka", "kb", "ends_sha256"])

    for batch in batches:
        a, b, c = (batch.column(x).to_numpy() for x in ("ka", "kb", "conv_id"))
        if not len(a):
            continue
        cuts = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
        for x, y in zip(cuts, np.r_[cuts[1:], len(a)], strict=True):
            if key != (a[x], b[x]):
                if key is not None:
                    yield row()
                key, state, started = (a[x], b[x]), hashlib.sha256(), False
            state.update((("," if started else "") + ",".join(map(str, c[x:y].tolist()))).encode())
            started = True
    if key is not None:
        yield row()


def trie(sequences: DataFrame, part: int = PART, bound: int = BOUND) -> DataFrame:
    """The nodes of the trie of ``sequences`` (conv_id, at, a, b, words), as the contract of ``report`` names them."""
    parts = stage(_parts(sequences, part), "parts")
    # Members that share a path before a part: the smallest of them is the parent of what follows.
    above = parts.where("s > 0").select(F.col("s").alias("s"), "ha", "hb").distinct()
    full = parts.select((F.col("s") + 1).alias("s"), F.try_element_at("ka", F.lit(-1)).alias("ha"), F.try_element_at("kb", F.lit(-1)).alias("hb"), "conv_id")
    above = full.join(above, ["s", "ha", "hb"], "left_semi").groupBy("s", "ha", "hb").agg(F.min("conv_id").alias("up"))
    root = parts.where("s = 0").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("lo"), F.sum("tail").alias("tails"), F.sum(F.when(F.size("ka") == 0, 1).otherwise(0)).alias("ends"),
    ).where("n > 0")
    top = root.first()
    end = [F.try_element_at(c, F.lit(-1)) for c in ("ka", "kb")]
    # Copies fold before the shuffle.  The last path of a part names the part whole.
    filled = parts.where(F.size("ka") > 0).withColumns({"fa": end[0], "fb": end[1]})
    folded = filled.groupBy("fa", "fb", "s", "ha", "hb").agg(
        F.first("ka").alias("ka"), F.first("kb").alias("kb"), F.first("w").alias("w"), F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("lo"),
        F.min(F.struct("conv_id", "tail"))["tail"].alias("lo_tail"), F.sum("tail").alias("tails"), F.sum("ends").alias("ends"),
    )
    start = folded.join(above, ["s", "ha", "hb"], "left").select(
        "fa", "fb", (F.col("s") * part).alias("depth"), F.col("ha").alias("ba"), F.col("hb").alias("bb"),
        F.coalesce("up", F.lit(top["lo"] if top else 0)).alias("up"), F.col("ha").alias("pa"), F.col("hb").alias("pb"),
        "ka", "kb", "w", *_STATS,
    )
    final, links = _burst(start, bound)
    final = stage(final, "final")

    def swept(df: DataFrame, carried: list[str], inner: bool) -> DataFrame:
        dealt = df.repartition(*_BOX).sortWithinPartitions(*_BOX)
        return dealt.mapInArrow(_sweep(carried, inner), _longs(_OUT if inner else ["lo", "n", "w", "ends"]))

    # What each conversation owns: the words of the nodes it is the smallest member of, and its own end if a leaf.
    owned = stage(
        swept(final, [], False).groupBy("lo").agg(
            F.sum("w").alias("owned"), F.max((F.col("n") == F.col("ends")).cast("long")).alias("leaves")
        ),
        "owned",
    )
    by_part = filled.select("conv_id", "fa", "fb").join(owned.withColumnRenamed("lo", "conv_id"), "conv_id")
    total = [F.sum("owned").alias("owned"), F.sum("leaves").alias("leaves")]
    sums = links.join(by_part.groupBy("fa", "fb").agg(*total), ["fa", "fb"]).groupBy(F.col("ta").alias("fa"), F.col("tb").alias("fb")).agg(*total)
    known = final.join(sums, ["fa", "fb"], "left").join(owned.select("lo", F.col("owned").alias("lo_owned")), "lo", "left")
    nodes = stage(swept(known.fillna(0, ["owned", "leaves", "lo_owned"]), ["owned", "leaves", "lo_owned"], True), "nodes")

    all_owned = owned.agg(*total).first()
    zero = dict.fromkeys(_OUT, 0)
    rows = []
    if top is not None:
        leaves = 1 if top["n"] == top["ends"] else all_owned["leaves"]
        rows = [zero | {c: top[c] for c in ("lo", "n", "ends", "tails")} | {"up": None, "owned": all_owned["owned"] or 0, "leaves": leaves}]
    roots = parts.sparkSession.createDataFrame([tuple(r[c] for c in _OUT) for r in rows], _longs(_OUT))
    below = nodes.where("outer = 1").groupBy(F.col("pa").alias("ka"), F.col("pb").alias("kb")).agg(F.count(F.lit(1)).alias("more"))
    over = parts.where("ends = 1").select(F.coalesce(end[0], F.lit(0)).alias("ka"), F.coalesce(end[1], F.lit(0)).alias("kb"), "conv_id")
    digests = over.repartition(F.col("ka"), F.col("kb")).sortWithinPartitions("ka", "kb", "conv_id").mapInArrow(
        _digest, T.StructType([T.StructField("ka", T.LongType()), T.StructField("kb", T.LongType()), T.StructField("ends_sha256", T.StringType())])
    )
    # A subtree's words: what all members own, where the smallest one's own path counts from here on.
    words = F.col("owned") - F.col("lo_owned") + F.col("lo_tail")
    return nodes.unionByName(roots).join(below, ["ka", "kb"], "left").join(digests, ["ka", "kb"], "left").select(
        F.col("lo").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        (F.col("children") + F.coalesce("more", F.lit(0))).alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("tails") - words).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NONE_SHA)).alias("ends_sha256"),
    )


def report(conversations: DataFrame, part: int = PART, bound: int = BOUND) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of the rebuilt conversations."""
    return trie(stage(rebuilt(ordered(conversations)), "rebuilt"), part, bound)
