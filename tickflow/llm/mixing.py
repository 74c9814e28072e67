"""Mixing sources to target weights by hierarchical budgeting, in DataFrame functions only.

Documents hang in a tree: domain, language, source.  A token budget flows from the root: every node
splits what it gets among its children by their weights, no child getting more than its leaves can give
(their tokens times ``max_epochs``).  What one child cannot take goes to its siblings by weight, and
only what all siblings together cannot take is left for the parent's siblings: a node is never asked for
more than its whole subtree holds.  Each split is a water level found with running sums over the
children; nothing iterates.

A leaf then gives whole epochs and a prefix of one more.  Every epoch has a seeded order of its own (a
hash of seed, epoch and id); the prefix has the documents before which less than the leaf's remainder
was taken, so it ends with the document that reaches it.  Running sums over a leaf go by ranges of
the hash first: a leaf of any size is summed in 4,096 ranges, and only its last range is ordered.

Defined results: null or empty texts have no tokens and are never taken; a null language or source is
a leaf named ``und`` or ``unknown``; weights are missing (1), or not positive (nothing is taken).  Rows
with one id are in one place of the order and are taken alike; rows without an id share the id ``''``.
An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickflow.llm.frames import stage

RANGE_DIGITS = 3
"""Hexadecimal digits that tell a range: 4,096 ranges."""


@dataclass(frozen=True)
class Mix:
    """What to mix.  Weights of names that are not listed are 1."""

    budget: int | None = None
    """Tokens; without it, the share below of all tokens."""
    share: float = 0.5
    max_epochs: int = 4
    seed: int = 17
    domains: dict[str, float] = field(default_factory=dict)
    languages: dict[str, float] = field(default_factory=dict)
    sources: dict[str, float] = field(default_factory=dict)
    n_domains: int = 4
    """Sources are dealt to domains by the number at the end of their name."""

    def domain(self, source: Column) -> Column:
        number = F.coalesce(F.expr("try_cast(regexp_extract(source, '([0-9]{1,9})$', 1) AS INT)"), F.lit(0))
        return F.concat(F.lit("domain"), F.pmod(number, F.lit(self.n_domains)).cast("string"))


def _weight(name: Column, weights: dict[str, float]) -> Column:
    if not weights:
        return F.lit(1.0)
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    return F.coalesce(F.get(F.map_values(F.map_filter(table, lambda k, v: k == name)), F.lit(0)), F.lit(1.0))


def tokens(text: Column) -> Column:
    """Words of a text, cut at ASCII white space."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+"), lambda w: w != "")).cast("long")


def _leaves(docs: DataFrame, mix: Mix) -> DataFrame:
    source = F.coalesce("source", F.lit("unknown"))
    return docs.withColumns(
        {"lang": F.coalesce("lang", F.lit("und")), "source": source, "n_tokens": tokens(F.col("text"))}
    ).withColumn("domain", mix.domain(F.col("source")))


def _split(nodes: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Give each row (weight, cap) its part of ``budget``, which the rows of one parent share.

    In the order of cap / weight, the first rows are filled to their caps; the level of the others is
    what is left over the weight that is left.
    """
    usable = F.col("weight") > 0
    fill = F.when(usable, F.col("cap") / F.col("weight")).otherwise(F.lit(0.0))
    cap, weight = F.when(usable, F.col("cap")).otherwise(0.0), F.when(usable, F.col("weight")).otherwise(0.0)
    order = Window.partitionBy(*parent).orderBy("fill", name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy(*parent)
    left = (
        nodes.withColumns({"fill": fill, "cap": cap, "weight": weight})
        .withColumns({"spent": F.coalesce(F.sum("cap").over(before), F.lit(0.0)), "still": F.sum("weight").over(after)})
        .withColumn("level", F.when(F.col("still") > 0, (F.col("budget") - F.col("spent")) / F.col("still")).otherwise(0.0))
    )
    # The first row that is not filled sets the level for itself and all after it.
    level = F.min(F.when(F.col("level") <= F.col("fill"), F.struct("fill", name, "level"))).over(whole)["level"]
    part = F.least(F.col("cap"), F.greatest(F.lit(0.0), F.coalesce(F.col("weight") * F.col("water"), F.col("cap"))))
    return left.withColumn("water", level).withColumn("part", part).drop("fill", "spent", "still", "level", "water")


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """(domain, lang, source, tokens, target) from (domain, lang, source, tokens): each leaf's share of the budget."""
    caps = leaves.withColumn("cap", (F.col("tokens") * mix.max_epochs).cast("double"))
    total = caps.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("all"))
    root = total.select((F.lit(mix.budget) if mix.budget is not None else F.floor(F.col("all") * mix.share)).cast("double").alias("budget"))
    domains = caps.groupBy("domain").agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(F.col("domain"), mix.domains))
    # One row, the budget, beside each domain.
    first = _split(domains.crossJoin(F.broadcast(root)).withColumn("root", F.lit(0)), ["root"], "domain").select("domain", F.col("part").alias("budget"))
    langs = caps.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).withColumn("weight", _weight(F.col("lang"), mix.languages))
    second = _split(langs.join(first, "domain"), ["domain"], "lang").select("domain", "lang", F.col("part").alias("budget"))
    last = caps.withColumn("weight", _weight(F.col("source"), mix.sources)).join(second, ["domain", "lang"])
    return _split(last, ["domain", "lang"], "source").select("domain", "lang", "source", "tokens", F.floor(F.col("part") + 0.5).alias("target"))


def plan(docs: DataFrame, mix: Mix) -> tuple[DataFrame, DataFrame]:
    """All documents as narrow rows with their leaf and order keys, and the leaves with their targets."""
    spot = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = stage(_leaves(docs, mix).select("doc_id", spot.alias("spot"), "domain", "lang", "source", "n_tokens"), "mixing")
    sums = rows.groupBy("domain", "lang", "source").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0")
    return rows, stage(
        budgets(sums, mix).withColumn("full", F.floor(F.col("target") / F.col("tokens")).cast("int")).withColumn("rest", F.col("target") - F.col("full") * F.col("tokens")),
        "leaves",
    )


def select(docs: DataFrame, mix: Mix) -> DataFrame:
    """(doc_id, spot, domain, lang, source, n_tokens, epochs): how often each document is taken, if at all."""
    rows, leaves = plan(docs, mix)
    leaf = ["domain", "lang", "source"]
    place = F.md5(F.concat_ws(":", F.lit(mix.seed).cast("string"), F.col("full").cast("string"), F.col("spot")).cast("binary"))
    placed = rows.where("n_tokens > 0").join(leaves.where("target > 0"), leaf).withColumn("place", place).withColumn(
        "range", F.substring("place", 1, RANGE_DIGITS)
    )
    # Ranges of a leaf: at most 4,096 rows each window.
    ranges = placed.where("rest > 0").groupBy(*leaf, "range").agg(F.sum("n_tokens").alias("sum"), F.first("rest").alias("rest"))
    upto = Window.partitionBy(*leaf).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    begun = ranges.withColumn("before", F.coalesce(F.sum("sum").over(upto), F.lit(0).cast("long")))
    open_ranges = begun.where("before < rest").select(
        *leaf, "range", "before", (F.col("before") + F.col("sum") > F.col("rest")).alias("last")
    )
    met = placed.join(open_ranges, [*leaf, "range"], "left")
    # Only the range in which the remainder is reached is put in order; equal places are taken together.
    inner = Window.partitionBy(*leaf, "range").orderBy("place").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    same = Window.partitionBy(*leaf, "range", "place")
    cut = met.where("last").withColumn("start", F.col("before") + F.sum("n_tokens").over(inner) - F.sum("n_tokens").over(same))
    columns = ["doc_id", "spot", *leaf, "n_tokens"]
    last = cut.select(*columns, (F.col("full") + (F.col("start") < F.col("rest")).cast("int")).alias("epochs"))
    others = met.where("NOT coalesce(last, false)").select(*columns, (F.col("full") + F.col("last").isNotNull().cast("int")).alias("epochs"))
    return last.unionByName(others).where("epochs > 0")


def report(docs: DataFrame, mix: Mix) -> DataFrame:
    return select(docs, mix).select("doc_id", "domain", "lang", "source", "n_tokens", "epochs")


def mixed(docs: DataFrame, mix: Mix) -> DataFrame:
    """The documents taken, with their own columns, and ``epochs``: how often each is taken."""
    taken = select(docs, mix).groupBy("spot").agg(F.max("epochs").alias("epochs"))
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("spot"))
    met = marked.join(taken, "spot").where(tokens(F.col("_row.text")) > 0)
    kept = [c for c in docs.columns if c != "epochs"]
    return met.select(*[F.col(f"_row.`{c}`").alias(c) for c in kept], "epochs")


def sql(mix: Mix) -> str:
    """The rows of ``report`` in SQL over ``documents``; splits are unrolled level by level."""

    def weight(name: str, weights: dict[str, float]) -> str:
        if not weights:
            return "1.0::DOUBLE"
        return "CASE " + name + "".join(f" WHEN '{k}' THEN {float(w)}::DOUBLE" for k, w in weights.items()) + " ELSE 1.0::DOUBLE END"

    def split(out: str, nodes: str, parent: str, name: str, keep: str) -> str:
        over = f"PARTITION BY {parent} ORDER BY cap / weight, {name}"
        return f"""{out}_a AS (SELECT *, coalesce(sum(cap) OVER ({over} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
  sum(weight) OVER ({over} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS still FROM {nodes} WHERE weight > 0),
{out}_b AS (SELECT *, (budget - spent) / still AS level FROM {out}_a),
{out}_c AS (SELECT *, first_value(CASE WHEN level <= cap / weight THEN level END IGNORE NULLS) OVER (PARTITION BY {parent}
  ORDER BY cap / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS water FROM {out}_b),
{out} AS (SELECT {keep}, least(cap, greatest(0.0, coalesce(weight * water, cap))) AS part FROM {out}_c)"""

    total = str(mix.budget) if mix.budget is not None else f"floor((SELECT sum(tokens) FROM leaf) * {mix.share})"
    return f"""WITH doc AS (SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS spot, coalesce(lang, 'und') AS lang, coalesce(source, 'unknown') AS source,
  len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '')) AS n_tokens FROM documents),
placed AS (SELECT *, 'domain' || (coalesce(TRY_CAST(regexp_extract(source, '([0-9]{{1,9}})$', 1) AS INT), 0) % {mix.n_domains}) AS domain FROM doc WHERE n_tokens > 0),
leaf AS (SELECT domain, lang, source, sum(n_tokens)::DOUBLE AS tokens, sum(n_tokens)::DOUBLE * {mix.max_epochs} AS cap FROM placed GROUP BY ALL),
d AS (SELECT domain, 0 AS root, sum(cap) AS cap, {weight("domain", mix.domains)} AS weight, {total} AS budget FROM leaf GROUP BY domain),
{split("d1", "d", "root", "domain", "domain")},
l AS (SELECT leaf.domain, leaf.lang, sum(cap) AS cap, {weight("leaf.lang", mix.languages)} AS weight, any_value(part) AS budget FROM leaf JOIN d1 USING (domain) GROUP BY leaf.domain, leaf.lang),
{split("l1", "l", "domain", "lang", "domain, lang")},
s AS (SELECT leaf.*, {weight("leaf.source", mix.sources)} AS weight, part AS budget FROM leaf JOIN l1 USING (domain, lang)),
{split("s1", "s", "domain, lang", "source", "domain, lang, source, tokens")},
target AS (SELECT *, floor(part + 0.5) AS target, floor(floor(part + 0.5) / tokens) AS full_epochs FROM s1),
ordered AS (SELECT placed.*, full_epochs, target - full_epochs * tokens AS rest,
  md5('{mix.seed}:' || CAST(CAST(full_epochs AS BIGINT) AS VARCHAR) || ':' || spot) AS place FROM placed JOIN target USING (domain, lang, source)),
summed AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
  - sum(n_tokens) OVER (PARTITION BY domain, lang, source, place) AS start FROM ordered)
SELECT doc_id, domain, lang, source, CAST(n_tokens AS BIGINT) AS n_tokens, CAST(full_epochs + CASE WHEN start < rest THEN 1 ELSE 0 END AS INTEGER) AS epochs
FROM summed WHERE full_epochs + CASE WHEN start < rest THEN 1 ELSE 0 END > 0"""
