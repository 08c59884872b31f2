"""Mix sources to target weights by a budget that runs down a domain, language, source tree.

Every node's budget is dealt to its children by weight, none above its capacity
(``max_epochs`` times the tokens below it). What a full child cannot take goes to its
siblings by weight; only what no sibling can take is missing at the parent, whose own
siblings then take it, because a parent's capacity is the sum of what its leaves can take: those
of weight above 0 all the way up.

A leaf's stream is its documents in a seeded order per epoch, epoch after epoch; its
prefix of ``budget`` tokens is taken. That prefix is some whole epochs and the documents
before one key in the last, so it is described by one row per leaf. Documents are then
selected by a join with that table and never shuffled or sorted; only the keys of one
bucket of about ``BUCKET`` documents per leaf, which is found in two levels, are sorted to find the last document.

Defined cases: null domain, language or source are values of their own; a null text has
no tokens; rows without a doc_id are ordered by their text; rows of one leaf with the same
doc_id stand at one place of the stream and are taken or left together; documents without
tokens are taken where they stand, and not at all in a leaf without tokens; a text of any length is counted as a whole; a weight that
is null or not above 0 gives nothing. Empty input gives empty output. Columns of the input
that are named like an output column are replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Workspace
from .common import WORD, free_prefix, workspace

BUCKET = 2_000
WIDE = 11  # bits of a bucket's number inside a run of buckets
TREE = ["domain", "lang", "source"]
ADDED = ["domain", "epoch", "n_tokens", "taken"]


@dataclass(frozen=True)
class Mix:
    """``domain``: SQL expression over documents; ``weights``: one whole-number SQL expression
    for each level over the tree's columns; ``budget``: tokens to take, all there are if None."""

    domain: str
    weights: dict[str, str]
    budget: int | None = None
    max_epochs: int = 4
    seed: int = 17


def token_count(text: Column) -> Column:
    return F.when(text.isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit(WORD))).cast("long")


def _identity() -> Column:
    return F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text")), F.lit(""))


def _key(seed: int, epoch: Column, identity: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), identity))


def _exact(c: Column) -> Column:
    return c.cast("decimal(18,0)")


def deal(nodes: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Add ``budget``: each parent's ``purse`` dealt to its children by ``weight`` up to ``capacity``.

    Children are taken in order of capacity for weight; from the first that the rest of
    the purse cannot fill, the rest is dealt in proportion, in whole tokens that add up.
    """
    order = [F.col("weight") <= 0, F.col("capacity") / F.greatest(F.col("weight"), F.lit(1)), F.col(child)]
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    line = by.orderBy(*order)
    nodes = nodes.withColumn("weight", F.greatest(F.coalesce(F.col("weight").cast("long"), F.lit(0)), F.lit(0)))
    nodes = nodes.withColumn("capacity", F.when(F.col("weight") > 0, F.col("capacity")).otherwise(F.lit(0)))
    before = F.coalesce(F.sum("capacity").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    nodes = nodes.withColumn("rest", F.col("purse") - before)
    nodes = nodes.withColumn("ahead", F.sum("weight").over(line.rowsBetween(0, Window.unboundedFollowing)))
    full = (F.col("weight") <= 0) | (
        _exact(F.col("capacity")) * _exact(F.col("ahead")) <= _exact(F.col("rest")) * _exact(F.col("weight"))
    )
    nodes = nodes.withColumn("open", ~full)
    opened = lambda c: F.max(F.when(F.col("open"), c)).over(by)
    nodes = nodes.withColumn("pool", opened(F.col("rest"))).withColumn("pool_weight", opened(F.col("ahead")))
    upto = F.sum(F.when(F.col("open"), F.col("weight")).otherwise(0)).over(
        line.rowsBetween(Window.unboundedPreceding, 0)
    )
    nodes = nodes.withColumn("upto", upto)
    part = "cast(pool as decimal(18,0)) * cast({0} as decimal(18,0)) div cast(pool_weight as decimal(18,0))"
    dealt = F.expr(part.format("upto")) - F.expr(part.format("(upto - weight)"))
    budget = F.when(F.col("open"), F.least(dealt, F.col("capacity"))).otherwise(F.col("capacity"))
    return nodes.withColumn("budget", budget).drop("rest", "ahead", "open", "pool", "pool_weight", "upto")


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """Leaf table (tree, supply, n_docs) with the ``budget`` of each leaf."""
    takes = F.lit(True)
    for level in TREE:
        takes = takes & (F.coalesce(F.expr(mix.weights[level]).cast("long"), F.lit(0)) > 0)
    leaves = leaves.withColumn("capacity", F.when(takes, F.col("supply") * F.lit(mix.max_epochs)).otherwise(F.lit(0)))
    total = F.sum("supply").over(Window.partitionBy(F.lit(0)))
    roots = leaves.groupBy("domain").agg(F.sum("capacity").alias("capacity"), F.sum("supply").alias("supply"))
    purse = total if mix.budget is None else F.lit(mix.budget).cast("long")
    nodes = deal(roots.withColumn("purse", purse).withColumn("weight", F.expr(mix.weights["domain"])), [], "domain")
    for depth in (2, 3):
        path = TREE[:depth]
        parents = nodes.select(*(F.col(c).alias(f"__mix_{c}") for c in path[:-1]), F.col("budget").alias("purse"))
        below = leaves if depth == 3 else leaves.groupBy(*path).agg(F.sum("capacity").alias("capacity"))
        on = [F.col(c).eqNullSafe(F.col(f"__mix_{c}")) for c in path[:-1]]
        below = below.join(parents, on).drop(*(f"__mix_{c}" for c in path[:-1]))
        nodes = deal(below.withColumn("weight", F.expr(mix.weights[path[-1]])), path[:-1], path[-1])
    return nodes.select(*TREE, "supply", "n_docs", "budget")


def _with_leaf(df: DataFrame, leaf: DataFrame, prefix: str = "__mix_") -> DataFrame:
    """``df`` with the columns of its rows' leaf, the names of which begin with ``prefix`` or are not in ``df``."""
    leaf = leaf.select(*(F.col(c).alias(f"{prefix}{c}") for c in TREE), *(c for c in leaf.columns if c not in TREE))
    on = [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in TREE]
    return df.join(leaf, on).drop(*(f"{prefix}{c}" for c in TREE))


def _ending(sums: DataFrame, place: str) -> DataFrame:
    """(leaf, place, before): where each leaf's cut falls among ``sums`` (leaf, place, tokens, cut, first)."""
    run = Window.partitionBy("leaf").orderBy(place).rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumn("before", F.col("first") + F.sum("tokens").over(run) - F.col("tokens"))
    inside = (F.col("before") < F.col("cut")) & (F.col("cut") <= F.col("before") + F.col("tokens"))
    return sums.filter(inside).select("leaf", place, "before")


def plan_mix(docs: DataFrame, mix: Mix, work: Workspace) -> DataFrame:
    """One row per leaf: tree, supply, budget, whole epochs, and the key and tokens of the
    last document of the epoch that is cut."""
    line = docs.select(
        F.expr(mix.domain).alias("domain"), "lang", "source", token_count(F.col("text")).alias("tokens"), _identity().alias("identity")
    )
    line = work.stage(line, "mix-line")
    leaves = line.groupBy(*TREE).agg(F.sum("tokens").alias("supply"), F.count("*").alias("n_docs"))
    leaf = budgets(work.stage(leaves, "mix-leaves"), mix)
    supply = F.greatest(F.col("supply"), F.lit(1))
    leaf = leaf.withColumn("epochs", F.floor(F.col("budget") / supply)).withColumn(
        "cut", F.col("budget") - F.col("epochs") * F.col("supply")
    )
    leaf = leaf.withColumn("leaf", F.md5(F.to_json(F.struct(*TREE), {"ignoreNullFields": "false"})))
    leaf = work.settle(leaf, "mix-budgets")
    # the bucket of the cut epoch in which the budget ends
    keyed = _with_leaf(line, leaf.filter(F.col("cut") > 0)).withColumn(
        "key", _key(mix.seed, F.col("epochs"), F.col("identity"))
    )
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    buckets = (F.col("n_docs") / F.lit(BUCKET)).cast("long") + 1
    keyed = keyed.select(
        "leaf", "key", "tokens", "cut", F.shiftright((place * buckets).cast("long"), 32).alias("bucket")
    )
    keyed = keyed.withColumn("wide", F.shiftright("bucket", WIDE))
    wides = keyed.groupBy("leaf", "wide").agg(F.sum("tokens").alias("tokens"), F.max("cut").alias("cut"))
    ends = work.settle(_ending(wides.withColumn("first", F.lit(0).cast("long")), "wide"), "mix-wide-ends")
    sums = keyed.join(ends.withColumnRenamed("before", "first"), ["leaf", "wide"]).groupBy("leaf", "bucket")
    sums = sums.agg(F.sum("tokens").alias("tokens"), F.max("cut").alias("cut"), F.max("first").alias("first"))
    ends = work.settle(_ending(sums, "bucket"), "mix-ends")
    near = keyed.join(ends, ["leaf", "bucket"]).groupBy("leaf", "key").agg(
        F.sum("tokens").alias("tokens"), F.max("before").alias("before"), F.max("cut").alias("cut")
    )
    run = Window.partitionBy("leaf").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("start", F.col("before") + F.sum("tokens").over(run) - F.col("tokens"))
    last = near.filter(F.col("start") < F.col("cut")).groupBy("leaf").agg(
        F.max("key").alias("last_key"), F.max(F.col("cut") - F.col("start")).alias("_"),
        F.min(F.col("cut") - F.col("start")).alias("last_taken"),
    ).drop("_")
    leaf = leaf.join(last, "leaf", "left")
    return work.settle(leaf.select(*TREE, "supply", "budget", "epochs", "cut", "last_key", "last_taken"), "mix-plan")


def select_mix(docs: DataFrame, plan: DataFrame, mix: Mix) -> DataFrame:
    """Documents as often as the plan takes them, with domain, epoch, n_tokens and taken:
    the tokens that count towards the budget, fewer than n_tokens for a leaf's last document."""
    own = free_prefix(docs, "__mix_")
    docs = docs.withColumns({"domain": F.expr(mix.domain), "n_tokens": token_count(F.col("text"))})
    asked = ["epochs", "last_key", "last_taken"]
    docs = _with_leaf(docs, plan.select(*TREE, *(F.col(c).alias(f"{own}{c}") for c in asked)), own)
    last, last_key, last_taken = (F.col(f"{own}{c}") for c in asked)
    key = F.col(f"{own}key")
    docs = docs.withColumn(f"{own}key", _key(mix.seed, last, _identity()))
    whole = F.when(last > 0, F.sequence(F.lit(0).cast("long"), last - 1)).otherwise(F.array().cast("array<bigint>"))
    within = F.coalesce(key <= last_key, F.lit(False))
    docs = docs.withColumn("epoch", F.explode(F.when(within, F.concat(whole, F.array(last))).otherwise(whole)))
    ending = (F.col("epoch") == last) & (key == last_key)
    taken = F.when(ending, F.least(F.col("n_tokens"), last_taken)).otherwise(F.col("n_tokens"))
    return docs.withColumn("taken", taken).drop(*(f"{own}{c}" for c in asked), f"{own}key")


def mix_sources(docs: DataFrame, mix: Mix) -> DataFrame:
    """``docs`` (doc_id, text, lang, source, ...) mixed: the rows taken, once for each epoch."""
    plan = plan_mix(docs, mix, workspace(docs.sparkSession))
    return select_mix(docs, plan, mix)
