"""Connected components of a table of links, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Workspace


def components(links: DataFrame, work: Workspace, name: str = "components", rounds: int = 60) -> DataFrame:
    """``links`` (a, b) to (node, root): every linked node with the smallest node it reaches.

    Large-star and small-star steps take turns: each node's larger neighbours, then its
    smaller ones, are tied to the smallest of them, until the links are stars. Every node's
    least neighbour comes from an aggregate with map-side combine and goes back by a join,
    so no node's links meet in one task. Each round is a written table. Null ends and links
    of a node with itself are left out; no links give no rows.
    """
    links = links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    links = work.stage(links, f"{name}-0")
    state = None
    for i in range(1, rounds + 1):
        # large star: larger neighbours of u go to the least of u and its neighbours
        both = links.union(links.select("b", "a"))
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.min("a")).alias("m"))
        large = (
            links.join(least, links.a == least.u).select(F.col("m").alias("a"), "b").filter("a <> b").distinct()
        )
        # small star: u and its smaller neighbours go to the least of them
        lower = large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
        small = large.join(lower, large.b == lower.u)
        links = (
            small.select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).filter("a <> b").distinct()
        )
        links = work.stage(links, f"{name}-{i}")
        now = links.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
        ).first()
        if now == state:
            return links.select(F.col("b").alias("node"), F.col("a").alias("root"))
        state = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
