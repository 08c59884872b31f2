"""Merkle manifest of a table of documents: leaf coordinates by bitmap rank, levels by slot arrays.

1. Leaves: SHA-256 of every row's fields, each as its length in bytes, a colon and the value.
2. Coordinates: a group's ids are bits of bitmaps, one for each run of 2^15 ids that holds any
   (the files they are written to compress them); ids that stand on several rows are listed
   beside the bits. A directory holds the rows before each bitmap: sums over runs of
   2^10 bitmaps, then inside a run. A leaf's place is the directory's number and the bits set below
   its own; no leaves are sorted. Rows of one id, and those without id, which come
   first, lie by leaf digest: first by the rows of smaller digest beginnings, then inside one.
3. Levels: blocks of ``arity`` ^ ``span`` places are slot arrays, keyed by group and block, that a
   task fills and reduces by ``span`` levels at once, so a group of n leaves takes
   log n / (span * log arity) shuffles. The groups' roots are reduced in the same way.
4. Proofs go down again: a block's way to the root is computed once and meets the
   block's leaves in one stream, where each leaf's own siblings are put before it.

Defined cases: nulls are ``-``; a null lang is a group of its own before all others; equal rows are
leaves next to one another; an empty table gives no rows; a text of any length is hashed as a whole in
the JVM. Only the five columns are read, so others cannot clash. Every group's own tree
grows until one node is left, so a last run of one node is hashed again, as long as its group has others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Workspace
from .common import ship, workspace

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUN = 15  # bits of an id inside a bitmap
DIRECTORY = 10  # bits of a bitmap's number inside a run of the directory
COPIES = 10_000  # equal rows that are dealt out together

NODE = "grp string, idx bigint, total bigint, digest string"
WAY = "grp string, idx bigint, lefts array<string>, rights array<string>"


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value: Column) -> Column:
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(**replaced: Column) -> Column:
    """SHA-256 of a row's fields, some of them replaced."""
    return F.sha2(F.concat(*(field(replaced.get(name, F.col(name))) for name in FIELDS)), 256)


def leaves(docs: DataFrame, altered: Column) -> DataFrame:
    """(grp, doc_id, leaf, altered): every row's leaf and, where the row is ``altered``, its leaf with n_chars one higher."""
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    grp = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))  # null before all others
    return docs.select(
        grp.alias("grp"), F.col("doc_id").cast("long").alias("doc_id"), leaf().alias("leaf"),
        F.when(altered, leaf(n_chars=more)).alias("altered"),
    )


def directory(ids: DataFrame, nulls: DataFrame, work: Workspace) -> DataFrame:
    """(grp, run, start, bits, more) of ``ids`` (grp, doc_id, m): bitmaps of each run's ids, the rows before the
    run, and the ids of several rows with the number of further ones."""
    at = F.col("doc_id").bitwiseAND(F.lit((1 << RUN) - 1))
    bitmaps = (
        ids.select("grp", F.shiftright("doc_id", RUN).alias("run"), at.alias("at"), "m")
        .repartition("grp", "run")
        .groupBy("grp", "run")
        .agg(
            F.bitmap_construct_agg("at").alias("bits"),
            F.sum("m").alias("rows"),
            F.collect_list(F.when(F.col("m") > 1, F.struct("at", (F.col("m") - 1).alias("n")))).alias("more"),
        )
    )
    bitmaps = work.stage(bitmaps, "merkle-bitmaps")
    wide = F.shiftright("run", DIRECTORY).alias("wide")
    inside = Window.partitionBy("grp", "wide").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    among = Window.partitionBy("grp").orderBy("wide").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda window: F.coalesce(F.sum("rows").over(window), F.lit(0))
    runs = bitmaps.select("grp", "run", wide, "rows")
    wides = runs.groupBy("grp", "wide").agg(F.sum("rows").alias("rows")).select("grp", "wide", before(among).alias("first"))
    starts = runs.select("grp", "run", "wide", before(inside).alias("own")).join(work.settle(wides, "merkle-wides"), ["grp", "wide"])
    starts = starts.join(nulls, "grp", "left").select("grp", "run", (F.col("first") + F.col("own") + F.coalesce("nulls", F.lit(0))).alias("start"))
    return bitmaps.join(work.settle(starts, "merkle-starts"), ["grp", "run"]).select("grp", "run", "start", "bits", "more")


def rank(found: DataFrame, tables: DataFrame) -> DataFrame:
    """``found`` (with grp, doc_id) and ``place``: rows of the group before the id's first."""
    at = F.col("doc_id").bitwiseAND(F.lit((1 << RUN) - 1)).cast("int")
    byte = F.floor(at / 8).cast("int")
    own = F.conv(F.hex(F.substring("bits", byte + 1, F.lit(1))), 16, 10).cast("int")
    below = F.bit_count(own.bitwiseAND(F.expr("shiftleft(1, cast(doc_id & 7 as int)) - 1")))
    more = F.aggregate(F.filter("more", lambda x: x["at"] < at), F.lit(0).cast("long"), lambda s, x: s + x["n"])
    place = F.col("start") + F.bitmap_count(F.substring("bits", F.lit(1), byte)) + below + more
    joined = found.withColumn("run", F.shiftright("doc_id", RUN)).join(tables, ["grp", "run"])
    return joined.select(*found.columns, place.cast("long").alias("place"))


def coordinates(rows: DataFrame, work: Workspace) -> DataFrame:
    """(grp, idx, doc_id, leaf, altered) of every row of ``rows`` (grp, doc_id, leaf, altered)."""
    ids = work.stage(rows.groupBy("grp", "doc_id").agg(F.count("*").alias("m")), "merkle-ids")
    nulls = work.settle(ids.filter("doc_id is null").select("grp", F.col("m").alias("nulls")), "merkle-nulls")
    named = ids.filter("doc_id is not null")
    tables = work.stage(directory(named, nulls, work), "merkle-directory")
    several = rank(named.filter("m > 1").select("grp", "doc_id"), tables)
    several = several.union(ids.filter("doc_id is null").select("grp", "doc_id", F.lit(0).cast("long")))
    several = work.settle(several.withColumnsRenamed({"grp": "g", "doc_id": "i"}), "merkle-several")
    same = F.col("grp").eqNullSafe(F.col("g")) & F.col("doc_id").eqNullSafe(F.col("i"))
    alone = rank(rows.join(several, same, "left_anti"), tables)
    # rows of one id: distinct leaves with their copies, placed by digest
    counted = rows.join(several, same).groupBy("grp", "doc_id", "leaf", "altered", "place").agg(F.count("*").alias("n"))
    counted = work.stage(counted.withColumn("front", F.substring("leaf", 1, 4)), "merkle-counted")
    fronts = counted.groupBy("grp", "doc_id", "front").agg(F.sum("n").alias("n"))
    by_front = Window.partitionBy("grp", "doc_id").orderBy("front").rowsBetween(Window.unboundedPreceding, -1)
    by_leaf = Window.partitionBy("grp", "doc_id", "front").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)
    fronts = fronts.select("grp", "doc_id", "front", F.coalesce(F.sum("n").over(by_front), F.lit(0)).alias("before"))
    fronts = work.settle(fronts.withColumnsRenamed({"grp": "g", "doc_id": "i", "front": "f"}), "merkle-fronts")
    inner = counted.withColumn("within", F.coalesce(F.sum("n").over(by_leaf), F.lit(0)))
    inner = inner.join(fronts, same & (F.col("front") == F.col("f")))
    first = (F.col("place") + F.col("before") + F.col("within")).alias("first")
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES).cast("long"))).alias("part")
    parts = inner.select("grp", "doc_id", "leaf", "altered", first, "n", part).repartition("grp", "leaf", "part")
    copy = F.sequence(F.col("part") * COPIES, F.least((F.col("part") + 1) * COPIES, F.col("n")) - 1)
    copies = parts.select("grp", "doc_id", "leaf", "altered", "first", F.explode(copy).alias("copy"))
    copies = copies.select("grp", (F.col("first") + F.col("copy")).alias("idx"), "doc_id", "leaf", "altered")
    return alone.select("grp", F.col("place").alias("idx"), "doc_id", "leaf", "altered").union(copies)


class Shape:
    """Blocks of ``arity`` ^ ``span`` places."""

    def __init__(self, arity: int, span: int):
        if arity < 2 or span < 1:
            raise ValueError("a tree takes an arity of 2 and a span of 1 at least")
        self.arity, self.span, self.size = arity, span, arity**span

    def levels(self, slots: list[str], total: int) -> list[list[str]]:
        """The block's nodes level by level; fewer than ``span`` steps only in a group of one block."""
        found, steps = [slots], 0
        while len(found[-1]) > 1 if total <= self.size else steps < self.span:
            now = found[-1]
            found.append([digest(*now[i : i + self.arity]) for i in range(0, len(now), self.arity)])
            steps += 1
        return found

    def way(self, levels: list[list[str]], slot: int) -> tuple[list[str], list[str]]:
        """Siblings before and after a slot's node on each level, as one text each."""
        lefts, rights = [], []
        for now in levels[:-1]:
            run = slot - slot % self.arity
            lefts.append("".join(now[run:slot]))
            rights.append("".join(now[slot + 1 : run + self.arity]))
            slot //= self.arity
        return lefts, rights


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[str, int, int, list, list[dict]]]:
    """(grp, block, total, upper way, rows by slot) of rows that come block by block, the way before the nodes."""
    key, way, rows = None, None, []
    for batch in batches:
        for row in batch.to_pylist():
            own = (row["grp"], row["block"])
            if own != key:
                if rows:
                    yield *key, rows[0]["total"], way, _slots(rows, key[1], size)
                key, way, rows = own, None, []
            if row["kind"]:
                rows.append(row)
            else:
                way = (row["lefts"], row["rights"])
    if rows:
        yield *key, rows[0]["total"], way, _slots(rows, key[1], size)


def _slots(rows: list[dict], block: int, size: int) -> list[dict]:
    slots: list = [None] * min(size, rows[0]["total"] - block * size)
    for row in rows:
        slots[row["idx"] - block * size] = row
    return slots


def _keyed(nodes: DataFrame, ways: DataFrame | None, size: int) -> DataFrame:
    """Nodes, each block's after its way, block by block."""
    block = F.floor(F.col("idx") / size).alias("block")
    rows = nodes.select("*", block, F.lit(1).alias("kind"))
    if ways is not None:
        ways = ways.select("grp", F.col("idx").alias("block"), F.lit(0).alias("kind"), "lefts", "rights")
        rows = rows.unionByName(ways, allowMissingColumns=True)
    return rows.repartition("grp", "block").sortWithinPartitions("grp", "block", "kind")


def climb(nodes: DataFrame, shape: Shape, work: Workspace, name: str) -> list[DataFrame]:
    """Tables of nodes (grp, idx, total, digest), level after level, until each group has one node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for grp, block, total, _, slots in _blocks(batches, shape.size):
            top = shape.levels([row["digest"] for row in slots], total)[-1][0]
            made = [{"grp": grp, "idx": block, "total": -(-total // shape.size), "digest": top}]
            yield pa.RecordBatch.from_pylist(made, pa.schema([("grp", pa.string()), ("idx", pa.int64()), ("total", pa.int64()), ("digest", pa.string())]))

    ship(nodes.sparkSession)
    tables = [nodes]
    while True:
        keyed = _keyed(tables[-1].select("grp", "idx", "total", "digest"), None, shape.size)
        tables.append(work.stage(keyed.mapInArrow(run, NODE), f"{name}-{len(tables)}"))
        if (tables[-1].agg(F.max("total")).first()[0] or 1) == 1:
            return tables


def descend(tables: list[DataFrame | None], ways: DataFrame, shape: Shape, work: Workspace, name: str) -> DataFrame:
    """Ways of the nodes of ``tables[1]``, which are the blocks of ``tables[0]``, from those of the last table's nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema([("grp", pa.string()), ("idx", pa.int64()), ("lefts", pa.list_(pa.string())), ("rights", pa.list_(pa.string()))])
        for grp, block, total, upper, slots in _blocks(batches, shape.size):
            levels = shape.levels([row["digest"] for row in slots], total)
            made = []
            for slot in range(len(slots)):
                lefts, rights = shape.way(levels, slot)
                made.append({"grp": grp, "idx": block * shape.size + slot, "lefts": lefts + upper[0], "rights": rights + upper[1]})
            yield pa.RecordBatch.from_pylist(made, kind)

    for i in range(len(tables) - 2, 0, -1):
        keyed = _keyed(tables[i].select("grp", "idx", "total", "digest"), ways, shape.size)
        ways = work.stage(keyed.mapInArrow(run, WAY), f"{name}-way-{i}")
    return ways


def manifest(docs: DataFrame, altered: Column | None = None, arity: int = 2, span: int = 10, work: Workspace | None = None) -> DataFrame:
    """(doc_id, grp, idx, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of ``docs``.

    ``grp`` is ``=`` and the lang, or empty for none. ``proof_sha256`` digests the siblings from the leaf
    to the root; ``folded_root`` is the root these give for the row as it is where ``altered`` holds
    (n_chars one higher), and ``verified`` tells whether that is the root.
    """
    work = work or workspace(docs.sparkSession)
    shape = Shape(arity, span)
    rows = work.stage(leaves(docs, F.lit(False) if altered is None else altered), "merkle-leaves")
    totals = work.settle(rows.groupBy("grp").agg(F.count("*").alias("total")), "merkle-totals")
    nodes = coordinates(rows, work).withColumnRenamed("leaf", "digest").join(totals, "grp")
    nodes = work.stage(nodes.select("grp", "idx", "total", "digest", "doc_id", "altered"), "merkle-nodes")
    tables = climb(nodes, shape, work, "merkle-level")
    # the groups' roots, of which there are as many as langs, are the leaves of the last tree
    ordered = tables[-1].select("grp", "digest", (F.row_number().over(Window.orderBy("grp")) - 1).cast("long").alias("idx"))
    ordered = work.stage(ordered, "merkle-groups")
    n_groups = ordered.count()
    last = climb(ordered.select(F.lit("").alias("grp"), "idx", F.lit(n_groups).cast("long").alias("total"), "digest"), shape, work, "merkle-top")
    top = last[-1].first()
    root = top["digest"] if top else ""
    none = F.array().cast("array<string>")
    start = last[-1].select("grp", "idx", none.alias("lefts"), none.alias("rights"))
    group_ways = descend([None, *last], start, shape, work, "merkle-top")
    group_ways = ordered.select("grp", "idx", F.col("digest").alias("subroot")).join(group_ways.drop("grp"), "idx").drop("idx")
    group_ways = work.settle(group_ways, "merkle-group-ways")
    start = tables[-1].select("grp", "idx").join(group_ways, "grp").select("grp", "idx", "lefts", "rights")
    ways = descend(tables, start, shape, work, "merkle-level")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "grp", "idx", "leaf", "proof_sha256", "folded_root"]
        kind = pa.schema([(n, pa.int64() if n in ("doc_id", "idx") else pa.string()) for n in names])
        for grp, block, total, upper, slots in _blocks(batches, shape.size):
            levels = shape.levels([row["digest"] for row in slots], total)
            rest = "".join(a + b for a, b in zip(*upper))
            made = []
            for slot, row in enumerate(slots):
                lefts, rights = shape.way(levels, slot)
                proof = digest(*(a + b for a, b in zip(lefts, rights)), rest)
                folded = row["altered"] or row["digest"]
                for a, b in [*zip(lefts, rights), *zip(*upper)]:
                    folded = digest(a, folded, b)
                made.append((row["doc_id"], grp, row["idx"], row["digest"], proof, folded))
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*made), kind)], names)

    found = _keyed(nodes, ways, shape.size).mapInArrow(
        run, "doc_id bigint, grp string, idx bigint, leaf string, proof_sha256 string, folded_root string"
    )
    subroots = work.settle(ordered.select("grp", F.col("digest").alias("subroot")), "merkle-subroots")
    return found.join(subroots, "grp").select(
        "doc_id", "grp", "idx", "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == F.lit(root)).alias("verified"),
    )
