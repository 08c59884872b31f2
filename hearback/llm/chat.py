"""Chat formatting: collapse cumulative snapshots, then render what is left.

Logs that write a conversation again after every turn hold each conversation many times,
as prefixes of the longest one. Every row gets a hash of all turns up to it (the prefix);
a conversation whose last prefix is an inner prefix of another one is a snapshot and goes.
Of equal conversations the one with the least conv_id stays.

The prefix hash is the exclusive or of two 64-bit hashes of (place, role, text), so that
it can be summed up in parts: rows are dealt in order of (conv_id, turn) to partitions of even
size, each part of a conversation is scanned by itself, and the parts' sums are added by a
join. No conversation has to fit one task. Only hashes move; texts move once, to be rendered.

Rendering writes each turn as start mark, role, new line, text, end mark, and joins
up to ``PART`` turns to one row, so that a row stays bounded: longer conversations have several
parts, to be read in order.

Defined cases: rows that repeat conv_id, turn, role and text are one row; turns are
ordered by turn (nulls first), different rows of one turn by their hashes; rows with null
conv_id are one conversation; null roles are ``unknown``, null texts empty (a null
and an empty text differ in the comparison). Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Workspace
from .common import workspace

PART = 256
# Marks around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


def _hash(seed: int, *columns: Column) -> Column:
    """64-bit hash in which nulls count."""
    each = [c for column in columns for c in (column.isNull(), column)]
    return F.xxhash64(F.lit(seed), *each)


def ordered_turns(turns: DataFrame, work: Workspace) -> DataFrame:
    """(conv_id, pos, t1, t2, p1, p2): place of each distinct row in its conversation, hashes of the
    row and of the conversation up to it."""
    rows = turns.select(
        "conv_id", "turn", _hash(1, F.col("role"), F.col("text")).alias("t1"), _hash(2, F.col("role"), F.col("text")).alias("t2")
    ).distinct()
    rows = rows.repartitionByRange("conv_id", "turn", "t1", "t2").withColumn("chunk", F.spark_partition_id())
    rows = work.stage(rows, "chat-turns")
    within = Window.partitionBy("conv_id", "chunk").orderBy("turn", "t1", "t2")
    rows = rows.withColumn("own", F.row_number().over(within).cast("long"))
    sizes = rows.groupBy("conv_id", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("conv_id", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))
    rows = _with_chunk(rows, sizes).withColumn("pos", F.col("own") + F.col("ahead"))
    for k in ("1", "2"):
        term = F.xxhash64(F.lit(int(k) + 2), "pos", f"t{k}")
        rows = rows.withColumn(f"x{k}", term).withColumn(f"p{k}", F.bit_xor(term).over(within))
    rows = work.stage(rows.select("conv_id", "chunk", "turn", "pos", "t1", "t2", "x1", "x2", "p1", "p2"), "chat-prefixes")
    sums = rows.groupBy("conv_id", "chunk").agg(F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2"))
    none = F.lit(0).cast("long")
    sums = sums.select(
        "conv_id", "chunk", *(F.coalesce(F.bit_xor(f"s{k}").over(before), none).alias(f"b{k}") for k in (1, 2))
    )
    rows = _with_chunk(rows, sums)
    return rows.select(
        "conv_id", "turn", "pos", "t1", "t2", *(F.col(f"p{k}").bitwiseXOR(F.col(f"b{k}")).alias(f"p{k}") for k in (1, 2))
    )


def _with_chunk(rows: DataFrame, chunks: DataFrame) -> DataFrame:
    chunks = chunks.withColumnsRenamed({"conv_id": "c_conv", "chunk": "c_chunk"})
    on = F.col("conv_id").eqNullSafe(F.col("c_conv")) & (F.col("chunk") == F.col("c_chunk"))
    return rows.join(chunks, on).drop("c_conv", "c_chunk")


def maximal(turns: DataFrame, work: Workspace) -> DataFrame:
    """(conv_id, turn, pos, t1, t2, n_turns) of the rows of the conversations that are no snapshot of another."""
    rows = work.stage(ordered_turns(turns, work), "chat-ordered")
    ends = rows.groupBy("conv_id").agg(F.max_by(F.struct("pos", "p1", "p2"), "pos").alias("end"))
    ends = work.stage(ends.select("conv_id", "end.*"), "chat-ends").withColumnsRenamed({"pos": "n_turns", "p1": "e1", "p2": "e2"})
    same = ends.groupBy("n_turns", "e1", "e2").agg(F.min("conv_id").alias("keep_id"))
    # inner prefixes: every prefix but the conversation's own end, each once
    last = ends.select(F.col("conv_id").alias("l_conv"), F.col("n_turns").alias("l_n"))
    inner = rows.join(last, F.col("conv_id").eqNullSafe(F.col("l_conv")) & (F.col("pos") < F.col("l_n")))
    inner = inner.select("pos", "p1", "p2").distinct()
    on = (F.col("n_turns") == F.col("pos")) & (F.col("e1") == F.col("p1")) & (F.col("e2") == F.col("p2"))
    kept = same.join(inner, on, "left_anti").select(F.col("keep_id").alias("k_conv"), "n_turns")
    return rows.join(kept, F.col("conv_id").eqNullSafe(F.col("k_conv"))).select("conv_id", "turn", "pos", "t1", "t2", "n_turns")


def render(turns: DataFrame, part: int = PART, work: Workspace | None = None) -> DataFrame:
    """(conv_id, part, n_turns, text): the maximal conversations of ``turns`` (conv_id, turn, role, text),
    ``part`` from 0, ``n_turns`` those of the whole conversation."""
    work = work or workspace(turns.sparkSession)
    kept = maximal(turns, work)
    kept = kept.withColumnsRenamed({"conv_id": "k_conv", "turn": "k_turn"})
    texts = turns.select(
        "conv_id", "turn", "role", "text",
        _hash(1, F.col("role"), F.col("text")).alias("h1"), _hash(2, F.col("role"), F.col("text")).alias("h2"),
    )
    on = (
        F.col("conv_id").eqNullSafe(F.col("k_conv")) & F.col("turn").eqNullSafe(F.col("k_turn"))
        & (F.col("h1") == F.col("t1")) & (F.col("h2") == F.col("t2"))
    )
    line = F.concat(
        F.lit(OPEN), F.coalesce("role", F.lit("unknown")), F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(CLOSE)
    )
    rows = texts.join(kept, on).select(
        "conv_id", F.floor((F.col("pos") - 1) / part).cast("int").alias("part"), "n_turns", "pos", line.alias("line")
    )
    # repeated rows have one place, so a part holds at most ``part`` different lines
    lines = F.array_sort(F.collect_set(F.struct("pos", "line")))
    joined = F.array_join(F.transform(lines, lambda x: x["line"]), "")
    return rows.groupBy("conv_id", "part").agg(F.max("n_turns").alias("n_turns"), joined.alias("text"))
