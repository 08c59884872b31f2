"""Order MinHash fingerprints of texts, sensitive to edit distance.

A text's k-mers (runs of ``K`` code points; a shorter text is one) are numbered by
occurrence, so that repeats count. Each of ``SKETCHES`` hash functions orders the numbered
k-mers; the ``PICK`` least are kept in the order of the text and their tuple is hashed. Two
texts agree in a sketch if they hold the same least k-mers in the same order; the share
of agreeing sketches falls with the edit distance, also for moved passages, which leave
the k-mers as they are.

Documents are compared with their successor in descending order of doc_id. Documents are
cut into ranges of ids; a range also gets a copy of the next range's first document, so
that each range is read in order by itself. An id with the rows of several ranges, or rows without one, are
cut further by the MD5 of the text, and copies of one text there, which are alike, are dealt
anyhow. Nothing runs over all documents, or all rows of an id, in one task.

Defined cases: null and empty texts have the fingerprint of no k-mers; equal texts have
equal fingerprints; documents without doc_id come last, rows of one doc_id in the order of
their texts; a single document is its own successor. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import code_points, ship, text_array

K = 6
SKETCHES = 32
PICK = 2
PIECE = 1 << 19
# Odd multipliers of the hash functions, from one generator.
FACTORS = np.random.default_rng(20_240_607).integers(0, 1 << 63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
HIGH = np.uint64(0xFFFFFFFF00000000)


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads all bits, in place where it can be."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _kmers(points: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` code points; of the whole text if it is shorter."""
    k = min(k, len(points))
    if not k:
        return np.zeros(0, dtype=np.uint64)
    wide = points.astype(np.uint64)
    hashed = wide[: len(wide) - k + 1].copy()
    for i in range(1, k):
        hashed *= np.uint64(0x9E3779B97F4A7C15)
        hashed += wide[i : len(wide) - k + 1 + i]
    return _mix(hashed)


def _numbered(hashed: np.ndarray) -> np.ndarray:
    """Hash of each k-mer with the number of its occurrence in the text.

    Equal k-mers are found by sorting hash and place as one number.
    """
    n = len(hashed)
    if n < 2:
        return _mix(hashed)
    bits = np.uint64(max(1, int(n - 1).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    line = np.sort(hashed & ~low | np.arange(n, dtype=np.uint64))
    same = (line[1:] >> bits) == (line[:-1] >> bits)
    if not same.any():
        return _mix(hashed)
    place = np.arange(n, dtype=np.int64)
    first = np.maximum.accumulate(np.where(np.r_[True, ~same], place, 0))
    number = np.empty(n, dtype=np.uint64)
    number[(line & low).astype(np.int64)] = (place - first).astype(np.uint64)
    return _mix(hashed + number * np.uint64(0xD1B54A32D192ED03))


def sketch(points: np.ndarray, k: int = K) -> np.ndarray:
    """The text's sketches: one 32-bit number each."""
    numbered = _numbered(_kmers(points, k))
    n = len(numbered)
    if not n:
        return np.zeros(SKETCHES, dtype=np.uint32)
    places = np.arange(n, dtype=np.uint64)
    kept = np.empty((SKETCHES, min(PICK, n)), dtype=np.int64)
    buffer = np.empty(min(n, PIECE), dtype=np.uint64)
    for j, factor in enumerate(FACTORS):
        least: list[int] = []
        for at in range(0, n, PIECE):
            line = buffer[: min(PIECE, n - at)]
            np.multiply(numbered[at : at + PIECE], factor, out=line)
            np.bitwise_and(line, HIGH, out=line)
            np.bitwise_or(line, places[at : at + PIECE] if n <= 1 << 32 else places[: len(line)], out=line)
            for _ in range(min(PICK, len(line))):
                where = int(line.argmin())
                least.append(int(line[where]))
                line[where] = np.uint64(0xFFFFFFFFFFFFFFFF)
        least.sort()
        kept[j] = sorted(x & 0xFFFFFFFF for x in least[: kept.shape[1]])
    tuples = np.full(SKETCHES, kept.shape[1], dtype=np.uint64)
    for i in range(kept.shape[1]):
        tuples = _mix(tuples * np.uint64(0x9E3779B97F4A7C15) + numbered[kept[:, i]])
    return (tuples >> np.uint64(32)).astype(np.uint32)


def written(sketches: np.ndarray) -> str:
    return sketches.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def _utf32(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def edit(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the next one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(df: DataFrame, k: int = K) -> DataFrame:
    """All columns and the ``fingerprint`` of the column ``text``."""
    df = df.drop("fingerprint")
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, starts = code_points(text_array(batch.column("text")))
            found = [written(sketch(flat[a:b], k)) for a, b in zip(starts[:-1], starts[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*names, "fingerprint"])

    ship(df.sparkSession)
    schema = df.withColumn("fingerprint", F.lit("")).schema
    return df.mapInArrow(run, schema)


NO_ID = -(1 << 63)  # stands for a missing id, which comes last
TIES = 1 << 20


def _hot_cuts(docs: DataFrame, bounds: list[int], count: int) -> tuple[list[tuple[int, str]], dict[tuple[int, str], int]]:
    """Cuts (id, md5) inside ids with more rows than a range should have, and texts of such an id
    that alone have more, with the number of parts for each."""
    total, missing = docs.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    target = max(1, -(-total // count))
    rows = {b: bounds.count(b) * target for b in set(bounds) if bounds.count(b) > 1}
    if missing > target:
        rows[NO_ID] = missing
    if not rows:
        return [], {}
    known = [i for i in rows if i != NO_ID]
    hot = F.col("doc_id").isin(known) | (F.col("doc_id").isNull() if NO_ID in rows else F.lit(False))
    texts = docs.filter(hot).groupBy("doc_id", F.md5("text").alias("text")).count().filter(F.col("count") > target)
    copied = {(NO_ID if r["doc_id"] is None else r["doc_id"], r["text"]): -(-r["count"] // target) for r in texts.collect()}
    cuts = []
    for i, n in rows.items():
        parts = -(-n // target)
        cuts += [(i, ""), (i, "z"), *((i, f"{(k << 32) // parts:08x}") for k in range(1, parts))]
    for i, text in copied:
        cuts += [(i, text), (i, f"{text}z")]
    return cuts, copied


def _ranges(docs: DataFrame) -> DataFrame:
    """Documents with ``slot`` (ascending along descending doc_id and text) and ``extra``: 1 marks the copy of
    the next slot's first document, which ends a slot."""
    spark = docs.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = docs.filter("doc_id is not null").approxQuantile("doc_id", [i / count for i in range(1, count)], 0.2 / count)
    bounds = [int(b) for b in bounds]  # fewer than there are partitions
    hot, copied = _hot_cuts(docs, bounds, count)
    row = F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.md5("text").alias("text"))
    if hot:  # a few cuts for each partition
        ordered = sorted({*((b, "") for b in bounds), *hot}, reverse=True)
        cuts = F.array(*(F.struct(F.lit(i).cast("long").alias("id"), F.lit(t).alias("text")) for i, t in ordered))
        slot = F.size(F.filter(cuts, lambda c: c > row)).cast("long") * TIES
        for (i, text), parts in copied.items():  # equal rows: any order is theirs
            dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(min(parts, TIES)))
            slot = slot + F.when((row["id"] == i) & (row["text"] == text), dealt).otherwise(F.lit(0))
    elif bounds:
        cuts = F.array(*(F.lit(b).cast("long") for b in sorted(set(bounds), reverse=True)))
        slot = F.when(F.col("doc_id").isNull(), F.lit(count)).otherwise(F.size(F.filter(cuts, lambda c: c > F.col("doc_id"))))
    else:
        slot = F.lit(0)
    docs = docs.withColumn("slot", slot.cast("long"))
    firsts = docs.groupBy("slot").agg(F.max(row).alias("first")).orderBy("slot").collect()  # one row per slot
    if not firsts:
        return docs.withColumn("extra", F.lit(0))
    slots = [r["slot"] for r in firsts]
    before = {s: slots[i - 1] for i, s in enumerate(slots)}  # the first slot's head ends the last slot
    heads = spark.createDataFrame(
        [(r["first"]["id"], r["first"]["text"], before[r["slot"]]) for r in firsts], "head_id long, head_text string, head_slot long"
    )
    known = docs.select("doc_id", "text", row["id"].alias("head_id"), row["text"].alias("head_text"))
    near = known.filter(F.col("head_id").isin(sorted({r["first"]["id"] for r in firsts})))
    near = near.join(F.broadcast(heads.select("head_id", "head_text").distinct()), ["head_id", "head_text"], "left_semi")
    extra = near.dropDuplicates(["head_id", "head_text"]).join(F.broadcast(heads), ["head_id", "head_text"])
    extra = extra.select("doc_id", "text", F.col("head_slot").alias("slot"), F.lit(1).alias("extra"))
    return docs.select("doc_id", "text", "slot", F.lit(0).alias("extra")).union(extra)


def with_successors(docs: DataFrame, k: int = K) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_chars, the edited text's digest, both fingerprints, and
    their likeness to each other and to the next document's."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    line = _ranges(docs)
    line = line.repartitionByRange(count, "slot").sortWithinPartitions(
        "slot", "extra", F.desc_nulls_last("doc_id"), F.desc(F.md5("text"))
    )
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the document whose successor comes next: slot, id, text, sketches
        for batch in batches:
            rows = []
            for slot, extra, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("slot", "extra", "doc_id", "text"))):
                own = sketch(_utf32(text), k)
                if held is not None and held[0] == slot:
                    edited = edit(held[2], text)
                    edited_sketch = held[3] if edited == held[2] else sketch(_utf32(edited), k)
                    rows.append((
                        held[1], len(held[2]), hashlib.sha256(edited.encode()).hexdigest(), written(held[3]),
                        written(edited_sketch), likeness(held[3], edited_sketch), likeness(held[3], own),
                    ))
                held = None if extra else (slot, doc_id, text, own)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) if i else pa.array(c, pa.int64()) for i, c in enumerate(zip(*rows))], names)

    ship(docs.sparkSession)
    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return line.mapInArrow(run, schema)
