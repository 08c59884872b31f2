"""Language identification with bit-sliced Bloom filters of character n-grams.

Learning counts the n-grams of every labelled text (in tasks, then summed by Spark). A
language's filter holds the n-grams that are typical of it: seen at least ``LEAST`` times and with at
least ``SHARE`` of the highest relative frequency in any language, so that a foreign passage in
a large corpus does not fill a filter. The filters of all languages lie on one another: a cell of
the table has one bit for each language, and the AND of an n-gram's ``PROBES`` cells is the set of all languages
that contain it, found in one look-up whatever their number.

A text's n-grams are looked up and counted per language. A filter with a share f of false
answers adds about f of the n-grams the language does not contain, so a count h of n becomes
(h - f n) / (1 - f). The language of the highest corrected count wins, ties go to the one
seen more often in learning, then by name; the score is its share of all corrected counts.

The table's cells are a power of two from the number of n-grams and take the bytes that the number of
languages needs, at most ``FILTER_BYTES`` in all, so that what a task holds is bounded. A language
with more typical n-grams than such a table holds well keeps its most frequent ones: as many as fill
half of its slice, so that no language is lost in false answers. Every text and n-gram is
counted; which are held is found from the numbers of n-grams by their logarithmic frequency, and
inside the last such level by their hash. Tasks make pages of the table, which the driver joins.

Defined cases: texts that are null or without letters are ``und`` with score 0, as are all
texts if nothing was learned; a text with no known n-gram gets the most frequent language and
score 0; null languages and null texts are not learned from; repeated rows are learned
as often as they occur. Columns of the input named like an output column are replaced by it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import code_points, gather_runs, map_arrow, ship, sliced, sum_runs, text_array

N = 4
LEAST = 3
SHARE = 0.1
PROBES = 3
FILTER_BYTES = 64 << 20
PAGE = 1 << 16
LIMIT = 6 << 20
UNKNOWN = "und"


def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def ngrams(texts: pa.Array, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of all lower-cased texts, and where each text's begin. Characters other than
    letters are one gap; a text begins and ends with one. Texts without letters have none."""
    lowered = pa.array([t.lower() for t in texts.to_pylist()], pa.large_string())
    flat, starts = code_points(lowered)
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    is_letter = letters[flat]
    codes = np.where(is_letter, flat, 0).astype(np.uint64)
    # keep letters and the first character of each gap; each text gets one gap before and one after
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1] & (owner[1:] == owner[:-1])
    codes, owner = codes[keep], owner[keep]
    last = np.r_[owner[1:] != owner[:-1], True] if len(owner) else np.zeros(0, dtype=bool)
    inner = ~(last & (codes == 0))  # a gap at a text's end is its end
    codes, owner = codes[inner], owner[inner]
    sizes = np.bincount(owner, minlength=len(texts)) if len(owner) else np.zeros(len(texts), dtype=np.int64)
    sizes = np.where(sizes > 0, sizes + 2, 0)
    begins = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    line = np.zeros(int(begins[-1]), dtype=np.uint64)
    line[gather_runs(begins[:-1] + 1, np.maximum(sizes - 2, 0))] = codes
    counts = np.maximum(sizes - N + 1, np.where(sizes > 0, 1, 0))
    hashed = line.copy()
    for i in range(1, N):
        hashed *= np.uint64(0x9E3779B97F4A7C15)
        hashed[:-i] += line[i:]
    hashed ^= hashed >> np.uint64(32)
    hashed *= np.uint64(0xD6E8FEB86659FD93)
    hashed ^= hashed >> np.uint64(29)
    # an n-gram begins at every place of a text but its last N - 1
    wanted = np.ones(len(line), dtype=bool)
    tail = sizes - counts
    ends = begins[1:]
    for i in range(1, N):
        wanted[ends[tail >= i] - i] = False
    first = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    return hashed[wanted], first


def probes(hashed: np.ndarray, cells: int) -> Iterator[np.ndarray]:
    """The cells of n-grams, one array for each probe."""
    low, high = hashed & np.uint64(0xFFFFFFFF), hashed >> np.uint64(32) | np.uint64(1)
    for i in range(PROBES):
        yield ((low + np.uint64(i) * high) & np.uint64(cells - 1)).astype(np.int64)


@dataclass
class Filters:
    """Filters of all languages; ``words`` has a row of masks for each cell, narrow ones where languages are few."""

    languages: list[str]
    words: np.ndarray
    false_share: np.ndarray


def learn(labelled: DataFrame) -> Filters | None:
    """Filters from the columns ``text`` and ``lang``; None if there is nothing to learn from."""
    spark = labelled.sparkSession
    labelled = labelled.filter("text is not null and lang is not null").select("text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        for batch in sliced(batches, "text", LIMIT):
            langs = batch.column("lang").dictionary_encode()
            hashed, first = ngrams(text_array(batch.column("text")), letters)
            which = np.repeat(langs.indices.to_numpy(zero_copy_only=False), np.diff(first))
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                grams, n = np.unique(hashed[which == i], return_counts=True)
                columns = [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])

    ship(spark)
    counts = labelled.mapInArrow(count, "lang string, gram bigint, n bigint")
    counts = counts.groupBy("gram", "lang").agg(F.sum("n").alias("n"))
    totals = labelled.groupBy("lang").count().select("lang", "count")
    sums = counts.groupBy("lang").agg(F.sum("n").alias("total")).join(totals, "lang", "right")
    seen = sums.orderBy(F.desc("count"), "lang").collect()  # one row per language
    if not seen:
        return None
    languages = [r["lang"] for r in seen]
    table = spark.createDataFrame([(r["lang"], i, float(r["total"] or 1)) for i, r in enumerate(seen)], "lang string, no int, total double")
    counts = counts.join(F.broadcast(table), "lang").withColumn("share", F.col("n") / F.col("total"))
    typical = counts.withColumn("most", F.max("share").over(Window.partitionBy("gram")))
    typical = typical.filter((F.col("n") >= LEAST) & (F.col("share") >= SHARE * F.col("most")))
    typical = typical.select("gram", "no", F.floor(F.log2("n") * 16).cast("int").alias("level")).cache()
    levels = typical.groupBy("no", "level").count().collect()  # at most a thousand levels for each language
    sizes: dict[int, dict[int, int]] = {}
    for r in levels:
        sizes.setdefault(r["no"], {})[r["level"]] = r["count"]
    held = max((sum(of.values()) for of in sizes.values()), default=1)
    kind, width = mask_type(len(languages))
    room = 1 << max(0, (FILTER_BYTES // (kind.itemsize * width)).bit_length() - 1)
    cells = min(room, 1 << max(16, int(held * 8 - 1).bit_length()))
    bits = kind.itemsize * 8
    limits = {no: kept_levels(of, int(cells * math.log(2) / PROBES)) for no, of in sizes.items()}
    if any(level is not None for level, _ in limits.values()):
        rows = [(no, level, share) for no, (level, share) in limits.items() if level is not None]
        bound = F.broadcast(spark.createDataFrame(rows, "no int, least int, part double"))  # one row per language
        inside = F.pmod(F.xxhash64("gram"), F.lit(1 << 20)) < F.col("part") * (1 << 20)
        kept = F.col("least").isNull() | (F.col("level") > F.col("least")) | ((F.col("level") == F.col("least")) & inside)
        chosen = typical.join(bound, "no", "left").filter(kept).select("gram", "no")
    else:
        chosen = typical.select("gram", "no")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            no = batch.column("no").to_numpy().astype(np.int64)
            hashed = batch.column("gram").to_numpy().view(np.uint64)
            for at in probes(hashed, cells):
                mask = np.left_shift(np.uint64(1), (no % bits).astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at * width + no // bits), pa.array(mask)], ["at", "mask"])

    page = min(PAGE, cells)

    def paged(table: pa.Table) -> pa.Table:
        at = table.column("at").to_numpy()
        words = np.zeros(page, dtype=kind)
        words[at % page] = table.column("mask").to_numpy().view(np.uint64).astype(kind)
        return pa.table({"page": pa.array([int(at[0]) // page]), "words": pa.array([words.tobytes()], pa.binary())})

    placed = chosen.mapInArrow(place, "at bigint, mask bigint").groupBy("at").agg(F.bit_or("mask").alias("mask"))
    pages = placed.groupBy(F.floor(F.col("at") / page).alias("page")).applyInArrow(paged, "page bigint, words binary")
    words = np.zeros(cells * width, dtype=kind)
    for r in pages.toLocalIterator():  # ``FILTER_BYTES`` in all
        words[r["page"] * page : (r["page"] + 1) * page] = np.frombuffer(r["words"], dtype=kind)
    typical.unpersist()
    words = words.reshape(cells, width)
    fill = np.array([_share_set(words[:, i // bits], i % bits) for i in range(len(languages))])
    return Filters(languages, words, fill**PROBES)


def _share_set(column: np.ndarray, bit: int) -> float:
    """Share of the cells that have the bit, counted in pieces."""
    one = column.dtype.type(1 << bit)
    return sum(int(np.count_nonzero(column[i : i + (1 << 20)] & one)) for i in range(0, len(column), 1 << 20)) / len(column)


def mask_type(languages: int) -> tuple[np.dtype, int]:
    """The narrowest numbers that have a bit for each language, and how many a cell needs."""
    for kind in (np.uint8, np.uint16, np.uint32):
        if languages <= np.dtype(kind).itemsize * 8:
            return np.dtype(kind), 1
    return np.dtype(np.uint64), -(-languages // 64)


def kept_levels(sizes: dict[int, int], most: int) -> tuple[int | None, float]:
    """The lowest level of n-grams to hold, of which a share is held, so that about ``most`` are; None to hold all."""
    if sum(sizes.values()) <= most:
        return None, 1.0
    for level in sorted(sizes, reverse=True):
        if sizes[level] >= most:
            return level, most / sizes[level]
        most -= sizes[level]
    raise AssertionError("all levels fit")


def classify(filters: Filters, texts: pa.Array, letters: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    hashed, first = ngrams(texts, letters)
    masks = None
    for at in probes(hashed, len(filters.words)):
        masks = filters.words[at] if masks is None else masks & filters.words[at]
    wide = filters.words.dtype.itemsize * 8
    n = np.diff(first).astype(np.float64)
    corrected = np.zeros((len(filters.languages), len(n)))
    for i, false in enumerate(filters.false_share):
        bits = (masks[:, i // wide] >> masks.dtype.type(i % wide)).astype(np.uint8) & np.uint8(1)
        hits = sum_runs(bits, first)
        corrected[i] = np.maximum(hits - false * n, 0.0) / max(1.0 - false, 1e-9)
    best = corrected.argmax(0)
    total = corrected.sum(0)
    score = np.divide(corrected.max(0), total, out=np.zeros(len(n)), where=total > 0)
    names = [filters.languages[i] if k else UNKNOWN for i, k in zip(best, n)]
    return names, np.clip(score, 0.0, 1.0)


def predict(df: DataFrame, filters: Filters | None) -> DataFrame:
    """All columns, ``lang_pred`` and ``score`` of the column ``text``."""
    df = df.drop("lang_pred", "score")
    if filters is None:
        return df.withColumn("lang_pred", F.lit(UNKNOWN)).withColumn("score", F.lit(0.0))
    schema = StructType([*df.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    sent = df.sparkSession.sparkContext.broadcast(filters)

    def make():
        letters = _letters()

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            names, score = classify(sent.value, text_array(batch.column("text")), letters)
            return pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(score)], schema.names)

        return work

    return map_arrow(df, make, schema, limit=LIMIT)
