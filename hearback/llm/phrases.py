"""Phrase collocations by marginalising the longest windows.

1. Every word of a piece leads a window: itself and the ``width`` - 1 words after it, as lead
   columns of the piece, padded where the piece ends. Only these longest windows are counted,
   in tasks slice by slice and then by Spark.
2. Spark's ROLLUP over the window's columns sums the windows of every shorter prefix, so one count
   gives those of all lengths, and its highest level the number of words. No n-grams of other lengths
   are listed.
3. A candidate's count and those of its cuts' parts come from that table by equi joins; hot keys
   of these are spread. Longer candidates give their inner phrases, of which each phrase takes the highest count.

What cannot reach ``least`` is not carried: a phrase that holds a pair of neighbours below
``least`` is below it as well. Pairs are counted first, as 64-bit hashes; those that reach
``least`` set a bit of a filter of at most ``FILTER_BITS`` bits, and a window is padded from its first
pair that is not in the filter. Hashes that meet and a full filter only let further windows
through; what is counted stays exact. The filter is sized from the number of such pairs.

Counts are exact whole numbers, and products of them are taken as decimals of 38 digits.

Defined cases: a null text has no words, a null lang is ``und`` and counted with rows of that lang; texts of any
length are read as a whole; ties of a score go to the higher count, then to the smaller phrase in
UTF-8 order; repeated rows count as often as they stand; an empty table gives no rows. Only text and
lang are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import hottest, spread_join
from ..session import Workspace
from .common import rare_collections, ship, sliced, strings_of, text_array, workspace

FILTER_BITS = 1 << 28
SLICE = 8 << 20
HOT_ROWS = 200_000
PAD = ""  # no word is empty
# What ends a piece, and what parts words inside one.
ENDS = r"[.,;:!?\x0A-\x0D]"
GAPS = "\t"


def split_pieces(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
    """Words of all texts, for each whether the next one is in the same piece, and the text it is of."""
    texts = texts.take(pa.array(np.arange(len(texts))))  # ascii_lower misreads a slice whose first offset is not 0
    marked = pc.replace_substring_regex(pc.ascii_lower(texts), ENDS, " \n ")
    lists = pc.split_pattern(pc.replace_substring(marked, GAPS, " "), " ")
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    values = coded.dictionary
    empty = pc.index(values, pa.scalar("", values.type)).as_py()
    ends = pc.index(values, pa.scalar("\n", values.type)).as_py()
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    word = (codes != empty) & (codes != ends)
    at = np.flatnonzero(word)
    # a piece's number: the ends before a word; the next word is in the same piece if it has the same number and text
    piece = np.cumsum(codes == ends)[at]
    owner = owner[at]
    follows = np.zeros(len(at), dtype=bool)
    follows[:-1] = (piece[1:] == piece[:-1]) & (owner[1:] == owner[:-1])
    return pa.DictionaryArray.from_arrays(coded.indices.take(pa.array(at)), values), follows, owner


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hashes of pairs of hashes."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + (b ^ (b >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pairs(words: pa.DictionaryArray, follows: np.ndarray, langs: np.ndarray) -> np.ndarray:
    """Hash of each word with the next one and the text's lang; 0 where the piece ends."""
    own = np.array([xxhash.xxh64_intdigest(w, 11) for w in strings_of(words.dictionary)], dtype=np.uint64)
    own = own[words.indices.to_numpy(zero_copy_only=False)] if len(own) else np.zeros(0, dtype=np.uint64)
    found = np.zeros(len(own), dtype=np.uint64)
    at = np.flatnonzero(follows)
    found[at] = _mix(own[at] ^ langs[at], own[at + 1])
    return found


def _lang_hashes(langs: pa.Array, owner: np.ndarray) -> np.ndarray:
    each = np.array([xxhash.xxh64_intdigest(x, 12) for x in langs.to_pylist()], dtype=np.uint64)
    return each[owner] if len(each) else np.zeros(0, dtype=np.uint64)


def _cell(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Cells of a filter of ``bits`` cells, a power of two."""
    return (hashes * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)


def pair_filter(docs: DataFrame, least: int, work: Workspace, most: int = FILTER_BITS) -> np.ndarray:
    """Bits (as bytes) of the hashed pairs of neighbours that occur ``least`` times in a lang."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare_collections()
        for batch in sliced(batches, "text", SLICE):
            words, follows, owner = split_pieces(text_array(batch.column("text")))
            hashes = _pairs(words, follows, _lang_hashes(batch.column("lang"), owner))
            values, n = np.unique(hashes[follows], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(n)], ["pair", "n"])

    counted = docs.mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    often = work.stage(counted.filter(F.col("n") >= least).select("pair"), "phrases-pairs")
    bits = 1 << 15
    while bits < most and bits < 16 * often.count():
        bits *= 2

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.unique(_cell(batch.column("pair").to_numpy().view(np.uint64), bits))
            yield pa.RecordBatch.from_arrays([pa.array(found)], ["cell"])

    set_bits = often.mapInArrow(cells, "cell bigint")
    rows = (  # at most bits / 2^15 rows of 4 KB
        set_bits.groupBy((F.col("cell") / 32768).cast("long").alias("part"))
        .agg(F.bitmap_construct_agg(F.col("cell") % 32768).alias("bits"))
        .collect()
    )
    found = np.zeros(bits // 8, dtype=np.uint8)
    for row in rows:
        found[row["part"] * 4096 : (row["part"] + 1) * 4096] = np.frombuffer(row["bits"], dtype=np.uint8)
    return found


def windows(docs: DataFrame, often: np.ndarray, width: int) -> DataFrame:
    """(lang, w1 .. w``width``, n): windows led by each word, padded behind the last word that may matter."""
    sent = docs.sparkSession.sparkContext.broadcast(often)
    names = [f"w{k + 1}" for k in range(width)]

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare_collections()
        known, bits = sent.value, len(sent.value) * 8
        for batch in sliced(batches, "text", SLICE):
            langs = batch.column("lang").dictionary_encode()
            words, follows, owner = split_pieces(text_array(batch.column("text")))
            cells = _cell(_pairs(words, follows, _lang_hashes(batch.column("lang"), owner)), bits)
            on = follows & (known[cells >> 3] >> (cells & 7).astype(np.uint8) & 1).astype(bool)
            del cells
            codes = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            # lead columns: the word k places on, as long as every pair up to it is frequent; two go into each key
            high = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[owner] << 26 | codes + 1
            low = np.zeros(len(codes), dtype=np.int64)
            open_ = np.flatnonzero(on)
            high <<= 26
            high[open_] |= codes[open_ + 1] + 1
            for k in range(2, width):
                open_ = open_[on[open_ + k - 1]]
                low <<= 26
                low[open_] |= codes[open_ + k] + 1
            order = np.lexsort((low, high))
            high, low = high[order], low[order]
            first = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])]) if len(order) else order
            n = np.diff(np.r_[first, len(order)])
            high, low = high[first], low[first]
            mask = (1 << 26) - 1
            kept = [high >> 26 & mask, high & mask, *(low >> 26 * (width - 1 - k) & mask for k in range(2, width))]
            values = pa.concat_arrays([pa.array([PAD], words.dictionary.type), words.dictionary])
            made = [values.take(pa.array(k)).cast(pa.string()) for k in kept]
            lang = langs.dictionary.take(pa.array(high >> 52)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([lang, *made, pa.array(n)], ["lang", *names, "n"])

    return docs.mapInArrow(lead, f"lang string, {', '.join(f'{n} string' for n in names)}, n bigint")


def phrase_counts(docs: DataFrame, least: int, width: int, work: Workspace) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, size, f) of all phrases of up to ``width`` words that occur ``least`` times and hold no rarer
    pair, and (lang, n) of all words."""
    docs = docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang"))
    ship(docs.sparkSession)
    names = [f"w{k + 1}" for k in range(width)]
    counted = windows(docs, pair_filter(docs, least, work), width).groupBy("lang", *names).agg(F.sum("n").alias("n"))
    rolled = counted.rollup("lang", *names).agg(F.sum("n").alias("f"), F.grouping_id().alias("gid"))
    size = (F.lit(width) - F.bit_count("gid")).cast("int").alias("size")
    last = F.element_at(F.array(F.lit("-"), *names), F.col("size") + 1)
    rolled = rolled.filter("lang is not null").select("lang", *names, "f", size)
    # a prefix that ends with padding is a shorter phrase's window
    rolled = rolled.filter((F.col("size") == 0) | ((last != PAD) & (F.col("f") >= least)))
    table = work.stage(rolled.select("lang", F.concat_ws(" ", *names).alias("phrase"), "size", "f"), "phrases-counts")
    return table.filter("size > 0"), table.filter("size = 0").select("lang", F.col("f").alias("n"))


def scored(counts: DataFrame, width: int, scale: int, work: Workspace) -> DataFrame:
    """(lang, phrase, size, a, l, r, score) of every phrase of two words or more, by its lowest-scoring cut."""
    cut = lambda a, b: F.array_join(F.slice(F.split("phrase", " ", -1), a, b), " ")
    cuts = counts.filter("size > 1").select("lang", "phrase", "size", F.col("f").alias("a"), F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cuts = cuts.select("*", cut(F.lit(1), F.col("k")).alias("first"), cut(F.col("k") + 1, F.col("size") - F.col("k")).alias("rest"))
    parts = counts.filter(F.col("size") < width)
    for part, name in (("first", "l"), ("rest", "r")):
        side = work.settle(parts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)), f"phrases-{part}")
        hot = hottest(cuts.groupBy("lang", part).agg(F.count("*").alias("_n")), ["lang", part], HOT_ROWS)
        cuts = spread_join(cuts, side, ["lang", part], "inner", ["phrase", "k"], HOT_ROWS, hot=hot)
    whole = lambda c: F.col(c).cast("decimal(20,0)")
    product = (F.lit(scale).cast("decimal(12,0)") * whole("a")).alias("up")
    cuts = cuts.select("*", product, (whole("l") + whole("r")).alias("down")).withColumn("score", F.expr("cast(up div down as bigint)"))
    best = F.min(F.struct("score", "k", "l", "r")).alias("best")
    return cuts.groupBy("lang", "phrase", "size", "a").agg(best).select("lang", "phrase", "size", "a", "best.l", "best.r", "best.score")


def inner(counts: DataFrame, width: int) -> DataFrame:
    """(lang, phrase, longest): the highest count of a longer phrase that holds the phrase."""
    words = F.split("phrase", " ", -1)
    inside = [
        F.when(F.col("size") == size, F.array(*(F.array_join(F.slice("words", a + 1, n), " ") for n in range(2, size) for a in range(size - n + 1))))
        for size in range(3, width + 1)
    ]
    longer = counts.filter("size > 2").select("lang", "f", "size", words.alias("words"))
    return longer.select("lang", "f", F.explode(F.coalesce(*inside)).alias("phrase")).groupBy("lang", "phrase").agg(F.max("f").alias("longest"))


def collocations(
    docs: DataFrame, least: int = 30, width: int = 4, top: int = 2000, scale: int = 2_000_000, share: int = 80, work: Workspace | None = None
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each lang's ``top`` phrases of 2 to ``width`` words.

    ``a`` is the phrase's count, ``l`` and ``r`` those of the parts of its lowest-scoring cut, ``n`` the lang's words,
    the score ``scale`` * a / (l + r) rounded down. Phrases go that a longer one holds with ``share`` percent of
    their count or more.
    """
    if not 2 < width <= 4:
        raise ValueError("windows hold three or four words")
    work = work or workspace(docs.sparkSession)
    counts, words = phrase_counts(docs, least, width, work)
    found = scored(counts, width, scale, work).join(inner(counts, width), ["lang", "phrase"], "left")
    hundred = F.lit(100).cast("decimal(10,0)") * F.col("longest").cast("decimal(20,0)")
    held = hundred >= F.lit(share).cast("decimal(10,0)") * F.col("a").cast("decimal(20,0)")
    found = found.filter(F.col("longest").isNull() | ~held)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    found = found.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return found.join(work.settle(words, "phrases-words"), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
