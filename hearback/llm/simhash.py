"""SimHash near-duplicates by an inverted index on byte positions with count filtering.

A fingerprint is eight bytes at fixed positions. Two fingerprints that differ in at most
``bits`` (at most 4) bits have at least 8 - ``bits`` equal bytes at equal positions. Lists of single
bytes would hold 1/256 of all fingerprints each, so the index is keyed by three positions
and their bytes: ``TRIPLES`` are 20 sets of three positions of which every set of four
positions contains one, so that every pair that can count to four meets in a list. Within
a list the equal positional bytes of each pair are tallied, pairs below the guaranteed
number are dropped and the rest is verified bit by bit.

Work is on distinct fingerprints; copies come back by a join. Lists hold about 1 / 2^24 of
the fingerprints. In a longer list (near copies of one text) no pairs are listed: its
components are found by searching outwards from one fingerprint among those not yet
reached, and a list over ``LIST`` entries is dealt into parts that are compared two at a time.
Only links that join something leave a list.

Defined cases: a null text counts as empty; a text without words has fingerprint 0 and is
linked like any other; rows without doc_id are linked but never name a component, whose id
is null if none of its rows has one; repeated rows come out as often as they came in.
Names of inner columns are chosen so that no column of the input has them. Texts of any length are hashed as a whole; of fingerprints
at the same distance all are linked; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import Workspace
from .common import free_prefix, map_arrow, ship, text_array, workspace
from .components import components

LIST = 4096
SHORT = 48


def _triples() -> list[tuple[int, int, int]]:
    """Sets of three positions of which every four positions hold one: with three groups of
    positions, those inside a group and those with two in a group and one in the next."""
    groups = {p: g for g, span in enumerate((range(3), range(3, 6), range(6, 8))) for p in span}
    found = []
    for t in combinations(range(8), 3):
        g = sorted(groups[p] for p in t)
        pair = next((x for x in g if g.count(x) == 2), None)
        if len(set(g)) == 1 or pair is not None and (pair + 1) % 3 in g:
            found.append(t)
    return found


TRIPLES = _triples()
# The first triple inside each set of equal positions (a bit mask), or none.
FIRST = np.array(
    [next((i for i, t in enumerate(TRIPLES) if all(mask >> p & 1 for p in t)), -1) for mask in range(256)]
)


def simhash(raw: bytes, width: int, seed: int) -> int:
    """Signed 64-bit fingerprint: a bit is 1 if set in over half the hashes of the shingles."""
    words = raw.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: max(1, len(words) - width + 1)]
    ends = ends[min(width, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), 1 << 16):
        cuts = zip(starts[at : at + (1 << 16)].tolist(), ends[at : at + (1 << 16)].tolist())
        hashes = np.array([digest(line[a:b], seed) for a, b in cuts], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the fingerprint of every row's text as a signed number."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = text_array(batch.column("text")).cast(pa.large_binary())
            found = pa.array([simhash(t.as_py(), width, seed) for t in texts], pa.int64())
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), found], ["doc_id", "fp"])

        return work

    return map_arrow(docs.select("doc_id", "text"), make, "doc_id bigint, fp bigint")


def _with_print(docs: DataFrame, width: int, seed: int, name: str) -> DataFrame:
    """All columns and the text's fingerprint as ``name``."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = text_array(batch.column("text")).cast(pa.large_binary())
            found = pa.array([simhash(t.as_py(), width, seed) for t in texts], pa.int64())
            return batch.append_column(name, found)

        return work

    return map_arrow(docs, make, StructType([*docs.schema.fields, StructField(name, LongType())]))


def _tally(x: np.ndarray) -> np.ndarray:
    """Mask of the equal positional bytes of pairs whose fingerprints differ by ``x``."""
    return np.packbits(x.view(np.uint8).reshape(-1, 8) == 0, axis=1, bitorder="little").ravel()


def _alike(x: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that reach the guaranteed count of equal bytes and pass the check of bits; their masks."""
    masks = _tally(x)
    hit = np.flatnonzero(np.bitwise_count(masks) >= 8 - bits)
    hit = hit[np.bitwise_count(x[hit]) <= bits]
    return hit, masks[hit]


def _short_lists(values: np.ndarray, group: np.ndarray, triple: np.ndarray, bits: int) -> list[np.ndarray]:
    """Links in lists of a few entries: neighbours at distance 1, 2, ... of all lists at once.
    A pair that meets in several lists is linked in the first only."""
    found = []
    for step in range(1, SHORT):
        pairs = np.flatnonzero(group[step:] == group[:-step])
        if not len(pairs):
            break
        hit, masks = _alike(values[pairs] ^ values[pairs + step], bits)
        own = pairs[hit][FIRST[masks] == triple[pairs[hit]]]
        found.append(np.stack([values[own], values[own + step]]))
    return found


def _long_list(values: np.ndarray, bits: int) -> list[np.ndarray]:
    """A spanning forest of one list's links: search outwards among what is not reached yet."""
    found, rest = [], values
    while len(rest):
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            near = frontier.pop()
            hit, _ = _alike(rest ^ near, bits)
            if len(hit):
                reached = rest[hit]
                found.append(np.stack([np.full(len(reached), near), reached]))
                frontier.extend(reached)
                rest = np.delete(rest, hit)
    return found


def _links(index: DataFrame, bits: int) -> DataFrame:
    """(a, b) links of an index (list, part, fp) that is sorted by list and part."""

    def close(table: pa.Table) -> pa.RecordBatch | None:
        keys, parts = table["list"].to_numpy(), table["part"].to_numpy()
        values = table["fp"].to_numpy().view(np.uint64)
        first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (parts[1:] != parts[:-1])])
        sizes = np.diff(np.r_[first, len(keys)])
        group = np.repeat(np.arange(len(first)), sizes)
        short = (sizes > 1) & (sizes <= SHORT)
        keep = short[group]
        found = _short_lists(values[keep], group[keep], (keys >> 24)[keep], bits)
        for i in np.flatnonzero(sizes > SHORT):
            found += _long_list(values[first[i] : first[i] + sizes[i]], bits)
        if not found:
            return None
        a, b = np.concatenate(found, axis=1).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            keys, parts = table["list"].to_numpy(), table["part"].to_numpy()
            last = np.flatnonzero((keys != keys[-1]) | (parts != parts[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = table.slice(cut).combine_chunks()
            if cut and (made := close(table.slice(0, cut))) is not None:
                yield made
        if held is not None and (made := close(held)) is not None:
            yield made

    ship(index.sparkSession)
    return index.mapInArrow(run, "a bigint, b bigint")


def near_links(prints: DataFrame, bits: int, work: Workspace) -> DataFrame:
    """Links (a, b) that join all fingerprints ``fp`` (distinct) within ``bits`` bits of each other."""
    if not 0 <= bits <= 4:
        raise ValueError("the index guarantees a meeting up to 4 bits")
    byte = lambda p: F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255))
    keys = [
        F.lit(i << 24).cast("long") + byte(t[0]) * F.lit(1 << 16) + byte(t[1]) * F.lit(1 << 8) + byte(t[2])
        for i, t in enumerate(TRIPLES)
    ]
    index = prints.select(F.explode(F.array(*keys)).alias("list"), "fp")
    sizes = index.groupBy("list").count()
    long = sizes.filter(F.col("count") > LIST).select("list", F.ceil(F.col("count") / LIST).cast("int").alias("parts"))
    index = index.join(work.settle(long, "simhash-long"), "list", "left")
    # every two parts of a long list meet once; other lists are one part
    own = F.pmod(F.xxhash64("fp"), F.col("parts"))
    other = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("parts"), F.lit(1)) - 1))
    index = index.withColumn("own", F.coalesce(own, F.lit(0))).withColumn("other", other)
    part = F.least("own", "other") * F.coalesce("parts", F.lit(1)) + F.greatest("own", "other")
    index = index.select("list", part.cast("long").alias("part"), "fp")
    index = index.repartition("list", "part").sortWithinPartitions("list", "part", "fp")
    return _links(index, bits)


def near_duplicates(docs: DataFrame, width: int = 4, bits: int = 4, seed: int = 42, work: Workspace | None = None) -> DataFrame:
    """(doc_id, fp, fingerprint, class_fp, component_id) of every row of ``docs``; ``class_fp`` is the
    least fingerprint of the component as a signed number, ``component_id`` its least doc_id."""
    work = work or workspace(docs.sparkSession)
    docs = work.stage(fingerprints(docs, width, seed), "simhash-docs")
    prints = work.stage(docs.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-prints")
    links = near_links(prints.select("fp"), bits, work)
    tied = components(links, work, "simhash-tied").withColumnRenamed("node", "fp")
    tied = tied.union(tied.select(F.col("root").alias("fp"), "root").distinct())
    tied = tied.join(prints, "fp")
    least = tied.groupBy("root").agg(F.min("least_id").alias("component_id"))
    tied = work.settle(tied.join(least, "root").select("fp", "root", "component_id"), "simhash-classes")
    classes = prints.join(tied, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("class_fp"), F.coalesce("component_id", "least_id").alias("component_id")
    )
    name = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return docs.join(classes, "fp").select("doc_id", "fp", name.alias("fingerprint"), "class_fp", "component_id")


def keep_first(docs: DataFrame, width: int = 4, bits: int = 4, seed: int = 42) -> DataFrame:
    """One row of every component: the one whose doc_id names it; of rows that repeat that
    doc_id in the component, one. A doc_id of several rows is told apart by their fingerprints,
    so that each component it names keeps a row. Rows without doc_id stay (one of each component) only where no row of
    their component has an id. Columns are those of ``docs``.

    Only the ids of the rows that go are joined with the documents.
    """
    work, own = workspace(docs.sparkSession), free_prefix(docs, "__simhash_")
    fp, class_fp = f"{own}fp", f"{own}class_fp"
    found = work.stage(near_duplicates(docs, width, bits, seed, work), "simhash-found")
    several = found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    gone = found.filter("doc_id <> component_id").select("doc_id").distinct()
    gone, several = work.settle(gone, "simhash-gone"), work.settle(several, "simhash-several")
    named = docs.filter(F.col("doc_id").isNotNull())
    once = named.join(gone, "doc_id", "left_anti").join(several, "doc_id", "left_anti")
    names = found.filter("doc_id = component_id").join(several, "doc_id", "left_semi")
    names = names.select("doc_id", F.col("fp").alias(fp), F.col("class_fp").alias(class_fp)).distinct()
    repeated = _with_print(named.join(several, "doc_id", "left_semi"), width, seed, fp)
    repeated = repeated.join(names, ["doc_id", fp]).dropDuplicates([class_fp])
    named = once.select(*docs.columns).unionByName(repeated.select(*docs.columns))
    lost = found.filter("component_id is null").select("fp", "class_fp").distinct()
    if lost.isEmpty():
        return named
    nameless = _with_print(docs.filter(F.col("doc_id").isNull()), width, seed, fp)
    lost = lost.select(F.col("fp").alias(fp), F.col("class_fp").alias(class_fp))
    nameless = nameless.join(lost, fp).dropDuplicates([class_fp])
    return named.unionByName(nameless.select(*docs.columns))
