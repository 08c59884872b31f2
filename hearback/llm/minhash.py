"""Near-duplicates of shingle sets by SuperMinHash, banding, verification and union-find.

1. Signature: every shingle's hash seeds a random permutation of the slots, dealt out step by step
   (Fisher-Yates); in step j the shingle offers j + a random fraction to the slot the step deals it. A
   slot keeps its least offer. Offers of step j are at least j, so a text is finished after the first step in
   which all its slots hold less than the next one: two or three steps for texts of many shingles.
   All texts of a slice take each step together, as array work.
2. Banding: ``BANDS`` bands of ``ROWS`` slots; a pair of similarity 0.85 misses all of them with a
   chance of 6e-9. Of each slot a byte is kept; a bucket is a band and its six bytes, so that it is found
   from them and never stored. Work is on distinct sets; copies come back by a join.
3. Verification: each bucket's sets have one of them as head, the least by one order of all sets. A set is
   compared with the ``HEADS`` it shares most buckets with, on whole sets of shingle hashes, which go to the
   head's task: a set travels ``HEADS`` times at most as one that is compared, and once for each place it heads.
   Links are reduced to forests by union-find in tasks, then joined to components.
4. What this may have left: in buckets that still hold several components, sets are compared across these
   inside the task, each pair in its first common bucket, by size, by signature (far below what 0.85 could
   show) and on whole sets, which only the rows with such a partner carry. Only links leave the task. So every
   pair that meets in a bucket is either in one component or was verified.

A bucket over ``LIST`` sets is dealt into parts, for the heads by a hash that differs by bucket; in step 4 its
main component's sets go to one part, others to every part.

Sets are told apart by 128-bit digests, shingles by 64-bit hashes.

Defined cases: a null text counts as empty; texts without words have no set and are linked with nothing; texts of fewer words
than ``width`` are one shingle; texts of any length are read as a whole; ties do not arise, as a component is
named by its least doc_id, or null if none of its rows has one; rows without doc_id are never kept; repeated rows
come out as often as they came in; an empty table gives no rows. Only doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.bloom import may_be_in
from ..operators.skew import hottest, spread_join
from ..session import Workspace
from .common import gather_runs, map_arrow, ship, strings_of, text_array, workspace
from .components import components

BANDS, ROWS = 40, 6
SLOTS = BANDS * ROWS
SURELY = 0.14  # so far below the similarity asked for no link's share of equal slots lies (six deviations)
LIST = 4096
HEADS = 2
BAND_BITS = 6  # the low bits of a bucket name its band
HOT_ROWS = 20_000  # sets compared with one head that a task takes
KEYS = 100_000  # keys that are sent to every task as they are; more go as a Bloom filter before the join
HELD = 1_000_000

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's distinct shingles, in order, one text after the other, and where each text's begin."""
    texts = texts.take(pa.array(np.arange(len(texts))))  # ascii_lower misreads a slice whose first offset is not 0
    lists = pc.split_pattern(pc.replace_substring_regex(pc.ascii_lower(texts), r"[\x09-\x0d]", " "), " ")
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    values = coded.dictionary
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    at = np.flatnonzero(codes != pc.index(values, pa.scalar("", values.type)).as_py())
    words = np.array([xxhash.xxh64_intdigest(w, 1) for w in strings_of(values)], dtype=np.uint64)[codes[at]]
    n_words = np.bincount(owner[at], minlength=len(texts))
    starts = np.concatenate([[0], np.cumsum(n_words)])
    n = np.where(n_words >= width, n_words - width + 1, n_words > 0).astype(np.int64)
    first = gather_runs(starts[:-1], n)
    owner = np.repeat(np.arange(len(texts)), n)
    hashes = np.zeros(len(first), dtype=np.uint64)
    for k in range(width):
        there = n_words[owner] > k
        following = np.full(len(first), 0x5851F42D4C957F2D, dtype=np.uint64)
        following[there] = words[first[there] + k]
        hashes = _mixed(hashes * GOLDEN + following + np.uint64(k))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    fresh = np.r_[True, (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])][: len(hashes)]
    hashes, owner = hashes[fresh], owner[fresh]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(texts)))])


def signatures(hashes: np.ndarray, starts: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash of each text's hashes: step and fraction of the least offer to each slot, in one number."""
    sizes = np.diff(starts)
    found = np.full((len(sizes), slots), np.uint64(0xFFFFFFFFFFFFFFFF))
    flat = found.reshape(-1)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    open_ = np.flatnonzero(sizes)
    dealt: list[np.ndarray] = []
    for step in range(slots):
        drawn = _mixed(hashes + np.uint64(step + 1) * GOLDEN)
        place = step + ((drawn >> np.uint64(32)) * np.uint64(slots - step) >> np.uint64(32)).astype(np.int16)
        # what earlier exchanges have put there: the slot of that step, in turn
        slot = place
        for earlier in range(step - 1, -1, -1):
            slot = np.where(slot == dealt[earlier], np.int16(earlier), slot)
        offer = np.uint64(step << 32) | (drawn & np.uint64(0xFFFFFFFF))
        np.minimum.at(flat, owner * slots + slot, offer)
        open_ = open_[found[open_].max(axis=1) >= np.uint64((step + 1) << 32)]
        if not len(open_):
            break
        going = np.zeros(len(sizes), dtype=bool)
        going[open_] = True
        keep = going[owner]
        hashes, owner = hashes[keep], owner[keep]
        dealt = [d[keep] for d in dealt] + [place[keep]]
    return found


def set_digests(hashes: np.ndarray, starts: np.ndarray) -> list[bytes | None]:
    data, cuts = hashes.tobytes(), (starts * 8).tolist()
    return [xxhash.xxh3_128_digest(data[a:b]) if b > a else None for a, b in zip(cuts, cuts[1:])]


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, set_id, n, short): every row's set digest (null: empty set), size and short signature."""

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            hashes, starts = shingle_sets(text_array(batch.column("text")), width)
            short = _mixed(signatures(hashes, starts)).astype(np.uint8)  # a byte of each slot
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(set_digests(hashes, starts), pa.binary()), pa.array(np.diff(starts)), pa.array([row.tobytes() for row in short], pa.binary())],
                ["doc_id", "set_id", "n", "short"],
            )

        return work

    schema = "doc_id bigint, set_id binary, n bigint, short binary"
    return map_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, schema)


def buckets(short: str) -> Column:
    """The buckets of a short signature: for each band a hash of its bytes, with the band in the low bits."""
    keys = (F.xxhash64(F.substring(short, ROWS * k + 1, ROWS)) for k in range(BANDS))
    return F.array(*(F.shiftleft(key, BAND_BITS).bitwiseOR(F.lit(k).cast("long")) for k, key in enumerate(keys)))


def among(df: DataFrame, keys: DataFrame, on: str, work: Workspace, name: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` is one of ``keys`` (distinct, without null). However many keys there are, of ``df``
    only rows that have one, and few others, are ever shuffled."""
    keys = work.stage(keys, name)
    n = keys.count()
    if n <= KEYS:
        return df.join(F.broadcast(keys), on, "left_semi")
    return may_be_in(df, keys, [on], n).join(keys, on).select(*df.columns)  # a semi join would be moved before the filter


def stars(index: DataFrame, long: DataFrame, percent: int) -> DataFrame:
    """(a, b) distinct: sets b of ``index`` (bucket, set_id, n), each with the ``HEADS`` heads a of its bucket parts that
    it shares most of them with.

    A part's head is the least by a hash of the set. Rows stream by.
    """
    part = F.coalesce(F.pmod(F.xxhash64("bucket", "set_id"), F.col("parts")), F.lit(0)).alias("part")
    dealt = index.join(long, "bucket", "left").select("bucket", part, F.xxhash64("set_id").alias("order"), "set_id", "n")
    dealt = dealt.repartition("bucket", "part").sortWithinPartitions("bucket", "part", "order")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # bucket, part, set and size of the part that is going on
        for batch in batches:
            if not batch.num_rows:
                continue
            bucket, part, n = (batch.column(c).to_numpy() for c in ("bucket", "part", "n"))
            fresh = np.r_[last is None or (bucket[0], part[0]) != last[:2], (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])]
            which = np.cumsum(fresh) - 1
            heads = np.flatnonzero(fresh)
            sets = batch.column("set_id")
            if which[0] < 0:  # the part began in an earlier batch
                which, head_sets, head_n = which + 1, pa.concat_arrays([pa.array([last[2]], pa.binary()), sets.take(pa.array(heads))]), np.r_[last[3], n[heads]]
            else:
                head_sets, head_n = sets.take(pa.array(heads)), n[heads]
            near = np.minimum(n, head_n[which]) * 100 >= np.maximum(n, head_n[which]) * percent
            at = np.flatnonzero(~fresh & near)
            last = (bucket[-1], part[-1], head_sets[int(which[-1])].as_py(), int(head_n[which[-1]]))
            if len(at):
                yield pa.RecordBatch.from_arrays([head_sets.take(pa.array(which[at])), sets.take(pa.array(at))], ["a", "b"])

    met = dealt.mapInArrow(run, "a binary, b binary").groupBy("b", "a").agg(F.count("*").alias("n"))
    most = F.sort_array(F.collect_list(F.struct(-F.col("n"), F.xxhash64("a"), "a")))  # one from each band at most
    return met.groupBy("b").agg(F.slice(most, 1, HEADS)["a"].alias("a")).select(F.explode("a").alias("a"), "b")


def open_parts(index: DataFrame, labels: DataFrame, prints: DataFrame, long: DataFrame, work: Workspace) -> DataFrame:
    """(bucket, part, set_id, n, tag, mine, short): the sets of buckets that hold several components,
    each component a ``tag``. A long bucket's main component is dealt to its parts, other sets go to each
    part and are ``mine`` in one of them."""
    index = index.join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    tagged = index.withColumn("tag", F.xxhash64("label"))
    mixed = tagged.groupBy("bucket").agg(F.min("tag").alias("x"), F.max("tag").alias("y")).filter("x <> y").select("bucket")
    mixed = work.settle(mixed, "minhash-mixed")
    tagged = work.stage(tagged.join(mixed, "bucket", "left_semi").select("bucket", "set_id", "n", "tag"), "minhash-open")
    long = long.join(mixed, "bucket", "left_semi")
    prints = among(prints, tagged.select("set_id").distinct(), "set_id", work, "minhash-open-sets")
    tags = tagged.join(long, "bucket").groupBy("bucket", "parts", "tag").count()
    main = tags.groupBy("bucket", "parts").agg(F.max_by("tag", F.struct("count", "tag")).alias("main"))
    main = work.settle(main, "minhash-main")
    own = F.coalesce(F.pmod(F.xxhash64("set_id"), F.col("parts")), F.lit(0))
    every = F.when(F.col("tag") == F.col("main"), F.array("own")).otherwise(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1).cast("long")) - 1))
    dealt = tagged.join(main, "bucket", "left").withColumn("own", own.cast("long")).withColumn("part", F.explode(every))
    mine = (F.col("own") == F.col("part")).alias("mine")
    return dealt.select("bucket", "part", "set_id", "n", "tag", mine).join(prints, "set_id")


def _by_part(dealt: DataFrame, answer, schema: str) -> DataFrame:
    """``answer(rows of one bucket part)`` of every part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            bucket, part = table["bucket"].to_numpy(), table["part"].to_numpy()
            cuts = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])])
            for x, y in zip(cuts, cuts[1:]):
                yield from answer(table.slice(x, y - x).combine_chunks())
            held = table.slice(cuts[-1])
        if held is not None:
            yield from answer(held.combine_chunks())

    ship(dealt.sparkSession)
    return dealt.repartition("bucket", "part").sortWithinPartitions("bucket", "part").mapInArrow(run, schema)


class Part:
    """The sets of one bucket part as arrays, and which of them may be alike."""

    def __init__(self, table: pa.Table, percent: int):
        self.n, self.tag, self.mine = (table[c].to_numpy() for c in ("n", "tag", "mine"))
        self.band, self.percent = table["bucket"][0].as_py() % (1 << BAND_BITS), percent
        self.short = np.frombuffer(b"".join(table["short"].to_pylist()), dtype=np.uint8).reshape(-1, SLOTS)
        values, counts = np.unique(self.tag, return_counts=True)
        self.strays = np.flatnonzero(self.tag != values[counts.argmax()])

    def near(self, i: int) -> np.ndarray:
        """Sets of other components whose size and signature are near the set's, where no earlier band has the pair."""
        j = np.flatnonzero((self.tag != self.tag[i]) & (self.mine | self.mine[i]))
        j = j[np.minimum(self.n[j], self.n[i]) * 100 >= np.maximum(self.n[j], self.n[i]) * self.percent]
        equal = self.short[j] == self.short[i]
        alike = equal.sum(axis=1) >= SLOTS * (self.percent / 100 - SURELY)
        j, equal = j[alike], equal[alike]
        return j[equal.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == self.band]


def likely(parts: DataFrame, percent: int) -> DataFrame:
    """The rows of ``parts`` (bucket, part, set_id, n, tag, mine) that have a near one of another component in their part."""

    def answer(table: pa.Table) -> Iterator[pa.RecordBatch]:
        part, hit = Part(table, percent), np.zeros(table.num_rows, dtype=bool)
        for i in part.strays:
            j = part.near(i)
            hit[j] = True
            hit[i] |= len(j) > 0
        if hit.any():
            yield from table.select(["bucket", "part", "set_id", "n", "tag", "mine"]).filter(pa.array(hit)).to_batches()

    return _by_part(parts, answer, "bucket bigint, part bigint, set_id binary, n bigint, tag bigint, mine boolean")


def linked(own: np.ndarray, others: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Which of the sets ``others``, one after the other and of such ``sizes``, are alike with the set ``own``; all are sorted."""
    there = own[np.minimum(np.searchsorted(own, others), len(own) - 1)] == others
    same = np.add.reduceat(there, np.r_[0, np.cumsum(sizes)[:-1]], dtype=np.int64)
    return same * 100 >= (len(own) + sizes - same) * percent


def across(parts: DataFrame, percent: int) -> DataFrame:
    """(a, b): verified links that tie together what ``parts``, with ``hashes`` of whole sets, hold of different components."""

    def answer(table: pa.Table) -> Iterator[pa.RecordBatch]:
        part = Part(table, percent)
        lists = table["hashes"].combine_chunks()
        starts, flat = lists.offsets.to_numpy(), lists.flatten().to_numpy().view(np.uint64)
        starts = starts - starts[0]
        group = np.unique(part.tag, return_inverse=True)[1]  # components, tied as links are found
        a, b = [], []
        for i in part.strays:
            j = part.near(i)
            j = j[group[j] != group[i]]
            if not len(j):
                continue
            sizes = np.diff(starts)[j].astype(np.int64)
            for k in j[linked(flat[starts[i] : starts[i + 1]], flat[gather_runs(starts[j].astype(np.int64), sizes)], sizes, percent)]:
                if group[k] != group[i]:
                    group[group == group[k]] = group[i]
                    a.append(i)
                    b.append(k)
        if a:
            sets = table["set_id"].combine_chunks()
            yield pa.RecordBatch.from_arrays([sets.take(pa.array(a)), sets.take(pa.array(b))], ["a", "b"])

    return _by_part(parts, answer, "a binary, b binary")


def whole_sets(wanted: DataFrame, docs: DataFrame, sets: DataFrame, repeated: DataFrame, width: int, work: Workspace, name: str) -> DataFrame:
    """(set_id, hashes) of the sets ``wanted`` (set_id, distinct), from the texts of one document each.

    A doc_id of one row gives one set and, being the least of its set, gives it alone: such sets are not shuffled.
    Those of ``repeated`` ids, and of sets whose rows have no id, are told apart by their digests."""
    wanted = work.stage(wanted.join(sets, "set_id").select("set_id", "least_id"), f"{name}-wanted")
    ids = wanted.filter("least_id is not null").select(F.col("least_id").alias("doc_id")).distinct()
    chosen = among(docs, ids, "doc_id", work, f"{name}-ids")
    shared = chosen.join(repeated, "doc_id", "left_semi")
    if not wanted.filter("least_id is null").isEmpty():
        shared = shared.union(docs.filter("doc_id is null"))

    def make():
        def work_(batch: pa.RecordBatch) -> pa.RecordBatch:
            hashes, starts = shingle_sets(text_array(batch.column("text")), width)
            lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(hashes.view(np.int64)))
            return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(set_digests(hashes, starts), pa.binary()), lists], ["doc_id", "set_id", "hashes"])

        return work_

    def whole(rows: DataFrame) -> DataFrame:
        return map_arrow(rows.select("doc_id", "text"), make, "doc_id bigint, set_id binary, hashes array<bigint>")

    asked = work.settle(wanted.select("set_id", F.col("least_id")), f"{name}-asked")
    many = whole(shared).alias("w").join(asked.alias("q"), F.expr("w.set_id = q.set_id and w.doc_id <=> q.least_id"), "left_semi")
    alone = whole(chosen.join(repeated, "doc_id", "left_anti"))
    return alone.select("set_id", "hashes").union(many.select("set_id", "hashes").dropDuplicates(["set_id"]))


def verified(pairs: DataFrame, whole: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose ``whole`` sets are alike. Sets go to the place of their head, which stands first there;
    a head of many sets has several places."""
    hot = hottest(pairs.groupBy("a").agg(F.count("*").alias("_n")), ["a"], HOT_ROWS)
    place = F.coalesce(F.pmod(F.xxhash64("b"), F.ceil(F.col("_n") / HOT_ROWS)), F.lit(0)).alias("place")
    dealt = pairs.join(F.broadcast(hot), "a", "left").select("a", place, "b")
    places = dealt.union(dealt.select("a", "place", F.col("a").alias("b")).distinct())
    sent = places.join(whole.withColumnRenamed("set_id", "b"), "b").select("a", "place", (F.col("a") != F.col("b")).alias("other"), "b", "hashes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, own = None, None  # the set whose place is going on
        for batch in batches:
            lists, sets, other = batch.column("hashes"), batch.column("b"), batch.column("other").to_numpy(zero_copy_only=False)
            starts, flat = lists.offsets.to_numpy().astype(np.int64), lists.flatten().to_numpy().view(np.uint64)
            starts = starts - starts[0]
            a, b = [], []
            cuts = [0, *np.flatnonzero(~other), len(other)]
            for x, y in zip(cuts, cuts[1:]):
                if x < y and not other[x]:
                    head, own = sets[x].as_py(), flat[starts[x] : starts[x + 1]].copy()
                    x += 1
                if x < y:
                    found = x + np.flatnonzero(linked(own, flat[starts[x] : starts[y]], np.diff(starts[x : y + 1]), percent))
                    a += [head] * len(found)
                    b += found.tolist()
            if b:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), sets.take(pa.array(b))], ["a", "b"])

    ship(pairs.sparkSession)
    return sent.repartition("a", "place").sortWithinPartitions("a", "place", "other").mapInArrow(run, "a binary, b binary")


def forest(links: DataFrame) -> DataFrame:
    """Links that join the same sets as ``links`` (a, b), by union-find in each task: fewer, where tasks hold cycles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[bytes, bytes] = {}

        def find(x: bytes) -> bytes:
            root = x
            while (up := parent.setdefault(root, root)) != root:
                root = up
            while parent[x] != root:
                parent[x], x = root, parent[x]
            return root

        def joined() -> pa.RecordBatch:
            tied = [(find(x), x) for x in list(parent)]
            tied = [(r, x) for r, x in tied if r != x]
            parent.clear()
            return pa.RecordBatch.from_arrays([pa.array([r for r, _ in tied], pa.binary()), pa.array([x for _, x in tied], pa.binary())], ["a", "b"])

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
            if len(parent) > HELD:
                yield joined()
        yield joined()

    ship(links.sparkSession)
    return links.mapInArrow(run, "a binary, b binary")


def near_duplicates(docs: DataFrame, width: int = 3, percent: int = 85, work: Workspace | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``: sets whose intersection is ``percent`` of their union are linked."""
    if not 50 <= percent <= 100:
        raise ValueError("the bands reach similarities near 0.85 and above")
    work = work or workspace(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = work.stage(sketches(docs, width), "minhash-rows")
    filled = rows.filter("set_id is not null")
    sets = work.stage(filled.groupBy("set_id").agg(F.min("doc_id").alias("least_id")), "minhash-sets")
    repeated = rows.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    repeated = work.settle(repeated, "minhash-repeated")
    distinct = filled.select("set_id", "n", "short").dropDuplicates(["set_id"])
    distinct = work.stage(distinct, "minhash-distinct")
    index = distinct.select(F.explode(buckets("short")).alias("bucket"), "set_id", "n")
    sizes = index.groupBy("bucket").count().filter("count > 1")
    sizes = work.stage(sizes, "minhash-sizes")
    long = work.settle(sizes.filter(F.col("count") > LIST).select("bucket", F.ceil(F.col("count") / LIST).alias("parts")), "minhash-long")
    index = work.stage(among(index, sizes.select("bucket"), "bucket", work, "minhash-shared"), "minhash-index")

    first = work.stage(stars(index, long, percent), "minhash-stars")
    ends = first.select(F.col("a").alias("set_id")).union(first.select("b")).distinct()
    links = verified(first, whole_sets(ends, docs, sets, repeated, width, work, "minhash-first"), percent)
    links = work.stage(links, "minhash-links-1")
    tied = components(forest(links), work, "minhash-tied-1")
    labels = work.settle(tied.select(F.col("node").alias("set_id"), F.col("root").alias("label")), "minhash-labels")
    prints = distinct.select("set_id", "short")
    near = work.stage(likely(open_parts(index, labels, prints, long, work), percent), "minhash-likely")
    ends = near.select("set_id").distinct()
    whole = whole_sets(ends, docs, sets, repeated, width, work, "minhash-second")
    prints = among(prints, ends, "set_id", work, "minhash-near-sets")
    more = work.stage(across(near.join(prints, "set_id").join(whole, "set_id"), percent), "minhash-links-2")
    if not more.isEmpty():
        tied = components(forest(links.union(more)), work, "minhash-tied-2")

    tied = tied.select(F.col("node").alias("set_id"), "root")
    tied = tied.union(tied.select(F.col("root").alias("set_id"), "root").distinct()).join(sets, "set_id")
    least = tied.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = work.settle(tied.join(least, "root").select("set_id", "component_id"), "minhash-named")
    named = sets.join(named, "set_id", "left").select("set_id", F.coalesce("component_id", "least_id").alias("component_id"))
    rows = rows.select("doc_id", "set_id", F.col("n").alias("n_shingles"))
    found = spread_join(rows, work.settle(named, "minhash-classes"), ["set_id"], "left", ["doc_id"])
    component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    found = found.select("doc_id", "n_shingles", component.alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
