"""SuperMinHash near-duplicates against plain set comparison."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hearback.llm import minhash
from hearback.llm.common import workspace
from hearback.session import Inline, Workspace

from .conftest import documents


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text, width=3):
    own = words(text)
    if len(own) < width:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + width]) for i in range(len(own) - width + 1)}


def plain(rows, percent=85):
    """Rows (doc_id, text) to the result's rows, sorted."""
    sets = [frozenset(shingles(t)) for _, t in rows]
    distinct = sorted({s for s in sets if s}, key=sorted)
    root = {s: s for s in distinct}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            same = len(a & b)
            if 100 * same >= percent * (len(a) + len(b) - same):
                root[find(a)] = find(b)
    least = {}
    for (doc_id, _), s in zip(rows, sets):
        if s and doc_id is not None:
            least[find(s)] = min(least.get(find(s), doc_id), doc_id)
    named = [(i, len(s), least.get(find(s)) if s else i) for (i, _), s in zip(rows, sets)]
    return sorted(((i, n, c, i is not None and i == c) for i, n, c in named), key=repr)


def found(docs, **more):
    return sorted((tuple(r) for r in minhash.near_duplicates(docs, **more).collect()), key=repr)


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def families(rng, n_families, members, length, edits):
    """Texts and copies with some words replaced, many of them near the threshold."""
    vocabulary = [f"w{i}" for i in range(900)]
    texts = []
    for _ in range(n_families):
        base = rng.choices(vocabulary, k=length)
        for _ in range(members):
            own = list(base)
            for _ in range(rng.randrange(edits + 1)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            texts.append(" ".join(own))
    return texts


def test_signatures_are_those_of_the_sequential_walk():
    """Slot values of plain Fisher-Yates walks over all steps, and the share of equal slots."""
    rng = np.random.default_rng(5)
    sets = [rng.integers(0, 2**63, size=n).astype(np.uint64) for n in (1, 2, 7, 40, 300, 0)]
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    slots = 24
    got = minhash.signatures(np.concatenate(sets), starts, slots)
    for own, row in zip(sets, got):
        want = [2**64 - 1] * slots
        for h in own:
            p = list(range(slots))
            for step in range(slots):
                drawn = int(minhash._mixed(np.array([h]) + np.uint64(step + 1) * minhash.GOLDEN)[0])
                k = step + ((drawn >> 32) * (slots - step) >> 32)
                p[step], p[k] = p[k], p[step]
                want[p[step]] = min(want[p[step]], step << 32 | drawn & 0xFFFFFFFF)
        assert row.tolist() == want
    a = rng.integers(0, 2**63, size=1000).astype(np.uint64)
    b = np.concatenate([a[:850], rng.integers(0, 2**63, size=150).astype(np.uint64)])
    x, y = minhash.signatures(np.concatenate([a, b]), np.array([0, 1000, 2000]))
    assert abs((x == y).mean() - 850 / 1150) < 0.12


def test_shingle_sets():
    texts = ["A b c d", "a B", "a", "", "a b c a b c a", None, "\x0b x\tY  z "]
    hashes, starts = minhash.shingle_sets(pa.array([t or "" for t in texts], pa.large_string()), 3)
    assert np.diff(starts).tolist() == [len(shingles(t)) for t in texts]
    assert all((np.diff(hashes[a:b].astype(object)) > 0).all() for a, b in zip(starts, starts[1:]))


@pytest.mark.parametrize("list_size", [4096, 5])
def test_families_near_the_threshold(spark, monkeypatch, list_size):
    monkeypatch.setattr(minhash, "LIST", list_size)
    monkeypatch.setattr(minhash, "HOT_ROWS", 4)
    rng = random.Random(list_size)
    texts = families(rng, 12, 14, 60, 5) + families(rng, 4, 10, 200, 14) + families(rng, 30, 1, 30, 0)
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[i % 5]) for i in range(20)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(docs) == plain(rows)


def test_links_that_stars_miss_are_found(spark, monkeypatch):
    """Without any star link all pairs come from the buckets that still hold several components."""
    rng = random.Random(2)
    rows = list(enumerate(families(rng, 6, 9, 80, 5)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    none = spark.createDataFrame([], "a binary, b binary")
    monkeypatch.setattr(minhash, "stars", lambda *a: none)
    monkeypatch.setattr(minhash, "LIST", 4)
    assert found(docs) == plain(rows)


def test_rough_rows(rough, nothing):
    assert found(rough) == plain(pairs(rough))
    assert found(nothing) == []
    with pytest.raises(ValueError):
        minhash.near_duplicates(rough, percent=40)


def test_sets_without_any_id(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
    rows = [(None, text), (None, text + " more"), (None, "other words here"), (4, text + " mare"), (4, "two words"), (9, "two words")]
    docs = documents(spark, [(i, t, "en", "s") for i, t in rows])
    assert found(docs) == plain(rows)


def test_sets_of_single_ids_are_not_shuffled(spark):
    """Whole sets are told apart only where an id has several rows, or a set no id."""
    texts = families(random.Random(11), 8, 6, 60, 4)
    rows = list(enumerate(texts)) + [(3, texts[0]), (3, texts[9]), (3, texts[9]), (50, texts[9]), (None, texts[20]), (None, "a b c d"), (None, "a b c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(docs) == plain(rows)
    sketched = minhash.sketches(docs, 3)
    sets = sketched.groupBy("set_id").agg(F.min("doc_id").alias("least_id"))
    repeated = sketched.groupBy("doc_id").count().filter("count > 1 and doc_id is not null").select("doc_id")
    whole = minhash.whole_sets(sets.select("set_id"), docs, sets, repeated, 3, Inline(spark), "all")
    assert whole._jdf.queryExecution().optimizedPlan().toString().startswith("Union")
    got = [r["set_id"] for r in whole.select("set_id").collect()]
    assert len(got) == len(set(got)) == len({frozenset(shingles(t)) for _, t in rows})


def test_one_text_holds_a_third_of_all_rows(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("the same words in each of these rows")).otherwise(F.concat(F.lit("row of its own with number "), "id")).alias("text")
    )
    got = minhash.near_duplicates(docs, work=workspace(spark)).groupBy("component_id").count().collect()
    assert sorted(r["count"] for r in got)[-2:] == [1, 1000]


def test_what_is_written_and_sent_grows_with_the_rows(spark, tmp_path):
    """No table holds bucket keys or hashes of a row's shingles, and no set meets more than two heads, however large its family."""

    class Seen(Workspace):
        tables = {}

        def stage(self, df, name, partition_by=()):
            self.tables[name] = table = super().stage(df, name, partition_by)
            return table

    rows = list(enumerate(families(random.Random(8), 2, 60, 120, 4)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    work = Seen(spark, str(tmp_path))
    assert found(docs, work=work) == plain(rows)
    assert not [(n, c) for n, t in work.tables.items() for c, kind in t.dtypes if kind.startswith("array")]
    heads = work.tables["minhash-stars"].groupBy("b").count().collect()
    assert len(heads) > 80 and max(r["count"] for r in heads) <= 2


@pytest.mark.parametrize("keys", [0, 10**6])
def test_keys_too_many_to_broadcast(spark, monkeypatch, keys):
    monkeypatch.setattr(minhash, "KEYS", keys)
    texts = families(random.Random(21), 6, 8, 60, 6)
    rows = list(enumerate(texts)) + [(3, texts[0]), (3, texts[9]), (None, texts[20]), (None, "a b c d"), (70, None), (71, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(docs) == plain(rows)


@pytest.mark.parametrize("hot", [2, 20_000])
def test_heads_of_many_sets_have_several_places(spark, monkeypatch, hot):
    monkeypatch.setattr(minhash, "HOT_ROWS", hot)
    rng = random.Random(4)
    sets = {bytes([i]) * 16: sorted(rng.sample(range(40), 34)) for i in range(60)}
    ids = sorted(sets)
    pairs = [(ids[0], x) for x in ids[1:]] + [(ids[1], x) for x in ids[2:9]]
    whole = spark.createDataFrame(list(sets.items()), "set_id binary, hashes array<bigint>")
    got = minhash.verified(spark.createDataFrame(pairs, "a binary, b binary"), whole, 75)
    alike = lambda a, b: 100 * len(set(a) & set(b)) >= 75 * len(set(a) | set(b))
    want = sorted((a, b) for a, b in pairs if alike(sets[a], sets[b]))
    assert 0 < len(want) < len(pairs)
    assert sorted((bytes(r["a"]), bytes(r["b"])) for r in got.collect()) == want


def test_buckets_name_their_band_and_bytes(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 256, minhash.SLOTS).astype(np.uint8)
    y = x.copy()
    y[[0, 7, 239]] += 1
    rows = [(bytes(x.tobytes()),), (bytes(y.tobytes()),)]
    got = [r["b"] for r in spark.createDataFrame(rows, "short binary").select(minhash.buckets("short").alias("b")).collect()]
    assert all([k % (1 << minhash.BAND_BITS) for k in b] == list(range(minhash.BANDS)) for b in got)
    assert [i for i, (p, q) in enumerate(zip(*got)) if p != q] == [0, 1, 39]
