import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash

from hearback.llm import simhash
from hearback.llm.common import workspace

from .conftest import documents


def plain(text, width=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints, bits=4):
    """Smallest print of each one's component, by comparing all."""
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in combinations(prints, 2):
        if (a ^ b).bit_count() <= bits:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {p: find(p) for p in prints}


def test_every_four_positions_hold_a_triple():
    assert len(simhash.TRIPLES) == 20
    assert all(any(set(t) <= set(four) for t in simhash.TRIPLES) for four in combinations(range(8), 4))


def test_prints():
    for text in ["", "One", "one two THREE", "a b c d e f\n\x0bg", "Ä ä b c d", "x " * 100]:
        assert simhash.simhash(text.encode(), 4, 42) & (1 << 64) - 1 == plain(text)


def near(rng, start, n, flips):
    """Prints that wander off from one another."""
    found = [start]
    while len(found) < n:
        p = rng.choice(found)
        for b in rng.sample(range(64), flips):
            p ^= 1 << b
        found.append(p)
    return found


def test_links_join_what_comparing_all_joins(spark, monkeypatch):
    rng = random.Random(7)
    prints = near(rng, 0, 150, 3) + near(rng, rng.getrandbits(64), 100, 5) + [rng.getrandbits(64) for _ in range(300)]
    prints += near(rng, (1 << 64) - 1, 40, 4)
    prints = sorted(set(prints))
    want = grouped(prints)
    for limit in (4096, 32):  # the second deals long lists to parts
        monkeypatch.setattr(simhash, "LIST", limit)
        signed = [(int(np.uint64(p).view(np.int64)),) for p in prints]
        links = simhash.near_links(spark.createDataFrame(signed, "fp long"), 4, workspace(spark)).collect()
        pairs = {(r["a"] & (1 << 64) - 1, r["b"] & (1 << 64) - 1) for r in links}
        assert all((a ^ b).bit_count() <= 4 for a, b in pairs)
        root = {p: p for p in prints}

        def find(p):
            while root[p] != p:
                p = root[p]
            return p

        for a, b in pairs:
            x, y = sorted((find(a), find(b)))
            root[y] = x
        assert {p: find(p) for p in prints} == want


def test_long_list_is_a_spanning_forest():
    rng = random.Random(8)
    prints = sorted(set(near(rng, 1 << 40, 400, 2)))
    links = np.concatenate(simhash._long_list(np.array(prints, dtype=np.uint64), 4), axis=1)
    groups = len(set(grouped(prints).values()))
    assert links.shape[1] == len(prints) - groups


def test_rough_rows(rough, nothing):
    rows = simhash.near_duplicates(rough).collect()
    texts = rough.collect()
    assert len(rows) == len(texts)
    want = grouped(sorted({plain(t["text"]) for t in texts}))
    least = {}
    for t in texts:
        if t["doc_id"] is not None:
            g = want[plain(t["text"])]
            least[g] = min(least.get(g, t["doc_id"]), t["doc_id"])
    wanted = sorted((str(t["doc_id"]), f"{plain(t['text']):016x}", least.get(want[plain(t["text"])])) for t in texts)
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in rows) == wanted
    assert simhash.near_duplicates(nothing).collect() == []


def test_one_row_of_each_group_stays(rough, nothing):
    kept = simhash.keep_first(rough)
    assert kept.columns == rough.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 4, 5, 8]  # 3 and 7 are empty like 2
    assert ids.count(None) == 1
    assert simhash.keep_first(nothing).collect() == []


def test_an_id_on_several_texts(spark):
    a, b, c = (f"{w} text of its own that is like no other one in this table, said by {w}" for w in ("first", "second", "third"))
    rows = [(5, a), (3, b), (5, b), (7, c), (7, c), (8, c), (7, "quite other words stand here and nothing else at all"), (9, a)]
    kept = simhash.keep_first(documents(spark, [(i, t, "en", "a") for i, t in rows])).select("doc_id", "text").collect()
    assert sorted(map(tuple, kept)) == sorted([(5, a), (3, b), (7, c), (7, rows[6][1])])


def test_slices_of_a_list_are_put_together():
    values = pa.array([1, 2, 3], pa.int64())
    assert simhash._tally(np.array([0, 1 << 8], dtype=np.uint64)).tolist() == [255, 253]
    assert len(values) == 3
