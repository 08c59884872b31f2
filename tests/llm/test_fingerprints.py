import hashlib
import random

import numpy as np

from hearback.llm import fingerprints as fp

from .conftest import documents


def slow_sketch(text):
    """Order MinHash with plain lists, from the same hashes."""
    points = fp._utf32(text)
    hashed = fp._kmers(points, fp.K).tolist()
    seen, numbered = {}, []
    for h in hashed:
        n = seen.get(h, 0)
        seen[h] = n + 1
        numbered.append(n)
    total = fp._mix(np.array(hashed, dtype=np.uint64) + np.array(numbered, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) if len(hashed) > 1 else fp._mix(np.array(hashed, dtype=np.uint64))
    values, out = total.tolist(), []
    for factor in fp.FACTORS.tolist():
        order = sorted(range(len(values)), key=lambda i: ((values[i] * factor & (1 << 64) - 1) >> 32, i))[: fp.PICK]
        h = np.array([len(order)], dtype=np.uint64)
        for i in sorted(order):
            h = fp._mix(h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(values[i]))
        out.append(int(h[0]) >> 32)
    return out if values else [0] * fp.SKETCHES


def test_sketch_against_plain_lists(monkeypatch):
    rng = random.Random(1)
    texts = ["", "a", "abcdef", "aaaaaaaaaaaaaaaa", "日本語" * 9, "x" * 300] + ["".join(rng.choice("ab ") for _ in range(200)) for _ in range(20)]
    for piece in (1 << 19, 64):  # the second goes through a text in pieces
        monkeypatch.setattr(fp, "PIECE", piece)
        for text in texts:
            assert fp.sketch(fp._utf32(text)).tolist() == slow_sketch(text)


def test_order_and_edits_count():
    rng = random.Random(2)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(400)]
    text = " ".join(words)
    like = lambda other: fp.likeness(fp.sketch(fp._utf32(text)), fp.sketch(fp._utf32(other)))
    few = [w if i % 100 else "zzz" for i, w in enumerate(words)]
    many = [w if i % 5 else "zzz" for i, w in enumerate(words)]
    swapped = " ".join(words[200:] + words[:200])
    assert like(text) == 1 and like(" ".join(few)) > like(" ".join(many)) > like("other " * 300)
    assert like(swapped) < 0.85  # the same k-mers in another order


def test_successors(spark, rough, nothing):
    rng = random.Random(3)
    rows = [(i * 3, "".join(rng.choice("abc 日") for _ in range(rng.randrange(0, 120))), "en", "a") for i in range(200)]
    rows[7] = (21, None, "en", "a")
    found = {r["doc_id"]: r for r in fp.with_successors(documents(spark, rows)).collect()}
    line = sorted(rows, key=lambda r: -r[0])
    assert len(found) == len(rows)
    for i, (doc_id, text, *_) in enumerate(line):
        text, following = text or "", line[(i + 1) % len(line)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = found[doc_id]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        own, other = fp.sketch(fp._utf32(text)), fp.sketch(fp._utf32(edited))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (fp.written(own), fp.written(other))
        assert r["near_edited"] == fp.likeness(own, other)
        assert r["near_next"] == fp.likeness(own, fp.sketch(fp._utf32(following)))
    assert len(fp.with_successors(rough).collect()) == rough.count()
    assert fp.with_successors(nothing).collect() == []
    one = fp.with_successors(documents(spark, [(1, "abcdef", "en", "a")])).collect()
    assert [(r["near_next"], r["edited_sha256"]) for r in one] == [(1.0, hashlib.sha256(b"abcabc").hexdigest())]
    assert [r["fingerprint"] for r in fp.fingerprints(rough).filter("doc_id = 1 or doc_id = 6").collect()].__len__() == 2


def test_hot_ids_are_split(spark):
    """A third of the rows without an id, a third of one id (most of them one text): whole results in even ranges."""
    rng = random.Random(6)
    short = lambda: "".join(rng.choice("abc") for _ in range(12))
    rows = [(None, short()) for _ in range(400)] + [(7, short() if i % 4 == 0 else "the copied text") for i in range(400)]
    rows += [(i * 2, short()) for i in range(400)]
    df = documents(spark, [(i, t, "en", "a") for i, t in rows])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        sizes = [r["count"] for r in fp._ranges(df.select("doc_id", "text")).groupBy("slot").count().collect()]
        found = fp.with_successors(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert max(sizes) <= 2.5 * 1200 / 16
    line = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], hashlib.md5(r[1].encode()).hexdigest()), reverse=True)
    want = []
    for i, (doc_id, text) in enumerate(line):
        edited = fp.edit(text, line[(i + 1) % len(line)][1])
        want.append((str(doc_id), fp.written(fp.sketch(fp._utf32(text))), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["edited_sha256"]) for r in found) == sorted(want)
