import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearback.llm import topk


def by_hand(rows, k, scale, every):
    most = 2**63 - 1
    vectors = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        vectors.append((i, [max(-most - 1, min(most, math.floor(scale * float(x)))) for x in v]))
    out = []
    for n, (q, v) in enumerate(vectors):
        if q % every == 0:
            scores = [(max(-most, min(most, sum(a * b for a, b in zip(v, w)))), c) for m, (c, w) in enumerate(vectors) if m != n]
            out += [(q, r + 1, c, s) for r, (s, c) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:k])]
    return sorted(out)


def search(spark, rows, k=5, scale=64, every=5):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, score int, rank int")
    return sorted(tuple(r) for r in topk.top_k(df, F.col("vec_id") % every == 0, k, scale).collect())


def vectors(rng, n, dims, size=lambda: 1.0):
    return [(i, [float(np.float32(rng.gauss(0, 1) * size() / (j + 1))) for j in range(dims)]) for i in range(n)]


@pytest.mark.parametrize("dims", [1, 3, 24])
def test_against_all_products(spark, dims, monkeypatch):
    rng = random.Random(dims)
    monkeypatch.setattr(topk, "CANDIDATES", 16)
    monkeypatch.setattr(topk, "HEAD", 20)
    rows = vectors(rng, 300, dims, lambda: rng.choice([0.1, 1, 4]))
    assert search(spark, rows) == by_hand(rows, 5, 64, 5)


def test_many_equal_vectors_and_several_blocks(spark, monkeypatch):
    rng = random.Random(9)
    rows = vectors(rng, 150, 4) + [(1000 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(200)]
    rng.shuffle(rows)
    monkeypatch.setattr(topk, "QUERIES", 20)
    assert search(spark, rows, k=7) == by_hand(rows, 7, 64, 5)


def test_rough_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (5, None), (10, []), (15, [nan, 1.0]), (20, [inf, 1.0]), (25, [None, 1.0]), (None, [9.0, 9.0]),
            (30, [1.0]), (31, [-3.0, 0.25]), (32, [0.0, 0.0]), (32, [0.0, 0.0]), (33, [2.0, 2.0]), (33, [1.0, 9.0])]
    assert search(spark, rows, k=9) == by_hand(rows, 9, 64, 5)
    assert search(spark, []) == [] and search(spark, [(1, [1.0])]) == []
    assert search(spark, [(5, [1.0])]) == []  # no other row
    assert search(spark, [(5, []), (6, [])]) == [(5, 1, 6, 0)]


def test_rows_of_one_id_are_rows_of_their_own(spark):
    rows = [(5, [1.0, 0.0]), (5, [1.0, 0.0]), (5, [0.0, 2.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (8, [-1.0, 0.0])]
    assert search(spark, rows, k=4) == by_hand(rows, 4, 64, 5)
    assert [r for r in search(spark, rows, k=4) if r[1] == 1] == [(5, 1, 5, 4096), (5, 1, 5, 4096), (5, 1, 7, 8192)]


def test_products_beyond_doubles(spark):
    rows = [(0, [3e7, 1.0]), (1, [3e7, 2.0]), (2, [3e7, 3.0]), (3, [1.0, 1.0])]
    assert search(spark, rows, k=3, scale=64) == by_hand([(i, [float(np.float32(x)) for x in v]) for i, v in rows], 3, 64, 5)


def test_scores_beyond_64_bits_are_held_at_the_ends(spark):
    rows = [(0, [1e10, 1e10]), (1, [1e10, 0.0]), (2, [-1e10, -1e10]), (3, [3e30, 1.0]), (4, [1.0, 1.0]), (5, [0.0, 2e7])]
    expected = by_hand([(i, [float(np.float32(x)) for x in v]) for i, v in rows], 4, 64, 5)
    assert search(spark, rows, k=4) == expected
    assert (0, 1, 1, 2**63 - 1) in expected and (0, 2, 3, 2**63 - 1) in expected
