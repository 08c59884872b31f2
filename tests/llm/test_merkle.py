"""Merkle manifest against a plain tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from hearback.llm import merkle

from .conftest import EXTRA, documents


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tower(hashes, arity):
    levels = [hashes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h(*now[i : i + arity]) for i in range(0, len(now), arity)])
    return levels


def way(levels, at, arity):
    for now in levels[:-1]:
        run = at - at % arity
        yield "".join(now[run:at]), "".join(now[at + 1 : run + arity])
        at //= arity


def tampered(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0


def plain(rows, arity=2):
    """Rows (doc_id, source, lang, n_chars, text) to the manifest's rows, sorted."""
    groups = {}
    for row in rows:
        more = None if row[3] is None else row[3] + 1
        own = (row[0] is not None, row[0] or 0, leaf(*row), leaf(*row[:3], more, row[4]) if tampered(row[0]) else leaf(*row))
        groups.setdefault("" if row[2] is None else "=" + row[2], []).append(own)
    order = sorted(groups, key=str.encode)
    trees = {g: tower([x[2] for x in sorted(groups[g])], arity) for g in order}
    top = tower([trees[g][-1][0] for g in order], arity) if order else []
    made = []
    for n, g in enumerate(order):
        for at, (named, doc_id, own, given) in enumerate(sorted(groups[g])):
            steps = [*way(trees[g], at, arity), *way(top, n, arity)]
            folded = given
            for a, b in steps:
                folded = h(a, folded, b)
            made.append((doc_id if named else None, g, at, own, trees[g][-1][0], top[-1][0], h(*(a + b for a, b in steps)), folded, folded == top[-1][0]))
    return sorted(made, key=repr)


def found(docs, **more):
    altered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return sorted((tuple(r) for r in merkle.manifest(docs, altered, **more).collect()), key=repr)


def given(docs):
    return [tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_rough_rows(spark, rough, nothing):
    assert set(EXTRA) <= set(rough.columns)
    assert found(rough, span=1) == plain(given(rough))
    assert found(rough) == plain(given(rough))
    assert found(nothing) == []


@pytest.mark.parametrize("arity, span", [(2, 2), (3, 1), (2, 10)])
def test_many_ids_nulls_and_repeats(spark, arity, span):
    rng = random.Random(7)
    ids = [*range(-40, 40), *(rng.randrange(-(2**63), 2**63) for _ in range(60)), 2**63 - 1, -(2**63), 32767, 32768, 65536]
    rows = [(i, f"text {i}", rng.choice(["en", "de", None, "", "日"]), "s") for i in ids]
    rows += [(None, f"nameless {i}", "en", "s") for i in range(30)] + [(7, f"other {i}", "en", "s") for i in range(25)]
    rows += [rows[3]] * 9 + [(None, "same", None, None)] * 11 + [(5, None, "en", None)]
    docs = documents(spark, rows)
    assert found(docs, arity=arity, span=span) == plain(given(docs), arity)


def test_one_hot_id_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(merkle, "COPIES", 16)
    docs = spark.range(400).select(
        F.when(F.col("id") < 200, F.lit(9)).otherwise(F.col("id")).cast("long").alias("doc_id"),
        F.when(F.col("id") < 100, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text"),
        F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(2**63 - 1).cast("long").alias("n_chars"),
    )
    assert found(docs, span=3) == plain(given(docs))


def test_bad_shape(rough):
    with pytest.raises(ValueError):
        merkle.manifest(rough, arity=1)
