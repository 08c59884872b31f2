"""Phrase collocations against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from hearback.llm import phrases
from hearback.llm.common import workspace

from .conftest import documents


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain(rows, least, width=4, top=2000, scale=2_000_000, share=80):
    """Rows (text, lang) to the result's rows, sorted."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, width + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    found = {}
    for (lang, words), a in f.items():
        if len(words) > 1 and a >= least:
            cuts = [(scale * a // (f[lang, words[:k]] + f[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            found[lang, words] = (a, f[lang, words[:k]], f[lang, words[k:]], score)
    drop = set()
    for (lang, words), (longer, *_) in found.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                inner = (lang, words[i : i + size])
                if 100 * longer >= share * found[inner][0]:
                    drop.add(inner)
    rows = []
    for lang in n:
        own = [(-s, -a, " ".join(w).encode(), a, l, r, s) for (g, w), (a, l, r, s) in found.items() if g == lang and (g, w) not in drop]
        for rank, (_, _, phrase, a, l, r, s) in enumerate(sorted(own)[:top], 1):
            rows.append((lang, rank, phrase.decode(), a, l, r, n[lang], s))
    return sorted(rows)


def found(docs, **more):
    return sorted(tuple(r) for r in phrases.collocations(docs, **more).collect())


def texts(docs):
    return [(r["text"], r["lang"]) for r in docs.select("text", "lang").collect()]


@pytest.fixture(scope="module")
def babble(spark):
    rng = random.Random(3)
    vocabulary = ["The", "cat", "dogs", "É", "run", "fast", "日本", "a-b", "x y", "\x00z", "of"]
    rows = []
    for i in range(120):
        words = rng.choices(vocabulary, [30, 9, 8, 7, 6, 5, 5, 4, 3, 2, 20], k=rng.randrange(0, 60))
        ends = rng.choices([" ", "  ", "\t", ". ", ",", "\n", "\r\n", "!?"], [60, 4, 4, 6, 3, 3, 2, 2], k=len(words))
        rows.append((i, "".join(w + e for w, e in zip(words, ends)), rng.choice(["en", "fr", None, "und"]), "s"))
    return documents(spark, rows + rows[:7])


def test_against_plain_counting(babble):
    for least in (2, 5, 30):
        assert found(babble, least=least) == plain(texts(babble), least)
    assert found(babble, least=2, width=3, top=7, share=60) == plain(texts(babble), 2, 3, 7, share=60)


def test_rough_rows(rough, nothing):
    assert found(rough, least=2) == plain(texts(rough), 2)
    assert found(nothing) == []
    with pytest.raises(ValueError):
        phrases.collocations(rough, width=5)


def test_a_full_filter_changes_nothing(babble, monkeypatch):
    monkeypatch.setattr(phrases, "pair_filter", lambda *a, **k: np.full(4096, 255, dtype=np.uint8))
    assert found(babble, least=4) == plain(texts(babble), 4)


def test_hot_parts_and_small_slices(babble, monkeypatch):
    monkeypatch.setattr(phrases, "HOT_ROWS", 3)
    monkeypatch.setattr(phrases, "SLICE", 200)
    assert found(babble, least=3) == plain(texts(babble), 3)


def test_products_past_64_bits(spark):
    big = 4 * 10**18
    rows = [("en", "a b", 2, big - 1), ("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "a b c", 3, 7), ("en", "c", 1, 9), ("en", "b c", 2, 8)]
    counts = spark.createDataFrame(rows, "lang string, phrase string, size int, f long")
    got = {r["phrase"]: (r["l"], r["r"], r["score"]) for r in phrases.scored(counts, 4, 2_000_000, workspace(spark)).collect()}
    assert got["a b"] == (big, big + 1, 2_000_000 * (big - 1) // (2 * big + 1))
    assert got["a b c"] == (big, 8, 0)  # both cuts score 0: the first one


def test_pieces_end_with_texts():
    import pyarrow as pa

    words, follows, owner = phrases.split_pieces(pa.array(["a b", "c. D\te", "", "f"], pa.large_string()))
    assert words.to_pylist() == ["a", "b", "c", "d", "e", "f"]
    assert follows.tolist() == [True, False, False, True, False, False] and owner.tolist() == [0, 0, 1, 1, 1, 3]
