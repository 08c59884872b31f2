import random
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from hearback.llm import language
from hearback.llm import queries

WORDS = {
    "en": "the of and that this with from there house water under light".split(),
    "de": "der die und nicht eine haus wasser unter licht über schön straße".split(),
    "el": "και το της που είναι νερό σπίτι φως κάτω από ένα".split(),
}


def texts(rng, lang, n):
    return [" ".join(rng.choice(WORDS[lang]) for _ in range(rng.randrange(5, 40))) for _ in range(n)]


def sample(spark, n=60):
    rng = random.Random(5)
    rows = [(t, lang) for lang in WORDS for t in texts(rng, lang, n)]
    return rows, spark.createDataFrame(rows, "text string, lang string")


def plain_grams(text):
    """n-grams by hand: letters of the lower-cased text, one gap between words and at the ends."""
    line = "".join(c if c.isalpha() else " " for c in text.lower())
    line = " " + " ".join(line.split()) + " "
    return [] if not line.strip() else [line[i : i + language.N] for i in range(max(1, len(line) - language.N + 1))]


def test_ngrams_against_strings():
    letters = language._letters()
    cases = ["", "a", "ab", " Ab, cd! ", "日本 x", "1 2 3", "straße—Öl\n", "é" * 9, "x9y"]
    hashed, first = language.ngrams(pa.array(cases, pa.large_string()), letters)
    one = {}
    for i, case in enumerate(cases):
        grams = plain_grams(case)
        got = hashed[first[i] : first[i + 1]].tolist()
        if 0 < len(case.strip()) and len(grams) == 1 and len(grams[0]) < language.N:
            assert len(got) == 1  # a text shorter than an n-gram is one
            continue
        assert len(got) == len(grams), case
        for g, h in zip(grams, got):
            assert one.setdefault(g, h) == h
    assert len(set(one.values())) == len(one)


def test_filters_hold_what_counting_by_hand_finds(spark):
    rows, labelled = sample(spark)
    filters = language.learn(labelled)
    assert sorted(filters.languages) == sorted(WORDS)
    counts = {lang: Counter(g for t, of in rows if of == lang for g in plain_grams(t)) for lang in WORDS}
    totals = {lang: sum(c.values()) for lang, c in counts.items()}
    letters = language._letters()
    for gram in {g for c in counts.values() for g in c}:
        most = max(c[gram] / totals[lang] for lang, c in counts.items())
        hashed, _ = language.ngrams(pa.array([gram.strip()]), letters)
        if len(gram.strip()) != language.N:
            continue
        hashed = hashed[1:2]  # without the gaps
        masks = None
        for at in language.probes(hashed, len(filters.words)):
            masks = filters.words[at] if masks is None else masks & filters.words[at]
        for i, lang in enumerate(filters.languages):
            n = counts[lang][gram]
            if n >= language.LEAST and n / totals[lang] >= language.SHARE * most * 1.01:
                assert int(masks[0, 0]) >> i & 1


def test_held_out_texts(spark):
    _, labelled = sample(spark)
    rng = random.Random(9)
    fresh = [(t, lang) for lang in WORDS for t in texts(rng, lang, 30)]
    found = language.predict(spark.createDataFrame(fresh, "text string, lang string"), language.learn(labelled)).collect()
    assert all(r["lang_pred"] == r["lang"] and 0.5 < r["score"] <= 1 for r in found)


def test_more_ngrams_than_the_filter_holds(spark, monkeypatch):
    """A language of many n-grams keeps its most frequent ones and is still told, as are the others."""
    rng = random.Random(11)
    signs = [chr(0x4E00 + i) for i in range(60)]
    common = ["".join(rng.choice(signs) for _ in range(6)) for _ in range(40)]
    rare = ["".join(rng.choice(signs) for _ in range(6)) for _ in range(30_000)]
    line = lambda: " ".join(rng.choice(common if rng.random() < 0.5 else rare) for _ in range(30))
    rows = sample(spark)[0] + [(" ".join(rare[i : i + 50]), "zh") for i in range(0, 30_000, 50)] * 3 + [(line(), "zh") for _ in range(300)]
    monkeypatch.setattr(language, "FILTER_BYTES", 1 << 16)
    filters = language.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert filters.words.dtype.itemsize == 1 and len(filters.words) == 1 << 16
    assert filters.false_share.max() < 0.2  # half full at most; all of them would fill it
    fresh = [(line(), "zh") for _ in range(40)] + [(t, lang) for lang in WORDS for t in texts(rng, lang, 20)]
    found = language.predict(spark.createDataFrame(fresh, "text string, lang string"), filters).collect()
    assert all(r["lang_pred"] == r["lang"] for r in found)


def test_many_languages(spark):
    rng = random.Random(12)
    rows = []
    for i in range(70):  # more than one mask of 64 bits
        words = ["".join(chr(0x1000 + i * 20 + rng.randrange(20)) if rng.random() < 0.9 else "a" for _ in range(5)) for _ in range(8)]
        words = [w if any(chr(c).isalpha() for c in map(ord, w)) else "abcd" for w in words]
        rows += [(" ".join(rng.choice(words) for _ in range(12)), f"l{i:02}") for _ in range(8)]
    filters = language.learn(spark.createDataFrame(rows, "text string, lang string"))
    assert filters.words.dtype.itemsize == 8 and filters.words.shape[1] == 2


def test_kept_levels():
    assert language.kept_levels({3: 10, 5: 4}, 14) == (None, 1.0)
    assert language.kept_levels({3: 10, 5: 4}, 9) == (3, 0.5)
    assert language.kept_levels({3: 10, 5: 4}, 2) == (5, 0.5)


def test_rough_rows(spark, rough, nothing):
    filters = language.learn(rough)
    rows = language.predict(rough, filters).collect()
    assert len(rows) == rough.count()
    for r in rows:
        assert 0 <= r["score"] <= 1
        assert (r["lang_pred"] == language.UNKNOWN) == (not any(c.isalpha() for c in r["text"] or ""))
    assert language.learn(nothing) is None
    assert {r["lang_pred"] for r in language.predict(rough, None).collect()} == {language.UNKNOWN}
    assert language.predict(nothing, filters).collect() == []


def test_query(spark, small):
    found = queries.QUERIES["op3_language_id"](spark, small)
    docs = spark.read.parquet(f"{small}/documents.parquet")
    joined = found.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right = joined.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert found.count() == docs.count() and right >= 0.95
