import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hearback.llm import queries, toxicity

from .conftest import documents

CLEAN = "the house under water light from there with that this green river stone walks slowly home again today".split()
BAD = ["idiot", "moron", "worthless", "scum"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(900):
        words = [rng.choice(CLEAN) for _ in range(rng.randrange(8, 40))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            words[rng.randrange(len(words))] = rng.choice(BAD)
        rows.append((i, " ".join(words), "en", "a"))
        labels.append((i, toxic))
    rows += [(2000 + i, " ".join(CLEAN + BAD), "en", "a") for i in range(40)]
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")


@pytest.fixture(scope="module")
def model(data):
    return toxicity.fit(*data)


def best_by_hand(places, model):
    """Score of the best reading, trying all."""
    def total(readings):
        a = b = toxicity.START
        score = 0.0
        for text, cost in readings:
            score += cost
            for c in text:
                score += model.log(a, b, c)
                a, b = (toxicity.START, toxicity.START) if c == toxicity.END else (b, c)
        return score + (0 if b == toxicity.START else model.log(a, b, toxicity.END))

    return max(itertools.product(*places), key=total)


def test_viterbi_against_all_readings(model):
    for token in ["1d10t", "m0r0n", "sc*m", "i d i o t", "w0rth1ess", "idiiiot", "$cum", "5tone", "a-b-c"]:
        places = toxicity.lattice(token)
        best = "".join(t for t, _ in best_by_hand(places, model.characters))
        assert toxicity.viterbi(places, model.characters) == [w for w in best.split(toxicity.END) if w], token


@pytest.mark.parametrize(
    "disguise", ["idi0t", "1diot", "i d i o t", "idiiiiot", "m0r0n", "m-o-r-o-n", "$cum", "w0rthl3ss", "MORON!!", "i.d.i.o.t", "sc*m", "mooooron"]
)
def test_disguised_words_are_found(spark, model, disguise):
    docs = documents(spark, [(1, f"the green house {disguise} walks slowly home", "en", "a"), (2, "the green house walks slowly home", "en", "a")])
    score = {r["doc_id"]: r["score"] for r in toxicity.add_score(docs, model).collect()}
    assert score[1] > 0.5 > score[2]


@pytest.mark.parametrize("disguise", ["morron", "idiiot", "scuum", "MORRON!!", "mor-on", "m0r.on", "id_iot", "wor-th-less", "(scuum)", "mo-0-r-on"])
def test_doubled_letters_and_marks_inside_are_read(model, disguise):
    words = toxicity.restore(disguise.lower(), model.characters)
    assert words in ([bad] for bad in BAD)


def test_what_is_written_stays(model):
    for token in ["green", "green,", "worthless", "green-river", "stone/house", "under_water", "light-2024-from", "walks-7-home"]:
        assert toxicity.restore(token, model.characters) == [w for w in re.split(r"[\W\d_]+", token) if w], token
    words = toxicity.restore("ab-1" * 3000, model.characters)  # many marks take time in proportion
    assert words and "".join(words).isalpha()


def test_plain_text_is_left_alone(model):
    for token in ["house", "the***", "green!!", "(river),", "1234", "", "--", "$$$", "a1b2c3d4"]:
        words = toxicity.restore(token, model.characters)
        assert "".join(words).isalpha() or words == []
    assert toxicity.restore("the***", model.characters) == ["the"]


def test_spelled_runs_end_with_their_text():
    words, starts = toxicity.split_words(pa.array(["a b", "c d e", "x", "f g h i"], pa.large_string()))
    runs, owners = toxicity.spelled(words, starts)
    assert (runs, owners.tolist()) == (["c d e", "f g h i"], [1, 3])


def test_copies_make_no_features(spark, model):
    assert {f.strip("=^")[:3] for f, _ in model.chance} <= {b[:3] for b in BAD}


def test_copies_count_once(spark, data):
    docs, labels = data
    copies = [(5000 + i, "this one text is copied moron", "en", "a") for i in range(1500)]
    more = spark.createDataFrame([(c[0], 1) for c in copies], "doc_id long, toxic int")
    characters = toxicity.learn_characters(docs)
    once = toxicity.learn(docs.union(documents(spark, copies[:1])), labels.union(more.limit(1)), characters)
    often = toxicity.learn(docs.union(documents(spark, copies)), labels.union(more), characters)
    assert often.base == pytest.approx(once.base) and often.chance == pytest.approx(once.chance)
    # a sample that does not hold all texts draws texts, not rows
    drawn = toxicity.learn(docs.union(documents(spark, copies)), labels.union(more), characters, rows=200)
    assert {f.strip("=^")[:3] for f, _ in drawn.chance} & {b[:3] for b in BAD}
    only = toxicity.learn(docs.union(documents(spark, copies)), labels.filter("toxic = 0").union(more), characters)
    assert only.chance == {} and only.base < 0.05


def test_rare_signs_on_a_rich_vocabulary(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("bcdfghklmnprstvw") + rng.choice("aeiou") for _ in range(5))
    common = [word() for _ in range(9000)]  # each three times in ten texts of both classes
    rows = [" ".join(w for w in common[i % 4 :: 4] for _ in range(3)) for i in range(40)]
    texts = [(i, t + (" zyqyx" if i in (0, 5, 10, 15, 20, 25) else ""), 1) for i, t in enumerate(rows)] + [(100 + i, t, 0) for i, t in enumerate(rows)]
    texts = [(i, t + f" n{'abcdefghij'[i // 10 % 10]}{'abcdefghij'[i % 10]}", k) for i, t, k in texts]  # no copies
    docs = documents(spark, [(i, t, "en", "a") for i, t, _ in texts])
    labels = spark.createDataFrame([(i, k) for i, _, k in texts], "doc_id long, toxic int")
    learned = toxicity.learn(docs, labels, toxicity.CharModel(np.zeros(0, dtype=np.int64), np.zeros(0)))
    assert ("=zyqyx", 1) in learned.chance


def test_rough_rows(spark, rough, nothing, data, model):
    rows = toxicity.add_score(rough, model).collect()
    assert len(rows) == rough.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert all(abs(r["score"] - model.base) < 1e-9 for r in rows if not (r["text"] or "").strip())
    assert all(r["score"] > 0.9 for r in rows if r["doc_id"] == 4)
    assert toxicity.add_score(nothing, model).collect() == []
    labels = data[1]
    for docs, known in ((nothing, labels), (data[0], labels.filter("toxic = 0")), (data[0], labels.limit(0)), (data[0], labels.withColumn("toxic", F.lit(None).cast("int")))):
        empty = toxicity.fit(docs, known)
        assert empty.chance == {}
        assert toxicity.add_score(rough, empty).agg(F.max("score")).first()[0] <= 0.5


def test_query(spark, small):
    found = queries.QUERIES["op9_toxicity"](spark, small)
    assert found.count() == spark.read.parquet(f"{small}/documents.parquet").count()
    assert found.filter("predicted <> cast(score >= 0.5 as int)").count() == 0


def test_repeated_letters_are_read_as_by_the_search(model):
    rng = random.Random(5)
    for _ in range(400):
        word = "".join(rng.choice("idotmrns") * rng.choice([1, 1, 2, 2, 3, 4]) for _ in range(rng.randrange(1, 7)))
        assert [toxicity.undouble(word, model.characters)] == toxicity.viterbi(toxicity.lattice(word), model.characters), word


def test_trigrams_are_counted_exactly(spark):
    """Many alphabets: no two trigrams share a count."""
    words = ["".join(chr(0x4E00 + (i * k) % 9000) for k in (1, 7, 13)) for i in range(3000)]
    docs = documents(spark, [(0, " ".join(words), "zh", "a"), (1, " ".join(words[:100]), "zh", "a"), (2, None, None, None)])
    found = toxicity.learn_characters(docs)
    for i in (3, 50, 150, 2999):
        of = sum(w.startswith(words[i][:2]) * (2 if n < 100 else 1) for n, w in enumerate(words))
        n = sum((w == words[i]) * (2 if k < 100 else 1) for k, w in enumerate(words))
        assert abs(found.log(*words[i]) - __import__("math").log((n + 0.05) / (of + 5.0))) < 1e-9
