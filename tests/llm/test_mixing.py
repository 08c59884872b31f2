import random
from collections import Counter

from pyspark.sql import functions as F

from hearback.llm import mixing

MIX = mixing.Mix(
    "CASE WHEN source IN ('a', 'b') THEN 'x' ELSE 'y' END",
    {"domain": "CASE domain WHEN 'x' THEN 3 ELSE 1 END", "lang": "CASE lang WHEN 'en' THEN 2 ELSE 1 END", "source": "1"},
    max_epochs=2,
)


def water(purse, children):
    """Tokens of each child (name, weight, capacity), filling the fullest first; fractions."""
    left, open_ = purse, {n: (w, c) for n, w, c in children if w > 0}
    dealt = {n: 0.0 for n, _, _ in children}
    while open_:
        level = left / sum(w for w, _ in open_.values())
        full = [n for n, (w, c) in open_.items() if c <= level * w]
        if not full:
            dealt.update({n: level * w for n, (w, _) in open_.items()})
            break
        for n in full:
            dealt[n] = open_.pop(n)[1]
            left -= dealt[n]
    return dealt


def test_deal_against_filling_by_hand(spark):
    rng = random.Random(3)
    for _ in range(6):
        children = [(f"c{i}", rng.choice([0, 1, 2, 5, 9]), rng.randrange(0, 5000)) for i in range(7)]
        purse = rng.randrange(0, 20_000)
        nodes = spark.createDataFrame([(*c, purse) for c in children], "child string, weight long, capacity long, purse long")
        got = {r["child"]: r["budget"] for r in mixing.deal(nodes, [], "child").collect()}
        want = water(purse, children)
        assert all(abs(got[n] - want[n]) <= 1 for n in want)
        most = sum(c for _, w, c in children if w > 0)
        assert sum(got.values()) == min(purse, most)


def test_shortage_goes_to_siblings_before_ancestors(spark):
    leaves = spark.createDataFrame(
        [("x", "en", "a", 100, 1), ("x", "de", "b", 10_000, 1), ("y", "en", "c", 10_000, 1)],
        "domain string, lang string, source string, supply long, n_docs long",
    )
    mix = mixing.Mix("''", {"domain": "1", "lang": "1", "source": "1"}, budget=4000, max_epochs=1)
    got = {r["source"]: r["budget"] for r in mixing.budgets(leaves, mix).collect()}
    assert got == {"a": 100, "b": 1900, "c": 2000}  # y keeps its half


def test_leaf_takes_whole_epochs_and_a_prefix(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 7 + 1), "en", "a") for i in range(300)], "doc_id long, text string, lang string, source string")
    supply = sum(i % 7 + 1 for i in range(300))
    mix = mixing.Mix("'d'", {"domain": "1", "lang": "1", "source": "1"}, budget=supply + 100, max_epochs=3, seed=5)
    rows = mixing.mix_sources(docs, mix).collect()
    times = Counter(r["epoch"] for r in rows)
    assert times[0] == 300 and 0 < times[1] < 300 and set(times) == {0, 1}
    assert sum(r["taken"] for r in rows) == supply + 100
    assert {r["doc_id"] for r in rows if r["epoch"] == 0} == set(range(300))
    other = mixing.mix_sources(docs, mixing.Mix("'d'", mix.weights, supply + 100, 3, seed=6))
    assert {r["doc_id"] for r in rows if r["epoch"] == 1} != {r["doc_id"] for r in other.filter("epoch = 1").collect()}


def test_rough_rows(rough, nothing):
    rows = mixing.mix_sources(rough, MIX).collect()
    assert rows and all(r["taken"] <= r["n_tokens"] for r in rows)
    assert {r["epoch"] for r in rows} <= {0, 1}
    total = rough.agg(F.sum(mixing.token_count(F.col("text")))).first()[0]
    assert sum(r["taken"] for r in rows) <= total
    assert mixing.mix_sources(nothing, MIX).collect() == []


def test_rows_without_tokens_only(spark):
    docs = spark.createDataFrame([(1, None, "en", "a"), (2, "", "en", "a")], "doc_id long, text string, lang string, source string")
    assert mixing.mix_sources(docs, MIX).collect() == []


def test_leaves_of_no_weight_lend_no_capacity(spark):
    """What a node's leaves without weight could hold is no capacity: its siblings take the budget."""
    leaves = spark.createDataFrame(
        [("x", "en", "a", 100, 1), ("x", "en", "b", 100, 1), ("y", "en", "c", 200, 1), ("y", "de", "c", 500, 1), ("z", "en", "c", 70, 1)],
        "domain string, lang string, source string, supply long, n_docs long",
    )
    weights = {"domain": "CASE WHEN domain = 'z' THEN null ELSE 1 END", "lang": "CASE lang WHEN 'de' THEN 0 ELSE 1 END", "source": "CASE source WHEN 'a' THEN 0 ELSE 1 END"}
    mix = mixing.Mix("''", weights, budget=300, max_epochs=1)
    got = {(r["domain"], r["lang"], r["source"]): r["budget"] for r in mixing.budgets(leaves, mix).collect()}
    assert got == {("x", "en", "a"): 0, ("x", "en", "b"): 100, ("y", "en", "c"): 200, ("y", "de", "c"): 0, ("z", "en", "c"): 0}


def test_the_cut_is_found_in_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 3)
    monkeypatch.setattr(mixing, "WIDE", 2)
    docs = spark.createDataFrame([(i, "w " * (i % 7), "en", "a") for i in range(200)], "doc_id long, text string, lang string, source string")
    for budget in (1, 99, 433, 591):
        mix = mixing.Mix("'d'", {"domain": "1", "lang": "1", "source": "1"}, budget=budget, max_epochs=1)
        rows = mixing.mix_sources(docs, mix).collect()
        order = sorted(range(200), key=lambda i: __import__("hashlib").md5(f"17:0:{i}".encode()).hexdigest())
        want, left = {}, budget
        for i in order:
            if left <= 0:
                break
            want[i] = min(left, i % 7)
            left -= want[i]
        assert {r["doc_id"]: r["taken"] for r in rows} == want
