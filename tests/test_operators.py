"""Operators against brute force, with hot keys forced onto the salted path."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from hearback.operators import audit, bloom, identity, names, quality, records, skew
from hearback.plans import recipes


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def skewed(n=400, seed=3):
    """A third of all rows on one key, some without a key."""
    rng = random.Random(seed)
    return [(i, "hot" if i % 3 == 0 else None if i % 10 == 1 else f"k{rng.randint(0, 20)}") for i in range(n)]


def test_spread_join_equals_a_plain_join(spark):
    left = spark.createDataFrame(skewed(), "i int, k string")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), ("zz", 4)], "k string, v int")
    for how in ("inner", "left", "left_semi"):
        cols = ["i", "k"] if how == "left_semi" else ["i", "k", "v"]
        got = skew.spread_join(left, right, ["k"], how, spread_by=["i"], hot_rows=50, salts=4)
        assert rows(got, *cols) == rows(left.join(right, "k", how), *cols)


def test_salts_follow_the_count_and_null_keys_spread(spark):
    data = [(i, "hot" if i < 900 else None if i < 1800 else "cold") for i in range(2000)]
    left = spark.createDataFrame(data, "i int, k string")
    right = spark.createDataFrame([("hot", 1), ("cold", 2), (None, 3)], "k string, v int")
    hot = skew.hot_keys(left, ["k"], 100)
    assert rows(hot, "k", "_n") == [("cold", 200), ("hot", 900)]
    for how in ("inner", "left", "left_semi"):
        got = skew.spread_join(left, right, ["k"], how, spread_by=["i"], hot_rows=100)
        cols = ["i", "k"] if how == "left_semi" else ["i", "k", "v"]
        assert rows(got, *cols) == rows(left.join(right, "k", how), *cols)


def test_only_the_hottest_keys_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_KEYS", 2)
    left = spark.createDataFrame([(f"k{i}",) for i in range(5) for _ in range(i + 1)], "k string")
    assert rows(skew.hot_keys(left, ["k"], 1), "k", "_n") == [("k3", 4), ("k4", 5)]
    right = spark.createDataFrame([(f"k{i}", i) for i in range(5)], "k string, v int")
    got = skew.spread_join(left, right, ["k"], "inner", spread_by=["k"], hot_rows=1)
    assert rows(got, "k", "v") == rows(left.join(right, "k"), "k", "v")


def test_hot_keys_are_bounded(spark):
    left = spark.createDataFrame(skewed(), "i int, k string")
    assert rows(skew.hot_keys(left, ["k"], 50), "k") == [("hot",)]


def test_keep_first(spark):
    data = [(2, "a", False), (1, "a", False), (3, "b", True), (4, "b", False), (5, "b", False)]
    df = spark.createDataFrame(data, "seq long, id string, blank boolean")
    got = records.mark_repeats(df, ["id"], "seq", counts=~F.col("blank"))
    assert rows(got, "seq", "is_repeat") == [(1, False), (2, True), (3, False), (4, False), (5, True)]


def test_reject_order(spark):
    df = spark.createDataFrame([(True, True), (False, True), (False, None)], "a boolean, b boolean")
    reason = records.reject_reason(("first", F.col("a")), ("second", F.col("b")))
    assert [r[0] for r in df.select(reason).collect()] == ["first", "second", None]


def test_reconcile_and_gate(spark):
    files = spark.createDataFrame([("f",), ("g",), ("empty",)], "file string")
    read = spark.createDataFrame([("f",), ("f",), ("g",)], "file string")
    one = spark.createDataFrame([("f",)], "file string")
    got = records.reconcile(files, read, one, one, ["file"])
    assert rows(got, "file", "rows_read", "rows_loaded", "rows_rejected", "ok") == [
        ("empty", 0, 0, 0, True), ("f", 2, 1, 1, True), ("g", 1, 0, 0, False),
    ]
    assert not records.all_ok(got)
    assert records.all_ok(got.filter("ok"))


def test_identity_map_with_a_hot_key(spark):
    rng = random.Random(5)
    seen = [(i, "hot" if i % 3 == 0 else f"k{rng.randint(0, 9)}", str(rng.randint(1, 40))) for i in range(600)]
    seen += [(1000, "hot", "abc"), (1001, None, "5"), (1002, "solo", "7")]
    df = spark.createDataFrame(seen, "seq long, user_key string, user_id string")
    counts, first = defaultdict(Counter), {}
    for seq, key, uid in seen:
        if key and uid.isdigit():
            counts[key][uid] += 1
            first.setdefault((key, uid), seq)
    want = []
    for key, ids in counts.items():
        best = min(ids, key=lambda u: (-ids[u], first[key, u]))
        want += [(key, u, n, u == best, len(ids) > 1) for u, n in ids.items()]
    for hot_rows in (5, 10_000):
        got = identity.identity_map(df, "seq", hot_rows=hot_rows)
        assert rows(got, "user_key", "user_id", "observations", "is_primary", "ambiguous") == sorted(want, key=repr)


def test_backfill(spark):
    items = spark.createDataFrame([(1, "a", None), (2, "a", "9"), (3, None, None), (4, "b", None)], "i int, user_key string, user_id string")
    primary = spark.createDataFrame([("a", "1")], "user_key string, primary_id string")
    fill = identity.backfill_user_id(items, primary, ["i"], hot_rows=1)
    assert rows(fill, "i", "user_id") == [(1, "1"), (2, "9"), (3, None), (4, None)]
    over = identity.backfill_user_id(items, primary, ["i"], overwrite=True)
    assert rows(over, "i", "user_id") == [(1, "1"), (2, "1"), (3, None), (4, None)]


def test_roll_up_first_and_last_known(spark):
    data = [(1, "u", "b", None, None), (2, "u", "a", "x", "p1"), (3, "u", "b", "y", "p2"), (4, "u", "a", "z", None), (5, None, "a", "z", "p")]
    df = spark.createDataFrame(data, "seq long, k string, s string, audience string, plan string").withColumn("at", F.col("seq"))
    row = identity.roll_up(df, "k", "s", "at", ["seq"], {"audience": "audience"}, {"plan": "plan"}).collect()
    assert len(row) == 1
    assert row[0].asDict() == {
        "k": "u", "sources": ["a", "b"], "n_sources": 2, "evidence_items": 4, "first_seen": 1, "last_seen": 4,
        "audience": "x", "plan": "p2",
    }


TEXTS = [
    (1, "Hello Jane Doe and Jane\tDoe, JANE DOE"),
    (2, "Mary Poppins met Bob Stone"),
    (3, "Jane does nothing"),
    (4, "The Book of Thank Mary"),
]


def test_known_names_both_ways(spark):
    people = spark.createDataFrame([("Jane", "Doe"), ("Mary", ""), ("Bob K", "Stone"), ("The", "Book"), ("Jo", "")], "a string, b string")
    registry = names.name_registry(people.select(names.name_tokens(F.col("a"), F.col("b")).alias("tokens")))
    assert rows(registry, "kind", "value") == [
        ("first", "Bob"), ("first", "Jane"), ("first", "Mary"), ("first", "The"),
        ("full", "bob k stone"), ("full", "bob k"), ("full", "jane doe"), ("full", "the book"),
    ]
    df = spark.createDataFrame(TEXTS, "i int, t string")
    pairs = names.capital_pairs(F.col("t"))
    small = names.known_names(df, ["i"], pairs, registry, registry_rows=8)
    large = names.known_names(df, ["i"], pairs, registry, stage=lambda found: found, hot_rows=2)
    want = [
        (1, ["JANE DOE", "Jane\tDoe", "Jane Doe"], ["Jane"]),
        (2, [], ["Bob", "Mary"]),
        (4, ["The Book"], []),
    ]
    for got in (small, large):
        assert [(i, sorted(p), f) for i, p, f in rows(got, "i", "known_pairs", "known_firsts")] == [
            (i, sorted(p), f) for i, p, f in want
        ]


def test_bloom_keeps_every_key_and_little_else(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") % 3).alias("g"))
    other = spark.range(40_000).select(F.concat(F.lit("x"), "id").alias("k"), (F.col("id") % 3).alias("g"), F.lit(1).alias("_x"))
    mixed = keys.withColumn("_x", F.lit(0)).union(other).union(spark.sql("SELECT null, 1L, 2"))
    got = {r["_x"]: r["count"] for r in bloom.may_be_in(mixed, keys, ["k", "g"], 20_000).groupBy("_x").count().collect()}
    assert got[0] == 20_000 and got.get(1, 0) < 800 and 2 not in got
    assert bloom.may_be_in(mixed, keys.limit(0), ["k", "g"], 0).count() == 0
    # a full filter only lets more pass
    assert bloom.may_be_in(mixed, keys, ["k", "g"], 50).filter("_x = 0").count() == 20_000
    assert bloom.parts_for(10**12) == bloom.MOST_PARTS


def test_names_are_filtered_before_the_shuffle(spark):
    """What is written for the join are the hits and a few others, not every pair of capitals."""
    registry = spark.range(3000).select(F.lit("full").alias("kind"), F.concat(F.lit("ann"), F.lit(" smith"), "id").alias("value"))
    texts = spark.range(5000).select("id", F.concat(F.lit("Said Bob Jones and Ann Smith"), "id").alias("t"))
    kept = []

    def stage(df):
        kept.append(df.count())
        return df

    pairs = F.array(F.lit("Said Bob"), F.lit("Bob Jones"), F.concat(F.lit("Ann Smith"), "id"), F.concat(F.lit("Eve Smith"), "id"))
    found = names.known_names(texts, ["id"], pairs, registry, stage=stage)
    assert found.count() == 3000 and 3000 <= kept[0] < 3400


def test_leaks(spark):
    registry = spark.createDataFrame([("full", "jane doe"), ("full", "jo b"), ("first", "Jane")], "kind string, value string")
    table = spark.createDataFrame(
        [("a@b.com and c@ours.test", ["555-123-4567", "Jane Doe Jane Doe"], 1), (None, ["1234 5678 9012 3456"], 2)],
        "t string, l array<string>, n int",
    )
    got = audit.check_leaks({"x": table}, registry, ["ours.test"])
    assert rows(got, "where", "kind", "n") == [
        ("x.l", "full_name", 2), ("x.l", "long_number", 1), ("x.l", "phone", 1), ("x.t", "email", 1),
    ]


def test_drift(spark):
    now = spark.createDataFrame([("s", "a"), ("s", "c"), ("new", "x"), ("sprig", "Q9_Response"), ("lyssna", "n")], "source string, column string")
    old = spark.createDataFrame([("s", "a"), ("s", "b"), ("gone", "y"), ("sprig", "k"), ("lyssna", "m")], "source string, column string")
    got = quality.schema_drift(now, old, ["source"], quality.expected_drift())
    assert rows(got, "source", "column", "change") == [("s", "b", "lost"), ("s", "c", "new"), ("sprig", "k", "lost")]


def test_said_before_equals_the_pairwise_join(spark):
    rng = random.Random(2)
    key = lambda: "hot" if rng.random() < 0.4 else f"u{rng.randint(0, 9)}"
    outcomes = spark.createDataFrame([(key(), rng.randint(0, 50)) for _ in range(60)], "k string, at int")
    items = spark.createDataFrame([(key(), rng.randint(0, 60), rng.choice("xyz")) for _ in range(120)], "k string, at int, g string")
    got = recipes.said_before(outcomes, items, "k", "at", "at", ["g"])
    o = outcomes.withColumnRenamed("at", "o_at")
    want = items.join(o, "k").filter("at < o_at").groupBy("g").agg(F.count_distinct("k").alias("people"))
    assert rows(got, "g", "people") == rows(want, "g", "people")


def test_names_are_masked_as_without_the_guard(spark):
    """The guard skips names a text does not hold; letters that fold to ASCII are no exception."""
    from hearback.functions import masks

    texts = ["ANN met Kurt", "Kurt", "an ınn and an İnn", "boſs Boss", "Straße STRASSE", "nobody", "", "éVA Éva", "a.b* x"]
    found = ["Ann", "Kurt", "inn", "boss", "straße", "éva", "a.b*", "İnn"]
    df = spark.createDataFrame([(t, found) for t in texts], "t string, names array<string>")
    got = [r[0] for r in df.select(masks.mask_each(F.col("t"), F.col("names"))).collect()]
    plain = F.col("t")
    for name in found:
        plain = F.regexp_replace(plain, "(?iu)" + masks.START + "\\Q" + name + "\\E" + masks.END, masks.MASK)
    assert got == [r[0] for r in df.select(plain).collect()]
    strict = df.select(masks.mask_each(F.col("t"), F.col("names"), flags="")).collect()
    assert strict[0][0] == "ANN met [name]"
