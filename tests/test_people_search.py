"""Tables bucketed by person and the trigram index of texts."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hearback.plans import recipes
from hearback.sources import people, search


def exchanges(df):
    """Keys that the plan's shuffles deal by."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("hashpartitioning(")[1].split(",")[0] for line in plan.splitlines() if "hashpartitioning(" in line]


def items(spark, n=400):
    rng = random.Random(4)
    start = dt.datetime(2026, 7, 1)
    rows = [
        (None if rng.random() < 0.1 else "hot" if rng.random() < 0.4 else f"u{rng.randrange(60)}", rng.choice("abc"),
         "user", rng.choice([["price"], ["price", "app"], []]), start + dt.timedelta(hours=rng.randrange(900)))
        for _ in range(n)
    ]
    return rows, spark.createDataFrame(rows, "user_key string, source string, population string, areas array<string>, at timestamp_ntz")


@pytest.fixture()
def acted(spark, tmp_path):
    rows, df = items(spark)
    people.write_bucketed(people.activity(df, "user_key", ["source", "population", "areas"], "at"), f"{tmp_path}/it's", "activity", "user_key", 6)
    before = {t.name for t in spark.catalog.listTables()}
    read = people.read_bucketed(spark, f"{tmp_path}/it's", "activity")
    assert {t.name for t in spark.catalog.listTables()} == before
    return rows, read


@pytest.fixture()
def unbroadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_questions_need_no_shuffle_by_person(spark, acted, unbroadcast):
    rows, table = acted
    a, b = table.filter("source = 'a'"), table.filter("source = 'b'")
    journey = recipes.said_before(a, b, "user_key", "last_at", "first_at", ["source"])
    both = recipes.people_in_both(a, b, "user_key")
    rate = recipes.match_rate(table, b, "user_key", ["source"], "n")
    area = recipes.area_across_sources(table, "price", "n")
    for asked in (journey, both, rate, area):
        assert all(not key.startswith("user_key") for key in exchanges(asked)), exchanges(asked)
    loose = table.repartition(3)
    assert any(key.startswith("user_key") for key in exchanges(recipes.people_in_both(loose, loose, "user_key")))

    of = {s: {r[0] for r in rows if r[1] == s and r[0]} for s in "abc"}
    assert both.first()["people"] == len(of["a"] & of["b"])
    earlier = {r[0] for r in rows for x in rows if r[1] == "b" and x[1] == "a" and r[0] and r[0] == x[0] and r[4] < x[4]}
    assert [(r["source"], r["people"]) for r in journey.collect()] == [("b", len(earlier))]
    got = {r["source"]: (r["members"], r["matched"]) for r in rate.collect()}
    assert got == {s: (sum(r[1] == s for r in rows), sum(r[1] == s and r[0] in of["b"] for r in rows)) for s in "abc"}
    got = {r["source"]: (r["n"], r["people"]) for r in area.collect()}
    mine = {s: [r for r in rows if r[1] == s and "price" in r[3]] for s in "abc"}
    assert got == {s: (len(of), len({r[0] for r in of if r[0]})) for s, of in mine.items()}


def test_a_person_of_many_items_is_few_rows(spark, acted):
    rows, table = acted
    assert table.filter("user_key = 'hot'").count() <= 9  # sources and areas
    assert table.agg(F.sum("n")).first()[0] == len(rows)


def test_no_such_bucketed_table(spark, acted, tmp_path):
    with pytest.raises(FileNotFoundError):
        people.read_bucketed(spark, f"{tmp_path}/it's", "other")


TEXTS = ["", None, "ab", "Straße ÖL über", "ΟΔΟΣ", "50%_off", "back\\slash", "line\nbreak here", "😀😀😀 smile", "İstanbul"]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rng = random.Random(8)
    words = "alpha beta gamma delta refund price cancel licence".split()
    rows = [(i, " ".join(rng.choice(words) for _ in range(6)), "x") for i in range(200)]
    rows += [(200 + i, t, "y") for i, t in enumerate(TEXTS)] + [(300 + i, "the same row", "x") for i in range(100)]
    base = f"{tmp_path_factory.mktemp('index')}/one"
    df = spark.createDataFrame(rows, "id long, body string, block string")
    search.build_index(df, base, "body", [F.desc("id")], block_rows=20)
    return rows, df, base


@pytest.mark.parametrize("needle", [
    "refund", "ALPHA BETA gam", "ß", "straSSe", "öl Ü", "οδο", "οδος", "50\\%\\_o", "a%z", "cancel%refund", "k\\\\s", "e\nb", "😀😀😀", "İst", "i̇st",
    "the same", "nothing of this", "", "%", "ab", "ice_ce",
])
def test_index_finds_what_a_scan_finds(spark, index, needle):
    _, df, base = index
    near = search.rows_near(spark, base, needle)
    assert near.columns == df.columns
    want = df.filter(F.col("body").ilike(f"%{needle}%"))
    assert sorted(near.filter(F.col("body").ilike(f"%{needle}%")).collect()) == sorted(want.collect())


def test_only_blocks_that_may_hold_the_needle_are_read(spark, index, monkeypatch):
    rows, _, base = index
    assert len(search.rows_near(spark, base, "smile").inputFiles()) == 1
    assert search.rows_near(spark, base, "nothing of this").inputFiles() == []
    same = search.rows_near(spark, base, "the same row")
    assert 5 <= len(same.inputFiles()) <= 7  # a hundred equal rows, dealt over blocks of twenty
    monkeypatch.setattr(search, "FEW_BLOCKS", 2)
    joined = search.rows_near(spark, base, "the same row")
    assert sorted(joined.collect()) == sorted(same.collect())
    assert "dynamicpruning" in joined._jdf.queryExecution().executedPlan().toString()


def test_stretches():
    assert search.stretches("%ab%c_d\\%e%") == ["ab", "c", "d%e"]
    assert search.stretches("%%") == [] and search.stretches("\\") == []


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "id long, body string")
    search.build_index(df, f"{tmp_path}/none", "body", [F.desc("id")])
    assert search.rows_near(spark, f"{tmp_path}/none", "refund").collect() == []
