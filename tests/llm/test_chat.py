import random

from hearback.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, pos long, part int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, 7) for r in rows], SCHEMA)


def kept(spark, rows, part=chat.PART):
    out = {}
    for r in sorted(chat.render(frame(spark, rows), part).collect(), key=lambda r: (r["conv_id"] is None, r["conv_id"], r["part"])):
        out.setdefault(r["conv_id"], []).append(r["text"])
    return out


def by_hand(rows):
    convs = {}
    for c, t, role, text in sorted(set(rows), key=lambda r: (str(r[0]), r[1])):
        convs.setdefault(c, []).append((role, text))
    stay = {}
    for c, turns in convs.items():
        longer = any(len(o) > len(turns) and o[: len(turns)] == turns for o in convs.values())
        first = min(k for k, o in convs.items() if o == turns)
        if not longer and c == first:
            stay[c] = "".join(f"<|im_start|>{role}\n{text}<|im_end|>\n" for role, text in turns)
    return stay


def test_against_comparing_all(spark):
    rng = random.Random(6)
    for _ in range(3):
        rows = []
        for c in range(60):
            n = rng.randrange(1, 6)
            base = rng.choice([0, 10])
            rows += [(c, base + t, rng.choice(["user", "user", "assistant"]), rng.choice(["a", "b"])) for t in range(n)]
        rows += rng.sample(rows, 20)  # repeated rows
        got = kept(spark, rows)
        assert {c: "".join(t) for c, t in got.items()} == by_hand(rows)


def test_one_conversation_over_many_partitions(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(3000)] + [(2, t, "user", f"t{t}") for t in range(2999)]
    rows += [(3, t, "user", f"t{t}" if t < 2998 else "other") for t in range(2999)]
    got = kept(spark, rows, part=100)
    assert sorted(got) == [1, 3] and len(got[1]) == 30
    assert "".join(got[1]) == "".join(f"<|im_start|>user\nt{t}<|im_end|>\n" for t in range(3000))


def test_nulls_and_nothing(spark):
    rows = [(None, 0, "user", "x"), (None, 1, None, None), (1, None, "user", "x"), (2, 0, "user", ""), (3, 0, "user", None), (4, 0, "user", "L" * 300_000)]
    got = kept(spark, rows)
    assert set(got) == {None, 2, 3, 4}  # 1 is a prefix of the conversation without id
    assert got[None] == ["<|im_start|>user\nx<|im_end|>\n<|im_start|>unknown\n<|im_end|>\n"]
    assert got[2] == got[3] == ["<|im_start|>user\n<|im_end|>\n"]
    assert chat.render(frame(spark, [])).collect() == []
