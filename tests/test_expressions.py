"""Scalar, mask and keyword expressions against plain Python."""

from __future__ import annotations

import hashlib
import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from hearback.functions import keywords, masks, scalars
from hearback.operators import reshape


def values(spark, cells, fn, kind="string"):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {kind}")
    return [r["v"] for r in df.select("i", fn(F.col("c")).alias("v")).orderBy("i").collect()]


DATES = {
    "2026-08-01T10:11:12.345Z": datetime(2026, 8, 1, 10, 11, 12, 345000),
    "2026-08-01T10:11:12Z": datetime(2026, 8, 1, 10, 11, 12),
    "2026-08-01T10:11:12.5+02:00": datetime(2026, 8, 1, 8, 11, 12, 500000),
    "2026-08-01T10:11:12-0530": datetime(2026, 8, 1, 15, 41, 12),
    " 2026-08-01 10:11:12 ": datetime(2026, 8, 1, 10, 11, 12),
    "2026-08-01 10:11": datetime(2026, 8, 1, 10, 11),
    "2026-08-01": datetime(2026, 8, 1),
    "08/01/2026 10:11:12": datetime(2026, 8, 1, 10, 11, 12),
    "8/1/2026 9:05": datetime(2026, 8, 1, 9, 5),
    "8/1/2026": datetime(2026, 8, 1),
    "08-01-2026": datetime(2026, 8, 1),
    "August 1, 2026 3:04 PM": datetime(2026, 8, 1, 15, 4),
    "August 1, 2026 12:00 am": datetime(2026, 8, 1),
    "august 1, 2026": datetime(2026, 8, 1),
    "August 1, 2026 13:00 PM": None,
    "Aug 1, 2026": None,
    "2026-02-30": None,
    "13/13/2026": None,
    "2026-08-01T10:11:60Z": None,
    "2026-08-01T10:11:12": None,
    "01.08.2026": None,
    "": None,
    None: None,
}


def test_dates(spark):
    assert values(spark, list(DATES), scalars.parse_dt) == list(DATES.values())


def test_times_without_seconds_are_not_cast(spark):
    """A cast that fails costs an exception for each row."""
    dates = spark.createDataFrame([("7/20/2026 14:05",), ("2026-07-20",), ("2026-07-20 14:05:09",)], "c string")
    parsed = dates.select(scalars.parse_dt("c").alias("d"))
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert "THEN try_cast(regexp_extract(" in plan and "(try_cast(regexp_extract(" not in plan
    assert [str(r["d"]) for r in parsed.collect()] == ["2026-07-20 14:05:00", "2026-07-20 00:00:00", "2026-07-20 14:05:09"]


def test_numbers(spark):
    cells = {"1,234.5": 1234.5, " 7\t": 7.0, "-3e2": -300.0, ".5": 0.5, "5.": 5.0}
    cells |= dict.fromkeys(["1d", "nan", "inf", "1_0", "0x1", "", "x", None])
    assert values(spark, list(cells), scalars.to_float) == list(cells.values())


def test_keys(spark):
    salt = "0123456789abcdef"

    def sha(text: str, n: int) -> str:
        return hashlib.sha256(text.encode()).hexdigest()[:n]

    mails = [" Ann.Lee@Mail.com\n", "no mail", "a@b", "", None]
    want = ["u_" + sha(salt + "ann.lee@mail.com", 16), None, None, None, None]
    assert values(spark, mails, lambda c: scalars.user_key(c, salt)) == want
    assert values(spark, [" x ", " "], lambda c: scalars.hash_id(c, salt, "cb_")) == ["cb_" + sha(salt + "|id|x", 16), None]
    assert values(spark, ["a", None], lambda c: scalars.short_hash(F.lit("s"), c)) == [sha("s\x1fa", 12), sha("s\x1f", 12)]


def test_small_functions(spark):
    assert values(spark, ["  A  b\n\tc ", None], scalars.squash_spaces) == ["A b c", None]
    assert values(spark, ["PIN / Book Clubs", "", None], scalars.slug) == ["pin_book_clubs", "", ""]
    assert values(spark, [" Book Club Member ", " "], scalars.audience_code) == ["book_club_member", None]
    assert values(spark, ["ann.lee+99@x.com", "jo_smith-7"], scalars.local_part_tokens) == [["ann", "lee"], ["smith"]]
    assert values(spark, ["a@Sub.Mail.com ", "plain"], scalars.email_domain) == ["sub.mail.com", "plain"]
    assert values(spark, ["Growth_Exp funnel", "The NPS deck", "spinning", ""], scalars.initiative_of) == [
        "Growth Experimentation", "NPS", None, None,
    ]
    assert values(spark, [["", "  ", None], ["", "x"], []], scalars.is_blank, "array<string>") == [True, False, True]
    number = values(spark, ["5", "4. 5", "five", "", None], lambda c: scalars.answer_type(F.lit(False), F.lit("scale"), c))
    assert number == ["score", "score", "text", "score", "score"]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("mail a.b+c@x-y.co.uk now", "mail [email] now"),
        ("call (555) 123-4567 or +1 555.123.4567.", "call [phone] or [phone]."),
        ("not 155-123-45678 nor 12:555-123-45678", "not 155-123-45678 nor 12:555-123-45678"),
        ("card 4111 1111-1111 1111, 12345678901", "card [number], 12345678901"),
        ("nothing here", "nothing here"),
        ("", ""),
        (None, None),
    ],
)
def test_contact_masks(spark, text, want):
    assert values(spark, [text], masks.mask_contacts) == [want]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Hi Jane Doe, hello", "Hi [name], hello"),
        ("Dear Support, hello", "Dear Support, hello"),
        ("Hey Thereby now", "Hey [name] now"),
        ("bye\nBest regards,\n\n- John McDonald", "bye\nBest regards,\n\n- [name]"),
        ("Thanks,\nJohn McDonald-Smith!", "Thanks,\n[name]!"),
        ("Thanks!\nTeam Blue", "Thanks!\nTeam Blue"),
        ("zed and ZED, not zedd", "[name] and [name], not zedd"),
        ("Hello Known Name there", "Hello [name] there"),
    ],
)
def test_scrub(spark, text, want):
    own, pairs = F.array(F.lit("zed")), F.array(F.lit("Known Name"))
    assert values(spark, [text], lambda c: masks.scrub(c, own, pairs)) == [want]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("I will change to jane roe's billing agreement", "I will change to [name]'s billing agreement"),
        ("Ann Lee <[email]> wrote", "[name] <[email]> wrote"),
        ("The billing agreement for max moe was ended; Max Moe agreed", "The billing agreement for [name] was ended; [name] agreed"),
        ("x agreement. Max Moe canceled this billing agreement", "x agreement. [name] canceled this billing agreement"),
        ("Customer canceled max moe ([email])", "Customer canceled [name] ([email])"),
        ("Max Moe, a decision on your case", "[name], a decision on your case"),
        ("notified you that max moe filed it", "notified you that [name] filed it"),
        ("Buyer's name Max Moe Buyer id", "Buyer's name [name] Buyer id"),
        ("Buyer: This person", "Buyer: This person"),
        ("Maria Gomez and Maria del", "[name] and Maria del"),
        ("all good\nCheers, Max", "all good\nCheers, [name]"),
        ("all good\nThanks, Monday", "all good\nThanks, Monday"),
        ("one line\ntwo\n\nMax M. Moe  \n", "one line\ntwo\n\n[name]"),
        ("one line\nRefund", "one line\nRefund"),
        ("Max Moe", "Max Moe"),
    ],
)
def test_scrub_mail(spark, text, want):
    assert values(spark, [text], lambda c: masks.scrub_mail(c, F.array(F.lit("Maria")))) == [want]


def test_subject_name(spark):
    cells = ["Re: Cancellation request - Max Moe", "Refund please – Max", "Question - Max Moe"]
    want = ["Re: Cancellation request - [name]", "Refund please – [name]", "Question - Max Moe"]
    assert values(spark, cells, masks.mask_subject_name) == want


AREAS = [
    ("billing", ["charge", "charged", "charges", "free trial", "trial", "money back"]),
    ("access", ["cannot access", "log in", "access my account"]),
    ("quality", ["ai-generated", "cannot find", "didn't load", "too short"]),
    ("ai", ["ai", "a.i.", "generated", "ask a question"]),
]


def counted(text: str, words: list[str]) -> int:
    """Hits by one plain scan per area, longest keyword first."""
    longest = "|".join(re.escape(w) for w in sorted(words, key=len, reverse=True))
    return len(re.findall(f"(?<![a-z0-9])(?:{longest})(?![a-z0-9])", text.lower()))


def test_keyword_hits_match_a_plain_scan(spark):
    import random

    rng = random.Random(7)
    pieces = [w for _, words in AREAS for k in words for w in re.findall(r"[\w'.-]+", k)]
    pieces += ["recharged", "Charged", "AI_charge", "été", "x", "find", "my", "account", "free", "trialed", "didn"]
    glue = [" ", " ", " ", "  ", "_", "-", ", ", ".", "\n", "'"]
    texts = ["".join(rng.choice(pieces) + rng.choice(glue) for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += ["free trial", "AI-generated a.i. recharged charged_x cannot access my account", "", "é charge é"]
    want = [[counted(t, words) for _, words in AREAS] for t in texts]
    assert values(spark, texts, lambda c: keywords.keyword_hits(c, AREAS)) == want
    # keywords that open with punctuation keep the punctuation around cut words
    dotted = [("net", [".net", "net"]), ("c", ["c#", "(x)"])]
    texts = ["foo .net bar net c# (x) foo(x)", "asp.net", "word. net", "c#, c"]
    want = [[counted(t, words) for _, words in dotted] for t in texts]
    assert values(spark, texts, lambda c: keywords.keyword_hits(c, dotted)) == want


def test_long_texts_are_scanned_whole(spark):
    text = "word, " * 400_000 + "refund charge " + "a1 b2\n" * 300_000 + "Charge"
    assert values(spark, [text], lambda c: keywords.keyword_hits(c, AREAS)) == [[2, 0, 0, 0]]
    mail = "x " * 500_000 + "a@b.com 555-123-4567 " + "1 a " * 200_000 + "4111 1111 1111 1111\nThanks,\nMax Moe"
    masked = values(spark, [mail], lambda c: masks.scrub(c))[0]
    assert masked.count("[email] [phone] ") == 1 and masked.endswith("[number]\nThanks,\n[name]")


def test_best_area_and_areas(spark):
    hits = [[0, 0, 0, 0], [1, 0, 1, 0], [0, 1, 2, 2]]
    assert values(spark, hits, lambda c: keywords.best_area(c, AREAS), "array<int>") == [None, "billing", "quality"]
    assert values(spark, hits, lambda c: keywords.hit_areas(c, AREAS), "array<int>") == [
        [], ["billing", "quality"], ["access", "ai", "quality"],
    ]


def test_panel_headers(spark):
    headers = {
        '(Screener) (Question 1: "What?") Answer': ("(Screener)", "What?", "Answer"),
        '2. (Questions) (Question 1: "Q: x (y)") Duration (ms)': ("2. (Questions)", "Q: x (y)", "Duration (ms)"),
        '1. (Card Sorting) (Card 1: "A") category label': ("1. (Card Sorting)", "A", "category label"),
        "3. (Prototype test: [abc]) Task result": ("3. (Prototype test: [abc])", "", "Task result"),
        "Plain": ("", "", "Plain"),
        '3.5 (A) (Question 2: "multi\nline") Answer': ("3.5 (A)", "multi\nline", "Answer"),
    }
    assert [tuple(v) for v in values(spark, list(headers), reshape.header_parts)] == list(headers.values())


def test_header_patterns_fall_through(spark):
    patterns = [(r"^\s*$", "status"), ("(?i)email", "email"), ("(?i)your", "your")]
    df = spark.createDataFrame([("f", ["Email", " ", "Your email", "Email again", "", "x"])], "source_file string, header array<string>")
    row = reshape.match_headers(df, patterns).first()
    assert row["fields"] == {"email": 0, "status": 1, "your": 2}
    assert row["unmapped"] == ["Email again", "", "x"]


def test_positions_and_padding(spark):
    df = spark.createDataFrame([(["a", "b", "a"], ["1"])], "h array<string>, c array<string>")
    padded = reshape.pad(F.col("c"), F.size("h"))
    row = df.select(
        reshape.position_of(F.col("h"), "a").alias("a"),
        reshape.position_of(F.col("h"), "z").alias("z"),
        padded.alias("p"),
        reshape.cell_at(F.col("c"), F.lit(7)).alias("far"),
    ).first()
    assert (row["a"], row["z"], row["p"], row["far"]) == (2, None, ["1", "", ""], "")
