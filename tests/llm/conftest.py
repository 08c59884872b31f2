from pathlib import Path

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use for their own columns or inside
EXTRA = [
    "score", "fp", "epoch", "domain", "ids", "fingerprint", "slot", "part", "component_id", "lang_pred", "taken",
    "n_tokens", "base", "spans", "parts", "leaf", "key", "tokens", "budget", "extra", "digest", "last", "round_trip",
    "__fp", "__class_fp", "__key", "__id", "__runs", "__mix_key", "__mix_domain", "__mix_epochs", "__score", "__kept_domain",
    "__secret_id", "__secret_runs", "__simhash_fp", "__simhash_class_fp", "grp", "idx", "label", "bucket", "place", "run",
]
LONG = "The quick fox met password=hunter22 and idiot 日本語 " * 4000

ROWS = [
    (1, "plain words of a text that is like no other one here", "en", "a"),
    (2, "", "en", "a"),
    (3, None, "en", "b"),
    (None, "a text without an id stands here as well as it can", "de", "a"),
    (None, "a text without an id stands here as well as it can", "de", "a"),
    (4, LONG, "en", "b"),
    (5, "twice the same row is what this one is about today", None, "b"),
    (5, "twice the same row is what this one is about today", None, "b"),
    (6, "plain words of a text that is like no other one here", "en", None),
    (7, " \n\t ", "fr", "c"),
    (8, "😀 ÀÉ 日本 x\u0000y  ​", "fr", "c"),
]


def documents(spark, rows=ROWS, extra=()):
    """Rows (doc_id, text, lang, source) as documents, with ``extra`` text columns."""
    full = [(*r, len(r[1] or ""), *("clash" for _ in extra)) for r in rows]
    return spark.createDataFrame(full, COLUMNS + "".join(f", {name} string" for name in extra))


@pytest.fixture(scope="session")
def rough(spark):
    """Nulls, empty and long texts, repeated rows, and columns with clashing names."""
    return documents(spark, extra=EXTRA).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return documents(spark, rows=[], extra=EXTRA)


@pytest.fixture(scope="session")
def small():
    folder = "/root/testdata/sf0.001"
    if not Path(folder).exists():
        pytest.skip("test tables are not here")
    return folder
