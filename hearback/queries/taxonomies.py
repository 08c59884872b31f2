"""Small taxonomies for the test tables, and the same rules as SQL text."""

from __future__ import annotations

from ..operators.classify import Taxonomy

# Function words separate the four languages of the test documents.
WORDS = Taxonomy(
    areas=[
        ("english_words", ["the", "of the", "and", "with"]),
        ("french_words", ["le", "la", "que", "que la"]),
        ("german_words", ["und", "der", "die"]),
        ("spanish_words", ["el", "los", "para", "para la"]),
        ("license_terms", ["license", "licensed", "warranty", "copyright", "apache license"]),
    ],
    source_map={
        "event_type": {"error": ("license_terms", "failed"), "signup": ("english_words", "joined")},
    },
)

# Rarer words, so that every step of the precedence decides for some documents.
PRECEDENCE = Taxonomy(
    areas=[
        ("license_terms", ["license", "licensed", "warranty", "copyright"]),
        ("german_words", ["und", "der"]),
        ("french_words", ["le", "fr"]),
        ("rights", ["rights", "reserved"]),
    ],
    source_map={
        "source": {"src0": ("rights", "first"), "src1": ("license_terms", "second"), "src2": ("rights", "third")},
    },
)


def hits_sql(text: str, words: list[str]) -> str:
    ordered = sorted({w.lower() for w in words}, key=lambda w: (-len(w), w))
    return (
        f"len(regexp_extract_all(replace(lower({text}), '_', ' '), '\\b(?:" + "|".join(ordered) + ")\\b'))"
    )


def hit_columns_sql(text: str, taxonomy: Taxonomy, prefix: str) -> str:
    return ", ".join(f"{hits_sql(text, words)} AS {prefix}{i}" for i, (_, words) in enumerate(taxonomy.areas))


def any_sql(taxonomy: Taxonomy, prefix: str) -> str:
    return "(" + " + ".join(f"{prefix}{i}" for i in range(len(taxonomy.areas))) + ") > 0"


def best_sql(taxonomy: Taxonomy, prefix: str) -> str:
    n = len(taxonomy.areas)
    top = "greatest(" + ", ".join(f"{prefix}{i}" for i in range(n)) + ")"
    arms = " ".join(f"WHEN {prefix}{i} = {top} THEN '{a}'" for i, (a, _) in enumerate(taxonomy.areas))
    return f"CASE {arms} END"


def areas_sql(taxonomy: Taxonomy, *prefixes: str) -> str:
    """Sorted hit areas as one text."""
    items = []
    for i, (a, _) in sorted(enumerate(taxonomy.areas), key=lambda e: e[1][0]):
        test = " + ".join(f"{p}{i}" for p in prefixes)
        items.append(f"CASE WHEN {test} > 0 THEN '{a}' END")
    return "concat_ws(',', " + ", ".join(items) + ")"
