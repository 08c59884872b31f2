"""Keyword taxonomy as column expressions."""

from __future__ import annotations

import re
from itertools import product

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import let


def _branch(words: set[str]) -> str:
    """Alternation of ``words`` with common beginnings shared, longest first."""
    by_first: dict[str, set[str]] = {}
    for w in words - {""}:
        by_first.setdefault(w[0], set()).add(w[1:])
    arms = [_escape(ch) + _branch(rest) for ch, rest in sorted(by_first.items())]
    if not arms:
        return ""
    body = arms[0] if len(arms) == 1 and "" not in words else "(?:" + "|".join(arms) + ")"
    # a keyword may end here: the longer continuation is tried first
    return body + "?" if "" in words and body.startswith("(?:") else body


def _escape(ch: str) -> str:
    return re.escape(ch) if ch.isascii() and not ch.isalnum() else ch


def keyword_pattern(keywords: list[str]) -> str:
    """Regex that counts whole keywords in lower-cased text, longest keyword first.

    The leading class rejects most positions with one test, and keywords that
    begin alike are tried together, so the scan stays near one pass.
    """
    words = {k.lower() for k in keywords if k}
    firsts = "".join(sorted({re.escape(w[0]) for w in words}))
    return f"(?=[{firsts}])(?<![a-z0-9])(?:{_branch(words)})(?![a-z0-9])"


def keyword_words(areas: list[tuple[str, list[str]]]) -> set[str]:
    return {w for _, words in areas for k in words for w in re.findall("[a-z0-9]+", k.lower())}


def keep_keyword_words(low: Column, areas: list[tuple[str, list[str]]]) -> Column:
    """Lower-cased text with every run of words that no keyword contains cut down to
    one mark, so that the scan per area runs over a fraction of the text.

    The mark is itself a word that no keyword contains, and punctuation around a run
    stays, so hits and word boundaries stay exactly as they were.
    """
    words = keyword_words(areas)
    if not all(re.search("[a-z0-9]", k.lower()) for _, keywords in areas for k in keywords):
        return low  # a keyword of punctuation only may hide between two words
    letters = "0123456789abcdefghijklmnopqrstuvwxyz"
    mark = next(m for n in (1, 2, 3) for m in map("".join, product(letters, repeat=n)) if m not in words)
    other = f"(?<![a-z0-9])(?!{_branch(words)}(?![a-z0-9]))[a-z0-9]++"
    return F.regexp_replace(low, f"{other}(?:[^a-z0-9]++{other})*+", mark)


def keyword_hits(text: Column, areas: list[tuple[str, list[str]]]) -> Column:
    """Array with the number of keyword hits per area, in taxonomy order."""

    def count(reduced: Column) -> Column:
        return F.array(
            *[F.regexp_count(reduced, F.lit(keyword_pattern(words))) if words else F.lit(0) for _, words in areas]
        )

    return let(keep_keyword_words(F.lower(text), areas), count)


def no_hits(areas: list[tuple[str, list[str]]]) -> Column:
    return F.array(*[F.lit(0) for _ in areas])


def any_hit(hits: Column) -> Column:
    return F.coalesce(F.array_max(hits) > 0, F.lit(False))


def best_area(hits: Column, areas: list[tuple[str, list[str]]]) -> Column:
    """Area with most hits; a tie goes to the area listed first."""
    names = F.array(*[F.lit(a) for a, _ in areas])
    place = F.array_position(hits, F.array_max(hits)).cast("int")
    return F.when(any_hit(hits), F.element_at(names, place))


def hit_areas(hits: Column, areas: list[tuple[str, list[str]]]) -> Column:
    """Sorted ids of all areas with a hit."""
    order = sorted(range(len(areas)), key=lambda i: areas[i][0])
    return F.array_compact(F.array(*[F.when(F.get(hits, F.lit(i)) > 0, F.lit(areas[i][0])) for i in order]))
