"""Registry of people's names and the search for them in free text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.masks import CAP_TOKEN, END, NOT_FIRST_NAMES, START
from ..functions.scalars import SPACE_CLASS, strip, text_or_empty
from .bloom import may_be_in
from .skew import HOT_ROWS, hottest, spread_join

# A lookahead finds overlapping pairs: in "Hello Jane Doe" also "Jane Doe".
PAIRS = START + r"(?=(" + CAP_TOKEN + r"[ \t]+" + CAP_TOKEN + ")" + END + ")"


def name_tokens(*parts: Column) -> Column:
    joined = strip(F.concat_ws(" ", *[text_or_empty(p) for p in parts]))
    return F.regexp_extract_all(joined, F.lit("[^" + SPACE_CLASS[1:] + "+"), F.lit(0))


def name_registry(people: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Distinct (kind, value): full names (first two words, all words; lower case)
    and capitalised first names of three letters or more."""
    t = F.col(tokens)
    head = F.get(t, F.lit(0))
    full = F.when(
        F.size(t) >= 2,
        F.array(F.lower(F.array_join(F.slice(t, 1, 2), " ")), F.lower(F.array_join(t, " "))),
    ).otherwise(F.array().cast("array<string>"))
    first = F.when((F.char_length(head) >= 3) & head.rlike(r"^\p{L}+$"), F.array(F.initcap(F.lower(head)))).otherwise(
        F.array().cast("array<string>")
    )
    entries = F.concat(
        F.transform(full, lambda v: F.struct(F.lit("full").alias("kind"), v.alias("value"))),
        F.transform(first, lambda v: F.struct(F.lit("first").alias("kind"), v.alias("value"))),
    )
    return people.select(F.explode(entries).alias("e")).select("e.kind", "e.value").distinct()


def capital_pairs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PAIRS), F.lit(1))


def pair_key(pair: Column) -> Column:
    return F.lower(F.regexp_replace(pair, r"[ \t]+", " "))


BROADCAST_NAMES = 500_000


def known_names(
    texts: DataFrame,
    keys: list[str],
    pairs: Column,
    registry: DataFrame,
    registry_rows: int | None = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Per row of ``texts`` (identified by ``keys``) the capitalised pairs and first
    names it shares with the registry: ``known_pairs``, ``known_firsts``.

    Rows without a hit do not appear, and every array is bounded by its own row's
    text. A registry counted to be small is broadcast and the texts are scanned
    once, without a shuffle. A larger one is joined by shuffle: a Bloom filter of the registry
    first drops what it does not hold, in the tasks that scan the texts, so that little more than the
    hits is written and shuffled. Pairs that many rows have in common are spread over salts; ``stage``
    keeps the pairs as a table so that the texts are scanned only once.
    """
    found = texts.select(*keys, F.explode(F.array_distinct(pairs)).alias("_pair"))
    first = F.regexp_extract("_pair", "^(" + CAP_TOKEN + ")", 1)
    lookups = F.array(
        F.struct(F.lit("full").alias("kind"), pair_key(F.col("_pair")).alias("value"), F.col("_pair").alias("raw")),
        F.struct(F.lit("first").alias("kind"), first.alias("value"), first.alias("raw")),
    )
    wanted = (
        found.select(*keys, F.explode(lookups).alias("c"))
        .select(*keys, "c.*")
        .filter(~((F.col("kind") == "first") & F.col("value").isin(NOT_FIRST_NAMES)))
    )
    on = ["kind", "value"]
    if registry_rows is not None and registry_rows <= BROADCAST_NAMES:
        hits = wanted.join(F.broadcast(registry), on, "left_semi")
    else:
        wanted = may_be_in(wanted, registry, on, registry.count() if registry_rows is None else registry_rows)
        wanted = stage(wanted) if stage else wanted
        counts = wanted.groupBy(*on).agg(F.count("*").alias("_n"))
        known = counts.filter("_n > 0").join(registry, on, "left_semi").select(*on)
        hot = hottest(counts, on, hot_rows)
        hits = spread_join(wanted, known, on, "left_semi", spread_by=keys, hot=hot)
    return hits.groupBy(*keys).agg(
        F.array_sort(F.collect_set(F.when(F.col("kind") == "full", F.col("raw")))).alias("known_pairs"),
        F.array_sort(F.collect_set(F.when(F.col("kind") == "first", F.col("raw")))).alias("known_firsts"),
    )
