"""Leak check over published tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.masks import LONG_NUMBER_HINT, PHONE, PHONE_HINT
from ..functions.scalars import EMAIL
from .names import capital_pairs, pair_key

# Digit runs that are no part of a word: keys and hashes of the tables are not counted.
FREE_NUMBER = r"(?<![\p{L}\p{N}_:])\p{Nd}(?:[ \-]?\p{Nd}){11,18}(?![\p{L}\p{N}_:])"


def string_cells(df: DataFrame, table: str) -> DataFrame:
    """(where, text) of every string, string array and string map of a table."""
    entries = []
    for f in df.schema.fields:
        where = F.lit(f"{table}.{f.name}")
        if isinstance(f.dataType, T.StringType):
            values = F.array(F.col(f"`{f.name}`"))
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            values = F.col(f"`{f.name}`")
        elif isinstance(f.dataType, T.MapType) and isinstance(f.dataType.valueType, T.StringType):
            values = F.map_values(F.col(f"`{f.name}`"))
        else:
            continue
        entries.append(F.struct(where.alias("where"), F.coalesce(values, F.array().cast("array<string>")).alias("values")))
    cells = df.select(F.explode(F.array(*entries)).alias("e"))
    return cells.select("e.where", F.explode("e.values").alias("text")).filter("text is not null")


def personal_emails(text: Column, allowed_domains: list[str]) -> Column:
    found = F.regexp_extract_all(text, F.lit(EMAIL), F.lit(0))
    found = F.when(F.contains(text, F.lit("@")), found).otherwise(F.array().cast("array<string>"))
    if not allowed_domains:
        return found
    system = "@(" + "|".join(d.replace(".", r"\.") for d in allowed_domains) + ")$"
    return F.filter(found, lambda e: ~F.lower(e).rlike(system))


def leak_counts(cells: DataFrame, allowed_domains: list[str] | None = None) -> DataFrame:
    """Emails, phones and long numbers left in the texts, by (where, kind).

    Hits are counted inside each text and summed map-side; no hit is moved.
    """
    per_text = cells.select(
        "where",
        F.size(personal_emails(F.col("text"), allowed_domains or [])).alias("email"),
        F.when(F.col("text").rlike(PHONE_HINT), F.regexp_count("text", F.lit(PHONE))).otherwise(0).alias("phone"),
        F.when(F.col("text").rlike(LONG_NUMBER_HINT), F.regexp_count("text", F.lit(FREE_NUMBER)))
        .otherwise(0)
        .alias("long_number"),
    )
    kinds = ["email", "phone", "long_number"]
    sums = per_text.groupBy("where").agg(*[F.sum(k).alias(k) for k in kinds])
    return (
        sums.unpivot(["where"], kinds, "kind", "n")
        .filter("n > 0")
        .select("where", "kind", F.col("n").cast("long").alias("n"))
    )


def name_leaks(cells: DataFrame, registry: DataFrame) -> DataFrame:
    """Full names of the registry (seven characters or more) left in the texts.

    Pairs are counted before they are looked up, so a frequent pair is one row.
    """
    pairs = cells.select("where", F.explode(capital_pairs(F.col("text"))).alias("pair"))
    counted = pairs.groupBy("where", pair_key(F.col("pair")).alias("value")).agg(F.count("*").alias("n"))
    names = registry.filter((F.col("kind") == "full") & (F.char_length("value") >= 7)).select("value")
    return (
        counted.join(names, "value", "left_semi")
        .groupBy("where")
        .agg(F.sum("n").cast("long").alias("n"))
        .select("where", F.lit("full_name").alias("kind"), "n")
    )


def check_leaks(
    tables: dict[str, DataFrame], registry: DataFrame, allowed_domains: list[str] | None = None
) -> DataFrame:
    cells = reduce(DataFrame.unionByName, [string_cells(df, name) for name, df in tables.items()])
    return leak_counts(cells, allowed_domains).unionByName(name_leaks(cells, registry))
