"""Linking people: identity pairs, primary ids, back-fill, per-person roll-up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import is_digits
from .skew import HOT_ROWS, hottest, spread_join


def identity_map(
    observed: DataFrame,
    seq: Column | str,
    key: str = "user_key",
    uid: str = "user_id",
    hot_rows: int = HOT_ROWS,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per (key, id) with observations, the primary id and ambiguity.

    Primary is the id seen most often; a tie goes to the id seen first. ``seq`` is a
    number that gives the processing order: its minimum is kept in a hash aggregate,
    where a minimum of structs or texts would sort all rows first. A key with very
    many ids is spread over salts when the ids get their key's figures back.
    ``stage`` keeps the counted pairs as a table, so that they are counted only once.
    """
    usable = observed.filter(F.col(key).isNotNull() & is_digits(F.col(uid).cast("string")))
    pairs = usable.groupBy(key, uid).agg(
        F.count("*").alias("observations"), F.min(seq).alias("_first")
    )
    # every use below asks for all columns, so that Spark counts the pairs once and reuses the exchange
    pairs = stage(pairs) if stage else pairs.filter("_first IS NOT NULL")
    per_key = primary_ids(pairs, key, uid).filter("primary_id IS NOT NULL")
    hot = hottest(per_key.select(key, F.col("n_ids").alias("_n")), [key], hot_rows)
    return (
        spread_join(pairs, per_key, [key], "inner", spread_by=[uid], hot=hot)
        .withColumn("is_primary", F.col(uid) == F.col("primary_id"))
        .withColumn("ambiguous", F.col("n_ids") > 1)
        .select(key, uid, "observations", "is_primary", "ambiguous")
    )


def primary_ids(pairs: DataFrame, key: str = "user_key", uid: str = "user_id") -> DataFrame:
    """Per key the primary id and the number of ids, by aggregation only."""
    best = F.min(F.struct((-F.col("observations")).alias("k"), F.col("_first"), F.col(uid).alias("id")))
    return pairs.groupBy(key).agg(best["id"].alias("primary_id"), F.count("*").alias("n_ids"))


def primary_of(identities: DataFrame) -> DataFrame:
    return identities.filter("is_primary").select("user_key", F.col("user_id").alias("primary_id"))


def backfill_user_id(
    df: DataFrame,
    primary: DataFrame,
    spread_by: list[str],
    key: str = "user_key",
    uid: str = "user_id",
    overwrite: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Fill ``uid`` from the primary id of the row's key; rows without a key stay as they are."""
    joined = spread_join(df, primary, [key], "left", spread_by=spread_by, hot_rows=hot_rows)
    filled = F.col("primary_id") if overwrite else F.coalesce(F.col(uid), F.col("primary_id"))
    return joined.withColumn(uid, filled).drop("primary_id")


def roll_up(
    items: DataFrame,
    key: str,
    source: str,
    at: str,
    seq: list[str],
    first: dict[str, str],
    last: dict[str, str],
) -> DataFrame:
    """One row per person. The items are first counted per (person, source, values of
    ``first`` and ``last``) in a hash aggregate over numbers only (``seq`` becomes one number), so
    that a person with very many items is combined map-side and nothing is sorted. The few
    rows that are left per person give the values."""
    order = F.lit(0).cast("decimal(38,0)")
    for part in seq:
        order = (order * F.lit(1 << 32).cast("decimal(10,0)") + F.col(part).cast("decimal(19,0)")).cast("decimal(38,0)")
    values = sorted({*first.values(), *last.values()})
    partial = (
        items.filter(F.col(key).isNotNull())
        .withColumn("_order", order)
        .groupBy(key, source, *values)
        .agg(
            F.count("*").alias("_n"), F.min(at).alias("_lo"), F.max(at).alias("_hi"),
            F.min("_order").alias("_first"), F.max("_order").alias("_last"),
        )
    )

    def known(value: str, place: str) -> Column:
        return F.collect_list(F.when(F.col(value).isNotNull(), F.struct(F.col(place).alias("s"), F.col(value).alias("v"))))

    return partial.groupBy(key).agg(
        F.array_sort(F.collect_set(source)).alias("sources"),
        F.count_distinct(source).cast("int").alias("n_sources"),
        F.sum("_n").alias("evidence_items"),
        F.min("_lo").alias("first_seen"),
        F.max("_hi").alias("last_seen"),
        *[F.array_min(known(c, "_first"))["v"].alias(o) for o, c in first.items()],
        *[F.array_max(known(c, "_last"))["v"].alias(o) for o, c in last.items()],
    )
