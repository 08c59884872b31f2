"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000
HOT_KEYS = 10_000
SALTS = 2


def hot_keys(df: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys with at least ``hot_rows`` rows and their number of rows ``_n``.

    Only the ``HOT_KEYS`` hottest, so the result is safe to broadcast at any size; keys
    behind them stay in the join as they are, where Spark may split their partitions.
    """
    counted = df.dropna(subset=on).groupBy(*on).agg(F.count("*").alias("_n"))
    return hottest(counted, on, hot_rows)


def hottest(counted: DataFrame, on: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """The same from keys that are counted already (``_n``)."""
    return counted.filter(F.col("_n") >= hot_rows).orderBy(F.desc("_n"), *on).limit(HOT_KEYS).select(*on, "_n")


def spread_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    how: str,
    spread_by: list[str],
    hot_rows: int = HOT_ROWS,
    salts: int = SALTS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Equi join (inner, left or left_semi) that spreads hot and null keys of ``left``.

    Rows of a hot key get a salt from a hash of ``spread_by`` (columns that tell the
    rows apart, so a retried task gives the same salt) and only the hot rows of
    ``right`` are copied once per salt. A key of n rows has n / ``hot_rows`` salts, ``salts``
    at least, so that no salt holds more than about ``hot_rows`` of them. Null keys match
    nothing: they are left out where the join drops them, and otherwise get the whole
    hash as salt, which deals them evenly to all partitions. Other keys join as they
    are. ``hot`` gives the hot keys (with ``_n``) where the caller has counted them
    already; it must be as bounded as ``hot_keys`` is.
    """
    hot = hot_keys(left, on, hot_rows) if hot is None else hot
    own = F.greatest(F.ceil(F.col("_n") / hot_rows), F.lit(salts)).cast("long")
    hot = F.broadcast(hot.select(*on, own.alias("_salts")))
    unset = F.lit(False)
    for key in on:
        unset = unset | F.col(key).isNull()
    if how != "left":
        left = left.filter(~unset)
    spread = F.xxhash64(*spread_by)
    salt = F.when(F.col("_salts").isNotNull(), F.pmod(spread, F.col("_salts"))).when(unset, spread)
    salted = left.join(hot, on, "left").withColumn("_salt", F.coalesce(salt, F.lit(0).cast("long")))
    every = F.sequence(F.lit(0).cast("long"), F.coalesce("_salts", F.lit(1).cast("long")) - 1)
    copies = right.join(hot, on, "left").withColumn("_salt", F.explode(every)).drop("_salts")
    return salted.drop("_salts").join(copies, [*on, "_salt"], how).drop("_salt")
