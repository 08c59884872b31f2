"""Keep-first marking, ordered reject reasons, reconciliation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mark_repeats(
    df: DataFrame,
    keys: list[str],
    seq: str,
    counts: Column | None = None,
    out: str = "is_repeat",
    settle: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Flag every row but the first of its key.

    ``seq`` is a number that orders and identifies the rows. The first one per key
    comes from a hash aggregate with map-side combine and goes back to its row by
    that number, which is unique, so copies of one key never meet in one task. Rows
    for which ``counts`` is false (blank ones) neither register nor are flagged.

    With ``settle`` the numbers of the repeats alone are worked out first and handed
    to it; where it finds them few and broadcasts them, the rows are not shuffled.
    """
    registers = F.coalesce(counts, F.lit(False)) if counts is not None else F.lit(True)
    firsts = (
        df.filter(registers)
        .groupBy(*keys)
        .agg(F.min(seq).alias(seq))
        .select(seq, F.lit(True).alias("_is_first"))
    )
    if settle is not None:
        repeats = df.filter(registers).select(seq).join(firsts, seq, "left_anti")
        flags = settle(repeats.withColumn(out, F.lit(True)))
        return df.join(flags, seq, "left").withColumn(out, F.coalesce(out, F.lit(False)))
    return df.join(firsts, seq, "left").withColumn(
        out, registers & F.col("_is_first").isNull()
    ).drop("_is_first")


def reject_reason(*rules: tuple[str, Column]) -> Column:
    """First reason whose test holds, null for a row that is loaded."""
    return F.coalesce(*[F.when(F.coalesce(test, F.lit(False)), F.lit(reason)) for reason, test in rules])


def reconcile(files: DataFrame, read: DataFrame, loaded: DataFrame, rejected: DataFrame, by: list[str]) -> DataFrame:
    """Rows read, loaded and rejected per file, each counted on its own table.

    ``files`` lists every file once, so an empty file shows up with zeros.
    """

    def per_file(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*by).agg(F.count("*").alias(name))

    joined = (
        files.select(*by)
        .join(per_file(read, "rows_read"), by, "left")
        .join(per_file(loaded, "rows_loaded"), by, "left")
        .join(per_file(rejected, "rows_rejected"), by, "left")
        .fillna(0, ["rows_read", "rows_loaded", "rows_rejected"])
    )
    return joined.withColumn("ok", F.col("rows_read") == F.col("rows_loaded") + F.col("rows_rejected"))


def all_ok(reconciliation: DataFrame) -> bool:
    """Gate: true when there are files and every one reconciles (one row comes to the driver)."""
    return bool(reconciliation.agg(F.coalesce(F.bool_and("ok"), F.lit(False)).alias("ok")).first()["ok"])


def volumes(reconciliation: DataFrame) -> DataFrame:
    return reconciliation.groupBy("source", "period").agg(
        F.sum("rows_read").alias("rows_read"),
        F.sum("rows_loaded").alias("rows_loaded"),
        F.sum("rows_rejected").alias("rows_rejected"),
        F.count("*").alias("files"),
    )


def reject_counts(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("source", F.col("excluded_reason").alias("reason")).agg(F.count("*").alias("rows"))
