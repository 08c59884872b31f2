"""Comparison with the previous run: columns and volumes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def column_sets(headers: DataFrame) -> DataFrame:
    """Distinct (source, column) over all files."""
    return headers.select("source", F.explode("header").alias("column")).distinct()


def schema_drift(now: DataFrame, before: DataFrame, scope: list[str], ignore: Column | None = None) -> DataFrame:
    """Columns that are new or lost per ``scope``; scopes without a past give no alert."""
    keys = [*scope, "column"]
    current, past = now.select(*keys).distinct(), before.select(*keys).distinct()
    known = past.select(*scope).distinct()
    running = current.select(*scope).distinct()
    new = current.join(past, keys, "left_anti").join(known, scope, "left_semi").withColumn("change", F.lit("new"))
    lost = past.join(current, keys, "left_anti").join(running, scope, "left_semi").withColumn("change", F.lit("lost"))
    changed = new.unionByName(lost)
    return changed.filter(~ignore) if ignore is not None else changed


def expected_drift() -> Column:
    """Columns that vary by design: survey questions and attributes, panel tests."""
    varies = (F.col("source") == "sprig") & F.col("column").rlike(r"^(Q[0-9]+_|Attribute_)")
    return varies | (F.col("source") == "lyssna")


def volume_swings(now: DataFrame, before: DataFrame, on: list[str], count: str, ratio: float) -> DataFrame:
    """Groups present in both runs whose row count moved by more than ``ratio``."""
    past = before.select(*on, F.col(count).alias("rows_before"))
    current = now.select(*on, F.col(count).alias("rows_now"))
    swing = F.abs(F.col("rows_now") - F.col("rows_before")) / F.col("rows_before")
    return current.join(past, on).filter((F.col("rows_before") > 0) & (swing > ratio)).withColumn("swing", swing)


def link_rates(evidence: DataFrame) -> DataFrame:
    """Share of real-user items that carry a key / an id, per source."""

    def share(c: str) -> Column:
        return F.round(F.avg((F.coalesce(F.col(c), F.lit("")) != "").cast("double")), 4)

    return (
        evidence.filter("population = 'user'")
        .groupBy("source")
        .agg(
            F.count("*").alias("evidence_items"),
            share("user_key").alias("with_user_key"),
            share("user_id").alias("with_user_id"),
        )
    )
