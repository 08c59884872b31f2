"""The usual questions, over DataFrames with the published column names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.scalars import small_sample
from ..operators.skew import HOT_ROWS, spread_join


def top_reasons(df: DataFrame, by: list[str], score: str, out: str) -> DataFrame:
    """Rows and mean score per group, most frequent first."""
    return (
        df.groupBy(*by)
        .agg(F.count("*").alias("n"), F.round(F.avg(score), 1).alias(out))
        .orderBy(F.desc("n"), *by)
    )


def _rows(weight: str | None) -> Column:
    """Number of rows, or of the rows that combined ones stand for."""
    return F.sum(weight) if weight else F.count("*")


def area_across_sources(evidence: DataFrame, area: str, weight: str | None = None) -> DataFrame:
    """Items and distinct people per source for one area, real users only. ``weight`` holds the
    items of a row where rows are combined."""
    return (
        evidence.filter((F.col("population") == "user") & F.array_contains("areas", area))
        .groupBy("source")
        .agg(_rows(weight).alias("n"), F.count_distinct("user_key").alias("people"))
        .orderBy(F.desc("n"), "source")
    )


def search_latest(df: DataFrame, text: str, needle: str, order: list[Column], keep: list[str], limit: int = 20, width: int = 240) -> DataFrame:
    """Latest items whose text contains ``needle``, any case, with an excerpt."""
    hits = df.filter(F.col(text).ilike(f"%{needle}%"))
    return hits.orderBy(*order).limit(limit).select(*keep, F.left(text, F.lit(width)).alias("excerpt"))


def nps(df: DataFrame, by: list[str], category: str = "nps_category") -> DataFrame:
    """Answers per category share and NPS score per group."""

    def share(name: str) -> Column:
        return F.lit(100.0) * F.count_if(F.col(category) == name) / F.count("*")

    return (
        df.filter(F.col(category).isNotNull())
        .groupBy(*by)
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col(category) == "Promoter").alias("promoters"),
            F.count_if(F.col(category) == "Passive").alias("passives"),
            F.count_if(F.col(category) == "Detractor").alias("detractors"),
            F.round(share("Promoter") - share("Detractor"), 1).alias("nps"),
        )
        .withColumn("directional", small_sample("n"))
    )


def nps_distribution(answers: DataFrame, responses: DataFrame) -> DataFrame:
    """Answers per NPS category, segment and channel. Answers are counted per response
    and category before the join, so a response has three rows at most there."""
    counted = (
        answers.filter(F.col("nps_category").isNotNull())
        .groupBy("response_id", "nps_category")
        .agg(F.count("*").alias("_n"))
    )
    keyed = responses.select("response_id", "segment", "channel")
    return (
        counted.join(keyed, "response_id")
        .groupBy("nps_category", "segment", "channel")
        .agg(F.sum("_n").alias("n"))
        .orderBy("segment", F.desc("n"), "nps_category", "channel")
    )


def top_box(df: DataFrame, by: list[str], score: str = "score", top: int = 5) -> DataFrame:
    """Share of the top answer, of the two top answers, and the mean, per group."""

    def pct(test: Column) -> Column:
        return F.round(F.lit(100.0) * F.count_if(test) / F.count("*"), 1)

    s = F.col(score)
    return (
        df.groupBy(*by)
        .agg(
            F.count("*").alias("n"),
            pct(s >= top).alias("pct_top"),
            pct(s >= top - 1).alias("pct_top2"),
            F.round(F.avg(s), 2).alias("mean_score"),
        )
        .withColumn("directional", small_sample("n"))
    )


def pmf_share(evidence: DataFrame) -> DataFrame:
    """Share of "very disappointed" per month and surface."""
    very = F.count_if(F.col("category") == "very_disappointed")
    return (
        evidence.filter("score_type = 'pmf_1_5'")
        .groupBy("period", "instrument")
        .agg(F.count("*").alias("n"), F.round(F.lit(100.0) * very / F.count("*"), 1).alias("pct_very"))
        .orderBy("period", F.desc("pct_very"), "instrument")
    )


def said_before(
    outcomes: DataFrame, items: DataFrame, key: str, outcome_at: str, item_at: str, by: list[str]
) -> DataFrame:
    """People per group who said something before (one of) their outcomes.

    An item lies before some outcome of a person exactly when their earliest item
    in the group lies before their latest outcome. Both sides shrink to that one
    timestamp before they meet, so no person's items are paired with outcomes.
    """
    latest = outcomes.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(outcome_at).alias("_latest"))
    earliest = items.filter(F.col(key).isNotNull()).groupBy(key, *by).agg(F.min(item_at).alias("_earliest"))
    return (
        earliest.join(latest, key)
        .filter("_earliest < _latest")
        .groupBy(*by)
        .agg(F.count("*").alias("people"))
        .orderBy(F.desc("people"), *by)
    )


def people_in_both(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Number of distinct people present on both sides; each side is reduced to its
    people first."""
    a = left.filter(F.col(key).isNotNull()).select(key).distinct()
    b = right.filter(F.col(key).isNotNull()).select(key).distinct()
    return a.join(b, key, "left_semi").agg(F.count("*").alias("people"))


def match_rate(cohort: DataFrame, behaviour: DataFrame, key: str, by: list[str], weight: str | None = None) -> DataFrame:
    """Members per group and how many of them are found in the other data.

    Members are counted per key before the join, so neither a frequent key nor the
    members without one pile up in a task.
    """
    found = behaviour.select(key).filter(F.col(key).isNotNull()).distinct().withColumn("_found", F.lit(True))
    counted = cohort.groupBy(key, *by).agg(_rows(weight).alias("_n"))
    matched = F.sum(F.when(F.col("_found"), F.col("_n")).otherwise(0))
    return (
        counted.join(found, key, "left")
        .groupBy(*by)
        .agg(
            F.sum("_n").alias("members"),
            matched.alias("matched"),
            F.round(matched / F.sum("_n"), 4).alias("match_rate"),
        )
    )


def quotes(df: DataFrame, by: list[str], order: list[Column], k: int = 5) -> DataFrame:
    """The first ``k`` items per group; the row limit is applied before the shuffle."""
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn("quote_no", F.row_number().over(w)).filter(F.col("quote_no") <= k)


def sources_per_person(users: DataFrame) -> DataFrame:
    return users.groupBy("n_sources").agg(F.count("*").alias("people")).orderBy("n_sources")


def studies_about(studies: DataFrame, name_like: str, initiative: str) -> DataFrame:
    """What has already been researched on a topic."""
    return (
        studies.filter(F.col("name").ilike(f"%{name_like}%") | (F.col("initiative") == initiative))
        .select("kind", "name", "period", "n", "source_file")
        .orderBy(F.desc("period"), "name")
    )


def documents_about(documents: DataFrame, needle: str) -> DataFrame:
    return documents.filter(F.col("text").ilike(f"%{needle}%")).select(
        "title", "period", F.left("text", F.lit(400)).alias("excerpt")
    )


def panel_answers(answers: DataFrame, studies: DataFrame, study_like: str, question_like: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Answers to matching questions of matching panel tests, one row per matching
    catalog entry as an inner join gives it. Both sides are filtered first."""
    wanted = studies.filter(F.col("name").ilike(f"%{study_like}%")).select("study_id")
    said = answers.filter((F.col("field") == "Answer") & F.col("question").ilike(f"%{question_like}%"))
    said = said.select("study_id", "response_id", "column_index", "answer")
    return spread_join(
        said, wanted, ["study_id"], "inner", spread_by=["response_id", "column_index"], hot_rows=hot_rows
    ).select("study_id", "response_id", "column_index", "answer")


def original_record(rows: DataFrame, mirror: DataFrame) -> DataFrame:
    """Masked copy of the export record behind each row."""
    copy = mirror.select("period", "source", "source_file", "row_number", "cells")
    on = [c for c in ("period", "source", "source_file", "row_number") if c in rows.columns]
    return rows.join(copy, on)
