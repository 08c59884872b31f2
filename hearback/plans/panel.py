"""Panel tests: one record per participant, one column per answer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import initiative_of, none_if_empty, parse_dt, short_hash, sorted_json, to_float
from ..operators.reshape import cell_at, header_parts, residual
from .evidence import feedback
from .family import KEY, SEQ, Columns, Output, Run, file_stem, loaded, shape, surrogate_id, unshadowed

SOURCE = "lyssna"

# Columns that describe the participant.
PARTICIPANT = [
    "Response ID", "Date", "Duration (ms)", "Age", "Country", "Gender", "Education level",
    "Annual household income", "Employment status", "Department", "Job", "Daily hours online",
    "Technical proficiency", "General hobbies and interests", "Device Type", "Device Platform",
    "Device Width", "Device Height",
]

COLS = Columns(*PARTICIPANT)


def study_name() -> Column:
    return F.trim(F.regexp_replace(file_stem(), r"\s*-\s*results.*$|-results.*$", ""))


def study_id() -> Column:
    return F.concat(F.lit("lys_"), short_hash("period", study_name()))


def layout(heads: DataFrame) -> DataFrame:
    described = F.transform(
        "header", lambda c, i: F.struct(i.alias("column_index"), c.alias("column"), header_parts(c).alias("parts"))
    )
    return heads.select(
        KEY,
        "header",
        "labels",
        "header_rows",
        F.transform("header", lambda c: F.when(c.isin(PARTICIPANT), "").otherwise("text")).alias("actions"),
        COLS.positions(F.col("header")).alias("pos"),
        F.transform(unshadowed(F.col("header")), lambda c: F.when(c.isin(PARTICIPANT), c)).alias("named"),
        F.filter(described, lambda d: ~d["column"].isin(PARTICIPANT)).alias("questions"),
    )


def is_open_text(answer: Column, field: Column) -> Column:
    """A cell someone wrote: long enough, several words, no link, no number, and in a
    field that takes answers."""
    f = F.lower(field)
    takes_answers = (f == "") | F.contains(f, F.lit("answer")) | F.contains(f, F.lit("response"))
    return (
        (F.char_length(answer) >= 15)
        & F.contains(answer, F.lit(" "))
        & ~answer.startswith("http")
        & to_float(answer).isNull()
        & takes_answers
    )


def answers(participants: DataFrame) -> DataFrame:
    """Long form: one row per participant and non-empty cell, without a shuffle."""
    filled = F.filter(
        F.transform("questions", lambda q: F.struct(q.alias("q"), cell_at(F.col("masked"), q["column_index"]).alias("answer"))),
        lambda a: a["answer"] != "",
    )
    return participants.select("*", F.explode(filled).alias("a")).select(
        *[c for c in participants.columns if c not in ("masked", "questions")],
        F.col("a.q.column_index").alias("column_index"),
        F.col("a.q.column").alias("column"),
        none_if_empty("a.q.parts.section").alias("section"),
        none_if_empty("a.q.parts.question").alias("question"),
        none_if_empty("a.q.parts.field").alias("field"),
        F.col("a.answer").alias("answer"),
    )


def build(run: Run) -> Output:
    response_id = F.when(F.get("pos", F.lit(0)).isNotNull(), COLS.raw("Response ID")).otherwise(surrogate_id("ly_"))
    shaped = shape(
        run,
        SOURCE,
        layout(run.layouts(SOURCE)),
        email=F.lit(None).cast("string"),
        own_names=F.array().cast("array<string>"),
        record_id=F.concat_ws(":", "study_id", response_id),
        extra={"study_name": study_name(), "study_id": study_id(), "response_id": response_id},
    )
    participants = loaded(shaped).select(
        "study_id",
        "response_id",
        "period",
        parse_dt(COLS.raw("Date")).alias("responded_at"),
        to_float(COLS.raw("Duration (ms)")).alias("duration_ms"),
        none_if_empty(COLS.raw("Country")).alias("country"),
        none_if_empty(COLS.raw("Age")).alias("age"),
        none_if_empty(COLS.raw("Gender")).alias("gender"),
        none_if_empty(COLS.raw("Device Type")).alias("device_type"),
        none_if_empty(COLS.raw("Device Platform")).alias("device_platform"),
        sorted_json(residual(F.col("named"), F.col("cells"), [])).alias("demographics"),
        "source_file",
        "row_number",
        SEQ,
        "record_id",
        "study_name",
        "masked",
        "questions",
    )
    long = answers(participants)
    written = long.filter(is_open_text(F.col("answer"), F.coalesce("field", F.lit(""))))
    items = feedback(
        written,
        source=F.lit(SOURCE),
        record_id=F.col("record_id"),
        sub_id=F.col("column_index"),
        period=F.col("period"),
        occurred_at=F.col("responded_at"),
        instrument=F.col("study_name"),
        question=F.coalesce("question", F.left("column", F.lit(200))),
        text=F.col("answer"),
        population=F.lit("panel"),
        initiative=initiative_of("study_name", rules=run.settings.initiatives),
        channel=F.col("device_type"),
        source_file=F.col("source_file"),
        row_number=F.col("row_number"),
        seq=F.col(SEQ),
    )
    counted = loaded(shaped).groupBy("source_file").agg(F.count("*").alias("n"))
    catalog = run.heads(SOURCE).filter(F.size("header") > 0)
    catalog = catalog.select("source_file", "period", study_id().alias("study_id"), study_name().alias("study_name"))
    studies = catalog.join(counted, "source_file", "left").select(
        "study_id",
        F.lit("lyssna_test").alias("kind"),
        F.col("study_name").alias("name"),
        initiative_of("study_name", rules=run.settings.initiatives).alias("initiative"),
        "period",
        F.coalesce("n", F.lit(0)).alias("n"),
        "source_file",
    )
    kept = ["study_id", "response_id", "column_index", "column", "section", "question", "field", "answer"]
    return Output(
        shaped,
        {
            "lyssna_participants": participants.drop("record_id", "study_name", "masked", "questions"),
            "lyssna_answers": long.select(*kept),
        },
        items,
        studies,
    )
