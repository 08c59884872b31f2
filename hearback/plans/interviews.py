"""Interview tracker: one record per interview, links removed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import initiative_of, none_if_empty, parse_dt, short_hash, sorted_json, text_or_empty
from ..operators.names import name_tokens
from ..operators.reshape import residual
from .evidence import feedback
from .family import KEY, SEQ, Columns, Output, Run, bind, file_name, loaded, shape, unshadowed

SOURCE = "interviews"

# Column names of the export; link columns to remove.
LINKS = ["Interview recording link", "Transcript link", "Snapshot link", "Metabase Info"]
LONG_TEXTS = ["Snapshot (for Zapier)", "Transcript (for Zapier)"]
COLS = Columns(
    "Users", "Email", "Segment", "Booking date", "Interview date", "Lead Interviewer", "Outcome", "Plan",
    *LONG_TEXTS, "Additional Notes",
)


def layout(heads: DataFrame) -> DataFrame:
    return heads.select(
        KEY,
        "header",
        "labels",
        "header_rows",
        F.transform(
            "header",
            lambda c: F.when(c == "Users", "name").when(c == "Email", "email").when(c.isin(LINKS), "removed").otherwise("mail"),
        ).alias("actions"),
        COLS.positions(F.col("header")).alias("pos"),
        unshadowed(F.col("header")).alias("named"),
    )


def people(run: Run) -> DataFrame:
    rows = bind(run, SOURCE, layout(run.layouts(SOURCE)))
    return rows.select(name_tokens(COLS.raw("Users")).alias("tokens"))


def build(run: Run) -> Output:
    shaped = shape(
        run,
        SOURCE,
        layout(run.layouts(SOURCE)),
        email=COLS.raw("Email"),
        own_names=F.concat(name_tokens(COLS.raw("Users")), F.array(COLS.raw("Users"))),
        record_id=F.concat(
            F.lit("iv_"),
            short_hash(
                text_or_empty("user_key"), COLS.raw("Interview date"), COLS.raw("Booking date"), "row_number", "source_file"
            ),
        ),
        mail=True,
        keep_first=False,
    )
    records = loaded(shaped).select(
        F.col("record_id").alias("interview_id"),
        "period",
        "user_key",
        none_if_empty(COLS.raw("Segment")).alias("segment"),
        parse_dt(COLS.raw("Booking date")).alias("booking_date"),
        parse_dt(COLS.raw("Interview date")).alias("interview_date"),
        none_if_empty(COLS.raw("Lead Interviewer")).alias("lead_interviewer"),
        none_if_empty(COLS.raw("Outcome")).alias("outcome"),
        none_if_empty(COLS.raw("Plan")).alias("plan"),
        none_if_empty(COLS.masked("Snapshot (for Zapier)")).alias("snapshot"),
        none_if_empty(COLS.masked("Transcript (for Zapier)")).alias("transcript"),
        none_if_empty(COLS.masked("Additional Notes")).alias("notes"),
        sorted_json(residual(F.col("named"), F.col("masked"), LONG_TEXTS)).alias("raw"),
        "source_file",
        "row_number",
        SEQ,
    )
    items = feedback(
        records.filter("snapshot IS NOT NULL"),
        source=F.lit(SOURCE),
        record_id=F.col("interview_id"),
        period=F.col("period"),
        occurred_at=F.col("interview_date"),
        user_key=F.col("user_key"),
        instrument=F.lit("User interview"),
        question=F.lit("Interview snapshot"),
        text=F.col("snapshot"),
        segment=F.col("segment"),
        plan=F.col("plan"),
        initiative=initiative_of(F.left("snapshot", F.lit(300)), rules=run.settings.initiatives),
        source_file=F.col("source_file"),
        row_number=F.col("row_number"),
        seq=F.col(SEQ),
    )
    counted = loaded(shaped).groupBy("source_file").agg(F.count("*").alias("n"))
    heads = run.heads(SOURCE).select("source_file", "period")
    studies = heads.join(counted, "source_file", "left").select(
        F.concat(F.lit("ivt_"), short_hash("period", file_name())).alias("study_id"),
        F.lit("interviews").alias("kind"),
        F.concat(F.lit("Interviews tracker ("), file_name(), F.lit(")")).alias("name"),
        F.lit(None).cast("string").alias("initiative"),
        "period",
        F.coalesce("n", F.lit(0)).alias("n"),
        "source_file",
    )
    return Output(shaped, {"interviews": records}, items, studies)
