"""Refund-request form: headers are sentences, bound to fields by patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import none_if_empty, parse_dt, short_hash, strip, text_or_empty, to_float
from ..operators.reshape import match_headers
from .evidence import feedback
from .family import KEY, SEQ, Columns, Output, Run, loaded, shape, unparsed_dates

SOURCE = "mbg"

# Header pattern → field, in order of precedence.
PATTERNS = [
    (r"^\s*$", "status"),
    (r"(?i)notes", "notes_sent_email"),
    (r"(?i)^amount$", "amount_usd"),
    (r"(?i)eligible", "refund_outcome"),
    (r"(?i)timestamp", "requested_at"),
    (r"(?i)email", "email"),
    (r"(?i)made you stay", "would_have_stayed_if"),
    (r"(?i)why do you want to cancel", "why_cancel"),
    (r"(?i)not pleased", "not_pleased_because"),
    (r"(?i)title and author", "title_and_author"),
    (r"(?i)i think the content", "content_opinion"),
    (r"(?i)expected to find", "expected_to_find"),
    (r"(?i)technical issue", "technical_issue"),
    (r"(?i)don.?t need it anymore", "dont_need_because"),
    (r"(?i)dropdown", "dropdown"),
]
TEXTS = [
    "would_have_stayed_if", "why_cancel", "not_pleased_because", "title_and_author", "content_opinion",
    "expected_to_find", "technical_issue", "dont_need_because", "dropdown",
]

# Labels of the answers in the assembled text, in this order.
LABELS = {
    "why_cancel": "Why cancel",
    "would_have_stayed_if": "Would have stayed if",
    "not_pleased_because": "Not pleased because",
    "content_opinion": "Content",
    "expected_to_find": "Expected to find",
    "technical_issue": "Technical issue",
    "dont_need_because": "Don't need it because",
    "title_and_author": "Title",
}

COLS = Columns(*[f for _, f in PATTERNS])


def layout(heads: DataFrame) -> DataFrame:
    matched = match_headers(heads.select(KEY, "header"), PATTERNS, KEY)
    fields = F.col("fields")
    free = [*TEXTS, "notes_sent_email"]
    plain = [f for _, f in PATTERNS if f not in free]  # keys, dates, numbers and codes

    def action(i: Column) -> Column:
        field = F.get(F.map_keys(F.map_filter(fields, lambda k, v: v == i)), F.lit(0))
        return F.when(field == "email", "email").when(field.isin(free), "text").when(field.isin(plain), "").otherwise("contact")

    return heads.join(matched, KEY).select(
        KEY,
        "header",
        "labels",
        "header_rows",
        F.transform("header", lambda c, i: action(i)).alias("actions"),
        F.array(*[F.try_element_at(fields, F.lit(f)) for _, f in PATTERNS]).alias("pos"),
    )


def unmapped_columns(heads: DataFrame) -> DataFrame:
    matched = match_headers(heads.select("source_file", "header"), PATTERNS)
    return matched.select("source_file", F.explode("unmapped").alias("column")).select(
        F.format_string(
            "mbg: unmapped column '%s' in %s (kept in mirror only)",
            F.col("column"),
            F.substring_index("source_file", "/", -1),
        ).alias("alert")
    )


def feedback_texts(records: DataFrame) -> DataFrame:
    """Records with ``text``: their labelled answers, null without any."""
    said = F.concat_ws(" | ", *[F.concat(F.lit(f"{label}: "), F.col(f)) for f, label in LABELS.items()])
    return records.withColumn("text", none_if_empty(said))


def build(run: Run) -> Output:
    requested = COLS.raw("requested_at")
    shaped = shape(
        run,
        SOURCE,
        layout(run.layouts(SOURCE)),
        email=COLS.raw("email"),
        own_names=F.array().cast("array<string>"),
        record_id=F.concat(
            F.lit("mbg_"), short_hash(text_or_empty("user_key"), requested, COLS.raw("why_cancel"))
        ),
    )
    records = loaded(shaped).select(
        F.col("record_id").alias("request_id"),
        "period",
        parse_dt(requested).alias("requested_at"),
        "user_key",
        none_if_empty(strip(COLS.raw("status"))).alias("status"),
        none_if_empty(COLS.raw("refund_outcome")).alias("refund_outcome"),
        to_float(COLS.raw("amount_usd")).alias("amount_usd"),
        none_if_empty(COLS.masked("notes_sent_email")).alias("notes_sent_email"),
        *[none_if_empty(COLS.masked(f)).alias(f) for f in TEXTS],
        "source_file",
        "row_number",
        SEQ,
    )
    items = feedback(
        feedback_texts(records),
        source=F.lit(SOURCE),
        record_id=F.col("request_id"),
        period=F.col("period"),
        occurred_at=F.col("requested_at"),
        user_key=F.col("user_key"),
        instrument=F.lit("Money-Back Guarantee form"),
        question=F.lit("Why do you want to cancel?"),
        text=F.col("text"),
        category=F.col("why_cancel"),
        score=F.col("amount_usd"),
        score_type=F.lit("refund_amount_usd"),
        source_file=F.col("source_file"),
        row_number=F.col("row_number"),
        seq=F.col(SEQ),
    )
    return Output(
        shaped,
        {"refunds": records},
        items,
        alerts=[unmapped_columns(run.heads(SOURCE)), unparsed_dates(shaped, SOURCE, requested, parse_dt(requested))],
    )


