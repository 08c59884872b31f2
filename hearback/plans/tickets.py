"""Support tickets: one record per mail."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import email_domain, local_part_tokens, none_if_empty, parse_dt, strip
from .evidence import feedback
from .family import KEY, SEQ, Columns, Output, Run, loaded, shape, surrogate_id, unparsed_dates

SOURCE = "freshdesk"

# Column names of the export.
REQUIRED = ["Date", "Ticket ID", "User", "Segmentation", "Feedback"]
ACTIONS = {"Date": "", "Ticket ID": "", "User": "sender", "Segmentation": "subject", "Feedback": "mail"}

COLS = Columns(*REQUIRED)


def sender_type(
    addr: Column, internal_domains: list[str], automated_patterns: list[str], typed_domains: dict[str, list[str]]
) -> Column:
    """Kind of sender by the first rule that fits: own domain, automated mail, a known
    kind of company, else a customer."""
    a = F.lower(strip(addr))
    domain = email_domain(addr)

    def within(domains: list[str]) -> Column:
        test = F.lit(False)
        for d in domains:
            test = test | (domain == d) | domain.endswith("." + d)
        return test

    automated = F.lit(False)
    for p in automated_patterns:
        automated = automated | F.contains(a, F.lit(p))
    kind = F.when(within(internal_domains), "internal").when(automated, "automated")
    for name, domains in typed_domains.items():
        kind = kind.when(within(domains), name)
    return kind.otherwise("customer")


def layout(heads: DataFrame) -> DataFrame:
    action = F.lit("contact")
    return heads.select(
        KEY,
        "header",
        "labels",
        "header_rows",
        F.transform(
            "header",
            lambda c: F.coalesce(*[F.when(c == name, F.lit(a)) for name, a in ACTIONS.items()], action),
        ).alias("actions"),
        COLS.positions(F.col("header")).alias("pos"),
    )


def missing_columns(heads: DataFrame) -> DataFrame:
    missing = F.array_except(F.array(*[F.lit(c) for c in REQUIRED]), F.col("header"))
    return heads.filter(F.size(missing) > 0).select(
        F.format_string(
            "freshdesk: %s missing columns %s", F.substring_index("source_file", "/", -1), F.array_join(missing, ", ")
        ).alias("alert")
    )


def build(run: Run) -> Output:
    settings = run.settings
    addr = strip(COLS.raw("User"))
    kind = sender_type(addr, settings.internal_domains, settings.automated_patterns, settings.typed_domains)
    has_domain = F.contains(addr, F.lit("@"))
    domain = F.when(has_domain, email_domain(addr))
    key = F.when(kind == "customer", F.col("user_key"))
    shaped = shape(
        run,
        SOURCE,
        layout(run.layouts(SOURCE)),
        email=addr,
        own_names=local_part_tokens(addr),
        record_id=F.coalesce(none_if_empty(strip(COLS.raw("Ticket ID"))), surrogate_id("fd_")),
        rules=[
            ("sender_internal", F.col("sender_type") == "internal"),
            ("sender_automated", F.col("sender_type") == "automated"),
        ],
        extra={
            "sender_type": kind,
            "sender_domain": domain,
            "user_key": key,
            "sender": F.coalesce(key, F.concat(F.lit("@"), domain), F.lit("")),
        },
        mail=True,
    )
    body = COLS.masked("Feedback")
    created = COLS.raw("Date")
    records = loaded(shaped).select(
        F.col("record_id").alias("ticket_id"),
        "period",
        parse_dt(created).alias("created_at"),
        "sender_type",
        "sender_domain",
        "user_key",
        none_if_empty(COLS.masked("Segmentation")).alias("subject"),
        none_if_empty(body).alias("body"),
        F.char_length(body).alias("body_chars"),
        "source_file",
        "row_number",
        SEQ,
    )
    items = feedback(
        records,
        source=F.lit(SOURCE),
        record_id=F.col("ticket_id"),
        period=F.col("period"),
        occurred_at=F.col("created_at"),
        user_key=F.col("user_key"),
        instrument=F.lit("Freshdesk ticket"),
        text=none_if_empty(F.concat_ws("\n", "subject", "body")),
        category=F.col("sender_type"),
        map_name=F.lit("freshdesk_sender_type"),
        map_key=F.col("sender_type"),
        source_file=F.col("source_file"),
        row_number=F.col("row_number"),
        seq=F.col(SEQ),
    )
    return Output(
        shaped,
        {"tickets": records},
        items,
        alerts=[missing_columns(run.heads(SOURCE)), unparsed_dates(shaped, SOURCE, created, parse_dt(created))],
    )
