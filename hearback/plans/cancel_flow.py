"""Cancel-flow exports: one record per cancel session."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import (
    audience_code,
    hash_id,
    is_digits,
    none_if_empty,
    parse_dt,
    sorted_json,
    strip,
    to_float,
)
from ..operators.names import name_tokens
from ..operators.reshape import residual
from .evidence import feedback
from .family import KEY, SEQ, Columns, Output, Run, bind, loaded, shape, surrogate_id, unshadowed

SOURCE = "chargebee"

# Column names of the export.
NAME_COLUMNS = [
    "ownerFirstName", "ownerLastName", "ownerFullName",
    "Owner First Name", "Owner Last Name", "Owner Full Name",
]
EMAIL_COLUMNS = ["email", "Owner Email"]
HASHED_COLUMNS = ["Billing ID", "Subscription ID"]
TEXT_COLUMNS = [
    "reasonOther", "competitor", "competitionOther", "details", "drilldown_modal_feedback",
    "free_text_modal_feedback",
]
ID_COLUMNS = ["exit_session_id", "internal_id", "id"]

# Published column → export column.
PLAIN = {
    "audiences_names": "Audiences Names",
    "reason": "reason",
    "reason_category": "bbkCategory",
    "accepted_offers": "acceptedOffers",
    "plan_id": "Plan ID",
    "plan_interval": "Plan Interval",
    "billing_interval": "billing_interval",
    "grade_level": "Customer Grade Level",
    "page_attributed": "Page attributed",
    "coupon_ids": "Coupon IDs",
    "validation_status": "validation_status",
    "subscription_status": "Subscription Status",
}
NUMBERS = {
    "return_likelihood": "returnLikelihood",
    "mrr_usd": "mrr",
    "billing_price_usd": "billing_price",
    "age_days": "age",
    "winbacks": "winbacks",
}
DATES = {"first_purchase_at": "First Purchase Date", "last_active_at": "lastActiveDate"}
TIMES = ["Cancel date", "startTime"]
MASKED = {"reason_other": "reasonOther", "details": "details", "competitor": "competitor"}

COLS = Columns(
    *NAME_COLUMNS, *EMAIL_COLUMNS, *TEXT_COLUMNS, *ID_COLUMNS, *PLAIN.values(), *NUMBERS.values(), *DATES.values(),
    "Customer Audience", *TIMES,
)


def actions(header: Column) -> Column:
    return F.transform(
        header,
        lambda c: F.when(c.isin(NAME_COLUMNS), "name")
        .when(c.isin(EMAIL_COLUMNS), "email")
        .when(c.isin(HASHED_COLUMNS), "id")
        .when(c.isin(TEXT_COLUMNS), "text")
        .when(c.isin([*ID_COLUMNS, *NUMBERS.values(), *DATES.values(), *TIMES]), "")
        .otherwise("contact"),
    )


def layout(heads: DataFrame) -> DataFrame:
    return heads.select(
        KEY,
        "header",
        "labels",
        "header_rows",
        actions(F.col("header")).alias("actions"),
        COLS.positions(F.col("header")).alias("pos"),
        unshadowed(F.col("header")).alias("named"),
    )


def people(run: Run) -> DataFrame:
    """Words of every person name in the name columns."""
    rows = bind(run, SOURCE, layout(run.layouts(SOURCE)))
    found = F.array(
        name_tokens(COLS.raw("ownerFirstName"), COLS.raw("ownerLastName")),
        name_tokens(COLS.raw("Owner First Name")),
        name_tokens(COLS.raw("ownerFullName")),
    )
    return rows.select(F.explode(found).alias("tokens"))


def first_of(*cells: Column) -> Column:
    return F.coalesce(*[none_if_empty(c) for c in cells], F.lit(""))


def build(run: Run) -> Output:
    own = F.concat(
        F.array(*[COLS.raw(c) for c in NAME_COLUMNS]), name_tokens(COLS.raw("ownerFullName"))
    )
    shaped = shape(
        run,
        SOURCE,
        layout(run.layouts(SOURCE)),
        email=first_of(COLS.raw("email"), COLS.raw("Owner Email")),
        own_names=own,
        record_id=F.coalesce(none_if_empty(COLS.raw("exit_session_id")), surrogate_id("cb_")),
    )
    raw_id = strip(first_of(COLS.raw("internal_id"), COLS.raw("id")))
    cancelled = F.coalesce(parse_dt(COLS.raw("Cancel date")), parse_dt(COLS.raw("startTime")))
    drop = [*NAME_COLUMNS, *EMAIL_COLUMNS, "id", "internal_id"]
    records = loaded(shaped).select(
        F.col("record_id").alias("session_id"),
        "period",
        cancelled.alias("cancel_at"),
        "user_key",
        F.when(is_digits(raw_id), raw_id).alias("user_id"),
        F.when(~is_digits(raw_id), hash_id(raw_id, run.settings.salt, "cb_")).alias("billing_customer_ref"),
        audience_code(COLS.raw("Customer Audience")).alias("audience"),
        *[none_if_empty(COLS.raw(c)).alias(name) for name, c in PLAIN.items()],
        *[none_if_empty(COLS.masked(c)).alias(name) for name, c in MASKED.items()],
        *[to_float(COLS.raw(c)).alias(name) for name, c in NUMBERS.items()],
        *[parse_dt(COLS.raw(c)).alias(name) for name, c in DATES.items()],
        sorted_json(residual(F.col("named"), F.col("masked"), drop)).alias("raw"),
        "source_file",
        "row_number",
        SEQ,
    )
    items = feedback(
        records,
        source=F.lit(SOURCE),
        record_id=F.col("session_id"),
        period=F.col("period"),
        occurred_at=F.col("cancel_at"),
        user_key=F.col("user_key"),
        user_id=F.col("user_id"),
        instrument=F.lit("Chargebee cancel flow"),
        question=F.lit("Cancel reason"),
        text=none_if_empty(
            F.concat_ws(" | ", "reason_other", "details", F.concat(F.lit("Competitor: "), F.col("competitor")))
        ),
        category=F.col("reason"),
        score=F.col("return_likelihood"),
        score_type=F.lit("return_likelihood_0_10"),
        map_name=F.lit("chargebee_reason"),
        map_key=F.col("reason"),
        segment=F.when(F.col("audience") == "book_club_member", "BCM").when(F.col("audience").isNotNull(), "Non-BCM"),
        audience=F.col("audience"),
        plan=F.col("plan_id"),
        source_file=F.col("source_file"),
        row_number=F.col("row_number"),
        seq=F.col(SEQ),
    )
    undated = loaded(shaped).filter(cancelled.isNull()).groupBy("source_file").agg(F.count("*").alias("n"))
    alert = undated.select(
        F.format_string("chargebee: %d unparsed cancel dates in %s", F.col("n"), F.substring_index("source_file", "/", -1)).alias("alert")
    )
    return Output(shaped, {"cancellations": records}, items, alerts=[alert])
