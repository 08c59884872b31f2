"""Columns and types of the published tables."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {
    "s": T.StringType(), "d": T.DoubleType(), "i": T.IntegerType(), "l": T.LongType(),
    "b": T.BooleanType(), "t": T.TimestampNTZType(), "a": T.ArrayType(T.StringType()),
}


def _table(spec: str) -> T.StructType:
    """``name`` is a string column, ``name:k`` one of kind ``k``."""
    pairs = [item.partition(":") for item in spec.split()]
    return T.StructType([T.StructField(name, _KINDS[kind or "s"]) for name, _, kind in pairs])


# Published column names, in their published order.
EVIDENCE = _table(
    "evidence_id source record_id sub_id period occurred_at:t population user_key user_id instrument question "
    "text text_chars:i category score:d score_type source_theme area areas:a theme theme_method answer_type "
    "segment audience channel plan initiative source_file row_number:l"
)
CANCELLATIONS = _table(
    "session_id period cancel_at:t user_key user_id billing_customer_ref audience audiences_names reason "
    "reason_category reason_other details competitor return_likelihood:d accepted_offers plan_id plan_interval "
    "billing_interval mrr_usd:d billing_price_usd:d age_days:d grade_level page_attributed coupon_ids winbacks:d "
    "validation_status subscription_status first_purchase_at:t last_active_at:t raw source_file row_number:l"
)
SURVEY_RESPONSES = _table(
    "response_id period survey_id survey_name survey_family initiative created_at:t completed_at:t user_key user_id "
    "visitor_id segment audience subscriber_status plan tenure grade_level channel os browser device_type href "
    "triggering_event attributes source_file row_number:l"
)
SURVEY_ANSWERS = _table(
    "response_id question_no:i question skipped:b response response_other value:d nps_category primary_theme "
    "themes:a choices:a"
)
TICKETS = _table(
    "ticket_id period created_at:t sender_type sender_domain user_key subject body body_chars:i source_file "
    "row_number:l user_id"
)
REFUNDS = _table(
    "request_id period requested_at:t user_key status refund_outcome amount_usd:d notes_sent_email "
    "would_have_stayed_if why_cancel not_pleased_because title_and_author content_opinion expected_to_find "
    "technical_issue dont_need_because dropdown source_file row_number:l user_id"
)
PANEL_PARTICIPANTS = _table(
    "study_id response_id period responded_at:t duration_ms:d country age gender device_type device_platform "
    "demographics source_file row_number:l"
)
PANEL_ANSWERS = _table("study_id response_id column_index:i column section question field answer")
INTERVIEWS = _table(
    "interview_id period user_key segment booking_date:t interview_date:t lead_interviewer outcome plan snapshot "
    "transcript notes raw source_file row_number:l user_id"
)
DOCUMENTS = _table(
    "doc_id period folder file_name title doc_type initiative chars:i text source_file row_number:l"
)
STUDIES = _table("study_id kind name initiative period n:l source_file")
USERS = _table(
    "user_key user_id sources:a evidence_items:l first_seen:t last_seen:t audience plan n_sources:i"
)
IDENTITY_MAP = _table("user_key user_id observations:l is_primary:b ambiguous:b")
REJECTS = _table("source period source_file row_number:l record_id excluded_reason")
RECONCILIATION = _table("source period file rows_read:l rows_loaded:l rows_rejected:l ok:b")

TABLES = {
    "evidence": EVIDENCE,
    "cancellations": CANCELLATIONS,
    "sprig_responses": SURVEY_RESPONSES,
    "sprig_answers": SURVEY_ANSWERS,
    "tickets": TICKETS,
    "refunds": REFUNDS,
    "lyssna_participants": PANEL_PARTICIPANTS,
    "lyssna_answers": PANEL_ANSWERS,
    "interviews": INTERVIEWS,
    "documents": DOCUMENTS,
    "studies": STUDIES,
    "users": USERS,
    "identity_map": IDENTITY_MAP,
    "rejects": REJECTS,
    "reconciliation": RECONCILIATION,
}
