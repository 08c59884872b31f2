"""The export families over records that are built from the test tables.

Each query writes a table's rows as the cells of an export and sends them through
the family's own code: binding, masking, keep-first, rejects, records, evidence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..plans import cancel_flow, interviews, panel, refunds, reports, surveys, tickets
from ..plans.family import KEY, Run, rejects
from ..session import Inline, load, widen
from ..settings import Settings
from ..sources.listing import with_origin
from .registry import query
from .text import masked_sql

SALT = "test-salt-0123456789"
# Configuration of the runs over the test tables.
CONFIG = {
    "sources": {
        "chargebee": ["Chargebee Form", "Chargebee"],
        "freshdesk": ["Freshdesk Tickets", "Freshdesk"],
        "mbg": ["MBG Form", "MBG"],
        "sprig": ["Surveys", "Sprig"],
        "lyssna": ["Lyssna Tests", "Lyssna"],
        "interviews": ["Interviews"],
    },
    "freshdesk": {
        "exclude_internal_domains": ["ours.test"],
        "exclude_automated_patterns": ["no-reply", "noreply", "mailer-daemon", "postmaster"],
        "sender_types": {"payment_dispute": ["paypal.com", "stripe.com"], "marketplace": ["shop.example"]},
    },
}
SETTINGS = Settings.from_config(CONFIG, SALT)
# What every number is like; a cast that fails costs an exception for each row.
NUMBER = r"^[^0-9A-Za-z]*[0-9]+[^0-9A-Za-z]*$"


def as_export(
    spark: SparkSession,
    rows: DataFrame,
    source: str,
    file: Column,
    number: Column,
    cells: dict[str, Column] | list[tuple[str, Column]],
    labels: list[str] | None = None,
    surplus: list[Column] | None = None,
) -> Run:
    """A run whose raw records are ``cells`` of ``rows`` (pairs where a name repeats); rows
    with the same ``file`` (a few values whose first letters or numbers differ) make up one
    export file. ``surplus`` are cells beyond the header.

    The test tables are single row groups, so the records are spread over the cores;
    a real run reads them from the many files of its work folder.
    """
    name, cells = file.cast("string"), list(cells.items()) if isinstance(cells, dict) else cells
    names = [n for n, _ in cells]
    raw = widen(rows, number).select(
        F.lit("2026-07").alias("period"),
        F.lit(source).alias("source"),
        F.concat(F.lit("2026-07/Export/"), name, F.lit(".csv")).alias("source_file"),
        F.coalesce(F.when(name.rlike(NUMBER), name.try_cast("long")), F.ascii(name)).cast("long").alias("file_no"),
        F.xxhash64(*(F.lit(n) for n in [source, *names, *(labels or names)])).alias(KEY),
        (number + 1).cast("long").alias("row_number"),
        F.array(*[F.coalesce(c.cast("string"), F.lit("")) for c in [*(c for _, c in cells), *(surplus or [])]]).alias("cells"),
    )
    # a header is a column of its file and no constant: what is worked out from it is not worked out for each record
    files = raw.groupBy("period", "source", "source_file", KEY).agg(F.count("*").alias("rows"))
    heads = files.withColumns(
        {
            "header": F.when(F.col("rows") > 0, F.array(*[F.lit(n) for n in names])),
            "labels": F.when(F.col("rows") > 0, F.array(*[F.lit(n) for n in labels or names])),
            "header_rows": F.lit(2 if labels else 1).cast("long"),
        }
    ).drop("rows")
    return Run(SETTINGS, Inline(spark), raw, heads)


def text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def joined(c: str) -> Column:
    return F.array_join(c, "|").alias(c)


KEY_SQL = f"'u_' || left(sha256('{SALT}' || %s), 16)"


# --- cancel flow ---------------------------------------------------------------------


def cancel_run(spark: SparkSession, sf: str) -> Run:
    orders = load(spark, sf, "orders")
    key, customer, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    cells = {
        "exit_session_id": text("s", key),
        "internal_id": F.when(status == "F", text("cust_", customer)).otherwise(customer.cast("string")),
        "email": text("C", customer, "@Mail.com"),
        "ownerFirstName": F.lit("Quentin"),
        "reason": F.col("o_orderpriority"),
        "details": F.when(urgent, text("Quentin said call 555-123-4567 about ", key)),
        "competitor": F.when(status == "P", F.lit("Rival")),
        "returnLikelihood": key % 11,
        "mrr": F.format_number("o_totalprice", 2),
        "Cancel date": F.when(status != "O", F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")),
        "startTime": F.date_format("o_orderdate", "MM/dd/yyyy HH:mm"),
        "Customer Audience": F.when(status == "O", "Book Club Member").when(status == "F", "student"),
        "Billing ID": text("B", customer),
        "Coupon Codes": F.when(key % 2 == 0, "SAVE10"),
    }
    return as_export(spark, orders, "chargebee", status, key, cells)


@query(
    "cancel_records",
    f"""
SELECT 's' || o_orderkey AS session_id, o_orderdate AS cancel_at, {KEY_SQL % "'c' || o_custkey || '@mail.com'"} AS user_key,
       CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS VARCHAR) END AS user_id,
       CASE WHEN o_orderstatus = 'F' THEN 'cb_' || left(sha256('{SALT}|id|cust_' || o_custkey), 16) END AS billing_customer_ref,
       CASE o_orderstatus WHEN 'O' THEN 'book_club_member' WHEN 'F' THEN 'student' END AS audience,
       CASE WHEN o_orderpriority = '1-URGENT' THEN '[name] said call [phone] about ' || o_orderkey END AS details,
       CAST(o_orderkey % 11 AS DOUBLE) AS return_likelihood, o_totalprice AS mrr_usd,
       'h_' || left(sha256('{SALT}|id|B' || o_custkey), 16) AS billing,
       CASE WHEN o_orderkey % 2 = 0 THEN 'SAVE10' END AS coupon, false AS has_email
FROM orders
""",
)
def cancel_records(spark: SparkSession, sf: str) -> DataFrame:
    records = cancel_flow.build(cancel_run(spark, sf)).tables["cancellations"]
    return records.select(
        "session_id", "cancel_at", "user_key", "user_id", "billing_customer_ref", "audience", "details",
        "return_likelihood", "mrr_usd",
        scalars.json_field("raw", "Billing ID").alias("billing"),
        scalars.json_field("raw", "Coupon Codes").alias("coupon"),
        F.contains("raw", F.lit("ail.com")).alias("has_email"),
    )


@query(
    "cancel_evidence",
    """
SELECT 's' || o_orderkey AS record_id,
       nullif(concat_ws(' | ', CASE WHEN o_orderpriority = '1-URGENT' THEN '[name] said call [phone] about ' || o_orderkey END,
                        CASE WHEN o_orderstatus = 'P' THEN 'Competitor: Rival' END), '') AS text,
       CASE o_orderstatus WHEN 'O' THEN 'BCM' WHEN 'F' THEN 'Non-BCM' END AS segment, o_orderpriority AS map_key
FROM orders
""",
)
def cancel_evidence(spark: SparkSession, sf: str) -> DataFrame:
    return cancel_flow.build(cancel_run(spark, sf)).items.select("record_id", "text", "segment", "map_key")


# --- surveys -------------------------------------------------------------------------


def survey_run(spark: SparkSession, sf: str) -> Run:
    """Orders as answers; one customer and status is one response, later copies repeat it."""
    orders = load(spark, sf, "orders")
    key, customer, urgent = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority") == "1-URGENT"
    likely = key % 11
    columns = [
        ("responseGroupUid", "", text(customer, "-", F.col("o_orderstatus"))),
        ("surveyName", "", text("PMF ", F.col("o_orderstatus"))),
        ("userId", "", customer),
        ("createdAt", "", F.date_format("o_orderdate", "MM/dd/yyyy HH:mm:ss")),
        ("Q1_Question_Text", "How would you  feel if it was gone?", F.lit("")),
        ("Q1_Response", "", F.when(urgent, "Very disappointed, Zoe").otherwise((key % 5 + 1).cast("string"))),
        ("Q2_Question_Text", "How likely?", F.lit("How likely are you?")),
        ("Q2_Response", "", F.when(key % 7 == 0, "[Skipped by user]").otherwise(likely.cast("string"))),
        ("Q2_Response_NPSCategory", "", F.when(likely >= 9, "Promoter").when(likely >= 7, "Passive").otherwise("Detractor")),
        ("Q3_Question_Text", "Which?", F.lit("")),
        ("Q3_Response", "", F.lit("")),
        ("Q3_Response_Other", "", F.when(key % 6 == 0, "mail zoe@mail.com")),
        ("Q3_Choice_1", "Phone", F.when(key % 2 == 0, "1").otherwise("0")),
        ("Q3_Choice_2", "Tablet", F.when(key % 3 == 0, "my pad").otherwise("false")),
        # labels repeat: the last filled cell counts
        ("Attribute_0", "email", F.lit("old@mail.com")),
        ("Attribute_1", "email", text("c", customer, "@mail.com")),
        ("Attribute_2", "firstName", F.lit("Zoe")),
        ("Attribute_3", "isStaff", F.when(customer % 50 == 7, "True")),
        ("Attribute_4", "email", F.lit("")),
        ("Attribute_5", "isStaff", F.lit("")),
    ]
    return as_export(
        spark, orders, "sprig", F.col("o_orderstatus"), key, [(name, cell) for name, _, cell in columns], [label for _, label, _ in columns]
    )


SURVEY_SQL = """
ranked AS (
  SELECT *, o_custkey || '-' || o_orderstatus AS response_id,
         row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS rn FROM orders
), kept AS (SELECT * FROM ranked WHERE rn = 1 AND o_custkey % 50 <> 7),
answered AS (
  SELECT response_id, 1 AS question_no, 'How would you feel if it was gone?' AS question, false AS skipped,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'Very disappointed, [name]' ELSE CAST(o_orderkey % 5 + 1 AS VARCHAR) END AS response,
         NULL AS response_other, NULL AS nps_category, '' AS choices, 'pmf_1_5' AS score_type,
         CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE CAST(o_orderkey % 5 + 1 AS DOUBLE) END AS score,
         CASE WHEN o_orderpriority = '1-URGENT' OR o_orderkey % 5 = 4 THEN 'very_disappointed'
              WHEN o_orderkey % 5 = 3 THEN 'somewhat_disappointed' ELSE 'not_disappointed' END AS category
  FROM kept
  UNION ALL
  SELECT response_id, 2, 'How likely are you?', o_orderkey % 7 = 0,
         CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 11 AS VARCHAR) END, NULL,
         CASE WHEN o_orderkey % 11 >= 9 THEN 'Promoter' WHEN o_orderkey % 11 >= 7 THEN 'Passive' ELSE 'Detractor' END, '', 'nps_0_10',
         CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 11 AS DOUBLE) END,
         CASE WHEN o_orderkey % 11 >= 9 THEN 'Promoter' WHEN o_orderkey % 11 >= 7 THEN 'Passive' ELSE 'Detractor' END
  FROM kept
  UNION ALL
  SELECT response_id, 3, 'Which?', false, NULL, CASE WHEN o_orderkey % 6 = 0 THEN 'mail [email]' END, NULL,
         concat_ws('|', CASE WHEN o_orderkey % 2 = 0 THEN 'Phone' END, CASE WHEN o_orderkey % 3 = 0 THEN 'my pad' END), NULL, NULL, NULL
  FROM kept WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0
)
"""


@query(
    "survey_answers",
    f"WITH {SURVEY_SQL} SELECT * FROM answered",
)
def survey_answers(spark: SparkSession, sf: str) -> DataFrame:
    run = survey_run(spark, sf)
    shaped = surveys.shaped_records(run)
    answered = surveys.answers(surveys.responses(shaped, run, "masked", "questions"))
    return answered.select(
        "response_id", "question_no", "question", "skipped", "response", "response_other", "nps_category",
        joined("choices"), "score_type", "score", "category",
    )


@query(
    "survey_evidence",
    f"""
WITH {SURVEY_SQL}
SELECT response_id AS record_id, CAST(question_no AS VARCHAR) AS sub_id, question_no = 3 AS is_choice,
       CASE WHEN question_no < 3 THEN response ELSE coalesce(response_other, replace(choices, '|', '; ')) END AS text
FROM answered WHERE NOT skipped
""",
)
def survey_evidence(spark: SparkSession, sf: str) -> DataFrame:
    return surveys.build(survey_run(spark, sf)).items.select("record_id", "sub_id", "is_choice", "text")


@query(
    "survey_responses",
    f"""
WITH {SURVEY_SQL}
SELECT response_id, 'PMF ' || o_orderstatus AS survey_name, 'PMF' AS survey_family, 'PMF' AS initiative, o_orderdate AS created_at,
       {KEY_SQL % "'c' || o_custkey || '@mail.com'"} AS user_key, CAST(o_custkey AS VARCHAR) AS user_id, 'web' AS channel,
       '{{}}' AS attributes, o_orderkey + 1 AS row_number
FROM kept
""",
)
def survey_responses(spark: SparkSession, sf: str) -> DataFrame:
    return surveys.build(survey_run(spark, sf)).tables["sprig_responses"].select(
        "response_id", "survey_name", "survey_family", "initiative", "created_at", "user_key", "user_id", "channel",
        "attributes", "row_number",
    )


@query(
    "survey_rejects",
    f"""
WITH {SURVEY_SQL}
SELECT CASE WHEN rn > 1 THEN 'duplicate' ELSE 'staff_response' END AS reason, count(*) AS rows, min(o_orderkey) + 1 AS first_row
FROM ranked WHERE rn > 1 OR o_custkey % 50 = 7 GROUP BY 1
""",
)
def survey_rejects(spark: SparkSession, sf: str) -> DataFrame:
    found = rejects(surveys.shaped_records(survey_run(spark, sf)), "sprig")
    return found.groupBy(F.col("excluded_reason").alias("reason")).agg(
        F.count("*").alias("rows"), F.min("row_number").alias("first_row")
    )


# --- tickets -------------------------------------------------------------------------


def ticket_run(spark: SparkSession, sf: str) -> Run:
    customer = load(spark, sf, "customer")
    key, nation = F.col("c_custkey"), F.col("c_nationkey") % 5
    sender = (
        F.when(nation == 0, text("robot", key, "@help.ours.test"))
        .when(nation == 1, "no-reply@shop.test")
        .when(nation == 2, "Service@mail.PayPal.com")
        .otherwise(text("quin.lee", key, "@mail.com"))
    )
    body = text("Hi Maria, quin has ", F.col("c_mktsegment"), ".\nmail a@b.com\n\nKind regards,\nBob McNeil\n")
    cells = {
        "Date": F.lit("2026-07-10 09:00:00"),
        "Ticket ID": text("t", key),
        "User": sender,
        "Segmentation": text("Cancel plan ", key, " - Max Moe"),
        "Feedback": body,
    }
    return as_export(spark, customer, "freshdesk", F.col("c_mktsegment"), key, cells)


@query(
    "ticket_records",
    f"""
SELECT 't' || c_custkey AS ticket_id, CASE WHEN c_nationkey % 5 = 2 THEN 'payment_dispute' ELSE 'customer' END AS sender_type,
       CASE WHEN c_nationkey % 5 = 2 THEN 'mail.paypal.com' ELSE 'mail.com' END AS sender_domain,
       CASE WHEN c_nationkey % 5 > 2 THEN {KEY_SQL % "'quin.lee' || c_custkey || '@mail.com'"} END AS user_key,
       'Cancel plan ' || c_custkey || ' - [name]' AS subject,
       'Hi [name], ' || CASE WHEN c_nationkey % 5 = 2 THEN 'quin' ELSE '[name]' END || ' has ' || c_mktsegment || '.' || chr(10)
         || 'mail [email]' || chr(10) || chr(10) || 'Kind regards,' || chr(10) || '[name]' || chr(10) AS body
FROM customer WHERE c_nationkey % 5 > 1
""",
)
def ticket_records(spark: SparkSession, sf: str) -> DataFrame:
    records = tickets.build(ticket_run(spark, sf)).tables["tickets"]
    body = F.concat(F.rtrim("body", F.lit("\n")), F.lit("\n"))
    return records.select("ticket_id", "sender_type", "sender_domain", "user_key", "subject", body.alias("body"))


@query(
    "ticket_rejects",
    """
SELECT CASE c_nationkey % 5 WHEN 0 THEN 'sender_internal' ELSE 'sender_automated' END AS reason, count(*) AS rows
FROM customer WHERE c_nationkey % 5 < 2 GROUP BY 1
""",
)
def ticket_rejects(spark: SparkSession, sf: str) -> DataFrame:
    found = rejects(tickets.build(ticket_run(spark, sf)).shaped, "freshdesk")
    return found.groupBy(F.col("excluded_reason").alias("reason")).agg(F.count("*").alias("rows"))


# --- refunds -------------------------------------------------------------------------


@query(
    "refund_records",
    f"""
WITH asked AS (
  SELECT *, 'c' || o_custkey || '@mail.com' AS email, strftime(o_orderdate, '%m/%d/%Y') || ' 10:00:00' AS asked_at,
         'Reason ' || o_orderpriority AS why FROM orders
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate, o_orderpriority ORDER BY o_orderstatus, o_orderkey) AS rn FROM asked
)
SELECT 'mbg_' || left(sha256({KEY_SQL % "email"} || chr(31) || asked_at || chr(31) || why), 12) AS request_id,
       o_orderdate + INTERVAL 10 HOUR AS requested_at, {KEY_SQL % "email"} AS user_key, o_totalprice AS amount_usd,
       'sent to [email]' AS notes_sent_email,
       'Why cancel: ' || why || ' | Title: Book ' || o_orderkey AS text
FROM numbered WHERE rn = 1
""",
)
def refund_records(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders")
    email = text("c", F.col("o_custkey"), "@mail.com")
    cells = {
        "": F.col("o_orderstatus"),
        "Support notes": F.concat(F.lit("sent to "), email),
        "Amount": F.format_number("o_totalprice", 2),
        "Timestamp": F.concat(F.date_format("o_orderdate", "MM/dd/yyyy"), F.lit(" 10:00:00")),
        "Email address": email,
        "Second email": F.lit("x"),
        "Why do you want to cancel?": text("Reason ", F.col("o_orderpriority")),
        "Title and author": text("Book ", F.col("o_orderkey")),
    }
    built = refunds.build(as_export(spark, orders, "mbg", F.col("o_orderstatus"), F.col("o_orderkey"), cells))
    return refunds.feedback_texts(built.tables["refunds"]).select(
        "request_id", "requested_at", "user_key", "amount_usd", "notes_sent_email", "text"
    )


# --- panel tests ---------------------------------------------------------------------

PANEL_QUESTION = '2. (Questions) (Question 1: "What did you think?") Answer'
PANEL_TIME = '2. (Questions) (Question 1: "What did you think?") Duration (ms)'


def panel_run(spark: SparkSession, sf: str) -> Run:
    part = load(spark, sf, "part")
    cells = {
        "Response ID": text("p", F.col("p_partkey")),
        "Date": F.lit("2026-07-15 10:00:00"),
        "Duration (ms)": F.col("p_size") * 100,
        "Device Type": F.when(F.col("p_size") > 20, "Mobile"),
        PANEL_QUESTION: F.when(F.col("p_size") % 3 != 0, text("I like the ", F.col("p_name"), " a lot")),
        PANEL_TIME: F.col("p_retailprice").cast("int"),
        "Note": F.when(F.col("p_size") % 3 == 1, "https://x.test/ see this page").when(F.col("p_size") % 3 == 2, "short one"),
    }
    return as_export(spark, part, "lyssna", F.col("p_type"), F.col("p_partkey"), cells)


@query(
    "panel_answers",
    """
SELECT 'p' || p_partkey AS response_id, 4 AS column_index, '2. (Questions)' AS section, 'What did you think?' AS question,
       'Answer' AS field, 'I like the ' || p_name || ' a lot' AS answer FROM part WHERE p_size % 3 <> 0
UNION ALL
SELECT 'p' || p_partkey, 5, '2. (Questions)', 'What did you think?', 'Duration (ms)', CAST(CAST(floor(p_retailprice) AS INT) AS VARCHAR) FROM part
UNION ALL
SELECT 'p' || p_partkey, 6, NULL, NULL, 'Note', CASE p_size % 3 WHEN 1 THEN 'https://x.test/ see this page' ELSE 'short one' END
FROM part WHERE p_size % 3 <> 0
""",
)
def panel_answers(spark: SparkSession, sf: str) -> DataFrame:
    long = panel.build(panel_run(spark, sf)).tables["lyssna_answers"]
    return long.select("response_id", "column_index", "section", "question", "field", "answer")


@query(
    "panel_open_texts",
    """
SELECT p_partkey + 1 AS row_number, '4' AS sub_id, 'panel' AS population, 'What did you think?' AS question,
       'I like the ' || p_name || ' a lot' AS text, CASE WHEN p_size > 20 THEN 'Mobile' END AS channel
FROM part WHERE p_size % 3 <> 0
""",
)
def panel_open_texts(spark: SparkSession, sf: str) -> DataFrame:
    items = panel.build(panel_run(spark, sf)).items
    return items.select("row_number", "sub_id", "population", "question", "text", "channel")


# --- interviews, reports, paths ------------------------------------------------------


@query(
    "interview_records",
    f"""
SELECT s_suppkey + 1 AS row_number, {KEY_SQL % "'s' || s_suppkey || '@mail.com'"} AS user_key,
       TIMESTAMP '2026-08-05 15:04:00' AS interview_date, '[name] likes nation ' || s_nationkey || '. Ask [name].' AS snapshot,
       '[removed]' AS link, '[name]' AS users
FROM supplier
""",
)
def interview_records(spark: SparkSession, sf: str) -> DataFrame:
    supplier = load(spark, sf, "supplier")
    cells = {
        "Users": F.lit("Gina Hall"),
        "Email": text("s", F.col("s_suppkey"), "@mail.com"),
        "Interview date": F.lit("August 5, 2026 3:04 PM"),
        "Snapshot (for Zapier)": text("Gina likes nation ", F.col("s_nationkey"), ". Ask Gina Hall."),
        "Transcript link": F.lit("https://rec.test/1"),
    }
    records = interviews.build(as_export(spark, supplier, "interviews", F.col("s_nationkey"), F.col("s_suppkey"), cells)).tables["interviews"]
    return records.select(
        "row_number", "user_key", "interview_date", "snapshot",
        scalars.json_field("raw", "Transcript link").alias("link"),
        scalars.json_field("raw", "Users").alias("users"),
    )


# Names after a greeting and after a sign-off on the line before.
GREETED_SQL = r"\b(Hi|Hello|Hey|Dear|Hiya)(,?[ \t]+)[A-Z][a-z]+(?:[ \t]+[A-Z][a-z]+)?\b"
# Written out here so that an error in the code's own list shows.
SIGN_OFFS_SQL = (
    "Thanks|Thank you|Thank You|Best|Regards|Best regards|Kind regards|Warm regards|Sincerely|Cheers"
    "|Warmly|Respectfully|Thanks again|Many thanks"
)
SIGNED_SQL = (
    rf"\b({SIGN_OFFS_SQL})([,!.]?[ \t]*\r?\n+[ \t]*[-—]?[ \t]*)"
    r"[A-Z][a-z]+[a-zA-Z''\-]*(?:[ \t]+[A-Z][a-zA-Z''\-]+)?"
)


def scrubbed_sql(c: str) -> str:
    greeted = f"regexp_replace({masked_sql(c)}, '{GREETED_SQL}', '\\1\\2[name]', 'g')"
    return f"regexp_replace({greeted}, '{SIGNED_SQL}', '\\1\\2[name]', 'g')"


@query(
    "report_records",
    f"""
SELECT 'doc_' || left(sha256('2026-07' || chr(31) || '2026-07/' || lang || '/nps-report_' || doc_id || '.md'), 12) AS doc_id,
       'nps-report ' || doc_id AS title, lang AS folder, 'md' AS doc_type, 'NPS' AS initiative,
       length(masked) AS chars, md5(masked) AS text_md5
FROM (SELECT *, {scrubbed_sql("text")} AS masked FROM documents)
""",
)
def report_records(spark: SparkSession, sf: str) -> DataFrame:
    texts = widen(load(spark, sf, "documents").select("doc_id", "lang", "text"), "doc_id").select(
        F.lit("2026-07").alias("period"),
        text("2026-07/", F.col("lang"), "/nps-report_", F.col("doc_id"), ".md").alias("source_file"),
        "text",
        F.lit(True).alias("readable"),
    )
    none = texts.select(F.lit("").alias("source")).limit(0)
    built = reports.build(Run(SETTINGS, Inline(spark), none, none), texts)
    return built.tables["documents"].select(
        "doc_id", "title", "folder", "doc_type", "initiative", F.col("chars").cast("long").alias("chars"),
        F.md5("text").alias("text_md5"),
    )


@query(
    "discover_files",
    """
WITH paths AS (
  SELECT CASE WHEN page_id % 10 = 9 THEN 'other' ELSE '2026-0' || (page_id % 9 + 1) END AS period,
         CASE page_id % 5 WHEN 0 THEN 'surveys' WHEN 1 THEN 'MBG Form' WHEN 2 THEN 'Pictures' WHEN 3 THEN '.cache' ELSE 'Interviews' END AS folder,
         CASE WHEN contains(url, '?') THEN '.md' WHEN contains(url, '#') THEN '.xlsx' ELSE '.CSV' END AS ext FROM pages
)
SELECT period, CASE WHEN ext = '.md' THEN 'documents' WHEN ext = '.CSV' THEN
         CASE folder WHEN 'surveys' THEN 'sprig' WHEN 'MBG Form' THEN 'mbg' WHEN 'Interviews' THEN 'interviews' END END AS source,
       count(*) AS files
FROM paths WHERE period <> 'other' AND folder <> '.cache' GROUP BY ALL
""",
)
def discover_files(spark: SparkSession, sf: str) -> DataFrame:
    page = F.col("page_id")
    period = F.when(page % 10 == 9, "other").otherwise(text("2026-0", page % 9 + 1))
    folders = ["surveys", "MBG Form", "Pictures", ".cache", "Interviews"]
    folder = F.coalesce(*[F.when(page % 5 == i, f) for i, f in enumerate(folders)])
    ext = F.when(F.contains("url", F.lit("?")), ".md").when(F.contains("url", F.lit("#")), ".xlsx").otherwise(".CSV")
    paths = load(spark, sf, "pages").select(text(period, "/", folder, "/file ", page, ext).alias("source_file"))
    return with_origin(paths, SETTINGS).groupBy("period", "source").agg(F.count("*").alias("files"))
