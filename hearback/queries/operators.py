"""Operators that the other queries only pass through: mirror, alerts, catalogs, names, gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import audit
from ..operators.classify import Taxonomy
from ..plans import cancel_flow, interviews, panel, recipes, refunds, surveys, tickets
from ..plans.evidence import build_evidence, union_all
from ..plans.family import mirror, rejects
from ..session import load, widen
from .families import KEY_SQL, SURVEY_SQL, as_export, panel_run, survey_run, text
from .registry import query
from .text import FOUND_SQL, REGISTRY_SQL, page_names


# --- mirror, masks of uncurated cells ---------------------------------------------------


@query(
    "mirror_cells",
    f"""
WITH sent AS (
  SELECT c_custkey AS k, CASE c_nationkey % 5 WHEN 0 THEN '@help.ours.test' WHEN 1 THEN '@shop.test'
           WHEN 2 THEN '@mail.paypal.com' ELSE {KEY_SQL % "'quin.lee' || c_custkey || '@mail.com'"} END AS sender FROM customer
)
SELECT k + 1 AS row_number, 1 AS pos, 'Ticket ID' AS "column", 't' || k AS value FROM sent
UNION ALL SELECT k + 1, 0, 'Date', '2026-07-10 09:00:00' FROM sent
UNION ALL SELECT k + 1, 3, 'Segmentation', 'Plan' FROM sent
UNION ALL SELECT k + 1, 4, 'Feedback', 'It stopped.' FROM sent
UNION ALL SELECT k + 1, 2, 'User', sender FROM sent
UNION ALL SELECT k + 1, 5, 'Agent notes', 'call [phone] for ' || k FROM sent
UNION ALL SELECT k + 1, 6, NULL, 'surplus [email]' FROM sent
""",
)
def mirror_cells(spark: SparkSession, sf: str) -> DataFrame:
    """All cells of tickets: senders, texts, a column nobody curated, and a cell beyond the header."""
    customer = load(spark, sf, "customer")
    key, nation = F.col("c_custkey"), F.col("c_nationkey") % 5
    sender = (
        F.when(nation == 0, text("robot", key, "@help.ours.test"))
        .when(nation == 1, "no-reply@shop.test")
        .when(nation == 2, "Service@mail.PayPal.com")
        .otherwise(text("quin.lee", key, "@mail.com"))
    )
    cells = {
        "Date": F.lit("2026-07-10 09:00:00"),
        "Ticket ID": text("t", key),
        "User": sender,
        "Segmentation": F.lit("Plan"),
        "Feedback": F.lit("It stopped."),
        "Agent notes": text("call 555-123-4567 for ", key),
    }
    run = as_export(spark, customer, "freshdesk", F.col("c_mktsegment"), key, cells, surplus=[F.lit("surplus a@b.com")])
    copy = mirror(tickets.build(run).shaped, "freshdesk").select("row_number", F.posexplode("cells").alias("pos", "cell"))
    return copy.select("row_number", "pos", "cell.column", "cell.value")


@query(
    "uncurated_cells",
    """
SELECT o_orderkey + 1 AS row_number, 'mbg' AS source, 'Comment' AS "column", 'mail me at [email] about ' || o_orderkey AS value FROM orders
UNION ALL
SELECT o_orderkey + 1, 'chargebee', 'Comment', 'mail me at [email] about ' || o_orderkey FROM orders
""",
)
def uncurated_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Contact data in columns without a rule, in refunds and cancel flow."""
    orders = load(spark, sf, "orders")
    key = F.col("o_orderkey")
    comment = {"Comment": text("mail me at z@y.com about ", key)}
    copies = []
    for source, plan, own in (("mbg", refunds, "Timestamp"), ("chargebee", cancel_flow, "exit_session_id")):
        run = as_export(spark, orders, source, F.col("o_orderstatus"), key, {own: text("x", key), **comment})
        copies.append(mirror(plan.build(run).shaped, source))
    cells = union_all(copies).select("row_number", "source", F.explode("cells").alias("cell"))
    return cells.select("row_number", "source", "cell.column", "cell.value").filter("column = 'Comment'")


# --- records without an id, blank records, alerts ------------------------------------------


def nameless_tickets(spark: SparkSession, sf: str):
    customer = load(spark, sf, "customer")
    key = F.col("c_custkey")
    blank = key % 8 == 0
    cells = {
        "Date": F.when(blank, "").when(key % 9 == 0, "someday").otherwise("2026-07-10 09:00:00"),
        "User": F.when(blank, "  ").otherwise(text("c", key, "@mail.com")),
        "Segmentation": F.lit(""),
        "Feedback": F.when(~blank, text("It stopped ", key)),
    }
    return as_export(spark, customer, "freshdesk", F.col("c_mktsegment"), key, cells)


@query(
    "surrogate_ids",
    """
SELECT 'fd_' || left(sha256('2026-07/Export/' || c_mktsegment || '.csv' || chr(31) || (c_custkey + 1)), 12) AS ticket_id,
       'It stopped ' || c_custkey AS body, CASE WHEN c_custkey % 9 <> 0 THEN TIMESTAMP '2026-07-10 09:00:00' END AS created_at
FROM customer WHERE c_custkey % 8 <> 0
""",
)
def surrogate_ids(spark: SparkSession, sf: str) -> DataFrame:
    return tickets.build(nameless_tickets(spark, sf)).tables["tickets"].select("ticket_id", "body", "created_at")


@query(
    "blank_records",
    "SELECT 'empty_row' AS reason, count(*) AS rows, min(c_custkey) + 1 AS first_row FROM customer WHERE c_custkey % 8 = 0 HAVING count(*) > 0",
)
def blank_records(spark: SparkSession, sf: str) -> DataFrame:
    found = rejects(tickets.build(nameless_tickets(spark, sf)).shaped, "freshdesk")
    return found.groupBy(F.col("excluded_reason").alias("reason")).agg(
        F.count("*").alias("rows"), F.min("row_number").alias("first_row")
    )


@query(
    "file_alerts",
    """
SELECT DISTINCT 'freshdesk: ' || c_mktsegment || '.csv missing columns Ticket ID' AS alert FROM customer
UNION ALL
SELECT 'freshdesk: ' || count(*) || ' unparsed dates in ' || c_mktsegment || '.csv' FROM customer
WHERE c_custkey % 9 = 0 AND c_custkey % 8 <> 0 GROUP BY c_mktsegment
UNION ALL
SELECT DISTINCT 'mbg: unmapped column ''Favourite colour'' in ' || o_orderstatus || '.csv (kept in mirror only)' FROM orders
""",
)
def file_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """Missing columns, dates of no known shape, and columns that match no pattern."""
    orders = load(spark, sf, "orders")
    cells = {"Timestamp": F.lit("7/20/2026 14:05:09"), "Amount": F.col("o_totalprice"), "Favourite colour": F.lit("red")}
    asked = as_export(spark, orders, "mbg", F.col("o_orderstatus"), F.col("o_orderkey"), cells)
    found = [*tickets.build(nameless_tickets(spark, sf)).alerts, refunds.unmapped_columns(asked.heads("mbg"))]
    return union_all(found)


# --- panel participants, interviews, choices ----------------------------------------------------


@query(
    "panel_participants",
    """
SELECT 'lys_' || left(sha256('2026-07' || chr(31) || p_type), 12) AS study_id, 'p' || p_partkey AS response_id,
       CAST(p_size * 100 AS DOUBLE) AS duration_ms, CAST(p_size AS VARCHAR) AS age, CAST(p_size AS VARCHAR) AS json_age,
       CASE WHEN p_size > 20 THEN 'Mobile' END AS device_type
FROM part
""",
)
def panel_participants(spark: SparkSession, sf: str) -> DataFrame:
    """A participant column that occurs twice: the last one counts."""
    part = load(spark, sf, "part")
    cells = [
        ("Response ID", text("p", F.col("p_partkey"))),
        ("Age", F.lit("99")),
        ("Duration (ms)", F.col("p_size") * 100),
        ("Age", F.col("p_size")),
        ("Device Type", F.when(F.col("p_size") > 20, "Mobile")),
    ]
    run = as_export(spark, part, "lyssna", text(F.col("p_type"), " - results (2)"), F.col("p_partkey"), cells)
    return panel.build(run).tables["lyssna_participants"].select(
        "study_id", "response_id", "duration_ms", "age", scalars.json_field("demographics", "Age").alias("json_age"), "device_type"
    )


def interview_run(spark: SparkSession, sf: str):
    supplier = load(spark, sf, "supplier")
    cells = {
        "Users": F.lit("Gina Hall"),
        "Interview date": F.lit("August 5, 2026 3:04 PM"),
        "Snapshot (for Zapier)": F.when(F.col("s_suppkey") % 3 != 0, text("A PIN review by Gina of nation ", F.col("s_nationkey"))),
    }
    return as_export(spark, supplier, "interviews", F.col("s_nationkey"), F.col("s_suppkey"), cells)


@query(
    "interview_items",
    """
SELECT s_suppkey + 1 AS row_number, 'User interview' AS instrument, 'Interview snapshot' AS question,
       'A PIN review by [name] of nation ' || s_nationkey AS text, 'PIN / Book Clubs' AS initiative
FROM supplier WHERE s_suppkey % 3 <> 0
""",
)
def interview_items(spark: SparkSession, sf: str) -> DataFrame:
    items = interviews.build(interview_run(spark, sf)).items
    return items.select("row_number", "instrument", "question", "text", "initiative")


@query(
    "choice_themes",
    f"""
WITH {SURVEY_SQL}
SELECT response_id AS record_id, coalesce(response_other, replace(choices, '|', '; ')) AS theme, 'choice' AS answer_type,
       length(coalesce(response_other, replace(choices, '|', '; ')))::INT AS text_chars,
       'ev_' || left(sha256('sprig' || chr(31) || response_id || chr(31) || '3'), 12) AS evidence_id
FROM answered WHERE question_no = 3
""",
)
def choice_themes(spark: SparkSession, sf: str) -> DataFrame:
    """A chosen option is its own theme where nothing else gives one."""
    items = surveys.build(survey_run(spark, sf)).items.filter("is_choice")
    found = build_evidence(items, Taxonomy(areas=[("none", ["no such word"])]))
    return found.select("record_id", "theme", "answer_type", "text_chars", "evidence_id")


# --- catalogs and their recipes -----------------------------------------------------------------


CATALOG_SQL = f"""
WITH {SURVEY_SQL}, catalog AS (
  SELECT 'sprig_None_2026-07' AS study_id, 'sprig_pmf' AS kind, 'PMF ' || o_orderstatus AS name, 'PMF' AS initiative, '2026-07' AS period,
         count(*) AS n, '2026-07/Export/' || o_orderstatus || '.csv' AS source_file FROM kept GROUP BY o_orderstatus
  UNION ALL
  SELECT 'lys_' || left(sha256('2026-07' || chr(31) || p_type), 12), 'lyssna_test', p_type, NULL, '2026-07', count(*),
         '2026-07/Export/' || p_type || '.csv' FROM part GROUP BY p_type
  UNION ALL
  SELECT 'ivt_' || left(sha256('2026-07' || chr(31) || s_nationkey || '.csv'), 12), 'interviews', 'Interviews tracker (' || s_nationkey || '.csv)',
         NULL, '2026-07', count(*), '2026-07/Export/' || s_nationkey || '.csv' FROM supplier GROUP BY s_nationkey
)
"""


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    built = [surveys.build(survey_run(spark, sf)), panel.build(panel_run(spark, sf)), interviews.build(interview_run(spark, sf))]
    columns = ["study_id", "kind", "name", "initiative", "period", "n", "source_file"]
    return union_all([b.studies.select(*columns) for b in built])


@query("family_studies", f"{CATALOG_SQL} SELECT * FROM catalog")
def family_studies(spark: SparkSession, sf: str) -> DataFrame:
    return catalog(spark, sf)


@query(
    "studies_about",
    f"{CATALOG_SQL} SELECT kind, name, period, n, source_file FROM catalog WHERE name ILIKE '%tracker (1%' OR initiative = 'PMF'",
)
def studies_about(spark: SparkSession, sf: str) -> DataFrame:
    return recipes.studies_about(catalog(spark, sf), "tracker (1", "PMF")


@query(
    "documents_about",
    """
SELECT 'report ' || doc_id AS title, lang AS period, left(text, 400) AS excerpt FROM documents WHERE text ILIKE '%license%'
""",
)
def documents_about(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    named = docs.select(text("report ", F.col("doc_id")).alias("title"), F.col("lang").alias("period"), "text")
    return recipes.documents_about(named, "license")


# --- names of a registry ---------------------------------------------------------------------------


@query(
    "known_first_names",
    """
WITH words AS (SELECT p_partkey, p_size, upper(left(p_name, 1)) || substr(split_part(p_name, ' ', 1), 2) AS first,
                      upper(left(split_part(p_name, ' ', 2), 1)) || substr(split_part(p_name, ' ', 2), 2) AS last FROM part)
SELECT p_partkey + 1 AS row_number, 'please ask ' || CASE WHEN first <> 'New' AND first IN (SELECT first FROM words) THEN '[name]'
         ELSE first || ' ' || last END || ' about ' || p_size AS body
FROM words
""",
)
def known_first_names(spark: SparkSession, sf: str) -> DataFrame:
    """Tickets that name people whose first names other exports hold."""
    part = load(spark, sf, "part")
    cells = {
        "Date": F.lit("2026-07-10 09:00:00"),
        "Ticket ID": text("t", F.col("p_partkey")),
        "User": text("c", F.col("p_partkey"), "@mail.com"),
        "Segmentation": F.lit(""),
        "Feedback": text("please ask ", F.initcap("p_name"), " about ", F.col("p_size")),
    }
    run = as_export(spark, part, "freshdesk", F.col("p_type"), F.col("p_partkey"), cells)
    first = F.initcap(F.substring_index("p_name", " ", 1))
    run.registry = part.select(F.lit("first").alias("kind"), first.alias("value")).distinct()
    run.registry_rows = run.registry.count()
    return tickets.build(run).tables["tickets"].select("row_number", "body")


@query(
    "name_leak_places",
    f"""
WITH {REGISTRY_SQL}, {FOUND_SQL}
SELECT 'documents.text' AS "where", 'full_name' AS kind,
       sum(len(regexp_extract_all(text, '\\b' || rx || '\\b')))::BIGINT AS n
FROM found JOIN documents USING (doc_id) WHERE length(value) >= 7 AND split_part(value, ' ', 1) <> split_part(value, ' ', 2)
HAVING count(*) > 0
""",
)
def name_leak_places(spark: SparkSession, sf: str) -> DataFrame:
    """Hits of names of two different words (SQL counts no overlapping hits of one name)."""
    docs = widen(load(spark, sf, "documents").select("doc_id", "text"), "doc_id").select("text")
    known = page_names(spark, sf).filter("split_part(value, ' ', 1) <> split_part(value, ' ', 2)")
    return audit.name_leaks(audit.string_cells(docs, "documents"), known)
