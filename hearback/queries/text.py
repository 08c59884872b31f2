"""Classification, masking, name and search queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import masks, scalars
from ..operators import audit, names
from ..operators.classify import classify
from ..operators.reshape import header_parts
from ..plans import recipes
from ..plans.evidence import build_evidence, feedback, union_all
from ..session import load, scratch, widen
from ..sources import search
from . import taxonomies as tx
from .registry import query

SALT = "test-salt-0123456789"


def feedback_items(spark: SparkSession, sf: str) -> DataFrame:
    """Documents, what users say in conversations, and events as feedback."""
    docs = feedback(
        widen(load(spark, sf, "documents").select("doc_id", "text", "source", "lang"), "doc_id"),
        source=F.lit("documents"),
        record_id=F.col("doc_id"),
        text=F.col("text"),
        category=F.col("source"),
        segment=F.col("lang"),
        population=F.lit("panel"),
        question=F.lit("Document text"),
    )
    talks = feedback(
        load(spark, sf, "conversations").filter("role = 'user'"),
        source=F.lit("conversations"),
        record_id=F.col("conv_id"),
        sub_id=F.col("turn"),
        text=F.col("text"),
        user_key=F.concat(F.lit("c"), F.col("conv_id").cast("string")),
        question=F.lit("What is the question?"),
    )
    events = feedback(
        load(spark, sf, "events"),
        source=F.lit("events"),
        record_id=F.col("event_id"),
        occurred_at=F.col("ts"),
        category=F.col("event_type"),
        map_name=F.lit("event_type"),
        map_key=F.col("event_type"),
        score=F.col("value"),
        score_type=F.lit("value"),
        user_key=F.concat(F.lit("u"), F.col("user_id").cast("string")),
        user_id=F.col("user_id"),
    )
    return union_all([docs, talks, events])


ITEMS_SQL = f"""
items AS (
  SELECT 'documents' AS source, CAST(doc_id AS VARCHAR) AS record_id, '' AS sub_id, text,
         source AS category, CAST(NULL AS VARCHAR) AS map_key, 'panel' AS population,
         CAST(NULL AS VARCHAR) AS user_key, CAST(NULL AS VARCHAR) AS score_type, 'Document text' AS question
  FROM documents
  UNION ALL
  SELECT 'conversations', CAST(conv_id AS VARCHAR), CAST(turn AS VARCHAR), text, NULL, NULL, 'user',
         'c' || conv_id, NULL, 'What is the question?' FROM conversations WHERE role = 'user'
  UNION ALL
  SELECT 'events', CAST(event_id AS VARCHAR), '', NULL, event_type, event_type, 'user',
         'u' || user_id, 'value', NULL FROM events
), scanned AS (
  SELECT *, {tx.hit_columns_sql("concat_ws(' ', nullif(text, ''), nullif(category, ''))", tx.WORDS, "h")},
         {tx.hit_columns_sql("coalesce(question, '')", tx.WORDS, "q")},
         CASE map_key WHEN 'error' THEN 'license_terms' WHEN 'signup' THEN 'english_words' END AS mapped
  FROM items
), tagged AS (
  SELECT *,
    CASE WHEN mapped IS NOT NULL THEN mapped
         WHEN {tx.any_sql(tx.WORDS, "h")} THEN {tx.best_sql(tx.WORDS, "h")}
         WHEN {tx.any_sql(tx.WORDS, "q")} THEN {tx.best_sql(tx.WORDS, "q")}
         ELSE 'other' END AS area,
    CASE WHEN mapped IS NOT NULL THEN 'source_map'
         WHEN {tx.any_sql(tx.WORDS, "h")} THEN 'text_rule'
         WHEN {tx.any_sql(tx.WORDS, "q")} THEN 'question_rule'
         ELSE 'none' END AS theme_method,
    CASE WHEN mapped IS NOT NULL THEN mapped
         WHEN {tx.any_sql(tx.WORDS, "h")} THEN {tx.areas_sql(tx.WORDS, "h")}
         WHEN {tx.any_sql(tx.WORDS, "q")} THEN {tx.areas_sql(tx.WORDS, "q")}
         ELSE '' END AS areas,
    CASE WHEN score_type IS NOT NULL AND regexp_matches(coalesce(text, ''), '^[ 0-9.]*$') THEN 'score' ELSE 'text' END AS answer_type,
    'ev_' || left(sha256(source || chr(31) || record_id || chr(31) || sub_id), 12) AS evidence_id
  FROM scanned
)
"""


@query(
    "evidence_union",
    f"""
WITH {ITEMS_SQL}
SELECT source, area, theme_method, answer_type, count(*) AS n,
       CAST(sum(CAST('0x' || substr(evidence_id, 4, 8) AS BIGINT)) AS BIGINT) AS id_sum, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS chars
FROM tagged GROUP BY ALL
""",
)
def evidence_union(spark: SparkSession, sf: str) -> DataFrame:
    evidence = build_evidence(feedback_items(spark, sf), tx.WORDS)
    return evidence.groupBy("source", "area", "theme_method", "answer_type").agg(
        F.count("*").alias("n"),
        # a check of all ids that adds up map-side, where a distinct count would move them
        F.sum(F.conv(F.substring("evidence_id", 4, 8), 16, 10).cast("long")).alias("id_sum"),
        F.sum("text_chars").cast("long").alias("chars"),
    )


@query(
    "area_people",
    f"""
WITH {ITEMS_SQL}
SELECT source, count(*) AS n, count(DISTINCT user_key) AS people
FROM tagged WHERE population = 'user' AND list_contains(string_split(areas, ','), 'license_terms')
GROUP BY source
""",
)
def area_people(spark: SparkSession, sf: str) -> DataFrame:
    return recipes.area_across_sources(build_evidence(feedback_items(spark, sf), tx.WORDS), "license_terms")


@query(
    "area_distribution",
    f"""
WITH {ITEMS_SQL}
SELECT population, area, theme_method, count(*) AS n FROM tagged GROUP BY ALL
""",
)
def area_distribution(spark: SparkSession, sf: str) -> DataFrame:
    evidence = build_evidence(feedback_items(spark, sf), tx.WORDS)
    return (
        evidence.groupBy("population", "area", "theme_method")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), "population", "area", "theme_method")
    )


@query(
    "taxonomy_text_rule",
    f"""
WITH scanned AS (SELECT doc_id, {tx.hit_columns_sql("text", tx.WORDS, "h")} FROM documents)
SELECT doc_id,
       CASE WHEN {tx.any_sql(tx.WORDS, "h")} THEN {tx.best_sql(tx.WORDS, "h")} ELSE 'other' END AS area,
       {tx.areas_sql(tx.WORDS, "h")} AS areas,
       CASE WHEN {tx.any_sql(tx.WORDS, "h")} THEN 'text_rule' ELSE 'none' END AS theme_method
FROM scanned
""",
)
def taxonomy_text_rule(spark: SparkSession, sf: str) -> DataFrame:
    docs = widen(load(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    tagged = classify(docs, tx.WORDS, text=F.col("text"), theme=F.lit(""), context=F.lit(""))
    return tagged.select("doc_id", "area", F.array_join("areas", ",").alias("areas"), "theme_method")


@query(
    "taxonomy_precedence",
    f"""
WITH asked AS (
  SELECT *, CASE WHEN lang IN ('fr', 'de') THEN 'theme ' || lang ELSE '' END AS label,
         CASE WHEN length(source) > 4 THEN 'Is the warranty clear?' ELSE 'Anything else?' END AS question
  FROM documents
), scanned AS (
  SELECT *, {tx.hit_columns_sql("text", tx.PRECEDENCE, "h")}, {tx.hit_columns_sql("label", tx.PRECEDENCE, "t")},
         {tx.hit_columns_sql("question", tx.PRECEDENCE, "q")},
         CASE source WHEN 'src0' THEN 'rights' WHEN 'src1' THEN 'license_terms' WHEN 'src2' THEN 'rights' END AS mapped
  FROM asked
)
SELECT doc_id,
  CASE WHEN mapped IS NOT NULL THEN mapped
       WHEN {tx.any_sql(tx.PRECEDENCE, "t")} THEN {tx.best_sql(tx.PRECEDENCE, "t")}
       WHEN {tx.any_sql(tx.PRECEDENCE, "h")} THEN {tx.best_sql(tx.PRECEDENCE, "h")}
       WHEN {tx.any_sql(tx.PRECEDENCE, "q")} THEN {tx.best_sql(tx.PRECEDENCE, "q")} ELSE 'other' END AS area,
  CASE WHEN mapped IS NOT NULL THEN array_to_string(list_sort(list_distinct(list_concat(
            list_filter(string_split({tx.areas_sql(tx.PRECEDENCE, "h", "t")}, ','), lambda a: a <> ''), [mapped]))), ',')
       WHEN {tx.any_sql(tx.PRECEDENCE, "t")} OR {tx.any_sql(tx.PRECEDENCE, "h")} THEN {tx.areas_sql(tx.PRECEDENCE, "h", "t")}
       ELSE {tx.areas_sql(tx.PRECEDENCE, "q")} END AS areas,
  CASE WHEN mapped IS NOT NULL THEN CASE source WHEN 'src0' THEN 'first' WHEN 'src1' THEN 'second' ELSE 'third' END
       ELSE nullif(label, '') END AS theme,
  CASE WHEN mapped IS NOT NULL THEN 'source_map' WHEN {tx.any_sql(tx.PRECEDENCE, "t")} THEN 'source_theme'
       WHEN {tx.any_sql(tx.PRECEDENCE, "h")} THEN 'text_rule'
       WHEN {tx.any_sql(tx.PRECEDENCE, "q")} THEN 'question_rule' ELSE 'none' END AS theme_method
FROM scanned
""",
)
def taxonomy_precedence(spark: SparkSession, sf: str) -> DataFrame:
    docs = widen(load(spark, sf, "documents").select("doc_id", "text", "lang", "source"), "doc_id")
    asked = docs.withColumns(
        {
            "label": F.when(F.col("lang").isin("fr", "de"), F.concat(F.lit("theme "), F.col("lang"))).otherwise(""),
            "question": F.when(F.char_length("source") > 4, "Is the warranty clear?").otherwise("Anything else?"),
        }
    )
    tagged = classify(
        asked,
        tx.PRECEDENCE,
        text=F.col("text"),
        theme=F.col("label"),
        context=F.col("question"),
        map_name=F.lit("source"),
        map_key=F.col("source"),
    )
    return tagged.select("doc_id", "area", F.array_join("areas", ",").alias("areas"), "theme", "theme_method")


EMAIL_SQL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
PHONE_SQL = r"((?:\+?1[\s.\-]?)?(?:\([0-9]{3}\)|[0-9]{3})[\s.\-][0-9]{3}[\s.\-][0-9]{4})"
PART_OF_WORD = r"\p{L}\p{N}_:"
LONG_SQL = r"([0-9](?:[ \-]?[0-9]){11,18})"


def masked_sql(text: str) -> str:
    t = f"regexp_replace({text}, '{EMAIL_SQL}', '[email]', 'g')"
    return marked_sql(marked_sql(t, PHONE_SQL, "0-9", "[phone]"), LONG_SQL, "0-9:", "[number]")


def marked_sql(text: str, pattern: str, edge: str, mark: str) -> str:
    """The SQL regex has no lookaround: it takes the characters around a hit along.
    Two hits may share one such character, so the replacement runs twice."""
    once = f"regexp_replace({text}, '(^|[^{edge}]){pattern}([^{edge}]|$)', '\\1{mark}\\3', 'g')"
    return f"regexp_replace({once}, '(^|[^{edge}]){pattern}([^{edge}]|$)', '\\1{mark}\\3', 'g')"


def count_sql(text: str, pattern: str, edge: str) -> str:
    return f"len(regexp_extract_all({marked_sql(text, pattern, edge, chr(1))}, chr(1)))"


@query(
    "pii_mask",
    f"""
WITH masked AS (SELECT doc_id, {masked_sql("text")} AS t FROM documents)
SELECT doc_id, md5(t) AS masked_md5, length(t) AS chars, contains(t, '[email]') AS has_email,
       contains(t, '[phone]') AS has_phone, contains(t, '[number]') AS has_number FROM masked
""",
)
def pii_mask(spark: SparkSession, sf: str) -> DataFrame:
    docs = widen(load(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    return docs.select("doc_id", masks.mask_contacts("text").alias("t")).select(
        "doc_id",
        F.md5("t").alias("masked_md5"),
        F.char_length("t").cast("long").alias("chars"),
        F.contains("t", F.lit("[email]")).alias("has_email"),
        F.contains("t", F.lit("[phone]")).alias("has_phone"),
        F.contains("t", F.lit("[number]")).alias("has_number"),
    )


@query(
    "pii_leak_counts",
    f"""
WITH cells AS (
  SELECT 'documents.text' AS "where", text AS t FROM documents
  UNION ALL SELECT 'pages.html', html FROM pages
  UNION ALL SELECT 'pages.url', url FROM pages
  UNION ALL SELECT 'conversations.text', text FROM conversations
), hits AS (
  SELECT "where", 'email' AS kind,
         len(list_filter(regexp_extract_all(t, '{EMAIL_SQL}'), lambda e: NOT regexp_matches(lower(e), '@mail1\\.example\\.com$'))) AS n
  FROM cells
  UNION ALL SELECT "where", 'phone', {count_sql("t", PHONE_SQL, "0-9")} FROM cells
  UNION ALL SELECT "where", 'long_number', {count_sql("t", LONG_SQL, PART_OF_WORD)} FROM cells
)
SELECT "where", kind, CAST(sum(n) AS BIGINT) AS n FROM hits GROUP BY ALL HAVING sum(n) > 0
""",
)
def pii_leak_counts(spark: SparkSession, sf: str) -> DataFrame:
    tables = {"documents": ["doc_id"], "pages": ["page_id"], "conversations": ["conv_id", "turn"]}
    cells = union_all([audit.string_cells(widen(load(spark, sf, t), *key), t) for t, key in tables.items()])
    return audit.leak_counts(cells, ["mail1.example.com"])


# People of the test: capitalised word pairs on the web pages.
PAGE_PAIRS = r"\b([A-Z][a-zA-Z'\-]+[ \t]+[A-Z][a-zA-Z'\-]+)\b"
REGISTRY_SQL = r"""
people AS (
  SELECT DISTINCT string_split_regex(p, '[ \t]+') AS tokens FROM (
    SELECT unnest(regexp_extract_all(regexp_replace(html, '[^A-Za-z0-9_'' \t\-]', '.', 'g'),
                  '\b([A-Z][a-zA-Z''\-]+[ \t]+[A-Z][a-zA-Z''\-]+)\b', 1)) AS p FROM pages)
), registry AS (
  SELECT DISTINCT 'full' AS kind, lower(tokens[1] || ' ' || tokens[2]) AS value FROM people
  UNION
  SELECT DISTINCT 'first', upper(left(tokens[1], 1)) || lower(substr(tokens[1], 2)) FROM people
  WHERE length(tokens[1]) >= 3 AND regexp_full_match(tokens[1], '[A-Za-z]+')
)
"""


def page_names(spark: SparkSession, sf: str) -> DataFrame:
    ascii_html = F.regexp_replace("html", r"[^A-Za-z0-9_' \t\-]", ".")
    pairs = F.regexp_extract_all(ascii_html, F.lit(PAGE_PAIRS), F.lit(1))
    pages = widen(load(spark, sf, "pages").select("page_id", "html"), "page_id")
    people = pages.select(F.explode(pairs).alias("p")).distinct()
    return names.name_registry(people.select(names.name_tokens(F.col("p")).alias("tokens")))


@query("name_registry", f"WITH {REGISTRY_SQL} SELECT kind, value FROM registry")
def name_registry(spark: SparkSession, sf: str) -> DataFrame:
    return page_names(spark, sf)


# One known pair as a SQL regex: both words start with a capital, the rest in any case.
PAIR_SQL = r"""
upper(left(split_part(value, ' ', 1), 1)) || '(?i:' || substr(split_part(value, ' ', 1), 2) || ')[ \t]+' ||
upper(left(split_part(value, ' ', 2), 1)) || '(?i:' || substr(split_part(value, ' ', 2), 2) || ')'
"""
FOUND_SQL = f"""
words AS (
  SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z][a-z''\\-]+')) AS w FROM documents
), candidates AS (
  SELECT a.doc_id, n.value FROM (SELECT value FROM registry WHERE kind = 'full') n
  JOIN words a ON a.w = split_part(n.value, ' ', 1)
  JOIN words b ON b.w = split_part(n.value, ' ', 2) AND b.doc_id = a.doc_id
), found AS (
  SELECT doc_id, value, {PAIR_SQL} AS rx FROM candidates JOIN documents USING (doc_id)
  WHERE regexp_matches(text, '(^|[^\\p{{L}}\\p{{N}}_])' || {PAIR_SQL} || '([^\\p{{L}}\\p{{N}}_]|$)')
)
"""


@query(
    "known_names_found",
    f"""
WITH {REGISTRY_SQL}, {FOUND_SQL}
SELECT doc_id, count(*) AS n_names, string_agg(value, ',' ORDER BY value) AS names FROM found GROUP BY doc_id
""",
)
def known_names_found(spark: SparkSession, sf: str) -> DataFrame:
    docs = widen(load(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    registry = page_names(spark, sf)
    hits = names.known_names(docs, ["doc_id"], names.capital_pairs(F.col("text")), registry)  # by filter and shuffle
    keys = F.array_sort(F.array_distinct(F.transform("known_pairs", names.pair_key)))
    return hits.filter(F.size("known_pairs") > 0).select(
        "doc_id", F.size(keys).cast("long").alias("n_names"), F.array_join(keys, ",").alias("names")
    )


@query(
    "mask_known_names",
    f"""
WITH {REGISTRY_SQL}, {FOUND_SQL}, per_doc AS (
  SELECT doc_id, list(rx ORDER BY value) AS rxs FROM found GROUP BY doc_id
)
SELECT doc_id, md5(CASE WHEN rxs IS NULL THEN text ELSE
         list_reduce(list_prepend(text, rxs), lambda t, rx: regexp_replace(t, '\\b' || rx || '\\b', '[name]', 'g')) END) AS masked_md5,
       rxs IS NOT NULL AS has_known
FROM documents LEFT JOIN per_doc USING (doc_id)
""",
)
def mask_known_names(spark: SparkSession, sf: str) -> DataFrame:
    docs = widen(load(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    registry = page_names(spark, sf)
    hits = names.known_names(docs, ["doc_id"], names.capital_pairs(F.col("text")), registry, registry.count())
    joined = docs.join(hits.filter(F.size("known_pairs") > 0).select("doc_id", "known_pairs"), "doc_id", "left")
    masked = masks.mask_each(F.col("text"), F.col("known_pairs"), flags="")
    return joined.select(
        "doc_id", F.md5(masked).alias("masked_md5"), F.col("known_pairs").isNotNull().alias("has_known")
    )


@query(
    "name_leaks",
    f"""
WITH {REGISTRY_SQL}, {FOUND_SQL}
SELECT value, count(*) AS docs FROM found WHERE length(value) >= 7 GROUP BY value
""",
)
def name_leaks(spark: SparkSession, sf: str) -> DataFrame:
    docs = widen(load(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    cells = docs.select(F.col("doc_id").cast("string").alias("where"), "text")
    pairs = cells.select("where", F.explode(names.capital_pairs(F.col("text"))).alias("pair"))
    counted = pairs.select("where", names.pair_key(F.col("pair")).alias("value")).distinct()
    known = page_names(spark, sf).filter((F.col("kind") == "full") & (F.char_length("value") >= 7))
    return (
        counted.groupBy("value")
        .agg(F.count("*").alias("docs"))
        .join(known.select("value"), "value", "left_semi")
    )


MAIL_SQL = r"""
mails AS (
  SELECT p_partkey, p_size % 6 AS shape, p_brand,
         CASE WHEN p_name LIKE 'new %' THEN 'New ' || upper(substr(p_name, 5, 1)) || substr(p_name, 6)
              ELSE '[name]' END AS who  -- "New" counts as no first name
  FROM part
)
"""


@query(
    "mask_greeting_signoff",
    f"""
WITH {MAIL_SQL}
SELECT p_partkey, shape, CASE shape
  WHEN 0 THEN 'Hi [name], about ' || p_brand || '.' || chr(10) || 'Thanks,' || chr(10) || '[name]'
  WHEN 1 THEN 'Hello Team, about ' || p_brand || '.' || chr(10) || 'Best regards, ' || who
  WHEN 2 THEN 'Please cancel ' || p_brand || '.' || chr(10) || chr(10) || who
  WHEN 3 THEN CASE WHEN who = '[name]' THEN 'The billing agreement for [name] was ended. Ask [name] about it.'
              ELSE 'The billing agreement for ' || lower(who) || ' was ended. Ask ' || who || ' about it.' END
  WHEN 4 THEN 'Cancellation request - [name]'
  ELSE 'Buyer: ' || who || chr(10) || 'paid for ' || p_brand END AS masked
FROM mails
""",
)
def mask_greeting_signoff(spark: SparkSession, sf: str) -> DataFrame:
    part = load(spark, sf, "part").select("p_partkey", "p_name", "p_brand", (F.col("p_size") % 6).alias("shape"))
    name = F.initcap("p_name")

    def say(*parts) -> F.Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    brand, first = F.col("p_brand"), F.substring_index(name, " ", 1)
    mail = (
        F.when(F.col("shape") == 0, say("Hi ", name, ", about ", brand, ".\nThanks,\n", first))
        .when(F.col("shape") == 1, say("Hello Team, about ", brand, ".\nBest regards, ", name))
        .when(F.col("shape") == 2, say("Please cancel ", brand, ".\n\n", name, "\n"))
        .when(
            F.col("shape") == 3,
            say("The billing agreement for ", F.lower(name), " was ended. Ask ", name, " about it."),
        )
        .when(F.col("shape") == 4, say("Cancellation request - ", name))
        .otherwise(say("Buyer: ", name, "\npaid for ", brand))
    )
    scrubbed = part.withColumn("s", masks.scrub(mail))
    mailed = scrubbed.withColumn("m", masks.scrub_mail(F.col("s")))
    return mailed.select("p_partkey", "shape", masks.mask_subject_name(F.col("m")).alias("masked"))


@query(
    "pseudonymise_keys",
    f"""
WITH found AS (
  SELECT doc_id, lower(unnest(regexp_extract_all(text, '{EMAIL_SQL}'))) AS e FROM documents
)
SELECT doc_id, 'u_' || left(sha256('{SALT}' || e), 16) AS user_key,
       'h_' || left(sha256('{SALT}|id|' || e), 16) AS hashed_id, count(*) AS n
FROM found GROUP BY ALL
""",
)
def pseudonymise_keys(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents").filter(F.contains("text", F.lit("@")))
    found = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(scalars.EMAIL), F.lit(0))).alias("e"))
    return (
        found.select(
            "doc_id",
            scalars.user_key("e", SALT).alias("user_key"),
            scalars.hash_id(F.lower("e"), SALT).alias("hashed_id"),
        )
        .groupBy("doc_id", "user_key", "hashed_id")
        .agg(F.count("*").alias("n"))
    )


@query(
    "text_search_latest",
    """
SELECT doc_id, source, lang, left(text, 240) AS excerpt FROM documents
WHERE text ILIKE '%license%' ORDER BY n_chars DESC, doc_id DESC LIMIT 20
""",
)
def text_search_latest(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    return recipes.search_latest(
        docs, "text", "license", [F.desc("n_chars"), F.desc("doc_id")], ["doc_id", "source", "lang"]
    )


NEEDLES = ["license", "LICENSE%version", "qu", "@mail", "no such words here", "\\\\_x"]


@query(
    "text_search_indexed",
    r"""
WITH needles AS (SELECT unnest(['license', 'LICENSE%version', 'qu', '@mail', 'no such words here', '\_x']) AS needle)
SELECT needle, doc_id, source, lang, excerpt FROM (
  SELECT needle, doc_id, source, lang, left(text, 240) AS excerpt,
         row_number() OVER (PARTITION BY needle ORDER BY n_chars DESC, doc_id DESC) AS place
  FROM needles JOIN documents ON text ILIKE '%' || needle || '%' ESCAPE '\')
WHERE place <= 20
""",
)
def text_search_indexed(spark: SparkSession, sf: str) -> DataFrame:
    """The longest texts with each needle, found through the posting lists."""
    base = scratch(spark).path("search")
    docs = load(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    search.build_index(docs, base, "text", [F.desc("n_chars"), F.desc("doc_id")], block_rows=500)
    found = None
    for needle in NEEDLES:
        near = search.rows_near(spark, base, needle)
        hits = recipes.search_latest(near, "text", needle, [F.desc("n_chars"), F.desc("doc_id")], ["doc_id", "source", "lang"])
        hits = hits.withColumn("needle", F.lit(needle))
        found = hits if found is None else found.union(hits)
    return found


@query(
    "quotes_per_group",
    """
SELECT lang, doc_id, quote_no, excerpt FROM (
  SELECT lang, doc_id, left(text, 240) AS excerpt,
         row_number() OVER (PARTITION BY lang ORDER BY abs(n_chars - 200), doc_id) AS quote_no FROM documents)
WHERE quote_no <= 5
""",
)
def quotes_per_group(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents").select("lang", "doc_id", "n_chars", F.left("text", F.lit(240)).alias("excerpt"))
    best = recipes.quotes(docs, ["lang"], [F.abs(F.col("n_chars") - 200), F.col("doc_id")])
    return best.select("lang", "doc_id", F.col("quote_no").cast("long").alias("quote_no"), "excerpt")


@query(
    "initiative_tag",
    r"""
SELECT coalesce(CASE WHEN regexp_matches(text, '(?i)apache licen[sc]e') THEN 'Apache'
                     WHEN regexp_matches(text, '(?i)general\s+public') THEN 'Public'
                     WHEN regexp_matches(text, '(?i)\bund\b|\bder\b') THEN 'German'
                     WHEN regexp_matches(text, '(?i)\bque\b') THEN 'Romance' END, 'none') AS initiative,
       count(*) AS n FROM documents GROUP BY 1
""",
)
def initiative_tag(spark: SparkSession, sf: str) -> DataFrame:
    rules = [
        ("apache licen[sc]e", "Apache"),
        (r"general\s+public", "Public"),
        (r"(?<![a-z0-9_])und(?![a-z0-9_])|(?<![a-z0-9_])der(?![a-z0-9_])", "German"),
        (r"(?<![a-z0-9_])que(?![a-z0-9_])", "Romance"),
    ]
    docs = widen(load(spark, sf, "documents").select("doc_id", "text"), "doc_id")
    tagged = docs.select(scalars.initiative_of("text", rules=rules).alias("i"))
    return tagged.groupBy(F.coalesce("i", F.lit("none")).alias("initiative")).agg(F.count("*").alias("n"))


@query(
    "header_decompose",
    r"""
WITH headers AS (
  SELECT p_partkey, CASE p_size % 4
    WHEN 0 THEN '(Screener) (Question ' || p_size || ': "' || p_name || '?") Answer'
    WHEN 1 THEN p_size || '. (Questions) (Question 1: "' || p_name || '") Duration (ms)'
    WHEN 2 THEN '3. (Prototype test: [' || p_name || ']) Task result'
    ELSE p_brand END AS h FROM part
)
SELECT p_partkey, regexp_extract(h, p, 1, 's') AS section, regexp_extract(h, p, 3, 's') AS question,
       regexp_extract(h, p, 4, 's') AS field
FROM headers, (SELECT '^(\d+(?:\.\d+)?\.?\s*\([^)]*\)|\([^)]*\))?\s*(?:\(([^:()]+):\s*"(.*?)"\))?\s*(.*)$' AS p)
""",
)
def header_decompose(spark: SparkSession, sf: str) -> DataFrame:
    size = F.col("p_size")

    def header(*parts) -> F.Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    name = F.col("p_name")
    h = (
        F.when(size % 4 == 0, header("(Screener) (Question ", size, ': "', name, '?") Answer'))
        .when(size % 4 == 1, header(size, '. (Questions) (Question 1: "', name, '") Duration (ms)'))
        .when(size % 4 == 2, header("3. (Prototype test: [", name, "]) Task result"))
        .otherwise(F.col("p_brand"))
    )
    parts = load(spark, sf, "part").select("p_partkey", header_parts(h).alias("p"))
    return parts.select("p_partkey", "p.section", "p.question", "p.field")
