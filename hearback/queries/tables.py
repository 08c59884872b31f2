"""Identity, quality, recipe and scalar queries over the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import masks, scalars
from ..operators import identity, quality, records
from ..operators.reshape import residual, wide_to_long
from ..plans import recipes
from ..plans.tickets import sender_type
from ..session import load, scratch
from ..sources.people import activity, read_bucketed, write_bucketed
from .registry import query

def day() -> Column:
    return F.to_date("ts")


@query(
    "dedup_keep_first",
    """
SELECT doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) > 1 AS is_repeat FROM documents
""",
)
def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents").select("doc_id", F.md5("text").alias("content"))
    return records.mark_repeats(docs, ["content"], "doc_id").select("doc_id", "is_repeat")


REASONS_SQL = """
reasoned AS (
  SELECT doc_id, source, CASE WHEN trim(text) = '' THEN 'empty_row' WHEN rn > 1 THEN 'duplicate'
                              WHEN n_chars < 300 THEN 'too_short' END AS reason
  FROM (SELECT *, row_number() OVER (PARTITION BY source, md5(text) ORDER BY doc_id) AS rn FROM documents)
)
"""


def reasoned(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents").select(
        "doc_id", "source", "n_chars", F.md5("text").alias("content"), (scalars.strip("text") == "").alias("blank")
    )
    marked = records.mark_repeats(docs, ["source", "content"], "doc_id", counts=~F.col("blank"))
    reason = records.reject_reason(
        ("empty_row", F.col("blank")), ("duplicate", F.col("is_repeat")), ("too_short", F.col("n_chars") < 300)
    )
    return marked.withColumn("excluded_reason", reason)


@query(
    "reject_reasons",
    f"WITH {REASONS_SQL} SELECT source, reason, count(*) AS rows FROM reasoned WHERE reason IS NOT NULL GROUP BY ALL",
)
def reject_reasons(spark: SparkSession, sf: str) -> DataFrame:
    return records.reject_counts(reasoned(spark, sf).filter("excluded_reason IS NOT NULL"))


@query(
    "reconcile",
    f"""
WITH {REASONS_SQL}
SELECT source, count(*) AS rows_read, count(*) FILTER (WHERE reason IS NULL AND NOT (source = 'src3' AND doc_id % 2 = 1)) AS rows_loaded,
       count(*) FILTER (WHERE reason IS NOT NULL) AS rows_rejected,
       count(*) FILTER (WHERE reason IS NULL AND source = 'src3' AND doc_id % 2 = 1) = 0 AS ok
FROM reasoned GROUP BY source
""",
)
def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """One source loses loaded rows on the way, which the counts must show."""
    docs = load(spark, sf, "documents")
    split = reasoned(spark, sf)
    return records.reconcile(
        docs.select("source").distinct(),
        docs,
        split.filter("excluded_reason IS NULL AND NOT (source = 'src3' AND doc_id % 2 = 1)"),
        split.filter("excluded_reason IS NOT NULL"),
        ["source"],
    )


@query(
    "volumes_by_period",
    """
SELECT event_type AS source, strftime(ts, '%Y-%m-%d') AS period, count(*) AS rows_read,
       count(*) FILTER (WHERE value >= 10) AS rows_loaded, count(*) FILTER (WHERE value < 10) AS rows_rejected
FROM events GROUP BY ALL
""",
)
def volumes_by_period(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events").select(
        F.col("event_type").alias("source"), F.date_format("ts", "yyyy-MM-dd").alias("period"), "value"
    )
    by = ["source", "period"]
    recon = records.reconcile(
        events.select(*by).distinct(), events, events.filter("value >= 10"), events.filter("value < 10"), by
    )
    return records.volumes(recon).drop("files")


@query(
    "identity_map",
    """
WITH pairs AS (
  SELECT l_suppkey, l_partkey, count(*) AS observations, min((l_orderkey, l_linenumber)) AS first_seq
  FROM lineitem GROUP BY ALL
)
SELECT l_suppkey, l_partkey, observations,
       row_number() OVER (PARTITION BY l_suppkey ORDER BY observations DESC, first_seq, l_partkey) = 1 AS is_primary,
       count(*) OVER (PARTITION BY l_suppkey) > 1 AS ambiguous
FROM pairs
""",
)
def identity_map(spark: SparkSession, sf: str) -> DataFrame:
    order = F.col("l_orderkey") * 1000 + F.col("l_linenumber")
    seen = load(spark, sf, "lineitem").select("l_suppkey", "l_partkey", order.alias("seq"))
    return identity.identity_map(seen, "seq", key="l_suppkey", uid="l_partkey")


@query(
    "identity_backfill",
    """
WITH e AS (
  SELECT event_id, event_type, json_extract_string(props, '$.k') AS k, user_id FROM events
), pairs AS (
  SELECT k, user_id, count(*) AS n, min(event_id) AS first_seq FROM e WHERE event_type = 'purchase' GROUP BY ALL
), prim AS (
  SELECT k, user_id AS primary_id FROM (
    SELECT *, row_number() OVER (PARTITION BY k ORDER BY n DESC, first_seq, user_id) AS rn FROM pairs) WHERE rn = 1
)
SELECT event_id, k, CASE WHEN event_type IN ('view', 'click') THEN primary_id ELSE user_id END AS user_id
FROM e LEFT JOIN prim USING (k)
""",
)
def identity_backfill(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events").select(
        "event_id", "event_type", scalars.json_field("props", "k").alias("user_key"), "user_id"
    )
    seen = identity.identity_map(events.filter("event_type = 'purchase'"), "event_id")
    anonymous = events.withColumn("user_id", F.when(~F.col("event_type").isin("view", "click"), F.col("user_id")))
    filled = identity.backfill_user_id(anonymous, identity.primary_of(seen), spread_by=["event_id"])
    return filled.select("event_id", F.col("user_key").alias("k"), "user_id")


ROLLUP_SQL = """
rolled AS (
  SELECT person, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS sources,
         count(DISTINCT event_type) AS n_sources, count(*) AS evidence_items,
         min(ts) AS first_seen, max(ts) AS last_seen,
         arg_min(props, event_id) FILTER (WHERE event_type = 'signup') AS audience,
         arg_max(value, event_id) FILTER (WHERE event_type = 'purchase') AS plan
  FROM (SELECT *, user_id || '/' || strftime(ts, '%Y-%m-%d') AS person FROM events) GROUP BY person
)
"""


def people(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events").select(
        F.concat_ws("/", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("person"),
        "event_type",
        "ts",
        "event_id",
        F.when(F.col("event_type") == "signup", F.col("props")).alias("audience"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("plan"),
    )
    return identity.roll_up(
        events, "person", "event_type", "ts", ["event_id"], first={"audience": "audience"}, last={"plan": "plan"}
    )


@query("user_rollup", f"WITH {ROLLUP_SQL} SELECT * FROM rolled")
def user_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return people(spark, sf).withColumns(
        {"sources": F.array_join("sources", ","), "n_sources": F.col("n_sources").cast("long")}
    )


@query("source_histogram", f"WITH {ROLLUP_SQL} SELECT n_sources, count(*) AS people FROM rolled GROUP BY n_sources")
def source_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return recipes.sources_per_person(people(spark, sf)).withColumn("n_sources", F.col("n_sources").cast("long"))


@query(
    "journey_before",
    """
SELECT e.event_type, strftime(e.ts, '%Y-%m-%d') AS day, count(DISTINCT c.user_id) AS people
FROM events c JOIN events e USING (user_id)
WHERE c.event_type = 'purchase' AND e.event_type <> 'purchase' AND e.ts < c.ts GROUP BY ALL
""",
)
def journey_before(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events").select("user_id", "event_type", "ts", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    bought = events.filter("event_type = 'purchase'")
    other = events.filter("event_type <> 'purchase'")
    return recipes.said_before(bought, other, "user_id", "ts", "ts", ["event_type", "day"])


@query(
    "source_overlap",
    """
SELECT count(DISTINCT a.person) AS people
FROM (SELECT user_id || '/' || strftime(ts, '%Y-%m-%d') AS person FROM events WHERE event_type = 'error') a
JOIN (SELECT user_id || '/' || strftime(ts, '%Y-%m-%d') AS person FROM events WHERE event_type = 'purchase') b USING (person)
""",
)
def source_overlap(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events").select(
        "event_type", F.concat_ws("/", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("person")
    )
    return recipes.people_in_both(
        events.filter("event_type = 'error'"), events.filter("event_type = 'purchase'"), "person"
    )


@query(
    "cohort_match_rate",
    """
SELECT c_mktsegment AS segment, count(*) AS members, count(u) AS matched, round(count(u) / count(*), 4) AS match_rate
FROM customer LEFT JOIN (SELECT DISTINCT user_id AS u FROM events) ON u = c_custkey GROUP BY 1
""",
)
def cohort_match_rate(spark: SparkSession, sf: str) -> DataFrame:
    cohort = load(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    return recipes.match_rate(cohort, load(spark, sf, "events").select("user_id"), "user_id", ["segment"])


def bucketed_events(spark: SparkSession, sf: str) -> DataFrame:
    """Activity of the people behind the events by type and day, as a run publishes that of evidence."""
    events = load(spark, sf, "events").select(
        F.col("user_id").alias("user_key"), F.col("event_type").alias("source"), F.lit("user").alias("population"), "ts",
        F.date_format("ts", "yyyy-MM-dd").alias("day"), F.array(F.date_format("ts", "yyyy-MM")).alias("areas"),
    )
    base = scratch(spark).path("people")
    write_bucketed(
        activity(events, "user_key", ["source", "population", "day", "areas"], "ts"), base, "activity", "user_key", 8
    )
    return read_bucketed(spark, base, "activity")


@query(
    "people_journey",
    """
SELECT e.event_type AS source, strftime(e.ts, '%Y-%m-%d') AS day, count(DISTINCT c.user_id) AS people
FROM events c JOIN events e USING (user_id)
WHERE c.event_type = 'purchase' AND e.event_type <> 'purchase' AND e.ts < c.ts GROUP BY ALL
""",
)
def people_journey(spark: SparkSession, sf: str) -> DataFrame:
    """Who did what before buying, from the bucketed activity."""
    acted = bucketed_events(spark, sf)
    bought, other = acted.filter("source = 'purchase'"), acted.filter("source <> 'purchase'")
    return recipes.said_before(bought, other, "user_key", "last_at", "first_at", ["source", "day"])


@query(
    "people_overlap",
    """
SELECT count(DISTINCT a.user_id) AS people FROM events a JOIN events b USING (user_id)
WHERE a.event_type = 'error' AND b.event_type = 'purchase'
""",
)
def people_overlap(spark: SparkSession, sf: str) -> DataFrame:
    acted = bucketed_events(spark, sf)
    return recipes.people_in_both(acted.filter("source = 'error'"), acted.filter("source = 'purchase'"), "user_key")


@query(
    "people_match_rate",
    """
SELECT event_type AS source, count(*) AS members, count(u) AS matched, round(count(u) / count(*), 4) AS match_rate
FROM events LEFT JOIN (SELECT DISTINCT user_id AS u FROM events WHERE event_type = 'purchase') ON u = user_id GROUP BY 1
""",
)
def people_match_rate(spark: SparkSession, sf: str) -> DataFrame:
    acted = bucketed_events(spark, sf)
    return recipes.match_rate(acted, acted.filter("source = 'purchase'"), "user_key", ["source"], "n")


@query(
    "people_areas",
    """
SELECT event_type AS source, count(*) AS n, count(DISTINCT user_id) AS people FROM events
WHERE strftime(ts, '%Y-%m') = (SELECT strftime(min(ts), '%Y-%m') FROM events) GROUP BY 1
""",
)
def people_areas(spark: SparkSession, sf: str) -> DataFrame:
    month = load(spark, sf, "events").agg(F.date_format(F.min("ts"), "yyyy-MM")).first()[0]
    return recipes.area_across_sources(bucketed_events(spark, sf), month, "n")


@query(
    "link_rate",
    """
SELECT event_type AS source, count(*) AS evidence_items,
       round(avg(CASE WHEN value >= 20 THEN 1.0 ELSE 0.0 END), 4) AS with_user_key,
       round(avg(CASE WHEN user_id < 50 THEN 1.0 ELSE 0.0 END), 4) AS with_user_id
FROM events GROUP BY 1
""",
)
def link_rate(spark: SparkSession, sf: str) -> DataFrame:
    items = load(spark, sf, "events").select(
        F.col("event_type").alias("source"),
        F.lit("user").alias("population"),
        F.when(F.col("value") >= 20, F.col("props")).alias("user_key"),
        F.when(F.col("user_id") < 50, F.col("user_id").cast("string")).otherwise("").alias("user_id"),
    )
    return quality.link_rates(items)


@query(
    "nps_by_group",
    """
WITH rated AS (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, least(10, CAST(floor(value / 10) AS INT)) AS s FROM events)
SELECT event_type, day, count(*) AS n, count(*) FILTER (WHERE s >= 9) AS promoters,
       count(*) FILTER (WHERE s BETWEEN 7 AND 8) AS passives, count(*) FILTER (WHERE s <= 6) AS detractors,
       round(100.0 * count(*) FILTER (WHERE s >= 9) / count(*) - 100.0 * count(*) FILTER (WHERE s <= 6) / count(*), 1) AS nps,
       count(*) < 30 AS directional
FROM rated GROUP BY ALL
""",
)
def nps_by_group(spark: SparkSession, sf: str) -> DataFrame:
    score = F.least(F.lit(10), F.floor(F.col("value") / 10).cast("int"))
    rated = load(spark, sf, "events").select(
        "event_type",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.when(score >= 9, "Promoter").when(score >= 7, "Passive").otherwise("Detractor").alias("nps_category"),
    )
    return recipes.nps(rated, ["event_type", "day"])


@query(
    "nps_distribution",
    """
WITH answers AS (
  SELECT l_orderkey AS response_id, CASE WHEN l_quantity >= 40 THEN 'Promoter' WHEN l_quantity >= 25 THEN 'Passive'
         WHEN l_quantity >= 5 THEN 'Detractor' END AS nps_category FROM lineitem
), responses AS (
  SELECT o_orderkey AS response_id, o_orderstatus AS segment, o_orderpriority AS channel FROM orders
)
SELECT a.nps_category, r.segment, r.channel, count(*) AS n FROM answers a JOIN responses r USING (response_id)
WHERE a.nps_category IS NOT NULL GROUP BY ALL
""",
)
def nps_distribution(spark: SparkSession, sf: str) -> DataFrame:
    quantity = F.col("l_quantity")
    category = F.when(quantity >= 40, "Promoter").when(quantity >= 25, "Passive").when(quantity >= 5, "Detractor")
    answers = load(spark, sf, "lineitem").select(F.col("l_orderkey").alias("response_id"), category.alias("nps_category"))
    responses = load(spark, sf, "orders").select(
        F.col("o_orderkey").alias("response_id"),
        F.col("o_orderstatus").alias("segment"),
        F.col("o_orderpriority").alias("channel"),
    )
    return recipes.nps_distribution(answers, responses)


@query(
    "top_box",
    """
WITH rated AS (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, 1 + least(4, CAST(floor(value / 20) AS INT)) AS score FROM events)
SELECT event_type, day, count(*) AS n, round(100.0 * count(*) FILTER (WHERE score >= 5) / count(*), 1) AS pct_top,
       round(100.0 * count(*) FILTER (WHERE score >= 4) / count(*), 1) AS pct_top2, round(avg(score), 2) AS mean_score,
       count(*) < 30 AS directional
FROM rated GROUP BY ALL
""",
)
def top_box(spark: SparkSession, sf: str) -> DataFrame:
    rated = load(spark, sf, "events").select(
        "event_type",
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        (F.lit(1) + F.least(F.lit(4), F.floor(F.col("value") / 20).cast("int"))).alias("score"),
    )
    return recipes.top_box(rated, ["event_type", "day"])


@query(
    "pmf_share",
    """
SELECT strftime(ts, '%Y-%m-%d') AS period, event_type AS instrument, count(*) AS n,
       round(100.0 * count(*) FILTER (WHERE value >= 60) / count(*), 1) AS pct_very FROM events GROUP BY ALL
""",
)
def pmf_share(spark: SparkSession, sf: str) -> DataFrame:
    answers = load(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("period"),
        F.col("event_type").alias("instrument"),
        F.lit("pmf_1_5").alias("score_type"),
        F.when(F.col("value") >= 60, "very_disappointed").otherwise("not_disappointed").alias("category"),
    )
    return recipes.pmf_share(answers)


@query(
    "top_reasons",
    """
SELECT o_orderstatus AS reason, o_orderpriority AS plan_interval, count(*) AS n, round(avg(o_totalprice), 1) AS avg_price
FROM orders GROUP BY ALL
""",
)
def top_reasons(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("reason"), F.col("o_orderpriority").alias("plan_interval"), "o_totalprice"
    )
    return recipes.top_reasons(orders, ["reason", "plan_interval"], "o_totalprice", "avg_price")


@query(
    "wide_to_long",
    """
SELECT l_orderkey, l_linenumber, measure, amount FROM (
  SELECT l_orderkey, l_linenumber, nullif(l_quantity, 0) AS quantity, nullif(l_extendedprice, 0) AS price,
         nullif(l_discount, 0) AS discount, nullif(l_tax, 0) AS tax FROM lineitem)
UNPIVOT (amount FOR measure IN (quantity, price, discount, tax))
""",
)
def lineitem_long(spark: SparkSession, sf: str) -> DataFrame:
    def filled(name: str) -> Column:
        return F.when(F.col(name) != 0, F.col(name))

    return wide_to_long(
        load(spark, sf, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        {
            "quantity": filled("l_quantity"),
            "price": filled("l_extendedprice"),
            "discount": filled("l_discount"),
            "tax": filled("l_tax"),
        },
        "measure",
        "amount",
    )


@query(
    "residual_json",
    """
SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, json_extract_string(props, '$.k') AS k,
       CAST(NULL AS VARCHAR) AS event_type, event_type = 'signup' AS has_note FROM events
""",
)
def residual_json(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(*[F.lit(n) for n in ("user_id", "event_type", "Event Props", "note")])
    cells = F.array(
        F.col("user_id").cast("string"),
        F.col("event_type"),
        F.col("props"),
        F.when(F.col("event_type") == "signup", "new user").otherwise(""),
    )
    raw = load(spark, sf, "events").select(
        "event_id", scalars.sorted_json(residual(names, cells, drop=["event_type"])).alias("raw")
    )
    return raw.select(
        "event_id",
        scalars.json_field("raw", "user_id").alias("user_id"),
        scalars.json_field(scalars.json_field("raw", "Event Props"), "k").alias("k"),
        scalars.json_field("raw", "event_type").alias("event_type"),
        scalars.json_field("raw", "note").isNotNull().alias("has_note"),
    )


DRIFT_SQL = """
seen AS (SELECT DISTINCT event_type AS source, CAST(ts AS DATE) AS day, 'k' || json_extract_string(props, '$.k') AS "column" FROM events),
past AS (SELECT source, day + 1 AS day, "column" FROM seen)
"""


@query(
    "schema_drift",
    f"""
WITH {DRIFT_SQL}, changed AS (
  SELECT s.source, CAST(s.day AS DATE) AS day, s."column", 'new' AS change FROM seen s
  WHERE NOT EXISTS (SELECT 1 FROM past p WHERE p.source = s.source AND p.day = s.day AND p."column" = s."column")
    AND EXISTS (SELECT 1 FROM past p WHERE p.source = s.source AND p.day = s.day)
  UNION ALL
  SELECT p.source, CAST(p.day AS DATE), p."column", 'lost' FROM past p
  WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE p.source = s.source AND p.day = s.day AND p."column" = s."column")
    AND EXISTS (SELECT 1 FROM seen s WHERE p.source = s.source AND p.day = s.day)
)
SELECT source, strftime(day, '%Y-%m-%d') AS day, "column", change FROM changed WHERE "column" NOT LIKE 'k7%'
""",
)
def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    seen = load(spark, sf, "events").select(
        F.col("event_type").alias("source"),
        day().alias("day"),
        F.concat(F.lit("k"), scalars.json_field("props", "k")).alias("column"),
    )
    before = seen.withColumn("day", F.date_add("day", 1))
    drift = quality.schema_drift(seen, before, ["source", "day"], ignore=F.col("column").startswith("k7"))
    return drift.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    "column_sets",
    """
SELECT event_type AS source, count(*) AS n_columns, string_agg(c, ',' ORDER BY c) AS "columns" FROM (
  SELECT DISTINCT event_type, 'k' || json_extract_string(props, '$.k') AS c FROM events) GROUP BY 1
""",
)
def column_sets(spark: SparkSession, sf: str) -> DataFrame:
    headers = load(spark, sf, "events").select(
        F.col("event_type").alias("source"),
        F.array(F.concat(F.lit("k"), scalars.json_field("props", "k"))).alias("header"),
    )
    sets = quality.column_sets(headers).groupBy("source").agg(F.array_sort(F.collect_set("column")).alias("c"))
    return sets.select("source", F.size("c").cast("long").alias("n_columns"), F.array_join("c", ",").alias("columns"))


@query(
    "volume_alerts",
    """
WITH v AS (SELECT event_type AS source, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL)
SELECT a.source, strftime(a.day, '%Y-%m-%d') AS day, a.n AS rows_now, b.n AS rows_before, abs(a.n - b.n) / b.n AS swing
FROM v a JOIN v b ON a.source = b.source AND a.day = b.day + 1 WHERE abs(a.n - b.n) / b.n > 0.25
""",
)
def volume_alerts(spark: SparkSession, sf: str) -> DataFrame:
    volume = load(spark, sf, "events").groupBy(F.col("event_type").alias("source"), day().alias("day")).agg(F.count("*").alias("n"))
    before = volume.withColumn("day", F.date_add("day", 1))
    swings = quality.volume_swings(volume, before, ["source", "day"], "n", ratio=0.25)
    return swings.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


SENDER_RULES = {
    "internal_domains": ["mail1.example.com", "example.net"],
    "automated_patterns": ["no-reply", "the", "@blog."],
    "typed_domains": {"payment_dispute": ["mail2.example.com"], "marketplace": ["example.org"]},
}


@query(
    "sender_rules",
    rf"""
WITH senders AS (
  SELECT 'documents' AS origin, lower(unnest(regexp_extract_all(text, '[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{{2,}}'))) AS a FROM documents
  UNION ALL SELECT 'pages', 'info@' || regexp_extract(url, '^https?://([^/?#]+)', 1) FROM pages
), split AS (SELECT *, split_part(a, '@', -1) AS d FROM senders)
SELECT origin, CASE
  WHEN d = 'mail1.example.com' OR d LIKE '%.mail1.example.com' OR d = 'example.net' OR d LIKE '%.example.net' THEN 'internal'
  WHEN contains(a, 'no-reply') OR contains(a, 'the') OR contains(a, '@blog.') THEN 'automated'
  WHEN d = 'mail2.example.com' OR d LIKE '%.mail2.example.com' THEN 'payment_dispute'
  WHEN d = 'example.org' OR d LIKE '%.example.org' THEN 'marketplace' ELSE 'customer' END AS sender_type,
  count(*) AS n, count(DISTINCT d) AS domains
FROM split GROUP BY ALL
""",
)
def sender_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents").filter(F.contains("text", F.lit("@")))
    senders = docs.select(
        F.lit("documents").alias("origin"),
        F.explode(F.regexp_extract_all("text", F.lit(scalars.EMAIL), F.lit(0))).alias("addr"),
    ).unionByName(
        load(spark, sf, "pages").select(
            F.lit("pages").alias("origin"),
            F.concat(F.lit("info@"), F.regexp_extract("url", "^https?://([^/?#]+)", 1)).alias("addr"),
        )
    )
    typed = senders.select(
        "origin", sender_type(F.col("addr"), **SENDER_RULES).alias("sender_type"), scalars.email_domain("addr").alias("d")
    )
    return typed.groupBy("origin", "sender_type").agg(F.count("*").alias("n"), F.count_distinct("d").alias("domains"))


# One date shape per case; the test formats a timestamp and reads it back.
DATE_SHAPES = [
    ("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "millisecond"),
    ("yyyy-MM-dd'T'HH:mm:ss'Z'", "second"),
    ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'", "microsecond"),
    ("yyyy-MM-dd'T'HH:mm:ss'+0200'", "second"),
    ("yyyy-MM-dd HH:mm:ss", "second"),
    ("yyyy-MM-dd HH:mm", "minute"),
    ("yyyy-MM-dd", "day"),
    ("MM/dd/yyyy HH:mm:ss", "second"),
    ("M/d/yyyy H:mm", "minute"),
    ("M/d/yyyy", "day"),
    ("MM-dd-yyyy", "day"),
    ("MMMM d, yyyy h:mm a", "minute"),
    ("MMMM d, yyyy", "day"),
    ("yyyy.MM.dd", None),
]


@query(
    "parse_dates",
    "SELECT event_id, CASE event_id % 14 "
    + " ".join(
        f"WHEN {i} THEN date_trunc('{unit}', ts)" + (" - INTERVAL 2 HOUR" if "+0200" in f else "")
        for i, (f, unit) in enumerate(DATE_SHAPES)
        if unit
    )
    + " END AS parsed FROM events",
)
def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    shape = F.col("event_id") % 14
    cell = F.coalesce(*[F.when(shape == i, F.date_format("ts", f)) for i, (f, _) in enumerate(DATE_SHAPES)])
    written = load(spark, sf, "events").select("event_id", cell.alias("cell"))
    return written.select("event_id", scalars.parse_dt("cell").alias("parsed"))


@query(
    "parse_numbers",
    """
SELECT o_orderkey, CASE o_orderkey % 8 WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 5 THEN NULL
       WHEN 2 THEN -o_totalprice WHEN 6 THEN o_totalprice * 100 ELSE o_totalprice END AS parsed
FROM orders
""",
)
def parse_numbers(spark: SparkSession, sf: str) -> DataFrame:
    price = F.format_number("o_totalprice", 2)
    plain = F.replace(price, F.lit(","), F.lit(""))
    shapes = [
        plain,
        price,
        F.concat(F.lit("-"), price),
        F.concat(plain, F.lit("d")),
        F.lit("nan"),
        F.lit("1_0"),
        F.concat(plain, F.lit("e2")),
        F.concat(F.lit("  +"), plain, F.lit("\t")),
    ]
    shape = F.col("o_orderkey") % 8
    cell = F.coalesce(*[F.when(shape == i, s) for i, s in enumerate(shapes)])
    written = load(spark, sf, "orders").select("o_orderkey", cell.alias("cell"))
    return written.select("o_orderkey", scalars.to_float("cell").alias("parsed"))


@query(
    "provenance_lookup",
    """
SELECT doc_id, source AS source_file, md5(regexp_replace(text, '[A-Za-z0-9._%+\\-]+@[A-Za-z0-9.\\-]+\\.[A-Za-z]{2,}', '[email]', 'g')) AS record_md5
FROM documents WHERE text ILIKE '%license%'
""".replace("\\\\", "\\"),
)
def provenance_lookup(spark: SparkSession, sf: str) -> DataFrame:
    docs = load(spark, sf, "documents")
    address = [F.col("source").alias("source_file"), F.col("doc_id").alias("row_number")]
    mirror = docs.select(
        F.col("lang").alias("period"),
        F.lit("documents").alias("source"),
        *address,
        F.create_map(F.lit("text"), masks.mask_emails("text")).alias("cells"),
    )
    hits = docs.filter(F.col("text").ilike("%license%")).select(
        "doc_id", F.col("lang").alias("period"), F.lit("documents").alias("source"), *address
    )
    found = recipes.original_record(hits, mirror)
    return found.select("doc_id", "source_file", F.md5(F.col("cells")["text"]).alias("record_md5"))


@query(
    "study_catalog",
    """
SELECT 'study_' || left(sha256(source || chr(31) || lang), 12) AS study_id, 'report_' || lower(lang) AS kind,
       source AS name, lang AS period, count(*) AS n FROM documents GROUP BY source, lang
""",
)
def study_catalog(spark: SparkSession, sf: str) -> DataFrame:
    counted = load(spark, sf, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"))
    return counted.select(
        F.concat(F.lit("study_"), scalars.short_hash("source", "lang")).alias("study_id"),
        F.concat(F.lit("report_"), scalars.slug("lang")).alias("kind"),
        F.col("source").alias("name"),
        F.col("lang").alias("period"),
        "n",
    )


@query(
    "answers_of_studies",
    """
SELECT s.source, count(*) AS n, min(a.text) AS first_answer, min(md5(a.text)) AS first_md5,
       CAST(sum(CAST('0x' || left(md5(a.text), 8) AS BIGINT)) AS BIGINT) AS md5_sum
FROM conversations a JOIN documents s ON s.doc_id = a.conv_id
WHERE s.lang = 'en' AND a.role = 'assistant' AND a.text ILIKE '%the%' GROUP BY 1
""",
)
def answers_of_studies(spark: SparkSession, sf: str) -> DataFrame:
    studies = load(spark, sf, "documents").select(
        F.col("doc_id").alias("study_id"), F.concat_ws(" ", "lang", "source").alias("name")
    )
    answers = load(spark, sf, "conversations").select(
        F.col("conv_id").alias("study_id"),
        F.col("conv_id").alias("response_id"),
        F.col("turn").alias("column_index"),
        F.when(F.col("role") == "assistant", "Answer").otherwise(F.col("role")).alias("field"),
        F.col("text").alias("question"),
        F.col("text").alias("answer"),
    )
    said = recipes.panel_answers(answers, studies, "en src", "the")
    named = said.join(load(spark, sf, "documents").select(F.col("doc_id").alias("study_id"), "source"), "study_id")
    return named.groupBy("source").agg(
        F.count("*").alias("n"),
        F.min("answer").alias("first_answer"),
        F.min(F.md5("answer")).alias("first_md5"),
        # a check of every answer that adds up map-side
        F.sum(F.conv(F.left(F.md5("answer"), F.lit(8)), 16, 10).cast("long")).alias("md5_sum"),
    )


@query(
    "score_and_answer_type",
    """
WITH a AS (
  SELECT event_id, CASE event_type WHEN 'click' THEN CAST(event_id % 11 AS VARCHAR) WHEN 'view' THEN 'somewhat'
                   WHEN 'error' THEN '' ELSE 'I would be very disappointed' END AS resp,
         event_type = 'purchase' AS is_choice, event_type IN ('click', 'view') AS scored
  FROM events
)
SELECT CASE WHEN is_choice THEN 'choice' WHEN scored AND regexp_matches(resp, '^[ 0-9.]*$') THEN 'score' ELSE 'text' END AS answer_type,
       count(*) AS n, sum(length(resp))::BIGINT AS chars FROM a GROUP BY 1
""",
)
def score_and_answer_type(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    answers = load(spark, sf, "events").select(
        F.when(kind == "click", (F.col("event_id") % 11).cast("string"))
        .when(kind == "view", "somewhat")
        .when(kind == "error", "")
        .otherwise("I would be very disappointed")
        .alias("resp"),
        (kind == "purchase").alias("is_choice"),
        F.when(kind.isin("click", "view"), "scale").alias("score_type"),
    )
    typed = answers.select(
        scalars.answer_type(F.col("is_choice"), F.col("score_type"), F.col("resp")).alias("answer_type"), "resp"
    )
    return typed.groupBy("answer_type").agg(
        F.count("*").alias("n"), F.sum(F.char_length("resp")).cast("long").alias("chars")
    )


@query(
    "table_sizes",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}"
        for t in ("customer", "orders", "lineitem", "events", "documents", "pages", "conversations")
    ),
)
def table_sizes(spark: SparkSession, sf: str) -> DataFrame:
    from ..plans.ingest import table_sizes as sizes

    names = ("customer", "orders", "lineitem", "events", "documents", "pages", "conversations")
    return sizes({n: load(spark, sf, n) for n in names})
