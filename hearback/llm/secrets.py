"""Secret scans: strong findings by pattern, weak ones only where their counterparts stand near.

Only DataFrame functions run here. Positions come from the texts between matches: ``split``
gives them, ``regexp_extract_all`` the matches, and running sums of their lengths the starts
and ends in code points. All of that stays in the row. Only the parts of texts that hold a
weak candidate are exploded and linked.

Linking: a part has a role (identifier, secret, endpoint) and is strong (found for sure) or
weak. Parts are joined with the parts of their scope: same document, no blank line between,
at most ``REACH`` code points from the end of one to the start of the next, however long the
parts are. A weak secret is reported where a strong
identifier stands in its scope, or a weak one and an endpoint; a weak identifier where a
strong secret does, or a weak one and an endpoint; an endpoint where an identifier and a
secret do. The interval join asks only whether such parts exist, so it takes the latest end of those
that start before a part and the earliest start of those after it, and lists no pairs. A weak part that overlaps a strong one is dropped.

Defined cases: a null text counts as empty and has no spans; rows without doc_id and
repeated rows are scanned like others; columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import Workspace
from .common import BLANKS, free_prefix, workspace

REACH = 300
BLOCK = 128
MARK = "[SECRET]"

# The base kinds in their order, with pattern, group and least length of it.
BASE = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]
# What the scan may look for first: no match of a kind without it.
HINTS = {"assign": BASE[0][1], "access": "AKIA[A-Z0-9]{16}", "hex": "[0-9a-f]{24}"}
KINDS = ["assign", "access", "hex", "id", "secret", "endpoint"]

_SETS = r"""["']?\x20*[:=]\x20*["']?"""
_VALUE = rf"""[^{BLANKS}"',;<>]{{3,}}"""
_ID = r"(?i:user(?:_?name|_?id)?|login|client_?id|account|access_?key_?id|key_?id)"
_POINT = r"(?i:endpoint|host(?:name)?|server|url)"
_SECRET = r"(?i:pwd|pass|auth|credentials?|private_?key|access_?key)"
_URL = rf"""https?://[^{BLANKS}"'<>]+"""
_BLOB = r"[A-Za-z0-9+/]{32,}={0,2}"
_BREAK = r"\n[ \t\r]*\n"
PARTS = rf"{_URL}|(?:{_ID}|{_POINT}|{_SECRET}){_SETS}{_VALUE}|{_BLOB}"


def _positions(df: DataFrame, out: str, pattern: str, hint: Column, group: int, least: int) -> DataFrame:
    """Add ``out``: array of (start, end, text) of the matches whose group has ``least`` code points.
    Only texts for which ``hint`` is true are searched.

    Running sums are taken within blocks of matches and over blocks, so that a text of many
    matches costs little more than its length.
    """
    text = F.col("__text")
    here = lambda c: F.when(hint, c)
    p = F.lit(pattern)
    df = df.withColumn("__found", here(F.regexp_extract_all(text, p, F.lit(0)))).withColumn(
        "__gaps", here(F.split(text, pattern, -1))
    )
    df = df.withColumn("__value", here(F.regexp_extract_all(text, p, F.lit(group))) if group else F.col("__found"))
    size = lambda c: F.char_length(c).cast("long")
    df = df.withColumn(
        "__sizes",
        F.transform(
            "__found",
            lambda m, i: F.struct(
                size(F.get("__gaps", i)).alias("gap"), size(m).alias("size"), size(F.get("__value", i)).alias("value")
            ),
        ),
    )
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x["gap"] + x["size"])
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("__sizes") - 1) / BLOCK).cast("int")),
        lambda b: total(F.slice("__sizes", b * BLOCK + 1, F.lit(BLOCK))),
    )
    df = df.withColumn("__blocks", F.when(F.size("__sizes") > 0, blocks))
    heads = F.transform(
        "__blocks", lambda x, b: F.aggregate(F.slice("__blocks", F.lit(1), b), F.lit(0).cast("long"), lambda s, y: s + y)
    )
    df = df.withColumn("__heads", heads)

    def span(x: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        before = total(F.slice("__sizes", block * BLOCK + 1, i - block * BLOCK))
        return F.struct((F.get("__heads", block) + before + x["gap"]).alias("start"), x.alias("of"), i.alias("i"))

    spans = F.transform(
        F.filter(F.transform("__sizes", span), lambda s: s["of"]["value"] >= least),
        lambda s: F.struct(
            s["start"].alias("start"), (s["start"] + s["of"]["size"]).alias("end"), F.get("__found", s["i"]).alias("text")
        ),
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint,text:string>>")
    df = df.withColumn(out, F.when(F.size("__sizes") > 0, spans).otherwise(none))
    return df.drop("__found", "__gaps", "__value", "__sizes", "__blocks", "__heads")


def _bare(spans: str | Column, kind: str) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("no"), s["end"].alias("end"), F.lit(kind).alias("kind")
        ),
    )


def _written(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan(docs: DataFrame, work: Workspace) -> DataFrame:
    """(doc_id, text_key, base, parts, breaks) of every row, without its text: strong spans, weak parts with
    their role, and blank lines of texts that have weak parts."""
    df = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("__text"))
    for kind, pattern, group, least in BASE:
        df = _positions(df.withColumn("__hint", F.col("__text").rlike(HINTS[kind])), kind, pattern, F.col("__hint"), group, least)
    df = _positions(df.withColumn("__hint", F.col("__text").rlike(PARTS)), "parts", PARTS, F.col("__hint"), 0, 3)
    df = _positions(df, "breaks", _BREAK, F.size("parts") > 0, 0, 1)
    base = F.array_sort(F.concat(*(_bare(kind, kind) for kind, *_ in BASE)))
    dense = lambda m: m.rlike(r"[0-9]") & m.rlike(r"[A-Z]") & m.rlike(r"[a-z]")
    role = lambda m: (
        F.when(m.rlike(rf"^(?:https?://|{_POINT}{_SETS})"), "endpoint")
        .when(m.rlike(rf"^{_ID}{_SETS}"), "id")
        .when(m.rlike(rf"^{_SECRET}{_SETS}") | dense(m), "secret")
    )
    parts = F.filter(
        F.transform("parts", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), role(s["text"]).alias("role"))),
        lambda s: s["role"].isNotNull(),
    )
    breaks = F.transform("breaks", lambda s: s["start"])
    return work.stage(
        df.select("doc_id", F.md5("__text").alias("text_key"), base.alias("base"), parts.alias("parts"), breaks.alias("breaks")),
        "secrets-scan",
    )


def link(scanned: DataFrame) -> DataFrame:
    """(doc_id, text_key, linked): the weak parts that are reported, as spans, of the texts that have any."""
    key = ["doc_id", "text_key"]
    weak = scanned.filter(F.size("parts") > 0)
    strong_role = lambda k: F.when(k == "access", "id").otherwise("secret")
    items = F.concat(
        F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), strong_role(s["kind"]).alias("role"), F.lit(True).alias("strong"))),
        F.transform("parts", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["role"].alias("role"), F.lit(False).alias("strong"))),
        F.transform("breaks", lambda b: F.struct(b.alias("start"), b.alias("end"), F.lit("break").alias("role"), F.lit(False).alias("strong"))),
    )
    rows = weak.select(*key, F.inline(items)).distinct()
    line = Window.partitionBy(*key).orderBy("start")
    rows = rows.withColumn("scope", F.sum(F.when(F.col("role") == "break", 1).otherwise(0)).over(line))
    rows = rows.filter("role <> 'break'")
    strong = F.col("strong")
    left = F.max(F.when(strong, F.col("end"))).over(line)
    right = F.min(F.when(strong, F.col("start"))).over(
        line.rangeBetween(Window.currentRow, Window.unboundedFollowing)
    )
    rows = rows.withColumn("left", left).withColumn("right", right)
    clear = (F.coalesce("left", F.lit(-1)) <= F.col("start")) & (F.col("right").isNull() | (F.col("right") >= F.col("end")))
    rows = rows.filter(strong | clear)
    # both frames run from the partition's first row to the current one, which takes one pass
    scope = Window.partitionBy(*key, "scope")
    upto = lambda order: scope.orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    before, after = upto(F.asc("start")), upto(F.desc("start"))

    def has(role: str, only: bool = False) -> Column:
        of = (F.col("role") == role) & (strong if only else F.lit(True))
        back = F.max(F.when(of, F.col("end"))).over(before) >= F.col("start") - REACH
        ahead = F.min(F.when(of, F.col("start"))).over(after) <= F.col("end") + REACH
        return F.coalesce(back, F.lit(False)) | F.coalesce(ahead, F.lit(False))

    rows = rows.withColumns(
        {"sure_id": has("id", True), "any_id": has("id"), "sure_secret": has("secret", True), "any_secret": has("secret"), "point": has("endpoint")}
    )
    reported = (
        F.when(F.col("role") == "secret", F.col("sure_id") | (F.col("any_id") & F.col("point")))
        .when(F.col("role") == "id", F.col("sure_secret") | (F.col("any_secret") & F.col("point")))
        .otherwise(F.col("any_id") & F.col("any_secret"))
    )
    no = F.when(F.col("role") == "id", 3).when(F.col("role") == "secret", 4).otherwise(5)
    rows = rows.filter(~strong & reported)
    span = F.struct("start", no.alias("no"), "end", F.col("role").alias("kind"))
    return rows.groupBy(*key).agg(F.array_sort(F.collect_list(span)).alias("linked"))


def find_secrets(docs: DataFrame, work: Workspace | None = None) -> DataFrame:
    """Per row: doc_id, text_key (MD5 of the text), base and all spans (start, no, end, kind; code points)."""
    work = work or workspace(docs.sparkSession)
    scanned = scan(docs, work)
    linked = work.settle(link(scanned), "secrets-linked").select(
        F.col("doc_id").alias("linked_id"), F.col("text_key").alias("linked_key"), "linked"
    )
    on = (F.col("text_key") == F.col("linked_key")) & F.col("doc_id").eqNullSafe(F.col("linked_id"))
    found = scanned.join(linked, on, "left")
    none = F.array().cast("array<struct<start:bigint,no:int,end:bigint,kind:string>>")
    spans = F.array_sort(F.concat("base", F.coalesce("linked", none)))
    return found.select("doc_id", "text_key", "base", spans.alias("spans"))


def report(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, digest of the base spans and all spans as text."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *(count(kind) for kind, *_ in BASE),
        F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"),
    )


def mask_secrets(docs: DataFrame, mark: str = MARK) -> DataFrame:
    """``docs`` with every span, strong or linked, replaced by ``mark``; n_chars, where there is
    one, counts the new text. Overlapping spans are one. Texts without spans stay as they are."""
    work, own = workspace(docs.sparkSession), free_prefix(docs, "__secret_")
    found = find_secrets(docs, work).filter(F.size("spans") > 0)
    key = ["doc_id", "text_key"]
    rows = found.select(*key, F.inline("spans")).distinct()
    line = Window.partitionBy(*key).orderBy("start", "no")
    upto = F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("new", (F.coalesce(upto, F.lit(-1)) <= F.col("start")).cast("int"))
    rows = rows.withColumn("run", F.sum("new").over(line))
    runs = rows.groupBy(*key, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    runs = runs.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias(f"{own}runs"))
    runs = work.settle(runs, "secrets-runs").select(
        F.col("doc_id").alias(f"{own}id"), F.col("text_key").alias(f"{own}key"), f"{own}runs"
    )
    text = F.col("text")
    on = (F.md5(F.coalesce(text, F.lit(""))) == F.col(f"{own}key")) & F.col("doc_id").eqNullSafe(F.col(f"{own}id"))
    df = docs.join(runs, on, "left")
    before = lambda i: F.coalesce(F.get(f"{own}runs", i - 1)["end"], F.lit(0))
    kept = F.transform(
        f"{own}runs", lambda r, i: F.substring(text, (before(i) + 1).cast("int"), (r["start"] - before(i)).cast("int"))
    )
    tail = F.substring(text, (F.element_at(f"{own}runs", -1)["end"] + 1).cast("int"), F.lit(2147483647))
    masked = F.concat(F.array_join(F.transform(kept, lambda k: F.concat(k, F.lit(mark))), ""), tail)
    df = df.withColumn("text", F.when(F.col(f"{own}runs").isNotNull(), masked).otherwise(text))
    if "n_chars" in docs.columns:
        counted = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        df = df.withColumn("n_chars", F.when(F.col(f"{own}runs").isNotNull(), counted).otherwise(F.col("n_chars")))
    return df.select(*docs.columns)
