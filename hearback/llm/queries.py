"""The dealt operators over their whole tables with production parameters, and SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, fingerprints, language, merkle, minhash, mixing, phrases, pieces, secrets, simhash, topk, toxicity, wavelet
from .common import workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


# Recipe of the mix: the domain of a source, and whole-number weights per level.
DOMAINS = {
    "web": ["src0", "src1", "src2", "src3", "src4"],
    "news": ["src5", "src6", "src7", "src8"],
    "books": ["src9", "src10", "src11", "src12"],
    "forums": ["src13", "src14", "src15", "src16"],
}
DOMAIN_WEIGHTS = {"web": 40, "news": 25, "books": 20, "forums": 10}
LANG_WEIGHTS = {"en": 50, "de": 20, "fr": 20, "es": 10}


def _sql_cases(column: str, values: dict, otherwise) -> str:
    quoted = lambda v: f"'{v}'" if isinstance(v, str) else str(v)
    return f"CASE {' '.join(f'WHEN {column} = {quoted(k)} THEN {quoted(v)}' for k, v in values.items())} ELSE {quoted(otherwise)} END"


MIX = mixing.Mix(
    domain=_sql_cases("source", {s: d for d, sources in DOMAINS.items() for s in sources}, "other"),
    weights={
        "domain": _sql_cases("domain", DOMAIN_WEIGHTS, 5),
        "lang": _sql_cases("lang", LANG_WEIGHTS, 1),
        "source": "1",
    },
    max_epochs=4,
    seed=17,
)


def _sql_deal(source: str, parent: str, child: str) -> str:
    """Water level of one sibling group in closed form: the children that fill up come first."""
    by = f"PARTITION BY {parent}" if parent else ""
    return f"""
    SELECT *, CASE WHEN full_up THEN cap ELSE least(cap,
        (max(CASE WHEN NOT full_up THEN rest END) OVER ({by}))::HUGEINT * upto // max(CASE WHEN NOT full_up THEN ahead END) OVER ({by})
      - (max(CASE WHEN NOT full_up THEN rest END) OVER ({by}))::HUGEINT * (upto - w) // max(CASE WHEN NOT full_up THEN ahead END) OVER ({by})) END::BIGINT AS budget
    FROM (SELECT *, sum(CASE WHEN full_up THEN 0 ELSE w END) OVER ({by} ORDER BY cap / w, {child} NULLS FIRST ROWS UNBOUNDED PRECEDING)::HUGEINT AS upto
      FROM (SELECT *, cap::HUGEINT * ahead <= rest * w AS full_up
        FROM (SELECT *, (purse - coalesce(sum(cap) OVER ({by} ORDER BY cap / w, {child} NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::HUGEINT AS rest,
                sum(w) OVER ({by} ORDER BY cap / w, {child} NULLS FIRST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS ahead
          FROM ({source}))))
    """


OP1_SQL = f"""
WITH line AS (
  SELECT doc_id, lang, source, {_sql_cases('source', {s: d for d, ss in DOMAINS.items() for s in ss}, 'other')} AS domain,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens
  FROM documents),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS supply, 4 * sum(n_tokens)::BIGINT AS cap FROM line GROUP BY ALL),
d AS ({_sql_deal(f"SELECT domain, sum(cap)::BIGINT AS cap, (SELECT sum(supply) FROM leaves)::BIGINT AS purse, {_sql_cases('domain', DOMAIN_WEIGHTS, 5)} AS w FROM leaves GROUP BY domain", "", "domain")}),
l AS ({_sql_deal(f"SELECT leaves.domain, lang, sum(leaves.cap)::BIGINT AS cap, any_value(d.budget) AS purse, {_sql_cases('lang', LANG_WEIGHTS, 1)} AS w FROM leaves JOIN d USING (domain) GROUP BY leaves.domain, lang", "domain", "lang")}),
s AS ({_sql_deal("SELECT leaves.domain, leaves.lang, source, leaves.supply, leaves.cap, l.budget AS purse, 1 AS w FROM leaves JOIN l ON leaves.domain = l.domain AND leaves.lang IS NOT DISTINCT FROM l.lang", "domain, lang", "source")}),
rows AS (
  SELECT line.*, s.budget, e.epoch FROM line JOIN s ON line.domain = s.domain AND line.lang IS NOT DISTINCT FROM s.lang AND line.source IS NOT DISTINCT FROM s.source,
    (SELECT unnest(range(5)) AS epoch) e WHERE e.epoch * s.supply < s.budget),
placed AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY epoch, md5('17:' || epoch || ':' || doc_id) ROWS UNBOUNDED PRECEDING) - n_tokens AS start
  FROM rows)
SELECT doc_id, domain, lang, source, epoch, n_tokens, least(n_tokens, budget - start)::BIGINT AS taken
FROM placed WHERE start < budget
"""


@query("op1_mix_sources", OP1_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as often as its source's budget takes it."""
    docs = load(spark, folder, "documents")
    return mixing.mix_sources(docs, MIX).select("doc_id", "domain", "lang", "source", "epoch", "n_tokens", "taken")


@query("op7_simhash_near_duplicates")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's SimHash of four-word shingles and its component at 4 bits."""
    found = simhash.near_duplicates(load(spark, folder, "documents"), width=4, bits=4, seed=42)
    return found.select("doc_id", "fingerprint", "component_id")


@query("op10_secret_scan")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    """Strong and linked secrets of every document."""
    return secrets.report(secrets.find_secrets(load(spark, folder, "documents")))


@query("op9_toxicity")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document's restored text."""
    docs = load(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, load(spark, folder, "labels"))
    return toxicity.add_score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op2_sentencepiece")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's piece ids, and whether they decode to the text."""
    model = Path(vocabulary("piece_bpe_32k.model")).read_bytes()
    docs = load(spark, folder, "documents").select("doc_id", "text")
    return pieces.encode(docs, model, "bpe", check=True).select("doc_id", "n_tokens", "ids", "round_trip")


@query("op5_order_minhash")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's fingerprint, its edited text's, and their likeness."""
    return fingerprints.with_successors(load(spark, folder, "documents"))


OP4_SQL = f"""
WITH rows AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
convs AS (
  SELECT conv_id, list(coalesce('+' || role, '-') || chr(1) || coalesce('+' || text, '-') ORDER BY turn, role, text) AS turns,
    string_agg('{chat.OPEN}' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS text
  FROM rows GROUP BY conv_id),
inner_prefixes AS (
  SELECT DISTINCT md5(turns[1:n]::VARCHAR) AS prefix FROM (SELECT turns, unnest(range(1, len(turns))) AS n FROM convs)),
alone AS (SELECT min(conv_id) AS conv_id FROM convs GROUP BY turns)
SELECT conv_id, 0 AS part, len(turns)::BIGINT AS n_turns, text
FROM convs JOIN alone USING (conv_id) WHERE md5(turns::VARCHAR) NOT IN (SELECT prefix FROM inner_prefixes)
"""


@query("op4_chat_formatting", OP4_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """The conversations that are no snapshot of a longer one, rendered."""
    return chat.render(load(spark, folder, "conversations"))


@query("op6_wavelet_token_files")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's place and digest in the token files written for the whole table."""
    tokenizer = Path(vocabulary("byte_bpe_50k.json")).read_text()
    files = wavelet.store(load(spark, folder, "documents"), workspace(spark), tokenizer, planes=16)
    return wavelet.read_documents(files)


OP8_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS id, vec_id, list_resize(list_transform(embedding, lambda x: floor(64 * x::DOUBLE)),
    (SELECT greatest(1, max(len(embedding))) FROM embeddings), 0) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.id AS query_row, q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.id <> c.id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id)::INT AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query("op8_exact_top_k", OP8_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 vectors of highest integer product with every twentieth vector."""
    return topk.top_k(load(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


@query("op3_language_id")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    docs = load(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 3 == 1
    filters = language.learn(docs.filter(~held_out).select("text", "lang"))
    found = language.predict(docs.select("doc_id", "text"), filters)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def _sql_crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    step = "c"
    for _ in range(8):
        step = f"list_transform([{step}], lambda z: xor(z >> 1, CASE WHEN z & 1 = 1 THEN 3988292384 ELSE 0 END))[1]"
    step = step.replace("[c]", "[xor(a, b)]", 1)
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda d: ord(d)::BIGINT)), lambda a, b: {step}), 4294967295)"


def _sql_field(value: str) -> str:
    return f"coalesce(octet_length(encode(({value})::VARCHAR))::VARCHAR || ':' || ({value})::VARCHAR, '-')"


def _sql_leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_sql_field(v) for v in ("doc_id", "source", "lang", n_chars, "text")) + ")"


OP11_SQL = f"""
WITH RECURSIVE rows AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '') AS grp, {_sql_leaf('n_chars')} AS leaf, {_sql_leaf('n_chars::HUGEINT + 1')} AS altered,
    {_sql_crc32('doc_id::VARCHAR')} % 7 = 0 AS tampered FROM documents),
placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY grp) AS n FROM rows),
nodes AS (
  SELECT grp, 0 AS level, idx, n, leaf AS h FROM placed
  UNION ALL
  SELECT grp, level + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM nodes WHERE n > 1 GROUP BY grp, level, idx // 2),
low AS MATERIALIZED (SELECT * FROM nodes),
subroots AS MATERIALIZED (
  SELECT grp, h, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n FROM low WHERE n = 1),
tops AS (
  SELECT 0 AS level, idx, n, h FROM subroots
  UNION ALL
  SELECT level + 1, idx // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY idx)) FROM tops WHERE n > 1 GROUP BY level, idx // 2),
high AS MATERIALIZED (SELECT * FROM tops),
ways AS (
  SELECT p.grp, p.idx AS place, w.level, w.idx % 2 AS side, w.h FROM placed p JOIN low w ON w.grp = p.grp AND w.idx = xor(p.idx >> w.level, 1)
  UNION ALL BY NAME
  SELECT p.grp, p.idx AS place, 1000 + w.level AS level, w.idx % 2 AS side, w.h
  FROM placed p JOIN subroots s ON s.grp = p.grp JOIN high w ON w.idx = xor(s.idx >> w.level, 1)),
own AS (
  SELECT grp, idx AS place, doc_id, leaf, CASE WHEN tampered THEN altered ELSE leaf END AS given FROM placed),
steps AS (
  -- a level without a sibling hashes the node alone
  SELECT p.grp, p.idx AS place, l.level, w.side, w.h FROM placed p JOIN (SELECT DISTINCT grp, level FROM low WHERE n > 1) l ON l.grp = p.grp
  LEFT JOIN ways w ON w.grp = p.grp AND w.place = p.idx AND w.level = l.level
  UNION ALL
  SELECT p.grp, p.idx AS place, 1000 + l.level, w.side, w.h FROM placed p JOIN (SELECT DISTINCT level FROM high WHERE n > 1) l ON true
  LEFT JOIN ways w ON w.grp = p.grp AND w.place = p.idx AND w.level = 1000 + l.level),
proofs AS (
  SELECT grp, place, sha256(coalesce(string_agg(h, '' ORDER BY level), '')) AS proof,
    list(CASE side WHEN 0 THEN 'L' WHEN 1 THEN 'R' ELSE '-' END || coalesce(h, '') ORDER BY level) AS way FROM steps GROUP BY grp, place)
SELECT o.doc_id, o.grp, o.place AS idx, o.leaf, s.h AS subroot, r.h AS root, coalesce(p.proof, sha256('')) AS proof_sha256,
  list_reduce(list_prepend(o.given, coalesce(p.way, [])), lambda x, y: sha256(CASE y[1] WHEN 'L' THEN y[2:] || x WHEN 'R' THEN x || y[2:] ELSE x END)) AS folded_root,
  folded_root = r.h AS verified
FROM own o JOIN subroots s USING (grp) JOIN (SELECT h FROM high WHERE n = 1) r ON true LEFT JOIN proofs p ON p.grp = o.grp AND p.place = o.place
"""


@query("op11_merkle_manifest", OP11_SQL)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's leaf and proof, and whether its row, some altered, still gives the root."""
    altered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return merkle.manifest(load(spark, folder, "documents"), altered)


OP12_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang, string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
pieces AS (SELECT lang, regexp_extract_all(unnest(pieces), '[^\x20\x09]+') AS w FROM texts),
spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
grams AS MATERIALIZED (
  SELECT lang, w[i:i + s.size - 1] AS words, s.size, count(*) AS f
  FROM spots JOIN (SELECT unnest([1, 2, 3, 4]) AS size) s ON i + s.size - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 30),
totals AS (SELECT lang, count(*) AS n FROM spots GROUP BY lang),
cuts AS (
  SELECT g.lang, g.words, g.f AS a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * g.f // (x.f + y.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM grams WHERE size > 1) g
  JOIN grams x ON x.lang = g.lang AND x.words = g.words[1:k] JOIN grams y ON y.lang = g.lang AND y.words = g.words[k + 1:]),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, words ORDER BY score, k) = 1),
inside AS (
  SELECT lang, words[s.i:s.i + s.n - 1] AS words, max(f) AS longest
  FROM grams JOIN (VALUES (3, 1, 2), (3, 2, 2), (4, 1, 2), (4, 2, 2), (4, 3, 2), (4, 1, 3), (4, 2, 3)) s(size, i, n) ON s.size = grams.size GROUP BY ALL),
ranked AS (
  SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, n, score,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(words, ' '))) AS rank
  FROM best LEFT JOIN inside USING (lang, words) JOIN totals USING (lang) WHERE longest IS NULL OR 100::HUGEINT * longest < 80::HUGEINT * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


@query("op12_phrase_collocations", OP12_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Each language's 2000 phrases of highest score."""
    return phrases.collocations(load(spark, folder, "documents"))


OP13_SQL = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT id, doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
classes AS MATERIALIZED (SELECT min(id) AS id, any_value(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
items AS MATERIALIZED (SELECT id, len(s) AS n, unnest(s) AS item FROM classes),
shared AS (SELECT a.id AS x, b.id AS y, any_value(a.n) AS m, any_value(b.n) AS n, count(*) AS same FROM items a JOIN items b ON a.item = b.item AND a.id < b.id GROUP BY a.id, b.id),
links AS MATERIALIZED (SELECT x, y FROM shared WHERE 100 * same >= 85 * (m + n - same)),
both_ways AS MATERIALIZED (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT id, id AS other FROM classes UNION SELECT r.id, b.y FROM reach r JOIN both_ways b ON b.x = r.other),
members AS (SELECT c.id, s.doc_id FROM classes c JOIN sets s ON list_sort(s.s) = list_sort(c.s)),
least AS (SELECT r.id, min(m.doc_id) AS component_id FROM reach r JOIN members m ON m.id = r.other GROUP BY r.id),
named AS (SELECT list_sort(c.s) AS s, component_id FROM least JOIN classes c USING (id))
SELECT doc_id, len(sets.s)::BIGINT AS n_shingles, CASE WHEN len(sets.s) = 0 THEN doc_id ELSE n.component_id END AS component_id,
  coalesce(doc_id = CASE WHEN len(sets.s) = 0 THEN doc_id ELSE n.component_id END, false) AS kept
FROM sets LEFT JOIN named n ON n.s = list_sort(sets.s)
"""


@query("op13_superminhash_near_duplicates", OP13_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's set size and component at a similarity of 0.85."""
    return minhash.near_duplicates(load(spark, folder, "documents"), width=3, percent=85)
