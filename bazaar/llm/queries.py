"""The operators bound to the driver's tables, with DuckDB SQL where SQL can
express the result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaar.llm.bpe_transducer import encode_texts
from bazaar.llm.common import stored, table
from bazaar.llm.edit_counts import EDIT, edited_counts
from bazaar.llm.fill_middle import restore, transform
from bazaar.llm.impact_search import integers, top_k
from bazaar.llm.learned_ann import fit as fit_router
from bazaar.llm.learned_ann import nearest
from bazaar.llm.packing import cut_documents, pack
from bazaar.llm.secrets import Forest, findings, judge, labelled_by_rule, train
from bazaar.llm.simhash import near_duplicates
from bazaar.llm.source_audit import LEAST_DOCS, PRIOR, TOP_TERMS, UNIT, divergence
from bazaar.llm.toxicity import Model, fit, score
from bazaar.llm.url_filter import judge_urls
from bazaar.llm.vectors import usable
from bazaar.llm.virtual_slots import shard
from bazaar.llm.warc import round_trip

# host, path, action
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def severity_grades(labels: DataFrame) -> DataFrame:
    """0: not toxic, 1: toxic, 2: toxic and of low quality."""
    return labels.select("doc_id", (F.col("toxic") * (F.lit(2) - F.coalesce("quality", F.lit(1)))).alias("grade"))


def toxicity_model(spark: SparkSession, sf_dir: str) -> Model:
    return fit(table(spark, sf_dir, "documents"), severity_grades(table(spark, sf_dir, "labels")))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir))


def sample_edits() -> Column:
    """Edits of a document taken from its own row: its source written over a
    fifth of the way in, a deletion in the middle, its language put in further
    on, and a last line."""
    n = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    source, lang = F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit(""))
    edits = [(F.floor(n / 5), F.length(source), source), (F.floor(n / 2), F.lit(7), F.lit("")),
             (F.floor(n * 4 / 5), F.lit(0), F.concat(F.lit(" "), lang, F.lit(" "))),
             (n + 10, F.lit(0), F.concat(F.lit("\n"), source))]
    return F.array(*[F.struct(s.cast("long").alias("start"), k.cast("long").alias("length"), t.alias("insert"))
                     for s, k, t in edits]).cast(f"array<{EDIT}>")


def op6_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_counts(table(spark, sf_dir, "documents"), sample_edits(), RANKS, public_tokenizers.PATTERN, state=False)


RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


LEAST_REVISIT_BYTES = 0


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = round_trip(table(spark, sf_dir, "pages"), LEAST_REVISIT_BYTES, payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# five hex digits of the SHA-1 are four base-32 digits
_WARC_SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
         sha1(coalesce(html, '')) AS hex
  FROM pages),
d AS (
  SELECT *, array_to_string(list_transform(range(32), lambda i:
           substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                  1 + ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31), 1)), '')
           AS payload_digest,
         max(page_id) OVER (PARTITION BY hex, payload_bytes) AS last
  FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {LEAST_REVISIT_BYTES} AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {LEAST_REVISIT_BYTES} AND page_id <> last THEN last END AS refers_to
FROM d
"""

SHINGLE_WORDS, MAX_BITS = 4, 4


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), SHINGLE_WORDS, MAX_BITS)
    return found.select("doc_id", "fingerprint", "component_id")


TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
MAX_TOKENS = 2048


def pack_documents(docs: DataFrame) -> DataFrame:
    pieces = cut_documents(docs, TOKENIZER, public_tokenizers.PATTERN, MAX_TOKENS)
    keys = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return pack(keys, MAX_TOKENS)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op7_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_texts(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN, decode=True)
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def secret_forest(docs: DataFrame) -> Forest:
    return train(labelled_by_rule(stored(findings(docs), "findings")))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = stored(findings(table(spark, sf_dir, "documents")), "findings")
    return judge(found, train(labelled_by_rule(found))).drop("value")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


NEIGHBOURS, QUERY_STEP = 5, 50


def op1_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = usable(table(spark, sf_dir, "embeddings"), nonzero=True)
    return nearest(vectors, vectors.where(F.col("id") % QUERY_STEP == 0), fit_router(vectors, NEIGHBOURS), NEIGHBOURS)


def op10_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integers(usable(table(spark, sf_dir, "embeddings")))
    return top_k(vectors, vectors.where(F.col("id") % QUERY_STEP == 0), NEIGHBOURS)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = restore(transform(table(spark, sf_dir, "documents")))
    return coded.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                        F.sha2("restored", 256).alias("restored_sha256"))


_MIDDLE_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS hex,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u
  FROM documents),
h AS (
  SELECT doc_id, text, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || hex[1:8] AS BIGINT) AS h1, CAST('0x' || hex[9:16] AS BIGINT) AS h2,
         CAST('0x' || hex[17:24] AS BIGINT) AS h3, CAST('0x' || hex[25:32] AS BIGINT) AS h4
  FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
s AS (
  SELECT doc_id, n, form, text, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(u[b + 1:n], ''), '') AS s
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM s
"""

def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(table(spark, sf_dir, "documents"))


_AUDIT_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
t AS (SELECT n, lang, source, unnest(terms) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS all_n FROM t GROUP BY lang, term HAVING count(DISTINCT n) >= {least}),
v AS (SELECT lang, count(*) AS terms, sum(all_n) AS total FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (
  SELECT g.lang, g.source, kept.term, any_value(all_n) AS all_n, count(t.n) AS n
  FROM g JOIN kept USING (lang) LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.term = kept.term
  GROUP BY g.lang, g.source, kept.term),
p AS (
  SELECT lang, source, term, n,
         CAST(1 + ({unit}::HUGEINT * (n + {prior})) // (sum(n) OVER (PARTITION BY lang, source) + {prior} * v.terms) AS BIGINT) AS p,
         CAST(1 + ({unit}::HUGEINT * (all_n + {prior})) // (v.total + {prior} * v.terms) AS BIGINT) AS q
  FROM c JOIN v USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT y.lang, y.source, z.source AS item, CAST(sum(abs(y.p - z.p)) AS BIGINT) AS value
             FROM p y JOIN p z ON y.lang = z.lang AND y.term = z.term AND y.source <> z.source
             GROUP BY y.lang, y.source, z.source) x
  ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
both_parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank
FROM both_parts
QUALIFY part = 'pair' OR rank <= {top}
""".replace("{least}", str(LEAST_DOCS)).replace("{unit}", str(UNIT)).replace("{prior}", str(PRIOR)).replace("{top}", str(TOP_TERMS))


SHARDS = 8


def op13_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = shard(table(spark, sf_dir, "documents"), SHARDS)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("place").alias("slot"),
                        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


_IMPACT_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % {QUERY_STEP} = 0 AND q.vec_id <> c.vec_id),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {NEIGHBOURS}
"""

_URL_SQL = r"""
WITH rules(rh, rp, action) AS (VALUES {rules}),
u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
p AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM u),
k AS (SELECT DISTINCT host, path FROM p),
fit AS (
  SELECT host, path, rh || rp AS rule, action,
         row_number() OVER (PARTITION BY host, path ORDER BY length(rh || rp) DESC, length(rh) DESC) AS rn
  FROM k JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT p.page_id, p.host, p.path, fit.rule, coalesce(fit.action, 'allow') AS verdict
FROM p LEFT JOIN fit ON p.host = fit.host AND p.path = fit.path AND fit.rn = 1
"""

QUERIES = {
    "op2_warc": op2_warc,
    "op1_learned_partitions": op1_learned_partitions,
    "op10_impact_search": op10_impact_search,
    "op6_edit_counts": op6_edit_counts,
    "op8_secret_scan": op8_secret_scan,
    "op5_toxicity": op5_toxicity,
    "op3_simhash": op3_simhash,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op7_bpe_transducer": op7_bpe_transducer,
    "op9_url_filter": op9_url_filter,
    "op11_fill_middle": op11_fill_middle,
    "op12_source_audit": op12_source_audit,
    "op13_virtual_slots": op13_virtual_slots,
}

ORACLE_SQL = {
    "op2_warc": _WARC_SQL,
    "op10_impact_search": _IMPACT_SQL,
    "op11_fill_middle": _MIDDLE_SQL,
    "op12_source_audit": _AUDIT_SQL,
    "op9_url_filter": _URL_SQL.format(rules=", ".join(f"('{h}', '{p}', '{a}')" for h, p, a in URL_RULES)),
}
