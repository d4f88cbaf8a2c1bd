"""Registered queries of the training-data operators: thin digests over the operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.llm.common import table, vocabulary

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        return fn
    return deco


@query("op1_sentencepiece")
def op1(spark: SparkSession, d: str) -> DataFrame:
    from murmur.llm.pieces import encode_and_decode
    coded = encode_and_decode(table(spark, d, "documents"), vocabulary("piece_bpe_32k.model"))
    return coded.select("doc_id", "ids", F.size("ids").alias("n_ids"), "round_trip")


@query("op2_exact_top_k")
def op2(spark: SparkSession, d: str) -> DataFrame:
    from murmur.llm.topk import top_k
    return top_k(table(spark, d, "embeddings"), every=100, k=10)


@query("op3_toxicity")
def op3(spark: SparkSession, d: str) -> DataFrame:
    from murmur.llm.toxicity import toxicity
    return toxicity(table(spark, d, "documents"), table(spark, d, "labels"))


@query("op4_substring_dedup")
def op4(spark: SparkSession, d: str) -> DataFrame:
    from murmur.llm import passages
    return passages.digest(passages.repeated_passages(table(spark, d, "documents")))


#: (host and path, verdict); the longest fitting rule wins.
URL_RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
             ("com/fr/", "allow"), ("com/de/", "block"))


@query("op5_url_filter")
def op5(spark: SparkSession, d: str) -> DataFrame:
    from murmur.llm.urls import judge
    return judge(table(spark, d, "pages"), URL_RULES)


@query("op6_embedding_near_dedup")
def op6(spark: SparkSession, d: str) -> DataFrame:
    from murmur.llm.neardup import near_duplicates
    return near_duplicates(table(spark, d, "embeddings"), threshold=0.98)


@query("op7_lm_scoring")
def op7(spark: SparkSession, d: str) -> DataFrame:
    from murmur.llm.lm import lm_scores
    return lm_scores(table(spark, d, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op8_secret_scan")
def op8(spark: SparkSession, d: str) -> DataFrame:
    from murmur.llm import secrets
    return secrets.digest(secrets.scan(table(spark, d, "documents"), vocabulary("byte_bpe_50k.tiktoken")))


@query("op9_best_fit_packing")
def op9(spark: SparkSession, d: str) -> DataFrame:
    from murmur.llm.packing import pack
    return pack(table(spark, d, "documents"), vocabulary("word_bpe_49k.json"), size=2048)


@query("op10_simhash_near_dedup")
def op10(spark: SparkSession, d: str) -> DataFrame:
    from murmur.llm.simhash import simhash_groups
    return simhash_groups(table(spark, d, "documents"), shingle=3, max_bits=3)


ORACLES["op2_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS HUGEINT) FOR x IN embedding] AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

ORACLES["op6_embedding_near_dedup"] = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0),
links AS (
  SELECT a.r, a.vec_id AS u, b.vec_id AS v
  FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT DISTINCT vec_id AS u, vec_id AS c FROM v
  UNION
  SELECT l.v, reach.c FROM reach JOIN links l ON l.u = reach.u),
least AS (SELECT u, min(c) AS c FROM reach GROUP BY u),
n AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(least.c, e.vec_id) AS component_id, coalesce(least.c = e.vec_id, true) AS kept
FROM embeddings e LEFT JOIN n ON n.u = e.vec_id LEFT JOIN least ON least.u = e.vec_id
"""


@query("pipeline")
def pipeline(spark: SparkSession, d: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, d)


#: Rows whose text is lower-cased (A-Z only) between manifest and verification: one in three.
def _today(doc_id, text):
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.crc32(doc_id.cast("string")) % 3 == 0, lower).otherwise(text)


@query("op12_merkle_manifest")
def op12(spark: SparkSession, d: str) -> DataFrame:
    from murmur.llm.manifest import manifest
    docs = table(spark, d, "documents")
    return manifest(docs, now={"text": _today(F.col("doc_id"), F.col("text"))})


# crc32 of the decimal doc_id: a table of one step per byte, eight shifts each
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], [ascii(ch)::BIGINT FOR ch IN string_split(CAST(doc_id AS VARCHAR), '')]),
  lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))))"""
_FIELD = "coalesce(CAST(octet_length(encode(CAST({0} AS VARCHAR))) AS VARCHAR) || ':' || CAST({0} AS VARCHAR), '-')"
_ROW = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || " + _FIELD

ORACLES["op12_merkle_manifest"] = f"""
WITH RECURSIVE rows AS (
  SELECT doc_id, lang, sha256({_ROW.format("text")}) AS leaf,
         CASE WHEN {_CRC} % 3 = 0 THEN sha256({_ROW.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS tampered
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM rows),
nodes AS (
  SELECT lang, 0 AS lvl, pos, leaf AS h, count(*) OVER (PARTITION BY lang) AS n FROM leaves
  UNION ALL
  SELECT lang, any_value(lvl) + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 7) // 8
  FROM nodes WHERE n > 1 GROUP BY lang, pos // 8),
sub AS (
  SELECT lang, h AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, pos, subroot AS h, count(*) OVER () AS n FROM sub
  UNION ALL
  SELECT any_value(lvl) + 1, pos // 8, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + 7) // 8
  FROM tops WHERE n > 1 GROUP BY pos // 8),
root AS (SELECT h AS root FROM tops WHERE n = 1),
-- siblings of every node: what stands left and right of it in its run
kin AS (
  SELECT lang, lvl, pos, n, coalesce(string_agg(h, '') OVER (PARTITION BY lang, lvl, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (PARTITION BY lang, lvl, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM nodes),
top_kin AS (
  SELECT lvl, pos, n, coalesce(string_agg(h, '') OVER (PARTITION BY lvl, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (PARTITION BY lvl, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM tops),
climb AS (
  SELECT e.lang, e.pos AS leaf_pos, e.pos, 0 AS lvl, coalesce(e.tampered, e.leaf) AS h, '' AS proof, false AS done FROM leaves e
  UNION ALL
  SELECT c.lang, c.leaf_pos, c.pos // 8, c.lvl + 1, CASE WHEN k.n > 1 THEN sha256(k.l || c.h || k.r) ELSE c.h END,
         CASE WHEN k.n > 1 THEN c.proof || k.l || k.r ELSE c.proof END, k.n = 1
  FROM climb c JOIN kin k ON k.lang IS NOT DISTINCT FROM c.lang AND k.lvl = c.lvl AND k.pos = c.pos WHERE NOT c.done),
over AS (
  SELECT c.lang, c.leaf_pos, s.pos, 0 AS lvl, c.h, c.proof, false AS done
  FROM climb c JOIN sub s ON s.lang IS NOT DISTINCT FROM c.lang WHERE c.done
  UNION ALL
  SELECT c.lang, c.leaf_pos, c.pos // 8, c.lvl + 1, CASE WHEN k.n > 1 THEN sha256(k.l || c.h || k.r) ELSE c.h END,
         CASE WHEN k.n > 1 THEN c.proof || k.l || k.r ELSE c.proof END, k.n = 1
  FROM over c JOIN top_kin k ON k.lvl = c.lvl AND k.pos = c.pos WHERE NOT c.done)
SELECT e.doc_id, e.leaf, s.subroot, t.root, sha256(o.proof) AS proof_sha256, o.h AS folded_root, o.h = t.root AS verified
FROM leaves e JOIN over o ON o.lang IS NOT DISTINCT FROM e.lang AND o.leaf_pos = e.pos AND o.done
JOIN sub s ON s.lang IS NOT DISTINCT FROM e.lang CROSS JOIN root t
"""


@query("op13_lexical_search")
def op13(spark: SparkSession, d: str) -> DataFrame:
    from murmur.llm.balltree import rank
    return rank(table(spark, d, "documents"), table(spark, d, "benchmark"), k=10)


_TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLES["op13_lexical_search"] = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
n AS (
  SELECT r, doc_id, CAST(len(terms) AS BIGINT) AS n FROM d WHERE len(terms) > 0),
s AS (
  SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS words FROM n),
t AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
w AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM t, s GROUP BY term),
q AS (
  SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
x AS (
  SELECT q.item_id, n.r, n.doc_id, sum(w.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (10 + (90 * n.n * s.docs) // s.words)))) AS score
  FROM q JOIN w USING (term) JOIN t USING (term) JOIN n ON n.r = t.r CROSS JOIN s GROUP BY ALL),
k AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id,
         CAST(score AS BIGINT) AS score
  FROM x WHERE score > 0)
SELECT * FROM k WHERE rank <= 10
"""


@query("op11_quality_rules")
def op11(spark: SparkSession, d: str) -> DataFrame:
    from murmur.llm.rules import quality
    return quality(table(spark, d, "documents"), table(spark, d, "labels"))
