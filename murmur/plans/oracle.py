"""Independent DuckDB SQL for every query key (the correctness oracle).

Each oracle is one SQL string over the driver's pre-registered views
(conversations, orders, events, documents, pages, ...).  The fixture adapters
are repeated here as CTEs with the same formulas as ``murmur.sources.fixtures``;
the query part is written straight from the documented semantics, not
generated from the Spark plans.
"""

from __future__ import annotations

import re

from murmur.functions.ontology import ASPECTS, SENTIMENTS, TOPICS, sql_list
from murmur.operators.langid import ALPHA, MIN_CHARS, SIZES


def _lst(values) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + v + "'" for v in values) + "]"


def clean_sql(x: str) -> str:
    """Curation clean-up for text without HTML entities or non-ASCII spaces."""
    return (f"lower(replace(replace(trim(regexp_replace(regexp_replace(coalesce({x}, ''), "
            f"'https?://\\S+', ' ', 'g'), '\\s+', ' ', 'g')), 'İ', 'i'), 'I', 'ı'))")


V = "CAST(conv_id % 20 AS VARCHAR)"
CH = "CAST(conv_id % 20 % 7 AS VARCHAR)"

CTES: dict[str, str] = {}

CTES["raw_comments"] = f"""
SELECT 'ch' || {CH} AS channel_id,
       CASE WHEN conv_id % 20 < 15 THEN 'Chan ' || {CH} END AS channel_title,
       'v' || {V} AS video_id,
       CASE WHEN conv_id % 20 < 10 THEN 'Vid ' || {V} END AS video_title,
       CAST(NULL AS TIMESTAMP) AS video_published_at,
       'c' || CAST(conv_id AS VARCHAR) || '.' || CAST(turn AS VARCHAR) AS comment_id,
       CASE WHEN turn > 0 THEN 'c' || CAST(conv_id AS VARCHAR) || '.0' END AS parent_id,
       turn = 0 AS is_top_level,
       CASE role WHEN 'assistant' THEN 'ch' || {CH}
                 WHEN 'user' THEN 'u' || CAST(conv_id % 13 AS VARCHAR) END AS author_channel_id,
       role AS author_display_name,
       text AS text_original,
       text AS text_display,
       CAST((conv_id * 7 + turn) % 50 AS BIGINT) AS like_count,
       TIMESTAMP '2024-01-01' + to_hours(conv_id) + to_minutes(turn) AS published_at,
       TIMESTAMP '2024-01-01' + to_hours(conv_id) + to_minutes(turn) AS updated_at,
       TIMESTAMP '2024-01-01' + to_hours(conv_id) + to_minutes(turn) AS ingested_at
FROM conversations"""

CTES["video_stats"] = """
SELECT 'v' || CAST(o_custkey % 22 AS VARCHAR) AS video_id,
       CASE WHEN o_orderkey % 10 = 0 THEN 'chX' ELSE 'ch' || CAST(o_custkey % 22 % 7 AS VARCHAR) END AS channel_id,
       CASE WHEN o_orderstatus <> 'F' THEN 'Stat ' || CAST(o_custkey % 22 AS VARCHAR) END AS video_title,
       CASE WHEN o_orderstatus <> 'F' THEN 'SChan ' || CAST(o_custkey % 22 % 7 AS VARCHAR) END AS channel_title,
       CAST(floor(o_totalprice) AS BIGINT) AS view_count,
       CAST(floor(o_totalprice / 10) AS BIGINT) AS like_count,
       CAST(o_orderkey % 500 AS BIGINT) AS comment_count,
       CASE WHEN o_orderkey % 4 <> 0 THEN o_orderdate - INTERVAL 7 DAY END AS published_at,
       o_orderdate AS fetched_at
FROM orders
WHERE o_custkey % 22 <> 19"""

CTES["events_k"] = """
SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"""

CTES["insights"] = f"""
SELECT 'c' || CAST(user_id AS VARCHAR) || '.' || CAST(event_id % 4 AS VARCHAR) AS comment_id,
       'v' || CAST(user_id % 20 AS VARCHAR) AS video_id,
       'ch' || CAST(user_id % 20 % 7 AS VARCHAR) AS channel_id,
       'm' || CAST(event_id % 3 AS VARCHAR) AS model_name,
       {_lst(SENTIMENTS + [None])}[event_id % 5 + 1] AS general_sentiment,
       {_lst(TOPICS + [None])}[k % 11 + 1] AS topic,
       CASE WHEN event_id % 17 = 0 THEN NULL
            ELSE list_transform(range(k % 4), lambda i: {{
                   'aspect': {_lst(ASPECTS)}[(event_id + i) % 19 + 1],
                   'sentiment': {_lst(SENTIMENTS)}[(k + i) % 4 + 1],
                   'evidence': 'e' || CAST(event_id AS VARCHAR) || '.' || CAST(i AS VARCHAR)}})
       END AS aspects,
       (event_type = 'purchase' AND event_id % 3 <> 0) AS purchase_intent,
       (event_type = 'click' OR event_id % 7 = 0) AS is_question,
       (event_type = 'error' OR event_id % 11 = 0) AS competitor_mention,
       ts AS inference_ts,
       'r' || CAST(event_id AS VARCHAR) AS inference_run_id
FROM events_k"""

CTES["curated"] = f"""
SELECT comment_id, video_id, channel_id, text_clean,
       parent_id IS NOT NULL AS is_reply, parent_id, author_channel_id, like_count,
       CAST(length(text_clean) AS BIGINT) AS comment_len_chars,
       CAST(CASE WHEN text_clean = '' THEN 0 ELSE len(string_split(text_clean, ' ')) END AS BIGINT)
         AS comment_len_tokens
FROM (SELECT *, {clean_sql('text_original')} AS text_clean FROM raw_comments WHERE like_count % 9 <> 0)"""
CTES["all_curated"] = CTES["curated"].replace(" WHERE like_count % 9 <> 0", "")

CTES["long_comments"] = """
SELECT 'ch' || source AS channel_id, source AS video_id,
       'd' || CAST(doc_id AS VARCHAR) AS comment_id,
       CAST(NULL AS VARCHAR) AS parent_id, CAST(NULL AS VARCHAR) AS author_channel_id,
       text AS text_original, CAST(doc_id % 50 AS BIGINT) AS like_count, lang
FROM documents"""

def _code_points(p: str) -> str:
    return f"regexp_extract_all({p}, '(?s).', 0)"


def _grams_sql(c: str) -> str:
    """Character 1-3-grams from a code-point list column (linear; substring-by-position is not)."""
    def of_size(k: int) -> str:
        gram = " || ".join(f"{c}[i + {j}]" for j in range(k))
        return f"list_transform(range(1, len({c}) - {k - 2}), lambda i: {gram})"
    return "list_concat(" + ", ".join(of_size(k) for k in SIZES) + ")"


def crc32_sql(text: str) -> str:
    """crc32 of ASCII text: one table-less step of eight shifts per byte."""
    step = "lambda x, z: xor(x >> 1, 3988292384 * (x & 1))"
    return (f"xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], [ascii(ch)::BIGINT FOR ch IN string_split({text}, '')]), "
            f"lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), {step})))")


HELD_OUT = f"{crc32_sql('CAST(doc_id AS VARCHAR)')} % 5 = 0"

# language-id model: floor(1000 * ln p) of character 1-3-grams per language, add-a-half smoothing
CTES["lang_counts"] = f"""
SELECT lang, gram, length(gram) AS size, count(*) AS n
FROM (SELECT lang, unnest({_grams_sql('c')}) AS gram
      FROM (SELECT lang, {_code_points("' ' || " + clean_sql('text') + " || ' '")} AS c
            FROM documents WHERE lang IS NOT NULL AND NOT {HELD_OUT}))
GROUP BY lang, gram"""
CTES["lang_model"] = f"""
SELECT t.lang, g.gram, CAST(floor(1000 * ln((coalesce(c.n, 0) + {ALPHA}) / (t.total + {ALPHA} * v.seen))) AS BIGINT) AS weight
FROM (SELECT DISTINCT gram, size FROM lang_counts) g
JOIN (SELECT size, count(DISTINCT gram) AS seen FROM lang_counts GROUP BY size) v ON g.size = v.size
JOIN (SELECT lang, size, sum(n)::DOUBLE AS total FROM lang_counts GROUP BY lang, size) t ON g.size = t.size
LEFT JOIN lang_counts c ON c.lang = t.lang AND c.gram = g.gram"""


def lang_predict_cte(source: str, key: str, text: str) -> str:
    """(key, language) for every row of ``source``; same rules as langid.predict."""
    return f"""
SELECT s.{key} AS key, CASE WHEN length(s.{text}) < {MIN_CHARS} OR b.lang IS NULL THEN 'unknown'
                            ELSE b.lang END AS language
FROM {source} s LEFT JOIN (
  SELECT key, lang FROM (
    SELECT key, lang, row_number() OVER (PARTITION BY key ORDER BY score DESC, lang ASC) AS rn
    FROM (SELECT g.key, m.lang, sum(g.n * m.weight) AS score
          FROM (SELECT key, gram, count(*) AS n
                FROM (SELECT key, unnest({_grams_sql('c')}) AS gram
                      FROM (SELECT {key} AS key, {_code_points("' ' || " + text + " || ' '")} AS c FROM {source}))
                GROUP BY key, gram) g
          JOIN lang_model m ON g.gram = m.gram
          GROUP BY ALL))
  WHERE rn = 1) b ON s.{key} = b.key"""


CTES["latest_run"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY video_id, comment_id
                               ORDER BY inference_ts DESC NULLS LAST, inference_run_id DESC NULLS LAST, model_name DESC NULLS LAST) AS rn
  FROM insights) WHERE rn = 1"""

CTES["raw_titles"] = """
SELECT video_id, channel_id, video_title, channel_title FROM (
  SELECT *, row_number() OVER (PARTITION BY video_id, channel_id
                               ORDER BY ingested_at DESC NULLS LAST, comment_id DESC NULLS LAST,
                               video_title DESC NULLS LAST, channel_title DESC NULLS LAST) AS rn
  FROM raw_comments) WHERE rn = 1"""

CTES["stats_latest"] = """
SELECT video_id, channel_id, video_title, channel_title, view_count, like_count, comment_count,
       published_at AS video_published_at FROM (
  SELECT *, row_number() OVER (PARTITION BY video_id
                               ORDER BY fetched_at DESC NULLS LAST, view_count DESC NULLS LAST, comment_count DESC NULLS LAST,
                               like_count DESC NULLS LAST, published_at DESC NULLS LAST, channel_id DESC NULLS LAST,
                               video_title DESC NULLS LAST, channel_title DESC NULLS LAST) AS rn
  FROM video_stats) WHERE rn = 1"""

CTES["report"] = f"""
SELECT l.comment_id, l.video_id, l.channel_id, l.model_name, l.general_sentiment, l.topic,
       l.purchase_intent, l.is_question, l.competitor_mention, l.inference_ts,
       c.text_clean, c.is_reply, c.author_channel_id, c.like_count AS comment_like_count,
       (c.author_channel_id IS NOT NULL AND c.author_channel_id = c.channel_id) AS is_creator_reply,
       CASE WHEN c.author_channel_id IS NOT NULL AND c.author_channel_id = c.channel_id THEN 'Creator reply'
            WHEN c.is_reply THEN 'Reply' ELSE 'Top-level' END AS comment_type,
       CASE WHEN l.purchase_intent THEN 'Pre-Purchase Intent'
            WHEN l.competitor_mention THEN 'Comparison'
            WHEN l.is_question THEN 'Information Seeking'
            WHEN l.general_sentiment = 'negative' AND l.topic IN ({sql_list(TOPICS[:8])}) THEN 'Complaint'
            WHEN l.topic IN ('product_review', 'performance_discussion', 'battery_discussion',
                             'camera_discussion', 'software_ui')
                 AND l.general_sentiment IN ('positive', 'negative') THEN 'Post-Purchase'
            WHEN l.topic = 'offtopic' OR l.topic IS NULL THEN 'Irrelevant'
            ELSE 'Other' END AS intent_category,
       COALESCE(s.video_title, r.video_title, l.video_id) AS video_title,
       COALESCE(s.channel_title, r.channel_title, l.channel_id) AS channel_title,
       s.view_count, s.like_count AS video_like_count, s.comment_count AS video_comment_count,
       s.video_published_at
FROM latest_run l
JOIN curated c ON l.comment_id = c.comment_id AND l.video_id = c.video_id AND l.channel_id = c.channel_id
LEFT JOIN raw_titles r ON l.video_id = r.video_id AND l.channel_id = r.channel_id
LEFT JOIN stats_latest s ON l.video_id = s.video_id AND l.channel_id = s.channel_id"""

_NAME_RE = re.compile(r"\b([a-z_][a-z0-9_]*)\b")


def _deps(body: str) -> list[str]:
    return [n for n in dict.fromkeys(_NAME_RE.findall(body)) if n in CTES]


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the adapter CTEs it needs, in dependency order."""
    order: list[str] = []

    def visit(name: str, stack: tuple = ()):
        if name in order or name in stack:
            return
        for d in _deps(CTES[name]):
            if d != name:
                visit(d, stack + (name,))
        order.append(name)

    for n in _deps(body):
        visit(n)
    if not order:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]}\n)" for n in order) + "\n" + body.strip()


ORACLES: dict[str, str] = {}


def register(key: str, body: str) -> None:
    ORACLES[key] = with_ctes(body)


register("comment_insights_report", "SELECT * FROM report")
register("raw_titles_latest", "SELECT * FROM raw_titles")
register("video_stats_latest", "SELECT * FROM stats_latest")


# -- aspect report, newest-model rows, dashboard aggregates --------------------

CTES["latest_aspect_run"] = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY video_id, comment_id
                               ORDER BY inference_ts DESC NULLS LAST, inference_run_id DESC NULLS LAST, model_name DESC NULLS LAST) AS rn
  FROM insights WHERE aspects IS NOT NULL AND len(aspects) > 0) WHERE rn = 1"""

CTES["aspect_report"] = """
SELECT l.comment_id, l.video_id, l.channel_id, l.model_name,
       l.general_sentiment AS comment_sentiment, l.topic AS comment_topic,
       l.a.aspect AS aspect, l.a.sentiment AS aspect_sentiment, l.a.evidence AS evidence,
       COALESCE(s.video_title, l.video_id) AS video_title,
       COALESCE(s.channel_title, l.channel_id) AS channel_title
FROM (SELECT *, unnest(aspects) AS a FROM latest_aspect_run) l
LEFT JOIN stats_latest s ON l.video_id = s.video_id AND l.channel_id = s.channel_id"""

CTES["newest_model"] = """
SELECT video_id, model_name FROM (
  SELECT video_id, model_name,
         row_number() OVER (PARTITION BY video_id ORDER BY mt DESC NULLS LAST, model_name ASC NULLS LAST) AS rn
  FROM (SELECT video_id, model_name, max(inference_ts) AS mt FROM insights GROUP BY video_id, model_name))
WHERE rn = 1"""

CTES["f5"] = """
SELECT p.video_id, p.comment_id, p.model_name, p.general_sentiment, p.topic, p.aspects,
       p.purchase_intent, p.is_question, p.competitor_mention,
       c.text_clean, c.is_reply, c.author_channel_id, c.channel_id
FROM insights p
JOIN newest_model m ON p.video_id = m.video_id AND p.model_name = m.model_name
JOIN curated c ON p.comment_id = c.comment_id"""

CTES["video_list"] = """
SELECT a.video_id, a.channel_id, a.n_comments,
       COALESCE(t.vt, a.video_id) AS video_title, COALESCE(t.ct, a.channel_id) AS channel_title,
       s.view_count, s.like_count, s.video_published_at AS published_at
FROM (SELECT video_id, channel_id, count(DISTINCT comment_id) AS n_comments
      FROM curated GROUP BY video_id, channel_id) a
LEFT JOIN (SELECT video_id, channel_id, max(video_title) AS vt, max(channel_title) AS ct
           FROM raw_comments GROUP BY video_id, channel_id) t
       ON a.video_id = t.video_id AND a.channel_id = t.channel_id
LEFT JOIN stats_latest s ON a.video_id = s.video_id AND a.channel_id = s.channel_id"""

register("aspect_sentiment_report", "SELECT * FROM aspect_report")

register("video_insights_latest_model", """
SELECT video_id, comment_id, model_name, general_sentiment, topic,
       CAST(len(aspects) AS INTEGER) AS n_aspects, purchase_intent, is_question, competitor_mention,
       text_clean, is_reply, author_channel_id, channel_id
FROM f5""")

register("video_list", "SELECT * FROM video_list")

register("sentiment_distribution", """
SELECT video_id, general_sentiment AS sentiment, count(*) AS "count"
FROM f5 WHERE general_sentiment IS NOT NULL GROUP BY ALL""")

register("topic_top10", """
SELECT * FROM (
  SELECT video_id, topic, "count",
         CAST(row_number() OVER (PARTITION BY video_id ORDER BY "count" DESC, topic ASC) AS INTEGER) AS rank
  FROM (SELECT video_id, topic, count(*) AS "count" FROM f5 WHERE topic IS NOT NULL GROUP BY ALL))
WHERE rank <= 10""")

register("aspect_sentiment_pivot", """
SELECT video_id, aspect,
       count(*) FILTER (WHERE sentiment = 'positive') AS positive,
       count(*) FILTER (WHERE sentiment = 'negative') AS negative,
       count(*) FILTER (WHERE sentiment = 'neutral') AS neutral,
       count(*) FILTER (WHERE sentiment = 'mixed') AS mixed
FROM (SELECT video_id, a.aspect AS aspect, a.sentiment AS sentiment
      FROM (SELECT video_id, unnest(aspects) AS a FROM f5))
WHERE aspect IS NOT NULL AND sentiment IS NOT NULL
GROUP BY video_id, aspect""")

register("comments_by_sentiment", """
SELECT video_id, general_sentiment AS sentiment, topic, text_clean AS comment_text, purchase_intent
FROM f5 WHERE general_sentiment = 'negative'""")

register("video_summary", """
SELECT a.video_id, v.channel_id, v.video_title, v.channel_title, a.n_analysed,
       CASE WHEN a.n_analysed > 0
            THEN CAST(round_even(CAST(100 AS DOUBLE) * a.n_positive / a.n_analysed, 0) AS BIGINT)
            ELSE 0 END AS positive_pct,
       COALESCE(format('{:,}', v.view_count), '—') AS views,
       COALESCE(format('{:,}', v.like_count), '—') AS likes,
       COALESCE(strftime(v.published_at, '%Y-%m-%d'), '—') AS published
FROM (SELECT video_id, count(*) AS n_analysed,
             count(*) FILTER (WHERE general_sentiment = 'positive') AS n_positive
      FROM f5 GROUP BY video_id) a
LEFT JOIN (SELECT * EXCLUDE (rn) FROM (
             SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY n_comments DESC, channel_id ASC) AS rn
             FROM video_list) WHERE rn = 1) v
       ON a.video_id = v.video_id""")

register("channel_engagement", """
SELECT video_id, channel_id, count(*) AS n_comments,
       count(*) FILTER (WHERE comment_type = 'Top-level') AS n_top_level,
       count(*) FILTER (WHERE comment_type = 'Reply') AS n_replies,
       count(*) FILTER (WHERE comment_type = 'Creator reply') AS n_creator_replies,
       count(*) FILTER (WHERE is_creator_reply) AS n_creator_authored
FROM report GROUP BY video_id, channel_id""")

register("signal_totals", """
SELECT video_id, count(*) AS n_comments,
       count(*) FILTER (WHERE purchase_intent) AS n_purchase_intent,
       count(*) FILTER (WHERE is_question) AS n_questions,
       count(*) FILTER (WHERE competitor_mention) AS n_competitor_mentions,
       count(*) FILTER (WHERE intent_category = 'Complaint') AS n_complaints
FROM report GROUP BY video_id""")

register("report_rollup", """
SELECT 'video_title' AS dimension, video_title AS value, count(*) AS record_count FROM report GROUP BY 2
UNION ALL SELECT 'topic', topic, count(*) FROM report GROUP BY 2
UNION ALL SELECT 'general_sentiment', general_sentiment, count(*) FROM report GROUP BY 2
UNION ALL SELECT 'comment_type', comment_type, count(*) FROM report GROUP BY 2
UNION ALL SELECT 'intent_category', intent_category, count(*) FROM report GROUP BY 2""")

register("label_coverage", """
SELECT COALESCE(t.video_id, a.video_id) AS video_id,
       COALESCE(t.n_comments, 0) AS n_comments, COALESCE(t.n_offtopic, 0) AS n_offtopic,
       COALESCE(t.n_topic_missing, 0) AS n_topic_missing,
       COALESCE(a.n_aspects, 0) AS n_aspects, COALESCE(a.n_other_aspects, 0) AS n_other_aspects
FROM (SELECT video_id, count(*) AS n_comments,
             count(*) FILTER (WHERE topic = 'offtopic') AS n_offtopic,
             count(*) FILTER (WHERE topic IS NULL) AS n_topic_missing
      FROM report GROUP BY video_id) t
FULL OUTER JOIN (SELECT video_id, count(*) AS n_aspects,
                        count(*) FILTER (WHERE aspect = 'other') AS n_other_aspects
                 FROM aspect_report GROUP BY video_id) a
  ON t.video_id = a.video_id""")


# -- curation, language id -----------------------------------------------------

def tokens_sql(t: str) -> str:
    return f"CAST(CASE WHEN {t} = '' THEN 0 ELSE len(string_split({t}, ' ')) END AS BIGINT)"


CTES["lc_clean"] = f"SELECT *, {clean_sql('text_original')} AS text_clean FROM long_comments"
CTES["lc_lang"] = lang_predict_cte("lc_clean", "comment_id", "text_clean")
CTES["doc_clean"] = f"SELECT doc_id, lang, {HELD_OUT} AS held_out, {clean_sql('text')} AS text_clean FROM documents"
CTES["doc_lang"] = lang_predict_cte("doc_clean", "doc_id", "text_clean")
CTES["pending_raw"] = """
SELECT r.* FROM raw_comments r ANTI JOIN curated c ON r.comment_id = c.comment_id"""
CTES["dedup_clean"] = f"""
SELECT *, {clean_sql('text_original')} AS text_clean FROM (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY comment_id ORDER BY ingested_at DESC NULLS LAST,
             updated_at DESC NULLS LAST, like_count DESC NULLS LAST, text_original DESC NULLS LAST) AS rn
    FROM raw_comments WHERE comment_id IS NOT NULL) WHERE rn = 1
  UNION ALL SELECT * FROM raw_comments WHERE comment_id IS NULL) n
ANTI JOIN curated c ON n.comment_id = c.comment_id"""
CTES["dedup_lang"] = lang_predict_cte("dedup_clean", "comment_id", "text_clean")


def _curated_out(src: str, lang: str) -> str:
    return f"""
SELECT s.comment_id, s.video_id, s.channel_id, s.text_clean, g.language,
       starts_with(g.language, 'tr') AS is_turkish, s.parent_id IS NOT NULL AS is_reply, s.parent_id,
       s.author_channel_id, s.like_count, CAST(length(s.text_clean) AS BIGINT) AS comment_len_chars,
       {tokens_sql('s.text_clean')} AS comment_len_tokens
FROM {src} s JOIN {lang} g ON s.comment_id = g.key"""


register("pending_curation", """
SELECT comment_id, video_id, channel_id, text_original, parent_id, author_channel_id, like_count, ingested_at
FROM pending_raw""")
register("curate_comments", _curated_out("lc_clean", "lc_lang"))
register("curate_dedup", _curated_out("dedup_clean", "dedup_lang"))
register("language_id", "SELECT d.doc_id, d.lang, d.held_out, g.language FROM doc_clean d JOIN doc_lang g ON d.doc_id = g.key")

register("pending_inference", """
SELECT c.comment_id, c.video_id, c.channel_id, c.text_clean FROM curated c
WHERE c.text_clean IS NOT NULL AND c.text_clean <> ''
  AND NOT EXISTS (SELECT 1 FROM insights p WHERE p.comment_id = c.comment_id AND p.model_name = 'm0')""")


# -- payload ingest ---------------------------------------------------------------

def lenient_sql(x: str) -> str:
    t = f"replace({x}, ',', '')"
    return (f"CASE WHEN regexp_full_match({t}, '\\s*[+-]?[0-9]+(_[0-9]+)*\\s*') "
            f"THEN CAST(replace({t}, '_', '') AS BIGINT) ELSE 0 END")


def _json_member(name: str, value: str) -> str:
    """'"name":value,' or nothing where the value is NULL."""
    return f"coalesce('\"{name}\":' || CAST(to_json({value}) AS VARCHAR) || ',', '')"


# the payload text of every comment and, for a thread's first one, of the whole thread
CTES["payloads"] = f"""
SELECT *, '{{"kind":"comment",' || {_json_member('id', 'comment_id')} || '"snippet":{{"authorChannelId":{{'
       || rtrim({_json_member('value', 'author_channel_id')}, ',') || '}},'
       || {_json_member('authorDisplayName', 'author_display_name')} || {_json_member('textOriginal', 'text_original')}
       || {_json_member('textDisplay', 'text_display')} || '"likeCount":' || CAST(like_count AS VARCHAR)
       || ',"publishedAt":"' || strftime(published_at, '%Y-%m-%dT%H:%M:%SZ')
       || '","updatedAt":"' || strftime(updated_at, '%Y-%m-%dT%H:%M:%SZ') || '"}}}}' AS comment_json
FROM raw_comments"""

register("thread_flatten", f"""
SELECT p.* EXCLUDE (ingested_at, comment_json), TIMESTAMP '2024-06-01 00:00:00' AS ingested_at,
       CASE WHEN p.is_top_level
            THEN '{{"etag":"e' || substring(p.comment_id, 2, length(p.comment_id) - 3) || '","snippet":{{'
                 || {_json_member('channelId', 'p.channel_id')} || {_json_member('channelTitle', 'p.channel_title')}
                 || {_json_member('videoId', 'p.video_id')} || {_json_member('videoTitle', 'p.video_title')}
                 || '"topLevelComment":' || p.comment_json || '}},"replies":{{"comments":['
                 || coalesce(r.replies, '') || ']}}}}'
            ELSE p.comment_json END AS raw_payload
FROM payloads p LEFT JOIN (
  SELECT parent_id, string_agg(comment_json, ',' ORDER BY published_at) AS replies
  FROM payloads WHERE NOT is_top_level GROUP BY parent_id) r ON p.is_top_level AND p.comment_id = r.parent_id""")

CTES["video_items"] = None  # filled below (needs the fixture's item template)

register("latest_videos_per_channel", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY published_at DESC NULLS LAST, video_id DESC) AS rn
  FROM (SELECT 'ch' || CAST(o_custkey % 7 AS VARCHAR) AS channel_id,
               CASE WHEN o_orderkey % 13 <> 0 THEN 'v' || CAST(o_orderkey AS VARCHAR) END AS video_id,
               o_orderdate AS published_at, 'Video ' || CAST(o_orderkey AS VARCHAR) AS video_title
        FROM orders)
  WHERE video_id IS NOT NULL AND video_id <> '')
WHERE rn <= 10""")


# -- JSON replies: the same Python semantics written for DuckDB's JSON functions ----

def jtype(j: str, f: str) -> str:
    return f"json_type({j}, '$.{f}')"


def jstr(j: str, f: str) -> str:
    """String value of field f, NULL for any other JSON type or a missing field."""
    return f"CASE WHEN {jtype(j, f)} = 'VARCHAR' THEN json_extract_string({j}, '$.{f}') END"


def jtruthy(j: str, f: str) -> str:
    t = jtype(j, f)
    return f"""(CASE WHEN {t} IS NULL OR {t} = 'NULL' THEN false
      WHEN {t} = 'BOOLEAN' THEN CAST(json_extract_string({j}, '$.{f}') AS BOOLEAN)
      WHEN {t} = 'VARCHAR' THEN json_extract_string({j}, '$.{f}') <> ''
      WHEN {t} = 'ARRAY' THEN json_array_length({j}, '$.{f}') > 0
      WHEN {t} = 'OBJECT' THEN len(json_keys({j}, '$.{f}')) > 0
      ELSE CAST(json_extract_string({j}, '$.{f}') AS DOUBLE) <> 0 END)"""


def jbool(j: str, f: str) -> str:
    return (f"(CASE WHEN {jtype(j, f)} = 'VARCHAR' THEN lower(trim(json_extract_string({j}, '$.{f}'))) "
            f"IN ('true', '1', 'yes', 'evet') ELSE {jtruthy(j, f)} END)")


def _norm(x: str, members: list, aliases: dict, default: str) -> str:
    v = f"lower(trim({x}))"
    arms = "".join(f" WHEN {v} = '{a}' THEN '{t}'" for a, t in aliases.items())
    return f"(CASE WHEN {v} IN ({sql_list(members)}) THEN {v}{arms} ELSE '{default}' END)"


def norm_topic(x: str) -> str:
    from murmur.functions.ontology import TOPIC_ALIASES
    return _norm(x, TOPICS, TOPIC_ALIASES, "offtopic")


def norm_aspect(x: str) -> str:
    from murmur.functions.ontology import ASPECT_ALIASES
    return _norm(x, ASPECTS, ASPECT_ALIASES, "other")


def norm_sentiment(x: str) -> str:
    return _norm(x, SENTIMENTS, {}, "neutral")


def _register_replies() -> None:
    from murmur.sources.fixtures import (ALIAS_WORDS, aspect_reply_sql, bad_reply_sql, bad_thread_sql, faulty_page_sql,
                                         tagging_reply_sql, video_item_sql)
    page = faulty_page_sql("VARCHAR")
    i = "CAST(conv_id AS VARCHAR)"
    register("thread_rejects", f"""
SELECT CASE conv_id % 17 WHEN 5 THEN 'thread' WHEN 7 THEN 'reply' ELSE 'page' END AS reason,
       CASE conv_id % 17 WHEN 5 THEN '{bad_thread_sql(i)}' WHEN 7 THEN '{bad_reply_sql(i)}' ELSE {page} END AS payload
FROM conversations WHERE turn = 0 AND conv_id % 17 IN (3, 5, 7, 9)""")
    CTES["video_items"] = f"SELECT {video_item_sql('duck')} AS item FROM orders"
    CTES["tag_base"] = f"""
SELECT 'c' || CAST(user_id AS VARCHAR) || '.' || CAST(event_id % 4 AS VARCHAR) AS comment_id,
       'v' || CAST(user_id % 20 AS VARCHAR) AS video_id,
       'ch' || CAST(user_id % 20 % 7 AS VARCHAR) AS channel_id,
       'm' || CAST(event_id % 3 AS VARCHAR) AS model_name,
       'r' || CAST(event_id AS VARCHAR) AS inference_run_id, ts AS inference_ts, event_id, k,
       {_lst(SENTIMENTS + [None])}[event_id % 5 + 1] AS sent,
       {_lst(TOPICS + [None])}[k % 11 + 1] AS topic,
       list_transform(range(k % 4), lambda i: {_lst(ASPECTS)}[(event_id + i) % 19 + 1]) AS names,
       (event_type = 'purchase' AND event_id % 3 <> 0) AS p,
       (event_type = 'click' OR event_id % 7 = 0) AS q,
       (event_type = 'error' OR event_id % 11 = 0) AS c
FROM events_k"""
    names_json = "'[' || array_to_string(list_transform(names, lambda x: '\"' || x || '\"'), ', ') || ']'"
    alias_json = ("'[' || array_to_string(list_transform(names, lambda x, i: '\"' || "
                  f"{_lst(ALIAS_WORDS)}[(event_id + i - 1) % {len(ALIAS_WORDS)} + 1] || '\"'), ', ') || ']'")
    CTES["tag_replies"] = f"""
SELECT comment_id, video_id, channel_id, model_name, inference_run_id, inference_ts, event_id, k,
       {tagging_reply_sql(names_json, alias_json, 'names[1]')} AS tagging_json
FROM tag_base"""
    CTES["tag_parsed"] = """
SELECT *, CASE WHEN json_valid(tagging_json) THEN tagging_json ELSE '{}' END AS j FROM tag_replies"""
    CTES["work_items"] = """
SELECT comment_id, video_id, channel_id, model_name, inference_run_id, event_id, k,
       unnest(range(len(d))) AS pos, unnest(d) AS aspect_name
FROM (SELECT *, list_filter(nb, lambda x, i: list_position(nb, x) = i) AS d
      FROM (SELECT *, list_filter(list_transform(list_filter(arr, lambda x: json_type(x) = 'VARCHAR'),
                                                 lambda x: trim(json_extract_string(x, '$'))),
                                  lambda x: x <> '') AS nb
            FROM (SELECT *, CASE WHEN json_type(j, '$.aspect_names') = 'ARRAY'
                                 THEN json_extract(j, '$.aspect_names[*]') ELSE CAST([] AS JSON[]) END AS arr
                  FROM tag_parsed)))"""
    CTES["asp_replies"] = f"""
SELECT inference_run_id, pos, aspect_name,
       {aspect_reply_sql()} AS aspect_json
FROM (SELECT *, {_lst(SENTIMENTS)}[(k + pos) % 4 + 1] AS asent,
             'e' || CAST(event_id AS VARCHAR) || '.' || CAST(pos AS VARCHAR) AS ev
      FROM work_items)"""
    aj = "aj"
    ev = f"trim({jstr(aj, 'evidence')})"
    CTES["asp_norm"] = f"""
SELECT inference_run_id, pos, bad,
       {norm_aspect(f"CASE WHEN {jtruthy(aj, 'aspect')} THEN {jstr(aj, 'aspect')} ELSE aspect_name END")} AS aspect,
       {norm_sentiment(jstr(aj, 'sentiment'))} AS sentiment,
       CASE WHEN coalesce({ev}, '') = '' THEN '(alıntı yok)' ELSE {ev} END AS evidence
FROM (SELECT *, CASE WHEN json_valid(aspect_json) THEN aspect_json ELSE '{{}}' END AS aj,
             aspect_json IS NULL OR NOT json_valid(aspect_json) AS bad
      FROM asp_replies)"""
    CTES["asp_agg"] = """
SELECT inference_run_id,
       string_agg(aspect || '|' || sentiment || '|' || evidence, ';' ORDER BY pos) AS aspects_text,
       count(*) AS n_aspects, bool_or(bad) AS aspect_error
FROM asp_norm GROUP BY ALL"""

    register("aspect_work_items", """
SELECT comment_id, video_id, channel_id, model_name, inference_run_id, CAST(pos AS INTEGER) AS pos, aspect_name
FROM work_items""")

    register("prediction_rows", f"""
SELECT t.comment_id, t.video_id, t.channel_id, t.model_name, t.inference_ts, t.inference_run_id,
       {norm_sentiment(jstr('t.j', 'general_sentiment'))} AS general_sentiment,
       {norm_topic(jstr('t.j', 'topic'))} AS topic,
       COALESCE(a.aspects_text, '') AS aspects_text, COALESCE(a.n_aspects, 0) AS n_aspects,
       {jbool('t.j', 'purchase_intent')} AS purchase_intent,
       {jbool('t.j', 'is_question')} AS is_question,
       {jbool('t.j', 'competitor_mention')} AS competitor_mention,
       (NOT json_valid(t.tagging_json)) OR COALESCE(a.aspect_error, false) AS had_error
FROM tag_parsed t LEFT JOIN asp_agg a ON t.inference_run_id = a.inference_run_id""")

    labels_body = f"""
SELECT kind, raw_value, count(*) AS n FROM (
  SELECT 'sentiment' AS kind, trim_free AS raw_value FROM (SELECT {jstr('j', 'general_sentiment')} AS trim_free FROM tag_parsed)
  UNION ALL SELECT 'topic', {jstr('j', 'topic')} FROM tag_parsed
  UNION ALL SELECT 'aspect', {jstr('aj', 'aspect')}
            FROM (SELECT CASE WHEN json_valid(aspect_json) THEN aspect_json ELSE '{{}}' END AS aj FROM asp_replies)
  UNION ALL SELECT 'sentiment', {jstr('aj', 'sentiment')}
            FROM (SELECT CASE WHEN json_valid(aspect_json) THEN aspect_json ELSE '{{}}' END AS aj FROM asp_replies))
WHERE raw_value IS NOT NULL GROUP BY kind, raw_value"""
    register("normalize_labels", f"""
SELECT kind, raw_value,
       CASE kind WHEN 'topic' THEN {norm_topic('raw_value')} WHEN 'aspect' THEN {norm_aspect('raw_value')}
                 ELSE {norm_sentiment('raw_value')} END AS normalized, n
FROM ({labels_body})""")

    register("video_stats_parse", f"""
SELECT COALESCE(json_extract_string(item, '$.id'), '') AS video_id,
       COALESCE(json_extract_string(item, '$.snippet.channelId'), '') AS channel_id,
       COALESCE(json_extract_string(item, '$.snippet.title'), '') AS video_title,
       COALESCE(json_extract_string(item, '$.snippet.channelTitle'), '') AS channel_title,
       {lenient_sql("json_extract_string(item, '$.statistics.viewCount')")} AS view_count,
       {lenient_sql("json_extract_string(item, '$.statistics.likeCount')")} AS like_count,
       {lenient_sql("json_extract_string(item, '$.statistics.commentCount')")} AS comment_count,
       strptime(NULLIF(json_extract_string(item, '$.snippet.publishedAt'), ''), '%Y-%m-%dT%H:%M:%SZ')
         AS published_at,
       TIMESTAMP '2024-06-01 00:00:00' AS fetched_at
FROM video_items""")


_register_replies()


# -- lexicon labeller, evidence, request tables, n-grams ------------------------------

def _register_text_jobs() -> None:
    from murmur.operators import annotate as an
    lex = an.default_lexicon()
    tags = an.stem_tags()
    t = "text_clean"
    pattern = an.stem_pattern(list(tags))
    of_stem = "MAP {" + ", ".join(f"'{stem}': [" + ", ".join(f"'{x}'" for x in names) + "]" for stem, names in tags.items()) + "}"
    # one row per sentence: the stems in it, looked up
    CTES["lex_sentences"] = f"""
SELECT comment_id, video_id, n, sentence,
       list_concat(flatten([{of_stem}[regexp_replace(regexp_replace(x, ' +', ' ', 'g'), '/+', '/', 'g')]
                            FOR x IN regexp_extract_all(wide, '{pattern}', 1)]),
                   CASE WHEN regexp_matches(wide, '{an.COMPARED_PATTERN}') THEN ['comparison'] ELSE [] END) AS tags
FROM (SELECT *, regexp_replace(' ' || sentence || ' ', '({an.EDGE})', '\\1\\1', 'g') AS wide
      FROM (SELECT comment_id, video_id, unnest(range(1, len(s) + 1)) AS n, unnest(s) AS sentence
            FROM (SELECT comment_id, video_id,
                         list_filter(list_transform(regexp_split_to_array({t}, '[.!?\\n]+'), lambda s: trim(s)), lambda s: s <> '') AS s
                  FROM all_curated)))"""
    CTES["lex_found"] = "SELECT DISTINCT comment_id, video_id, unnest(tags) AS tag FROM lex_sentences"
    found = "list_filter([" + ", ".join(f"CASE WHEN list_contains(tags, '{a}') THEN '{a}' END" for a in lex) + "], lambda x: x IS NOT NULL)"
    topic = "CASE" + "".join(f" WHEN list_contains(found, '{a}') THEN '{tp}'" for a, tp in an.ASPECT_TOPIC) + \
        " WHEN len(found) > 0 THEN 'product_review' ELSE 'offtopic' END"
    CTES["lex_tags"] = f"""
SELECT comment_id, video_id, channel_id, {t},
       CASE WHEN list_contains(tags, '+') AND list_contains(tags, '-') THEN 'mixed' WHEN list_contains(tags, '+') THEN 'positive'
            WHEN list_contains(tags, '-') THEN 'negative' ELSE 'neutral' END AS general_sentiment,
       {topic} AS topic, found, list_contains(tags, 'buy') AS purchase_intent, contains({t}, '?') AS is_question,
       list_contains(found, 'comparison') AS competitor_mention
FROM (SELECT *, {found} AS found
      FROM (SELECT c.*, coalesce(g.tags, []) AS tags
            FROM all_curated c LEFT JOIN (SELECT comment_id, video_id, list(tag) AS tags FROM lex_found GROUP BY ALL) g
              ON c.comment_id = g.comment_id AND c.video_id = g.video_id))"""
    register("lexicon_tags", """
SELECT comment_id, video_id, channel_id, text_clean, general_sentiment, topic,
       array_to_string(found, ',') AS aspect_names, purchase_intent, is_question, competitor_mention
FROM lex_tags""")

    register("aspect_evidence", f"""
SELECT f.comment_id, f.video_id, CAST(f.pos AS INTEGER) AS pos, f.aspect,
       array_to_string(string_split(arg_min(s.sentence, s.n), ' ')[1:{an.MAX_EVIDENCE_WORDS}], ' ') AS evidence
FROM (SELECT comment_id, video_id, unnest(range(0, len(found))) AS pos, unnest(found) AS aspect FROM lex_tags) f
JOIN lex_sentences s ON s.comment_id = f.comment_id AND s.video_id = f.video_id AND list_contains(s.tags, f.aspect)
GROUP BY f.comment_id, f.video_id, f.pos, f.aspect""")

    def q(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    CTES["pending_m0"] = """
SELECT c.comment_id, c.video_id, c.channel_id, c.text_clean FROM curated c
WHERE c.text_clean IS NOT NULL AND c.text_clean <> ''
  AND NOT EXISTS (SELECT 1 FROM insights p WHERE p.comment_id = c.comment_id AND p.model_name = 'm0')"""
    register("tagging_requests", f"""
SELECT comment_id, video_id, channel_id, CAST(0 AS INTEGER) AS turn, 'system' AS role,
       {q(an.TAGGING_SYSTEM)} AS content FROM pending_m0
UNION ALL
SELECT comment_id, video_id, channel_id, CAST(1 AS INTEGER), 'user', {q(an.JSON_USER)} || text_clean FROM pending_m0""")

    CTES["asp_req"] = """
SELECT w.comment_id, w.video_id, w.inference_run_id, CAST(w.pos AS INTEGER) AS pos, w.aspect_name, c.text_clean
FROM work_items w JOIN all_curated c ON w.comment_id = c.comment_id AND w.video_id = c.video_id"""
    register("aspect_requests", f"""
SELECT comment_id, video_id, inference_run_id, pos, aspect_name, CAST(0 AS INTEGER) AS turn, 'system' AS role,
       {q(an.ASPECT_SYSTEM)} AS content FROM asp_req
UNION ALL
SELECT comment_id, video_id, inference_run_id, pos, aspect_name, CAST(1 AS INTEGER), 'user',
       'Aspect: "' || aspect_name || '"' || chr(10) || chr(10) || 'Comment:' || chr(10) || text_clean FROM asp_req""")

    register("ngram_counts", """
SELECT video_id, n, gram, count(*) AS "count"
FROM (SELECT video_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram
      FROM (SELECT video_id, string_split(text_clean, ' ') AS w FROM lc_clean WHERE text_clean <> '') d,
           (VALUES (2), (3)) ns(n),
           unnest(range(1, len(w) - n + 2)) AS r(i))
GROUP BY ALL""")

    register("ngram_top20", """
SELECT * FROM (
  SELECT video_id, n, gram, "count",
         CAST(row_number() OVER (PARTITION BY video_id, n ORDER BY "count" DESC, gram ASC) AS INTEGER) AS rank
  FROM (SELECT video_id, n, gram, count(*) AS "count"
        FROM (SELECT video_id, n, array_to_string(w[i:i + n - 1], ' ') AS gram
              FROM (SELECT video_id, string_split(text_clean, ' ') AS w FROM lc_clean WHERE text_clean <> '') d,
                   (VALUES (2), (3)) ns(n),
                   unnest(range(1, len(w) - n + 2)) AS r(i))
        GROUP BY ALL))
WHERE rank <= 20""")


_register_text_jobs()
