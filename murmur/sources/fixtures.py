"""Adapters that shape the driver's Parquet tables into the pipeline's tables.

The driver tables (conversations, orders, events, documents, pages) are not
comment data; these functions derive deterministic stand-ins with the exact
schemas of ``murmur.schemas`` so every job runs on data that grows with the
scale factor.  The same formulas exist as DuckDB CTEs in
``murmur.plans.oracle`` and a test checks both sides agree row for row.

All adapters are narrow projections over one scan (no shuffle) except
``curated`` (which runs curation) and the JSON-payload adapters (one grouping).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur import schemas
from murmur.functions.ontology import ASPECTS, SENTIMENTS, TOPICS

EPOCH_2024 = 1704067200  # 2024-01-01T00:00:00Z


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``documents`` table; see ``_spread``."""
    return _spread(spark, _read(spark, sf_dir, "documents"))


def _spread(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A scan that would leave task slots idle (the driver's small tables are one row group, so one
    task) is dealt over the slots before heavy per-row work; a table of many files is read as it lies."""
    slots = spark.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def _s(c: Column) -> Column:
    return c.cast("string")


def _pick(values: list, idx0: Column) -> Column:
    """values[idx0] for a 0-based index column (None entries give NULL)."""
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (idx0 + 1).cast("int"))


def _conform(df: DataFrame, schema, *extra: str) -> DataFrame:
    """Columns of ``schema`` in order (missing ones NULL), then the ``extra`` columns."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*cols, *extra)


# -- raw.comments from conversations ------------------------------------------

def raw_comments(spark: SparkSession, sf_dir: str, keep_source_keys: bool = False) -> DataFrame:
    """raw.comments rows; ``keep_source_keys`` adds conv_id and turn (for payload rebuilding)."""
    c = _read(spark, sf_dir, "conversations")
    v = F.col("conv_id") % 20
    ch = v % 7
    ts = F.timestamp_seconds(F.lit(EPOCH_2024) + F.col("conv_id") * 3600 + F.col("turn") * 60)
    out = c.select(
        F.concat(F.lit("ch"), _s(ch)).alias("channel_id"),
        F.when(v < 15, F.concat(F.lit("Chan "), _s(ch))).alias("channel_title"),
        F.concat(F.lit("v"), _s(v)).alias("video_id"),
        F.when(v < 10, F.concat(F.lit("Vid "), _s(v))).alias("video_title"),
        F.concat(F.lit("c"), _s(F.col("conv_id")), F.lit("."), _s(F.col("turn"))).alias("comment_id"),
        F.when(F.col("turn") > 0, F.concat(F.lit("c"), _s(F.col("conv_id")), F.lit(".0"))).alias("parent_id"),
        (F.col("turn") == 0).alias("is_top_level"),
        F.when(F.col("role") == "assistant", F.concat(F.lit("ch"), _s(ch)))
         .when(F.col("role") == "user", F.concat(F.lit("u"), _s(F.col("conv_id") % 13)))
         .alias("author_channel_id"),
        F.col("role").alias("author_display_name"),
        F.col("text").alias("text_original"),
        F.col("text").alias("text_display"),
        ((F.col("conv_id") * 7 + F.col("turn")) % 50).alias("like_count"),
        ts.alias("published_at"), ts.alias("updated_at"), ts.alias("ingested_at"),
        "conv_id", "turn",
    )
    return _conform(out, schemas.RAW_COMMENTS, *(["conv_id", "turn"] if keep_source_keys else []))


# -- raw.video_stats from orders ----------------------------------------------

def video_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots of a video, one per order."""
    o = _read(spark, sf_dir, "orders").where(F.col("o_custkey") % 22 != 19)
    v = F.col("o_custkey") % 22
    fetched = F.col("o_orderdate").cast("timestamp")
    out = o.select(
        F.concat(F.lit("v"), _s(v)).alias("video_id"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit("chX"))
         .otherwise(F.concat(F.lit("ch"), _s(v % 7))).alias("channel_id"),
        F.when(F.col("o_orderstatus") != "F", F.concat(F.lit("Stat "), _s(v))).alias("video_title"),
        F.when(F.col("o_orderstatus") != "F", F.concat(F.lit("SChan "), _s(v % 7))).alias("channel_title"),
        F.floor(F.col("o_totalprice")).cast("bigint").alias("view_count"),
        F.floor(F.col("o_totalprice") / 10).cast("bigint").alias("like_count"),
        (F.col("o_orderkey") % 500).alias("comment_count"),
        F.when(F.col("o_orderkey") % 4 != 0, fetched - F.expr("INTERVAL 7 DAYS")).alias("published_at"),
        fetched.alias("fetched_at"),
    )
    return _conform(out, schemas.VIDEO_STATS)


# -- ml.comment_insights from events ------------------------------------------

def _event_k() -> Column:
    return F.get_json_object(F.col("props"), "$.k").cast("bigint")


def _aspect_names(k: Column) -> Column:
    """k % 4 aspect names: ASPECTS[(event_id + i) % 19] for i in 0 .. k%4-1."""
    names = F.array(*[F.lit(a) for a in ASPECTS])
    return F.transform(F.array_repeat(F.lit(0), (k % 4).cast("int")),
                       lambda _x, i: F.element_at(names, ((F.col("event_id") + i) % 19 + 1).cast("int")))


def insights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many runs per comment, each with a run id of its own."""
    e = _read(spark, sf_dir, "events")
    k = _event_k()
    v = F.col("user_id") % 20
    eid = F.col("event_id")
    sents = F.array(*[F.lit(s) for s in SENTIMENTS])
    aspects = F.when(eid % 17 == 0, F.lit(None)).otherwise(
        F.transform(F.array_repeat(F.lit(0), (k % 4).cast("int")), lambda _x, i: F.struct(
            F.element_at(F.array(*[F.lit(a) for a in ASPECTS]), ((eid + i) % 19 + 1).cast("int")).alias("aspect"),
            F.element_at(sents, ((k + i) % 4 + 1).cast("int")).alias("sentiment"),
            F.concat(F.lit("e"), _s(eid), F.lit("."), _s(i)).alias("evidence"))))
    out = e.select(
        F.concat(F.lit("c"), _s(F.col("user_id")), F.lit("."), _s(eid % 4)).alias("comment_id"),
        F.concat(F.lit("v"), _s(v)).alias("video_id"),
        F.concat(F.lit("ch"), _s(v % 7)).alias("channel_id"),
        F.concat(F.lit("m"), _s(eid % 3)).alias("model_name"),
        _pick(SENTIMENTS + [None], eid % 5).alias("general_sentiment"),
        _pick(TOPICS + [None], k % 11).alias("topic"),
        aspects.alias("aspects"),
        ((F.col("event_type") == "purchase") & (eid % 3 != 0)).alias("purchase_intent"),
        ((F.col("event_type") == "click") | (eid % 7 == 0)).alias("is_question"),
        ((F.col("event_type") == "error") | (eid % 11 == 0)).alias("competitor_mention"),
        F.col("ts").cast("timestamp").alias("inference_ts"),
        F.concat(F.lit("r"), _s(eid)).alias("inference_run_id"),
    )
    return _conform(out, schemas.COMMENT_INSIGHTS)


# -- core.comments_curated ----------------------------------------------------

def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with ``like_count % 9 <> 0`` passed through curation; the rest stay pending.
    No reader of this table uses ``language``, so it is left NULL."""
    from murmur.operators.curate import curate
    return curate(raw_comments(spark, sf_dir).where(F.col("like_count") % 9 != 0))


def all_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw row passed through curation: the table once nothing is pending."""
    from murmur.operators.curate import curate
    return curate(raw_comments(spark, sf_dir))


# -- long comments from documents ---------------------------------------------

def long_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-comment shaped rows over ``documents``; ``lang`` is the truth label."""
    d = documents(spark, sf_dir)
    out = d.select(
        F.concat(F.lit("ch"), F.col("source")).alias("channel_id"),
        F.col("source").alias("video_id"),
        F.concat(F.lit("d"), _s(F.col("doc_id"))).alias("comment_id"),
        F.lit(True).alias("is_top_level"),
        F.col("text").alias("text_original"),
        F.col("text").alias("text_display"),
        (F.col("doc_id") % 50).alias("like_count"),
        F.timestamp_seconds(F.lit(EPOCH_2024) + F.col("doc_id") * 60).alias("ingested_at"),
        F.col("lang"),
    )
    return _conform(out, schemas.RAW_COMMENTS, "lang")


HELD_OUT = 5      # one document in so many (by crc32 of its id) trains no language


def held_out(doc_id: Column) -> Column:
    return F.crc32(_s(doc_id)) % HELD_OUT == 0


def language_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(text, lang) examples for the language-id model: the documents that are not held out."""
    return documents(spark, sf_dir).where(~held_out(F.col("doc_id"))).select("text", "lang")


# -- JSON payloads and model replies ------------------------------------------
#
# The reply adapters carry deliberate dirt (case, blanks, aliases, string /
# number booleans, non-array lists, malformed JSON) keyed on the event id.  The
# CASE text below is plain SQL shared with the DuckDB oracle; only the
# array-to-JSON snippets differ by dialect and are passed in.

ALIAS_WORDS = ["wifi", "SES", "Garanti", "sd kart", "value", "microphone", "DEPOLAMA"]


def _js(x: str) -> str:
    return f"coalesce('\"' || {x} || '\"', 'null')"


def _jb(x: str) -> str:
    return f"CASE WHEN {x} THEN 'true' ELSE 'false' END"


def tagging_reply_sql(names_json: str, alias_json: str, first: str) -> str:
    """Tagging-reply JSON text from columns event_id, sent, topic, p, q, c."""
    clean_bools = (f"', \"purchase_intent\": ' || {_jb('p')} || ', \"is_question\": ' || {_jb('q')}"
                   f" || ', \"competitor_mention\": ' || {_jb('c')} || '}}'")
    return f"""CASE event_id % 13
  WHEN 0 THEN '{{"general_sentiment": ' || {_js('sent')} || ', "topic": ' || {_js('topic')}
              || ', "aspect_names": ' || {names_json} || {clean_bools}
  WHEN 1 THEN '{{"general_sentiment": ' || {_js("' ' || upper(sent) || ' '")} || ', "topic": ' || {_js('upper(topic)')}
              || ', "aspect_names": ' || {names_json} || {clean_bools}
  WHEN 2 THEN '{{"general_sentiment": ' || {_js('sent')} || ', "topic": "channel_quality", "aspect_names": '
              || {alias_json} || {clean_bools}
  WHEN 3 THEN '{{"general_sentiment": ' || {_js('sent')} || ', "topic": ' || {_js('topic')}
              || ', "aspect_names": ' || {names_json}
              || ', "purchase_intent": ' || CASE WHEN p THEN '"yes"' ELSE '"no"' END
              || ', "is_question": ' || CASE WHEN q THEN '"Evet "' ELSE '"hayır"' END
              || ', "competitor_mention": ' || CASE WHEN c THEN '"1"' ELSE '"2"' END || '}}'
  WHEN 4 THEN '{{"general_sentiment": ' || {_js('sent')} || ', "topic": ' || {_js('topic')}
              || ', "aspect_names": ' || {names_json}
              || ', "purchase_intent": ' || CASE WHEN p THEN '1' ELSE '0' END
              || ', "is_question": ' || CASE WHEN q THEN '2' ELSE '0' END
              || ', "competitor_mention": ' || CASE WHEN c THEN '0.5' ELSE '0.0' END || '}}'
  WHEN 5 THEN '{{"general_sentiment": "", "topic": "", "aspect_names": '
              || CASE WHEN {first} IS NULL THEN '[""]'
                      ELSE substring({names_json}, 1, length({names_json}) - 1) || ', "", " ' || {first} || ' "]' END
              || {clean_bools}
  WHEN 6 THEN '{{"general_sentiment": ' || {_js('sent')} || ', "topic": ' || {_js('topic')}
              || ', "aspect_names": "battery", "purchase_intent": null, "is_question": null, "competitor_mention": null}}'
  WHEN 7 THEN '{{"general_sentiment": ' || {_js('sent')}
  WHEN 8 THEN '{{}}'
  WHEN 9 THEN '{{"general_sentiment": "olumlu", "topic": "battery", "aspect_names": '
              || substring({names_json}, 1, length({names_json}) - 1)
              || CASE WHEN {first} IS NULL THEN '5, null]' ELSE ', 5, null]' END || {clean_bools}
  WHEN 10 THEN '{{"general_sentiment": ' || {_js('sent')} || ', "topic": ' || {_js('topic')}
              || ', "aspect_names": '
              || CASE WHEN {first} IS NULL THEN '[]'
                      ELSE '["' || {first} || '", "' || upper({first}) || '", ' || substring({names_json}, 2) END
              || ', "purchase_intent": [], "is_question": {{"x": 1}}, "competitor_mention": [0]}}'
  WHEN 11 THEN '{{"general_sentiment": ' || {_js('sent')} || ', "topic": " Comparison ", "aspect_names": '
              || {names_json} || '}}'
  ELSE '{{"general_sentiment": null, "topic": null, "aspect_names": null, "purchase_intent": null, '
       || '"is_question": null, "competitor_mention": null}}'
END"""


def aspect_reply_sql() -> str:
    """Aspect-reply JSON text from columns event_id, pos, aspect_name, asent, ev."""
    return f"""CASE (event_id + pos) % 7
  WHEN 0 THEN '{{"aspect": ' || {_js('aspect_name')} || ', "sentiment": ' || {_js('asent')}
              || ', "evidence": ' || {_js('ev')} || '}}'
  WHEN 1 THEN '{{"sentiment": ' || {_js('asent')} || ', "evidence": ' || {_js('ev')} || '}}'
  WHEN 2 THEN '{{"aspect": "", "sentiment": ' || {_js('upper(asent)')} || ', "evidence": ' || {_js('ev')} || '}}'
  WHEN 3 THEN '{{"aspect": ' || {_js('upper(aspect_name)')} || ', "sentiment": ' || {_js("' ' || asent || ' '")}
              || ', "evidence": "  "}}'
  WHEN 4 THEN '{{"aspect": 5, "sentiment": "olumlu", "evidence": ' || {_js("' ' || ev || ' '")} || '}}'
  WHEN 5 THEN '{{"aspect": ' || {_js('aspect_name')} || ', "sentiment": null}}'
  ELSE '{{"aspect": '
END"""


def _reply_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _spread(spark, _read(spark, sf_dir, "events"))
    k = _event_k()
    v = F.col("user_id") % 20
    eid = F.col("event_id")
    return e.select(
        F.concat(F.lit("c"), _s(F.col("user_id")), F.lit("."), _s(eid % 4)).alias("comment_id"),
        F.concat(F.lit("v"), _s(v)).alias("video_id"),
        F.concat(F.lit("ch"), _s(v % 7)).alias("channel_id"),
        F.concat(F.lit("m"), _s(eid % 3)).alias("model_name"),
        F.concat(F.lit("r"), _s(eid)).alias("inference_run_id"), F.col("ts").cast("timestamp").alias("inference_ts"),
        eid.alias("event_id"), k.alias("k"),
        _pick(SENTIMENTS + [None], eid % 5).alias("sent"),
        _pick(TOPICS + [None], k % 11).alias("topic"),
        _aspect_names(k).alias("names"),
        ((F.col("event_type") == "purchase") & (eid % 3 != 0)).alias("p"),
        ((F.col("event_type") == "click") | (eid % 7 == 0)).alias("q"),
        ((F.col("event_type") == "error") | (eid % 11 == 0)).alias("c"))


def tagging_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One tagging reply (JSON text, some of it dirty or malformed) per run."""
    alias = "array(" + ", ".join(f"'{w}'" for w in ALIAS_WORDS) + ")"
    sql = tagging_reply_sql(
        names_json="concat('[', array_join(transform(names, x -> concat('\"', x, '\"')), ', '), ']')",
        alias_json=("concat('[', array_join(transform(names, (x, i) -> concat('\"', "
                    f"element_at({alias}, cast((event_id + i) % {len(ALIAS_WORDS)} + 1 as int)), '\"')), ', '), ']')"),
        first="try_element_at(names, 1)")
    return _reply_base(spark, sf_dir).select(
        "comment_id", "video_id", "channel_id", "model_name", "inference_run_id", "inference_ts", "event_id", "k",
        F.expr(sql).alias("tagging_json"))


def aspect_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One aspect reply per work item derived from the tagging replies."""
    from murmur.operators.annotate import aspect_work_items
    j = aspect_work_items(tagging_replies(spark, sf_dir), keep=("k", "event_id"))
    j = j.withColumn("asent", F.element_at(F.array(*[F.lit(s) for s in SENTIMENTS]),
                                           ((F.col("k") + F.col("pos")) % 4 + 1).cast("int")))
    j = j.withColumn("ev", F.concat(F.lit("e"), _s(F.col("event_id")), F.lit("."), _s(F.col("pos"))))
    return j.select("inference_run_id", "pos", F.expr(aspect_reply_sql()).alias("aspect_json"))


def _iso(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def thread_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comment-thread API pages (JSON text) rebuilt from ``conversations``: one
    thread per conversation (turn 0 on top, later turns as replies), at most 10
    threads per page, with fields (kind, etag) that no schema of ours names.  Flattening them must give
    back ``raw_comments``."""
    raw = raw_comments(spark, sf_dir, keep_source_keys=True)
    comment = F.struct(
        F.lit("comment").alias("kind"),
        F.col("comment_id").alias("id"),
        F.struct(F.struct(F.col("author_channel_id").alias("value")).alias("authorChannelId"),
                 F.col("author_display_name").alias("authorDisplayName"),
                 F.col("text_original").alias("textOriginal"),
                 F.col("text_display").alias("textDisplay"),
                 F.col("like_count").alias("likeCount"),
                 _iso(F.col("published_at")).alias("publishedAt"),
                 _iso(F.col("updated_at")).alias("updatedAt")).alias("snippet"))
    per_conv = raw.select("conv_id", "turn", "channel_id", "channel_title", "video_id", "video_title",
                          comment.alias("comment"))
    threads = per_conv.groupBy("conv_id").agg(
        F.first("channel_id").alias("channelId"), F.first("channel_title").alias("channelTitle"),
        F.first("video_id").alias("videoId"), F.first("video_title").alias("videoTitle"),
        F.max_by("comment", F.when(F.col("turn") == 0, 1).otherwise(0)).alias("top"),
        F.array_sort(F.collect_list(F.when(F.col("turn") > 0, F.struct("turn", "comment")))).alias("r"))
    item = F.struct(
        F.concat(F.lit("e"), _s(F.col("conv_id"))).alias("etag"),
        F.struct("channelId", "channelTitle", "videoId", "videoTitle",
                 F.col("top").alias("topLevelComment")).alias("snippet"),
        F.struct(F.transform("r", lambda x: x.getField("comment")).alias("comments")).alias("replies"))
    pages = threads.groupBy((F.col("conv_id") % 20).alias("v"), (F.col("conv_id") / 200).cast("bigint").alias("pg")) \
        .agg(F.collect_list(item).alias("items"))
    return pages.select(F.to_json(F.struct("items")).alias("page_json"))


def faulty_thread_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``thread_pages`` and, for some conversations, a page that is cut off, one whose thread has no
    snippet, one with a reply without snippet, and one whose items are no list."""
    c = _read(spark, sf_dir, "conversations").where("turn = 0")
    return thread_pages(spark, sf_dir).union(c.select(F.expr(faulty_page_sql("string")).alias("page_json")).where("page_json is not null"))


def faulty_page_sql(text: str) -> str:
    """The faulty page of a conversation (``text``: the dialect's name of the string type)."""
    i = f"CAST(conv_id AS {text})"
    return f"""CASE conv_id % 17
  WHEN 3 THEN '{{"items":[{{"id":"' || {i} || '","snippet":{{"videoId":"v'
  WHEN 5 THEN '{{"items":[{bad_thread_sql(i)}],"nextPageToken":"n"}}'
  WHEN 7 THEN '{{"items":[{{"snippet":{{"topLevelComment":{{"snippet":{{}}}}}},"replies":{{"comments":[{bad_reply_sql(i)}]}}}}]}}'
  WHEN 9 THEN '{{"items":' || {i} || '}}' END"""


def bad_thread_sql(i: str) -> str:
    return f"""{{"id":"c' || {i} || '","replies":{{"comments":[]}}}}"""


def bad_reply_sql(i: str) -> str:
    return f"""{{"id":"c' || {i} || '.x","etag":"new"}}"""


def video_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Video-statistics API pages (JSON text, <= 50 items each) with counters as
    numbers, comma strings, padded strings, junk or missing."""
    return _read(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") / 50).cast("bigint").alias("pg"), F.expr(video_item_sql("spark")).alias("item")) \
        .groupBy("pg").agg(F.concat(F.lit('{"items": ['), F.array_join(F.collect_list("item"), ", "),
                                    F.lit("]}")).alias("page_json")).select("page_json")


def video_item_sql(dialect: str) -> str:
    """One video item as JSON text from an ``orders`` row."""
    if dialect == "spark":
        fmt = "format_number(floor(o_totalprice), 0)"
        iso = "date_format(o_orderdate - INTERVAL 7 DAYS, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
        s = "cast({} as string)"
    else:
        fmt = "format('{:,}', CAST(floor(o_totalprice) AS BIGINT))"
        iso = "strftime(o_orderdate - INTERVAL 7 DAY, '%Y-%m-%dT%H:%M:%SZ')"
        s = "CAST({} AS VARCHAR)"
    v = s.format("o_custkey % 22")
    price = s.format("CAST(floor(o_totalprice) AS BIGINT)")
    return f"""'{{' || CASE WHEN o_orderkey % 97 = 0 THEN '' ELSE '"id": "v' || {v} || '", ' END
  || '"snippet": {{'
  || CASE WHEN o_orderkey % 89 = 0 THEN '' ELSE '"channelId": "'
       || CASE WHEN o_orderkey % 10 = 0 THEN 'chX' ELSE 'ch' || {s.format('o_custkey % 22 % 7')} END || '", ' END
  || CASE WHEN o_orderstatus = 'F' THEN '' ELSE '"title": "Stat ' || {v} || '", "channelTitle": "SChan '
       || {s.format('o_custkey % 22 % 7')} || '", ' END
  || '"publishedAt": "' || CASE WHEN o_orderkey % 4 <> 0 THEN {iso} ELSE '' END || '"}}, '
  || '"statistics": {{'
  || CASE o_orderkey % 6 WHEN 0 THEN '"viewCount": ' || {price} || ', '
                         WHEN 1 THEN '"viewCount": "' || {fmt} || '", '
                         WHEN 2 THEN '"viewCount": " ' || {price} || ' ", '
                         WHEN 3 THEN '"viewCount": "' || {price} || '.5", '
                         WHEN 4 THEN '"viewCount": "x", '
                         ELSE '' END
  || '"likeCount": "' || {s.format('CAST(floor(o_totalprice / 10) AS BIGINT)')} || '", '
  || '"commentCount": ' || {s.format('o_orderkey % 500')} || '}}}}'"""


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel upload listings (search results) from ``orders``; some items lack a video id."""
    o = _read(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("ch"), _s(F.col("o_custkey") % 7)).alias("channel_id"),
        F.when(F.col("o_orderkey") % 13 != 0, F.concat(F.lit("v"), _s(F.col("o_orderkey")))).alias("video_id"),
        F.col("o_orderdate").cast("timestamp").alias("published_at"),
        F.concat(F.lit("Video "), _s(F.col("o_orderkey"))).alias("video_title"))
