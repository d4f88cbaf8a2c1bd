"""Query catalog: one callable ``(spark, sf_dir) -> DataFrame`` per query key.

Every query reads the driver tables through ``murmur.sources.fixtures`` and runs
over whole tables; none collects, samples or caps its input.  Column names
match the SQL oracles in ``murmur.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur import schemas
from murmur.functions.text import clean_text
from murmur.operators import annotate, curate, langid, ngrams
from murmur.plans import metrics, reports
from murmur.sources import fixtures as fx
from murmur.sources import payloads

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(key: str):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        return fn
    return deco


@query("comment_insights_report")
def q_comment_insights_report(spark: SparkSession, d: str) -> DataFrame:
    return reports.comment_insights_report(fx.insights(spark, d), fx.curated(spark, d),
                                           fx.raw_comments(spark, d), fx.video_stats(spark, d))


@query("raw_titles_latest")
def q_raw_titles_latest(spark: SparkSession, d: str) -> DataFrame:
    return reports.raw_titles_latest(fx.raw_comments(spark, d))


@query("video_stats_latest")
def q_video_stats_latest(spark: SparkSession, d: str) -> DataFrame:
    return reports.video_stats_latest(fx.video_stats(spark, d))


def _f5(spark: SparkSession, d: str) -> DataFrame:
    return reports.latest_model_insights(fx.insights(spark, d), fx.curated(spark, d))


def _report(spark: SparkSession, d: str) -> DataFrame:
    return q_comment_insights_report(spark, d)


def _aspect_report(spark: SparkSession, d: str) -> DataFrame:
    return reports.aspect_sentiment_report(fx.insights(spark, d), fx.video_stats(spark, d))


def _videos(spark: SparkSession, d: str) -> DataFrame:
    return metrics.video_list(fx.curated(spark, d), fx.raw_comments(spark, d), fx.video_stats(spark, d))


@query("aspect_sentiment_report")
def q_aspect_sentiment_report(spark: SparkSession, d: str) -> DataFrame:
    return _aspect_report(spark, d)


@query("video_insights_latest_model")
def q_video_insights_latest_model(spark: SparkSession, d: str) -> DataFrame:
    return _f5(spark, d).select(
        "video_id", "comment_id", "model_name", "general_sentiment", "topic",
        F.size("aspects").alias("n_aspects"), "purchase_intent", "is_question", "competitor_mention",
        "text_clean", "is_reply", "author_channel_id", "channel_id")


@query("video_list")
def q_video_list(spark: SparkSession, d: str) -> DataFrame:
    return metrics.video_list_ordered(_videos(spark, d))


@query("sentiment_distribution")
def q_sentiment_distribution(spark: SparkSession, d: str) -> DataFrame:
    return metrics.sentiment_distribution(_f5(spark, d))


@query("topic_top10")
def q_topic_top10(spark: SparkSession, d: str) -> DataFrame:
    return metrics.topic_top(_f5(spark, d), 10)


@query("aspect_sentiment_pivot")
def q_aspect_sentiment_pivot(spark: SparkSession, d: str) -> DataFrame:
    return metrics.aspect_sentiment_pivot_ordered(metrics.aspect_sentiment_pivot(_f5(spark, d)))


@query("comments_by_sentiment")
def q_comments_by_sentiment(spark: SparkSession, d: str) -> DataFrame:
    return metrics.comments_by_sentiment(_f5(spark, d), "negative")


@query("video_summary")
def q_video_summary(spark: SparkSession, d: str) -> DataFrame:
    return metrics.video_summary(_f5(spark, d), _videos(spark, d))


@query("channel_engagement")
def q_channel_engagement(spark: SparkSession, d: str) -> DataFrame:
    return metrics.channel_engagement(_report(spark, d))


@query("signal_totals")
def q_signal_totals(spark: SparkSession, d: str) -> DataFrame:
    return metrics.signal_totals(_report(spark, d))


@query("report_rollup")
def q_report_rollup(spark: SparkSession, d: str) -> DataFrame:
    return metrics.report_rollup(_report(spark, d))


@query("label_coverage")
def q_label_coverage(spark: SparkSession, d: str) -> DataFrame:
    return metrics.label_coverage(_report(spark, d), _aspect_report(spark, d))


# -- curation and language id ------------------------------------------------------

CURATED_OUT = ["comment_id", "video_id", "channel_id", "text_clean", "language", "is_turkish", "is_reply",
               "parent_id", "author_channel_id", "like_count", "comment_len_chars", "comment_len_tokens"]


def _lang_model(spark: SparkSession, d: str) -> langid.Model:
    return curate.language_model(fx.language_training(spark, d))


@query("pending_curation")
def q_pending_curation(spark: SparkSession, d: str) -> DataFrame:
    return curate.pending_curation(fx.raw_comments(spark, d), fx.curated(spark, d))


@query("curate_comments")
def q_curate_comments(spark: SparkSession, d: str) -> DataFrame:
    """Every long comment (documents) curated as one batch, language included."""
    return curate.curate(fx.long_comments(spark, d), _lang_model(spark, d)).select(*CURATED_OUT)


@query("curate_dedup")
def q_curate_dedup(spark: SparkSession, d: str) -> DataFrame:
    return curate.curate_dedup(fx.raw_comments(spark, d), fx.curated(spark, d),
                               _lang_model(spark, d)).select(*CURATED_OUT)


@query("language_id")
def q_language_id(spark: SparkSession, d: str) -> DataFrame:
    docs = fx.documents(spark, d).select(
        "doc_id", "lang", fx.held_out(F.col("doc_id")).alias("held_out"), clean_text(F.col("text")).alias("text_clean"))
    return langid.predict(docs, "text_clean", _lang_model(spark, d)).select("doc_id", "lang", "held_out", "language")


# -- payload ingest -----------------------------------------------------------------

INGEST_TS = "2024-06-01 00:00:00"


@query("thread_flatten")
def q_thread_flatten(spark: SparkSession, d: str) -> DataFrame:
    return payloads.flatten_threads(fx.thread_pages(spark, d), F.lit(INGEST_TS).cast("timestamp"))


@query("thread_rejects")
def q_thread_rejects(spark: SparkSession, d: str) -> DataFrame:
    return payloads.thread_rejects(fx.faulty_thread_pages(spark, d))


@query("video_stats_parse")
def q_video_stats_parse(spark: SparkSession, d: str) -> DataFrame:
    pages = payloads.parse_pages(fx.video_pages(spark, d), schema=schemas.VIDEO_PAGE)
    return payloads.flatten_video_stats(pages, F.lit(INGEST_TS).cast("timestamp"))


@query("latest_videos_per_channel")
def q_latest_videos_per_channel(spark: SparkSession, d: str) -> DataFrame:
    return payloads.latest_videos_per_channel(fx.uploads(spark, d), 10)


# -- annotation data jobs --------------------------------------------------------------

MODEL = "m0"


@query("pending_inference")
def q_pending_inference(spark: SparkSession, d: str) -> DataFrame:
    return annotate.pending_inference(fx.curated(spark, d), fx.insights(spark, d), MODEL)


@query("aspect_work_items")
def q_aspect_work_items(spark: SparkSession, d: str) -> DataFrame:
    return annotate.aspect_work_items(fx.tagging_replies(spark, d))


@query("prediction_rows")
def q_prediction_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = annotate.prediction_rows(fx.tagging_replies(spark, d), fx.aspect_replies(spark, d))
    return rows.select(*annotate.RUN_COLUMNS, "inference_ts", "general_sentiment", "topic",
                       annotate.aspects_text(F.col("aspects")).alias("aspects_text"),
                       F.size("aspects").cast("bigint").alias("n_aspects"),
                       "purchase_intent", "is_question", "competitor_mention", "had_error")


@query("normalize_labels")
def q_normalize_labels(spark: SparkSession, d: str) -> DataFrame:
    return annotate.label_normalization(fx.tagging_replies(spark, d), fx.aspect_replies(spark, d))


@query("lexicon_tags")
def q_lexicon_tags(spark: SparkSession, d: str) -> DataFrame:
    tags = annotate.lexicon_tags(fx.all_curated(spark, d))
    return tags.withColumn("aspect_names", F.array_join("aspect_names", ",")).drop("mentions")


@query("aspect_evidence")
def q_aspect_evidence(spark: SparkSession, d: str) -> DataFrame:
    return annotate.aspect_evidence(annotate.lexicon_tags(fx.all_curated(spark, d)))


@query("tagging_requests")
def q_tagging_requests(spark: SparkSession, d: str) -> DataFrame:
    pending = annotate.pending_inference(fx.curated(spark, d), fx.insights(spark, d), MODEL)
    return annotate.messages_rows(annotate.tagging_requests(pending), "comment_id", "video_id", "channel_id")


@query("aspect_requests")
def q_aspect_requests(spark: SparkSession, d: str) -> DataFrame:
    items = annotate.aspect_work_items(fx.tagging_replies(spark, d))
    req = annotate.aspect_requests(items, fx.all_curated(spark, d))
    return annotate.messages_rows(req, "comment_id", "video_id", "inference_run_id", "pos", "aspect_name")


# -- documented analytics ----------------------------------------------------------------

@query("ngram_counts")
def q_ngram_counts(spark: SparkSession, d: str) -> DataFrame:
    docs = fx.long_comments(spark, d).select("video_id", clean_text(F.col("text_original")).alias("text_clean"))
    return ngrams.ngram_counts(docs, sizes=(2, 3))


@query("ngram_top20")
def q_ngram_top20(spark: SparkSession, d: str) -> DataFrame:
    docs = fx.long_comments(spark, d).select("video_id", clean_text(F.col("text_original")).alias("text_clean"))
    return ngrams.top_ngrams(docs, sizes=(2, 3), k=20)
