"""Dashboard and BI aggregates, computed for every video in one pass.

The dashboard of the original system picks one video and aggregates its rows
in the UI process.  Here each aggregate is grouped by ``video_id`` so one job
serves all videos; a single video is just a filter on the result.  Grouped
counts use map-side partial aggregation, so a video holding a third of all
comments only sends one partial row per task to the shuffle; per-video
top-k windows run on those already-aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmur.functions import labels
from murmur.functions.ontology import SENTIMENTS
from murmur.operators.latest import latest_per_key
from murmur.plans import reports


# -- G1 video list -------------------------------------------------------------

def video_list(curated: DataFrame, raw: DataFrame, stats: DataFrame) -> DataFrame:
    """One row per curated (video, channel): distinct comments, titles, latest stats.

    Raw titles are reduced to one row per (video, channel) *before* the join,
    which gives the same answer as joining every curated row to every raw row
    of its video (a per-video n x m fan-out) without producing those rows.
    """
    agg = curated.groupBy("video_id", "channel_id").agg(F.count_distinct("comment_id").alias("n_comments"))
    titles = raw.groupBy("video_id", "channel_id").agg(
        F.max("video_title").alias("r_video_title"), F.max("channel_title").alias("r_channel_title"))
    s = reports.video_stats_latest(stats).select(
        "video_id", "channel_id", "view_count", "like_count", F.col("video_published_at").alias("published_at"))
    return (agg.join(titles, ["video_id", "channel_id"], "left")
            .join(s, ["video_id", "channel_id"], "left")
            .select("video_id", "channel_id", "n_comments",
                    F.coalesce("r_video_title", "video_id").alias("video_title"),
                    F.coalesce("r_channel_title", "channel_id").alias("channel_title"),
                    "view_count", "like_count", "published_at"))


def video_list_ordered(videos: DataFrame) -> DataFrame:
    """Presentation order: most comments first (ties by id)."""
    return videos.orderBy(F.col("n_comments").desc(), F.col("video_id"), F.col("channel_id"))


# -- G3 / G4 / G5 / B4 over the latest-model rows (F5) -------------------------

def sentiment_distribution(f5: DataFrame) -> DataFrame:
    return (f5.where(F.col("general_sentiment").isNotNull())
            .groupBy("video_id", F.col("general_sentiment").alias("sentiment"))
            .agg(F.count(F.lit(1)).alias("count")))


def topic_top(f5: DataFrame, k: int = 10) -> DataFrame:
    """Top-k topics per video by count (ties: topic name); ``rank`` 1..k."""
    counts = (f5.where(F.col("topic").isNotNull())
              .groupBy("video_id", "topic").agg(F.count(F.lit(1)).alias("count")))
    w = Window.partitionBy("video_id").orderBy(F.col("count").desc(), F.col("topic").asc())
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def aspect_sentiment_pivot(f5: DataFrame) -> DataFrame:
    """Aspect x sentiment counts per video with a fixed sentiment column set (0 when absent)."""
    asp = (f5.select("video_id", F.explode("aspects").alias("a"))
           .select("video_id", F.col("a.aspect").alias("aspect"), F.col("a.sentiment").alias("sentiment"))
           .where(F.col("aspect").isNotNull() & F.col("sentiment").isNotNull()))
    return asp.groupBy("video_id", "aspect").pivot("sentiment", SENTIMENTS).count().na.fill(0, SENTIMENTS)


def aspect_sentiment_pivot_ordered(pivot: DataFrame) -> DataFrame:
    return pivot.orderBy("video_id", F.col("negative").desc(), "aspect")


def sentiment_choices(f5: DataFrame) -> DataFrame:
    """Filter choices: distinct non-NULL sentiments per video, sorted."""
    return (f5.where(F.col("general_sentiment").isNotNull()).select("video_id", "general_sentiment").distinct()
            .orderBy("video_id", "general_sentiment"))


def comments_by_sentiment(f5: DataFrame, sentiment: str | None = None) -> DataFrame:
    """Comment list for display; ``None`` (the "all" choice) applies no filter."""
    rows = f5 if sentiment is None else f5.where(F.col("general_sentiment") == F.lit(sentiment))
    return rows.select("video_id", F.col("general_sentiment").alias("sentiment"), "topic",
                       F.col("text_clean").alias("comment_text"), "purchase_intent")


# -- G6 summary tiles ----------------------------------------------------------

def video_summary(f5: DataFrame, videos: DataFrame) -> DataFrame:
    """Per video with analysed rows: count, positive share (half-even), formatted stats."""
    per_video = f5.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("n_analysed"),
        F.count_if(F.col("general_sentiment") == "positive").alias("n_positive"))
    first_row = latest_per_key(videos, ["video_id"], [F.col("n_comments").desc(), F.col("channel_id").asc()])
    j = per_video.join(first_row, "video_id", "left")
    pct = F.bround(F.lit(100.0) * F.col("n_positive") / F.col("n_analysed"), 0).cast("bigint")
    return j.select(
        "video_id", "channel_id", "video_title", "channel_title", "n_analysed",
        F.when(F.col("n_analysed") > 0, pct).otherwise(F.lit(0).cast("bigint")).alias("positive_pct"),
        labels.thousands(F.col("view_count")).alias("views"),
        labels.thousands(F.col("like_count")).alias("likes"),
        labels.day_text(F.col("published_at")).alias("published"))


# -- D2 / D3 / D4 / D5 over the reports ----------------------------------------

def channel_engagement(report: DataFrame) -> DataFrame:
    ct = F.col("comment_type")
    return report.groupBy("video_id", "channel_id").agg(
        F.count(F.lit(1)).alias("n_comments"),
        F.count_if(ct == "Top-level").alias("n_top_level"),
        F.count_if(ct == "Reply").alias("n_replies"),
        F.count_if(ct == "Creator reply").alias("n_creator_replies"),
        F.count_if(F.col("is_creator_reply")).alias("n_creator_authored"))


def signal_totals(report: DataFrame) -> DataFrame:
    return report.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("n_comments"),
        F.count_if(F.col("purchase_intent")).alias("n_purchase_intent"),
        F.count_if(F.col("is_question")).alias("n_questions"),
        F.count_if(F.col("competitor_mention")).alias("n_competitor_mentions"),
        F.count_if(F.col("intent_category") == "Complaint").alias("n_complaints"))


ROLLUP_DIMENSIONS = ["video_title", "topic", "general_sentiment", "comment_type", "intent_category"]


def report_rollup(report: DataFrame, dims: list[str] = ROLLUP_DIMENSIONS) -> DataFrame:
    """Record count by each report dimension in one pass (GROUPING SETS)."""
    g = report.groupingSets([[F.col(d)] for d in dims], *[F.col(d) for d in dims]).agg(
        F.count(F.lit(1)).alias("record_count"), F.grouping_id().alias("_gid"))
    n = len(dims)
    # grouping_id bit i (from the left, most significant first) is 1 when dims[i] is aggregated away
    dim_name = F.lit(None).cast("string")
    dim_value = F.lit(None).cast("string")
    for i, d in enumerate(dims):
        only_d = (1 << n) - 1 - (1 << (n - 1 - i))
        dim_name = F.when(F.col("_gid") == only_d, F.lit(d)).otherwise(dim_name)
        dim_value = F.when(F.col("_gid") == only_d, F.col(d).cast("string")).otherwise(dim_value)
    return g.select(dim_name.alias("dimension"), dim_value.alias("value"), "record_count")


def label_coverage(report: DataFrame, aspect_report: DataFrame) -> DataFrame:
    """Per video: how often the fallback labels (aspect 'other', topic 'offtopic') occur."""
    topics = report.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("n_comments"),
        F.count_if(F.col("topic") == "offtopic").alias("n_offtopic"),
        F.count_if(F.col("topic").isNull()).alias("n_topic_missing"))
    aspects = aspect_report.groupBy("video_id").agg(
        F.count(F.lit(1)).alias("n_aspects"),
        F.count_if(F.col("aspect") == "other").alias("n_other_aspects"))
    return topics.join(aspects, "video_id", "full_outer").select(
        "video_id",
        *[F.coalesce(F.col(c), F.lit(0).cast("bigint")).alias(c)
          for c in ["n_comments", "n_offtopic", "n_topic_missing", "n_aspects", "n_other_aspects"]])
