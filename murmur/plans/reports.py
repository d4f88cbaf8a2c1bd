"""Report views as DataFrame plans over all videos at once.

* ``raw_titles_latest``        newest raw row per (video, channel)
* ``video_stats_latest``       newest stats snapshot per video (channel ignored)
* ``comment_insights_report``  one row per (video, comment): latest run of any
                               model, joined to curated text, titles and stats
* ``aspect_sentiment_report``  one row per aspect of the latest run *that has
                               aspects*
* ``latest_model_insights``    every row of the model that ran last on a video

Plan notes.  The latest-run window is partitioned by (video_id, comment_id)
and the curated join is keyed on those two columns plus channel equality
(which the optimizer folds into the join keys); with
``spark.sql.requireAllClusterKeysForCoPartition=false`` (a session default
here) the join reuses the window's partitioning, so the insights side is
shuffled once for both operators.  Titles and stats are
merged to one row per (video, channel) before they meet the comments in one join; AQE
broadcasts that side only when its measured size is under the broadcast threshold, and splits
hot videos where it is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur.functions import labels
from murmur.operators.latest import latest_per_key, newest_first

# Columns of the stored tables that decide between rows of one time.  Rows that agree in all of them
# give the same answer.  Counters only grow, so the larger ones are the later snapshot.
INSIGHT_TIES = ("inference_run_id", "model_name")
RAW_TIES = ("comment_id", "video_title", "channel_title")
STATS_TIES = ("view_count", "comment_count", "like_count", "published_at", "channel_id", "video_title", "channel_title")


def raw_titles_latest(raw: DataFrame) -> DataFrame:
    """(video_id, channel_id) -> titles of the newest raw row (even when those are NULL)."""
    cols = raw.select("video_id", "channel_id", "video_title", "channel_title", "ingested_at", "comment_id")
    return latest_per_key(cols, ["video_id", "channel_id"],
                          newest_first(cols, "ingested_at", RAW_TIES)
                          ).select("video_id", "channel_id", "video_title", "channel_title")


def video_stats_latest(stats: DataFrame) -> DataFrame:
    """Newest snapshot per ``video_id``; the partition ignores ``channel_id``."""
    cols = stats.select("video_id", "channel_id", "video_title", "channel_title", "view_count",
                        "like_count", "comment_count", "published_at", "fetched_at")
    return latest_per_key(cols, ["video_id"], newest_first(cols, "fetched_at", STATS_TIES)).select(
        "video_id", "channel_id", "video_title", "channel_title", "view_count", "like_count",
        "comment_count", F.col("published_at").alias("video_published_at"))


def video_dimension(raw: DataFrame, stats: DataFrame) -> DataFrame:
    """One row per (video, channel): newest raw titles (``r_``) and newest statistics (``s_``).

    Both sides are small before they meet, so that the comments are joined once; the exchange of that
    one join lies right below it, where Spark can split a video that holds very many comments.
    """
    r = raw_titles_latest(raw).select(
        "video_id", "channel_id", F.col("video_title").alias("r_video_title"), F.col("channel_title").alias("r_channel_title"))
    s = video_stats_latest(stats).select(
        "video_id", "channel_id", F.col("video_title").alias("s_video_title"), F.col("channel_title").alias("s_channel_title"),
        "view_count", F.col("like_count").alias("video_like_count"), F.col("comment_count").alias("video_comment_count"),
        "video_published_at")
    return r.join(s, ["video_id", "channel_id"], "full_outer")


def latest_runs(insights: DataFrame, require_aspects: bool = False) -> DataFrame:
    """Latest run per (video_id, comment_id) across all models."""
    src = insights
    if require_aspects:
        src = src.where(F.col("aspects").isNotNull() & (F.size("aspects") > 0))
    return latest_per_key(src, ["video_id", "comment_id"], newest_first(src, "inference_ts", INSIGHT_TIES))


REPORT_COLUMNS = [
    "comment_id", "video_id", "channel_id", "model_name", "general_sentiment", "topic",
    "purchase_intent", "is_question", "competitor_mention", "inference_ts", "text_clean",
    "is_reply", "author_channel_id", "comment_like_count", "is_creator_reply", "comment_type",
    "intent_category", "video_title", "channel_title", "view_count", "video_like_count",
    "video_comment_count", "video_published_at",
]


def comment_insights_report(insights: DataFrame, curated: DataFrame, raw: DataFrame,
                            stats: DataFrame) -> DataFrame:
    l = latest_runs(insights.select(
        "comment_id", "video_id", "channel_id", "model_name", "general_sentiment", "topic",
        "purchase_intent", "is_question", "competitor_mention", "inference_ts", "inference_run_id"))
    c = curated.select(
        "comment_id", "video_id", F.col("channel_id").alias("c_channel_id"), "text_clean", "is_reply",
        "author_channel_id", F.col("like_count").alias("comment_like_count"))
    j = (l.join(c, ["video_id", "comment_id"], "inner")
         .where(F.col("channel_id") == F.col("c_channel_id"))
         .join(video_dimension(raw, stats), ["video_id", "channel_id"], "left"))
    author, channel = F.col("author_channel_id"), F.col("c_channel_id")
    return j.select(
        "comment_id", "video_id", "channel_id", "model_name", "general_sentiment", "topic",
        "purchase_intent", "is_question", "competitor_mention", "inference_ts", "text_clean",
        "is_reply", "author_channel_id", "comment_like_count",
        labels.is_creator_reply(author, channel).alias("is_creator_reply"),
        labels.comment_type(author, channel, F.col("is_reply")).alias("comment_type"),
        labels.intent_category(F.col("purchase_intent"), F.col("competitor_mention"),
                               F.col("is_question"), F.col("general_sentiment"),
                               F.col("topic")).alias("intent_category"),
        F.coalesce("s_video_title", "r_video_title", "video_id").alias("video_title"),
        F.coalesce("s_channel_title", "r_channel_title", "channel_id").alias("channel_title"),
        "view_count", "video_like_count", "video_comment_count", "video_published_at",
    )


ASPECT_REPORT_COLUMNS = [
    "comment_id", "video_id", "channel_id", "model_name", "comment_sentiment", "comment_topic",
    "aspect", "aspect_sentiment", "evidence", "video_title", "channel_title",
]


def aspect_sentiment_report(insights: DataFrame, stats: DataFrame) -> DataFrame:
    """Latest run with a non-empty aspect list, one row per aspect (inner unnest)."""
    l = latest_runs(insights.select(
        "comment_id", "video_id", "channel_id", "model_name", "general_sentiment", "topic",
        "aspects", "inference_ts", "inference_run_id"), require_aspects=True)
    vs = video_stats_latest(stats).select(
        "video_id", "channel_id", F.col("video_title").alias("s_video_title"),
        F.col("channel_title").alias("s_channel_title"))
    exploded = l.select(
        "comment_id", "video_id", "channel_id", "model_name",
        F.col("general_sentiment").alias("comment_sentiment"), F.col("topic").alias("comment_topic"),
        F.inline("aspects"))
    return exploded.join(vs, ["video_id", "channel_id"], "left").select(
        "comment_id", "video_id", "channel_id", "model_name", "comment_sentiment", "comment_topic",
        "aspect", F.col("sentiment").alias("aspect_sentiment"), "evidence",
        F.coalesce("s_video_title", "video_id").alias("video_title"),
        F.coalesce("s_channel_title", "channel_id").alias("channel_title"))


def latest_model_per_video(insights: DataFrame) -> DataFrame:
    """(video_id, model_name) of the model whose newest run on the video is newest.

    Ties on the timestamp go to the smaller model name.  Runs with a NULL
    model never match a join, as in the SQL original.
    """
    per_model = insights.groupBy("video_id", "model_name").agg(F.max("inference_ts").alias("mt"))
    return latest_per_key(per_model, ["video_id"],
                          [F.col("mt").desc_nulls_last(), F.col("model_name").asc_nulls_last()]
                          ).select("video_id", "model_name")


def latest_model_insights(insights: DataFrame, curated: DataFrame, video_id: str | None = None) -> DataFrame:
    """All runs of each video's newest model joined to curated on ``comment_id`` only
    (no per-comment dedup: re-runs by that model repeat; curated duplicates fan out)."""
    p = insights
    if video_id is not None:
        p = p.where(F.col("video_id") == F.lit(video_id))
    p = p.select("video_id", "comment_id", "model_name", "general_sentiment", "topic", "aspects",
                 "purchase_intent", "is_question", "competitor_mention", "inference_ts")
    best = latest_model_per_video(p)
    p = p.drop("inference_ts")
    c = curated.select("comment_id", "text_clean", "is_reply", "author_channel_id", "channel_id")
    return p.join(best, ["video_id", "model_name"], "inner").join(c, "comment_id", "inner")
