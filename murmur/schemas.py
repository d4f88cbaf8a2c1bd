"""Fixed table schemas of the three layers (raw -> core -> ml).

JSON columns (``raw_payload``, ``raw_response``) are kept as JSON text in a
STRING column so that Parquet files stay readable by any engine; they are
parsed on demand with ``try_parse_json`` / ``from_json``.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, B, TS, D = T.StringType(), T.LongType(), T.BooleanType(), T.TimestampType(), T.DoubleType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_COMMENTS = _schema(
    ("channel_id", S), ("channel_title", S), ("video_id", S), ("video_title", S),
    ("video_published_at", TS), ("comment_id", S), ("parent_id", S), ("is_top_level", B),
    ("author_channel_id", S), ("author_display_name", S), ("text_original", S),
    ("text_display", S), ("like_count", L), ("published_at", TS), ("updated_at", TS),
    ("raw_payload", S), ("ingested_at", TS),
)

VIDEO_STATS = _schema(
    ("video_id", S), ("channel_id", S), ("video_title", S), ("channel_title", S),
    ("view_count", L), ("like_count", L), ("comment_count", L),
    ("published_at", TS), ("fetched_at", TS),
)

CURATED_COMMENTS = _schema(
    ("comment_id", S), ("video_id", S), ("channel_id", S), ("text_clean", S),
    ("language", S), ("is_turkish", B), ("is_reply", B), ("parent_id", S),
    ("author_channel_id", S), ("like_count", L), ("comment_len_chars", L),
    ("comment_len_tokens", L), ("curated_at", TS),
)

ASPECT = T.StructType([
    T.StructField("aspect", S, True),
    T.StructField("sentiment", S, True),
    T.StructField("evidence", S, True),
])

COMMENT_INSIGHTS = _schema(
    ("comment_id", S), ("video_id", S), ("channel_id", S), ("model_name", S),
    ("general_sentiment", S), ("topic", S), ("aspects", T.ArrayType(ASPECT, True)),
    ("purchase_intent", B), ("is_question", B), ("competitor_mention", B),
    ("inference_ts", TS), ("inference_run_id", S), ("temperature", D),
    ("max_tokens", L), ("raw_response", S),
)

TABLES = {
    "raw.comments": RAW_COMMENTS,
    "raw.video_stats": VIDEO_STATS,
    "core.comments_curated": CURATED_COMMENTS,
    "ml.comment_insights": COMMENT_INSIGHTS,
}

# Payload shapes of the comment-thread API and the video-statistics API: the fields that the raw
# tables need.  Counters arrive as numbers or as strings such as "1,234": they are kept as text.
_SNIPPET = ("struct<authorChannelId: struct<value: string>, authorDisplayName: string, textOriginal: string, "
            "textDisplay: string, likeCount: string, publishedAt: string, updatedAt: string>")
COMMENT = f"id string, snippet {_SNIPPET}"
THREAD_ITEM = ("snippet struct<channelId: string, channelTitle: string, videoId: string, videoTitle: string, "
               f"topLevelComment: struct<id: string, snippet: {_SNIPPET}>>, replies struct<comments: array<string>>")

VIDEO_ITEM = T.StructType([
    T.StructField("id", S),
    T.StructField("snippet", T.StructType([
        T.StructField("channelId", S), T.StructField("title", S),
        T.StructField("channelTitle", S), T.StructField("publishedAt", S),
    ])),
    T.StructField("statistics", T.StructType([
        T.StructField("viewCount", S), T.StructField("likeCount", S),
        T.StructField("commentCount", S),
    ])),
])
VIDEO_PAGE = T.StructType([T.StructField("items", T.ArrayType(VIDEO_ITEM))])
