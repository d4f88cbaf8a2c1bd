"""API payloads -> raw tables, as distributed JSON jobs.

A payload page is one JSON text per row (``read_pages``).  Pages are opened with ``from_json`` into
the texts of their items, and each item once more into the fields that the raw tables need;
there is no driver loop and no page-at-a-time processing.  A page is a bounded unit (the
API caps items per page), so no row ever grows with the data.

* ``flatten_threads``   comment-thread pages -> raw.comments rows: one row for the top-level
                        comment plus one per embedded reply, produced by a single ``inline``
                        over a per-thread array.  ``raw_payload`` is the item's (the reply's) own
                        JSON with all its fields in their order (blanks between them aside), so
                        fields that no schema names survive.
* ``thread_rejects``    what could not be flattened, with its text and the reason: pages that
                        are no JSON object or whose items are no list, threads without a
                        thread snippet or top-level snippet, replies without a snippet.
                        Rows of ``flatten_threads`` and rejects together hold every payload.
* ``flatten_video_stats`` video pages -> raw.video_stats rows with lenient
                        counters and '' for missing strings.
* ``latest_videos_per_channel`` newest N uploads per channel.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur import schemas
from murmur.functions.labels import lenient_long
from murmur.operators.latest import latest_per_key

BAD_PAGE, BAD_THREAD, BAD_REPLY = "page", "thread", "reply"
_BAD = "_corrupt_record"


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """JSON-lines payload files, one page text per row (``page_json``)."""
    return spark.read.text(path).withColumnRenamed("value", "page_json")


def parse_pages(json_text: DataFrame, col: str = "page_json", schema=schemas.VIDEO_PAGE) -> DataFrame:
    """Payload text column -> page struct columns."""
    return json_text.select(F.from_json(F.col(col), schema).alias("p")).select("p.*")


def _iso_ts(c: Column) -> Column:
    """API timestamp text (ISO-8601, 'Z' or offset) -> TIMESTAMP; '' or junk -> NULL."""
    return F.try_to_timestamp(F.nullif(c, F.lit("")))


def _open(text: Column, schema: str) -> Column:
    """The fields of a JSON object; NULL if the text is none or a field has another type."""
    parsed = F.from_json(text, f"{schema}, {_BAD} string", {"columnNameOfCorruptRecord": _BAD})
    return F.when(F.ltrim(text).startswith("{") & parsed.getField(_BAD).isNull(), parsed)


def _threads(pages: DataFrame, col: str) -> DataFrame:
    """(page, good, at, item, thread): a row per item, and one without ``at`` for a page without items."""
    page = _open(F.col(col), "items array<string>")
    opened = pages.select(F.col(col).alias("page"), page.alias("p"))
    items = opened.select("page", F.col("p").isNotNull().alias("good"), F.posexplode_outer("p.items").alias("at", "item"))
    return items.withColumn("thread", _open(F.col("item"), schemas.THREAD_ITEM))


def _valid(thread: Column) -> Column:
    top = thread.getField("snippet").getField("topLevelComment").getField("snippet")
    return thread.isNotNull() & thread.getField("snippet").isNotNull() & top.isNotNull()


def _replies(thread: Column) -> Column:
    """Embedded replies: their text and their fields."""
    texts = F.coalesce(thread.getField("replies").getField("comments"), F.array())
    return F.transform(texts, lambda r: F.struct(r.alias("text"), _open(r, schemas.COMMENT).alias("fields")))


def _has_snippet(reply: Column) -> Column:
    return reply.getField("fields").isNotNull() & reply.getField("fields").getField("snippet").isNotNull()


def flatten_threads(pages: DataFrame, ingested_at: Column | None = None, col: str = "page_json") -> DataFrame:
    """raw.comments rows; every row of one thread shares ``ingested_at``."""
    ingested_at = ingested_at if ingested_at is not None else F.current_timestamp()
    thread = F.col("thread").getField("snippet")
    top = thread.getField("topLevelComment")

    def row(comment: Column, parent: Column, is_top: bool, payload: Column) -> Column:
        s = comment.getField("snippet")
        return F.struct(
            comment.getField("id").alias("comment_id"),
            parent.alias("parent_id"),
            F.lit(is_top).alias("is_top_level"),
            s.getField("authorChannelId").getField("value").alias("author_channel_id"),
            s.getField("authorDisplayName").alias("author_display_name"),
            s.getField("textOriginal").alias("text_original"),
            s.getField("textDisplay").alias("text_display"),
            s.getField("likeCount").alias("like_count"),
            s.getField("publishedAt").alias("published_at"),
            s.getField("updatedAt").alias("updated_at"),
            payload.alias("raw_payload"))

    good = _threads(pages, col).where(_valid(F.col("thread"))).withColumn("replies", _replies(F.col("thread")))
    rows = F.concat(
        F.array(row(top, F.lit(None).cast("string"), True, F.col("item"))),
        F.transform(F.filter("replies", _has_snippet),
                    lambda r: row(r.getField("fields"), top.getField("id"), False, r.getField("text"))))
    flat = good.select(thread.getField("channelId").alias("channel_id"),
                       thread.getField("channelTitle").alias("channel_title"),
                       thread.getField("videoId").alias("video_id"),
                       thread.getField("videoTitle").alias("video_title"),
                       ingested_at.alias("ingested_at"),
                       F.inline(rows))
    out = flat.select(
        "channel_id", "channel_title", "video_id", "video_title",
        F.lit(None).cast("timestamp").alias("video_published_at"),
        "comment_id", "parent_id", "is_top_level", "author_channel_id", "author_display_name",
        "text_original", "text_display", F.col("like_count").try_cast("bigint").alias("like_count"),
        _iso_ts(F.col("published_at")).alias("published_at"),
        _iso_ts(F.col("updated_at")).alias("updated_at"),
        "raw_payload", "ingested_at")
    return out.select(*[F.col(f.name).cast(f.dataType) for f in schemas.RAW_COMMENTS.fields])


def thread_rejects(pages: DataFrame, col: str = "page_json") -> DataFrame:
    """(reason, payload) of everything that ``flatten_threads`` leaves out."""
    def reject(reason: str, payload: Column) -> Column:
        return F.struct(F.lit(reason).alias("reason"), payload.alias("payload"))

    bad_replies = F.transform(F.filter(_replies(F.col("thread")), lambda r: ~_has_snippet(r)),
                              lambda r: reject(BAD_REPLY, r.getField("text")))
    found = (F.when(~F.col("good"), F.array(reject(BAD_PAGE, F.col("page"))))
             .when(F.col("at").isNotNull() & ~_valid(F.col("thread")), F.array(reject(BAD_THREAD, F.col("item"))))
             .when(F.col("at").isNotNull(), bad_replies))
    return _threads(pages, col).select(F.inline(found))


def flatten_video_stats(pages: DataFrame, fetched_at: Column | None = None) -> DataFrame:
    """raw.video_stats rows: missing strings -> '', counters lenient (junk -> 0), '' date -> NULL."""
    fetched_at = fetched_at if fetched_at is not None else F.current_timestamp()
    it = F.col("item")
    sn, st = it.getField("snippet"), it.getField("statistics")
    blank = F.lit("")
    out = pages.select(F.explode("items").alias("item")).select(
        F.coalesce(it.getField("id"), blank).alias("video_id"),
        F.coalesce(sn.getField("channelId"), blank).alias("channel_id"),
        F.coalesce(sn.getField("title"), blank).alias("video_title"),
        F.coalesce(sn.getField("channelTitle"), blank).alias("channel_title"),
        lenient_long(st.getField("viewCount")).alias("view_count"),
        lenient_long(st.getField("likeCount")).alias("like_count"),
        lenient_long(st.getField("commentCount")).alias("comment_count"),
        _iso_ts(sn.getField("publishedAt")).alias("published_at"),
        fetched_at.alias("fetched_at"))
    return out.select(*[F.col(f.name).cast(f.dataType) for f in schemas.VIDEO_STATS.fields])


def latest_videos_per_channel(uploads: DataFrame, max_videos: int = 10) -> DataFrame:
    """Newest ``max_videos`` uploads per channel (items without a video id skipped).

    Ties on the upload time go to the larger video id.
    """
    have_id = uploads.where(F.col("video_id").isNotNull() & (F.col("video_id") != ""))
    return latest_per_key(have_id, ["channel_id"],
                          [F.col("published_at").desc_nulls_last(), F.col("video_id").desc()], n=max_videos)
