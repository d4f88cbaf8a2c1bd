"""Raw -> curated: pick up raw rows not yet curated and clean them.

* ``pending_curation``: a left-anti join on ``comment_id`` (NULL ids never
  match, so they come back every run, as in the warehouse version); an
  optional ``limit`` keeps the first rows by ``(ingested_at, comment_id)``.
* ``curate``: one projection -> text clean-up, language, lengths, flags.
* ``curate_dedup``: opt-in variant that keeps only the newest raw row per id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmur import schemas
from murmur.functions.text import char_len, clean_text, token_count
from murmur.operators import langid
from murmur.operators.latest import latest_per_key, newest_first

RAW_COLUMNS = ["comment_id", "video_id", "channel_id", "text_original", "parent_id",
               "author_channel_id", "like_count"]


def pending_curation(raw: DataFrame, curated: DataFrame, limit: int | None = None) -> DataFrame:
    """Raw rows whose ``comment_id`` is not in the curated table (duplicates all pass)."""
    cols = RAW_COLUMNS + [c for c in ("ingested_at",) if c in raw.columns]
    new = raw.select(*cols).join(curated.select("comment_id"), "comment_id", "left_anti")
    if limit is not None and limit > 0:
        new = new.orderBy(F.col("ingested_at").asc_nulls_last(), F.col("comment_id").asc_nulls_last()).limit(limit)
    return new


def curate(raw: DataFrame, language_model: langid.Model | None = None) -> DataFrame:
    """Curated rows with the fixed ``core.comments_curated`` schema.

    ``language_model`` is a fitted ``murmur.operators.langid`` model; without
    one the language is left NULL (and ``is_turkish`` false).
    """
    text = clean_text(F.col("text_original"))
    staged = raw.select(*[F.col(c) for c in RAW_COLUMNS if c != "text_original"], text.alias("text_clean"))
    if language_model is not None:
        staged = langid.predict(staged, "text_clean", language_model, "language")
    else:
        staged = staged.withColumn("language", F.lit(None).cast("string"))
    return staged.select(
        "comment_id", "video_id", "channel_id", "text_clean", "language",
        F.coalesce(F.col("language").startswith("tr"), F.lit(False)).alias("is_turkish"),
        F.col("parent_id").isNotNull().alias("is_reply"),
        "parent_id", "author_channel_id",
        F.col("like_count").cast("bigint").alias("like_count"),
        char_len(F.col("text_clean")).alias("comment_len_chars"),
        token_count(F.col("text_clean")).alias("comment_len_tokens"),
        F.current_timestamp().alias("curated_at"),
    ).select(*[F.col(f.name).cast(f.dataType) for f in schemas.CURATED_COMMENTS.fields])


def curate_dedup(raw: DataFrame, curated: DataFrame, language_model: langid.Model | None = None) -> DataFrame:
    """Pending rows reduced to the newest observation per ``comment_id``, then curated.

    Rows without an id are no observations of one comment: they all stay (and come back in every
    run, as the anti-join never finds them done)."""
    order = newest_first(raw, "ingested_at", ["updated_at", "like_count", "text_original"])
    alone = F.when(F.col("comment_id").isNull(), F.monotonically_increasing_id())      # a key of its own
    newest = latest_per_key(raw.withColumn("_alone", alone), ["comment_id", "_alone"], order).drop("_alone")
    return curate(pending_curation(newest, curated), language_model)


def language_model(examples: DataFrame, text_col: str = "text", lang_col: str = "lang",
                   max_grams: int = langid.MAX_GRAMS) -> langid.Model:
    """Fit the language model on raw labelled text, cleaned exactly as curation does."""
    cleaned = examples.select(clean_text(F.col(text_col)).alias("text_clean"), F.col(lang_col).alias("lang"))
    return langid.fit(cleaned, max_grams=max_grams)
