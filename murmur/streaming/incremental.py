"""Incremental curation and annotation with Structured Streaming.

The batch pipeline finds new work with anti-joins against the target table.
As streams, a file source plus its checkpoint remembers which raw files were
already read, and each micro-batch runs the same batch operators through
``foreachBatch``:

* ``curate_stream``   raw rows -> anti-join against what the sink already holds
                      -> curation.  No watermark: late rows and rows without an
                      id are curated like any other.
* ``annotate_stream`` curated rows -> pending for the model (anti-join against
                      the insight table) -> labeller -> insight rows.

Every micro-batch writes to its own ``batch_id=N`` folder with overwrite and
leaves that folder out when it looks up what is done already, so a batch
retried after a failure replaces its own output: it neither loses nor repeats
rows.  Use ``trigger(availableNow=True)`` for scheduled catch-up runs.

A batch's rows lie in ``bucket=K`` folders by the hash of ``comment_id`` (insights also by ``model_name``).
The lookup reads only the buckets that the batch's own comments fall into, so a small batch
does not read the whole sink; the buckets are as many at any size, and their list is all that the
driver sees.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur import schemas
from murmur.operators import annotate, curate, langid
from murmur.sources.storage import exists


BUCKETS = 256


def bucket(comment_id) -> Column:
    return F.pmod(F.xxhash64(comment_id), F.lit(BUCKETS)).cast("int")


def done(batch: DataFrame, out_dir: str, schema: str, batch_id: int, where: Column | None = None) -> DataFrame:
    """Key columns of what other batches wrote into the buckets of ``batch`` (``schema``: a DDL string
    of those columns)."""
    spark = batch.sparkSession
    if not exists(spark, out_dir):
        return spark.createDataFrame([], schema)
    own = [r[0] for r in batch.where(F.col("comment_id").isNotNull()).select(bucket("comment_id")).distinct().collect()]
    rows = spark.read.schema(f"{schema}, batch_id long, bucket int").parquet(out_dir)
    rows = rows.where(F.col("bucket").isin(own) & (F.col("batch_id") != batch_id))
    return (rows if where is None else rows.where(where)).drop("batch_id", "bucket")


def batch_writer(out_dir: str, build, *partitions: str):
    """``foreachBatch`` function: ``build(batch, batch_id)`` replaces the batch's own folder."""
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = build(batch, batch_id).withColumn("bucket", bucket("comment_id"))
        # one file a bucket, not one a bucket and task
        (rows.repartition("bucket").write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(*partitions, "bucket").parquet(os.path.join(out_dir, f"batch_id={batch_id}")))
    return write


def curate_batch_writer(spark: SparkSession, out_dir: str, language_model: langid.Model | None = None):
    def build(batch: DataFrame, batch_id: int) -> DataFrame:
        return curate.curate(curate.pending_curation(batch, done(batch, out_dir, "comment_id string", batch_id)), language_model)
    return batch_writer(out_dir, build)


def curate_stream(spark: SparkSession, raw_dir: str, out_dir: str, checkpoint: str,
                  language_model: langid.Model | None = None, available_now: bool = True):
    """Start (and, with ``available_now``, run to completion) the curation stream."""
    raw = spark.readStream.schema(schemas.RAW_COMMENTS).parquet(raw_dir)
    q = (raw.writeStream.foreachBatch(curate_batch_writer(spark, out_dir, language_model))
         .option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()


def annotate_batch_writer(spark: SparkSession, insights_dir: str, model_name: str = "lexicon"):
    def build(batch: DataFrame, batch_id: int) -> DataFrame:
        seen = done(batch, insights_dir, "comment_id string, model_name string", batch_id, F.col("model_name") == model_name)
        return annotate.lexicon_insight_rows(annotate.pending_inference(batch, seen, model_name), model_name)
    return batch_writer(insights_dir, build, "model_name")


def annotate_stream(spark: SparkSession, curated_dir: str, insights_dir: str, checkpoint: str,
                    model_name: str = "lexicon", available_now: bool = True):
    """Label curated rows the model has not seen yet with the offline labeller."""
    curated_rows = spark.readStream.schema(schemas.CURATED_COMMENTS).parquet(curated_dir)
    q = (curated_rows.writeStream.foreachBatch(annotate_batch_writer(spark, insights_dir, model_name))
         .option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()
