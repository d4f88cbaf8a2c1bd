"""A key that holds a third of all rows (hot video / hot comment)."""

from pyspark.sql import functions as F

from murmur.plans import metrics, reports
from murmur.sources import fixtures as fx
from tests.conftest import SF_SMALL


def _hot(spark):
    ins = fx.insights(spark, SF_SMALL)
    hot = F.substring("inference_run_id", 2, 20).cast("long") % 3 == 0
    return (ins.withColumn("video_id", F.when(hot, F.lit("v0")).otherwise(F.col("video_id")))
               .withColumn("channel_id", F.when(hot, F.lit("ch0")).otherwise(F.col("channel_id")))
               .withColumn("comment_id", F.when(hot, F.lit("c0.0")).otherwise(F.col("comment_id"))))


def test_latest_run_with_hot_key(spark):
    ins = _hot(spark)
    latest = reports.latest_runs(ins)
    keys = ins.select("video_id", "comment_id").distinct().count()
    assert latest.count() == keys
    hot_row = latest.where((F.col("video_id") == "v0") & (F.col("comment_id") == "c0.0")).collect()
    want = ins.where((F.col("video_id") == "v0") & (F.col("comment_id") == "c0.0")) \
        .orderBy(F.col("inference_ts").desc(), F.col("inference_run_id").desc()).first()
    assert len(hot_row) == 1 and hot_row[0].inference_run_id == want.inference_run_id
    plan = latest._jdf.queryExecution().executedPlan().toString()
    # partial top-1 below the exchange: the hot key ships one row per map task
    assert plan.count("WindowGroupLimit") >= 2


def test_per_video_aggregates_with_hot_video(spark):
    ins = _hot(spark)
    f5 = reports.latest_model_insights(ins, fx.curated(spark, SF_SMALL))
    dist = metrics.sentiment_distribution(f5)
    total = f5.where(F.col("general_sentiment").isNotNull()).count()
    assert dist.agg(F.sum("count")).first()[0] == total
    plan = dist._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan  # map-side partial aggregation before the shuffle


def test_hot_video_is_split_in_the_one_dimension_join(spark):
    """Without broadcast, the comments meet titles and statistics in one join that splits the hot video."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k, None) for k in keys}
    raw, cur = fx.raw_comments(spark, SF_SMALL), fx.curated(spark, SF_SMALL)
    ins = fx.insights(spark, SF_SMALL)
    many = spark.range(3000).select(F.concat(F.lit("x"), "id").alias("comment_id"))
    hot_ins = many.select(*[(F.col("comment_id") if f == "comment_id" else F.lit("v0") if f == "video_id" else F.lit("ch0") if f == "channel_id" else F.lit(None)).cast(t.dataType).alias(f)
                            for f, t in ((x.name, x) for x in ins.schema.fields)])
    hot_cur = many.select(*[(F.col("comment_id") if f.name == "comment_id" else F.lit("v0") if f.name == "video_id" else F.lit("ch0") if f.name == "channel_id"
                             else F.concat(F.lit("text "), F.sha2("comment_id", 256)) if f.name == "text_clean" else F.lit(None)).cast(f.dataType).alias(f.name) for f in cur.schema.fields])
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        report = reports.comment_insights_report(ins.unionByName(hot_ins), cur.unionByName(hot_cur), raw, fx.video_stats(spark, SF_SMALL))
        rows = report.collect()
        p = report._jdf.queryExecution().executedPlan().toString()
        assert sum(r.video_id == "v0" and r.comment_id.startswith("x") for r in rows) == 3000
        assert "skew=true" in p
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
