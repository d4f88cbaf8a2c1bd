"""Table storage for the three layers: fixed schemas, append loads, layer reset.

Tables are Parquet directories under one root (a shared filesystem or object
store path on a cluster).  Appends never rewrite existing files; the insight
table is partitioned by ``model_name`` and the raw tables by ingest day, so
"pending work for model m" and "today's raw rows" read only their partitions.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur import schemas

PARTITIONING = {
    "raw.comments": ["ingest_day"],
    "raw.video_stats": ["fetch_day"],
    "core.comments_curated": [],
    "ml.comment_insights": ["model_name"],
}
_DAY_SOURCE = {"ingest_day": "ingested_at", "fetch_day": "fetched_at"}


def table_path(root: str, table: str) -> str:
    return os.path.join(root, *table.split("."))


def _conformed(df: DataFrame, table: str) -> DataFrame:
    schema = schemas.TABLES[table]
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns
            else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    out = df.select(*cols)
    for p in PARTITIONING[table]:
        if p in _DAY_SOURCE:
            out = out.withColumn(p, F.to_date(F.col(_DAY_SOURCE[p])))
    return out


def append(df: DataFrame, root: str, table: str) -> None:
    """Append rows with the table's fixed schema (no dedup; an empty frame writes no rows)."""
    _conformed(df, table).write.mode("append").partitionBy(*PARTITIONING[table]).parquet(table_path(root, table))


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """The table with its fixed schema (partition helper columns dropped)."""
    from pyspark.sql import types as T
    parts = [T.StructField(p, T.DateType() if p in _DAY_SOURCE else T.StringType(), True)
             for p in PARTITIONING[table] if p not in schemas.TABLES[table].fieldNames()]
    full = T.StructType([f for f in schemas.TABLES[table].fields
                         if f.name not in PARTITIONING[table]] + parts +
                        [f for f in schemas.TABLES[table].fields if f.name in PARTITIONING[table]])
    df = spark.read.schema(full).parquet(table_path(root, table))
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.TABLES[table].fields])


def reset(spark: SparkSession, root: str, table: str) -> None:
    """Drop every row and recreate the table empty with the same schema (irreversible)."""
    empty = spark.createDataFrame([], schemas.TABLES[table])
    _conformed(empty, table).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*PARTITIONING[table]).parquet(
        table_path(root, table))


def ensure_tables(spark: SparkSession, root: str) -> None:
    """Create every missing table empty (idempotent; existing data is untouched)."""
    for table in schemas.TABLES:
        path = table_path(root, table)
        if not exists(spark, path):
            reset(spark, root, table)


def register_views(spark: SparkSession, root: str) -> None:
    """Temp views for the tables first, then the two report views built on them."""
    from murmur.plans import reports
    frames = {t: read(spark, root, t) for t in schemas.TABLES}
    for t, df in frames.items():
        df.createOrReplaceTempView(t.replace(".", "_"))
    reports.comment_insights_report(frames["ml.comment_insights"], frames["core.comments_curated"],
                                    frames["raw.comments"], frames["raw.video_stats"]
                                    ).createOrReplaceTempView("ml_comment_insights_report")
    reports.aspect_sentiment_report(frames["ml.comment_insights"], frames["raw.video_stats"]
                                    ).createOrReplaceTempView("ml_aspect_sentiment_report")


# -- bucketed tables for the anti-joins on comment_id -------------------------------------

BUCKETED = ("core.comments_curated", "ml.comment_insights")


def bucketed_name(table: str) -> str:
    return "murmur_bucketed_" + table.replace(".", "_")


def ensure_bucketed(spark: SparkSession, root: str, buckets: int = 256) -> None:
    """Declare the curated and the insight table under ``root`` as tables bucketed and sorted by
    ``comment_id`` (idempotent; files of earlier sessions are found again).

    A lookup by comment id (pending curation, pending inference) then joins them as they lie:
    only the new side is shuffled, into ``buckets`` partitions, however large the stored side has grown.
    """
    for table in BUCKETED:
        name = bucketed_name(table)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.TABLES[table].fields)
        by, path = PARTITIONING[table], f"{table_path(root, table)}_bucketed"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
                  + (f"PARTITIONED BY ({', '.join(by)}) " if by else "")
                  + f"CLUSTERED BY (comment_id) SORTED BY (comment_id) INTO {buckets} BUCKETS "
                  + f"LOCATION '{path}'")
        if by and exists(spark, path):
            spark.catalog.recoverPartitions(name)


def append_bucketed(df: DataFrame, table: str) -> None:
    """Append rows to a table of ``ensure_bucketed``; rows are dealt by bucket first, so that a task
    writes whole buckets instead of a file for each."""
    spark = df.sparkSession
    name = bucketed_name(table)
    buckets = int(next(r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect() if r["col_name"] == "Num Buckets"))
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
               for f in schemas.TABLES[table].fields]
    rows = df.select(*columns).select(*spark.table(name).columns)
    rows.repartition(buckets, "comment_id").write.insertInto(name)


def read_bucketed(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(bucketed_name(table)).select(*schemas.TABLES[table].fieldNames())


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def stage(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Write an intermediate result under ``spark.checkpoint.dir`` and read it back.

    Cuts lineage between long stages (e.g. annotation stages) so a lost
    executor re-runs only the current stage; the folder is the shared one
    the cluster names, never a machine-local temp dir.
    """
    from murmur.session import ensure_checkpoint_dir
    path = os.path.join(ensure_checkpoint_dir(spark), "stages", f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
