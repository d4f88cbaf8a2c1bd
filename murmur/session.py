"""Spark session helpers.

The library never hard-codes cluster settings.  ``get_session`` only fills in
values that are *unset*, so a cluster-provided configuration (shuffle
partitions, checkpoint dir, AQE knobs) always wins.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Defaults for local runs and tests; a cluster config overrides every one.
LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # let a join reuse a partitioning on a subset of its keys: the latest-run
    # window is partitioned by (video_id, comment_id) and the curated join adds
    # channel_id, so the insights side is shuffled once instead of twice
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}
# Settings of the application itself, for sessions that this function starts on one machine.
LOCAL_APPLICATION = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "murmur", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    given = dict(extra or {})
    if shuffle_partitions:
        given.setdefault("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            given = {**LOCAL_APPLICATION, **given}
    for k, v in given.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    set_by_cluster = spark.sparkContext.getConf()
    for k, v in LOCAL_DEFAULTS.items():
        if k not in given and not set_by_cluster.contains(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is given by the session configuration and must be
    on shared storage.  Only when it is unset in a local session (tests) do we pick a
    fresh scratch folder ourselves; a cluster without the setting is an error, as executors
    do not see the driver's folders.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not fallback and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        current = fallback or tempfile.mkdtemp(prefix="murmur-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(current)
    return current


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make the package importable in the executors' Python workers, once per application (functions
    that run there are pickled by reference)."""
    sc = spark.sparkContext
    root = os.path.dirname(os.path.abspath(__file__))
    if sc.applicationId in _shipped or not os.path.isdir(root):      # sent already, or itself an archive
        return
    _shipped.add(sc.applicationId)
    archive = os.path.join(tempfile.mkdtemp(prefix="murmur-package-"), "murmur_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.join(os.path.basename(root), os.path.relpath(path, root)))
    sc.addPyFile(archive)
