"""Spark session defaults for tessera jobs.

Everything runs with the session zone pinned to UTC (catalogue timestamps
are UTC by definition), adaptive execution on (runtime broadcast decisions,
partition coalescing and skew-join splitting) and the Spark UI off.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A partition is "skewed" when 5x the median and over 64 MB: split it.
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.files.ignoreCorruptFiles": "false",
}


def get_session(master: str | None = None, app: str = "tessera",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with tessera's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small ones anyway).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate on an existing session ignores builder conf for SQL
    # options: set the runtime-settable ones explicitly.
    for k, v in conf.items():
        if k.startswith("spark.sql.") and k != "spark.sql.files.ignoreCorruptFiles":
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf on a live session
                pass
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment to a shared file
    system; a machine-local temp folder would not survive executor loss.
    Only a local-mode session without the setting (tests, laptops) gets a
    fresh temp folder of its own.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if path:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(path)
        return path
    if sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: configure a shared folder "
            "(HDFS/S3A/ABFS) for lineage cuts on a cluster")
    path = tempfile.mkdtemp(prefix="tessera-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return path
