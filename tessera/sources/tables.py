"""Parquet table access.

All inputs are read lazily; column pruning and predicate pushdown are
left to Catalyst (every caller selects the columns it needs, so the scan's
ReadSchema stays narrow).
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A plain scan of one table, split as its files allow."""
    return spark.read.parquet(table_path(sf_dir, name))


def broadcast_if_small(df: DataFrame, max_bytes: int = 8 << 20) -> DataFrame:
    """Hint a broadcast if the plan's own size estimate, in bytes and taken
    anew from the files at every call, is at most ``max_bytes``; otherwise the
    join is left to adaptive execution.  The estimate of a scan is its file
    size and only grows through joins, so it does not understate a table."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(df) if 0 <= size <= max_bytes else df


@contextmanager
def shuffles_released(spark: SparkSession):
    """Shuffle files of what is written here go when it is written, not when
    the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.  For
    loops: unlike ``checkpoint()`` the result's size estimate is that of its
    files, not the product of all estimates before it."""
    import uuid

    from tessera.session import ensure_checkpoint_dir
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/kept/{name}-{uuid.uuid4().hex}"
    with shuffles_released(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clustered(df: DataFrame, *cols, share: int = 1) -> DataFrame:
    """Rows in ranges of ``cols``, each sorted, at least two per core so that
    later scans use every core (over all of ``share`` tables like this one).
    For the narrow rows a derived table is made of: what is computed from them
    row by row keeps their order, so the wide rows are never shuffled, sorted
    or computed for a sample of the ranges."""
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return df.repartitionByRange(-(-n // share), *cols).sortWithinPartitions(*cols)


def stored(spark: SparkSession, name: str, version: str, sf_dir: str, inputs, build) -> DataFrame:
    """A derived table written once to the shared checkpoint folder and read
    back afterwards (as a catalogue or order store is loaded once, then
    queried).  Keyed by the input files (path, size, modification time) and
    ``version``, so changed inputs or a changed builder are rebuilt."""
    import hashlib
    import uuid

    from tessera.session import ensure_checkpoint_dir
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    stamp = []
    for t in inputs:
        hp = jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, t))
        st = hp.getFileSystem(conf).getFileStatus(hp)
        stamp.append(f"{t}:{st.getLen()}:{st.getModificationTime()}")
    key = hashlib.sha1("|".join([sf_dir.rstrip("/"), version, *stamp]).encode()).hexdigest()[:16]
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stored/{name}/{key}"
    marker = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if not marker.getFileSystem(conf).exists(marker):
        df = build()
        # Written aside and moved into place: a reader never sees half of it,
        # and of two jobs that build the same table one wins.
        aside = f"{path}-{uuid.uuid4().hex}"
        with shuffles_released(spark):
            df.write.option("compression", "zstd").parquet(aside)     # documents, and most of what is stored
        fs, source, target = marker.getFileSystem(conf), jvm.org.apache.hadoop.fs.Path(aside), jvm.org.apache.hadoop.fs.Path(path)
        if not fs.exists(marker) and not fs.rename(source, target) and not fs.exists(marker):
            raise RuntimeError(f"cannot move {aside} to {path}")
    return spark.read.parquet(path)
