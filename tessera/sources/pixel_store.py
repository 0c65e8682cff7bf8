"""A store of pixel observations, read by cell.

Files are partitioned by tile and sorted by time within, so that a worker's
cells prune to their folders (dynamic partition pruning on the work keys) and a
time slice to the row groups that meet it.  Broken files are skipped on demand,
as broken scenes are in a load, and reported as rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.lenses import TILE_KEYS


def write_pixels(obs: DataFrame, path: str, t: str = "t") -> None:
    """Brought together by tile first (adaptive execution splits large ones)."""
    (obs.hint("rebalance", *TILE_KEYS).sortWithinPartitions(*TILE_KEYS, t)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*TILE_KEYS).parquet(path))


def read_pixels(spark: SparkSession, path: str, schema, keys: DataFrame | None = None, time: tuple | None = None,
                skip_broken: bool = False, t: str = "t") -> DataFrame:
    """Pixels of the cells in ``keys`` (all without) whose time lies in the
    closed slice ``time``.  ``schema`` is the stored one, so that no file has
    to be opened to plan.  With ``skip_broken`` files that cannot be read give
    no rows (see :func:`broken_files`), else they fail the job."""
    pixels = spark.read.schema(schema).option("ignoreCorruptFiles", str(skip_broken).lower()).parquet(path)
    if time is not None:
        lo, hi = (F.lit(x).cast("timestamp_ntz") for x in time)
        pixels = pixels.where((F.col(t) >= lo) & (F.col(t) <= hi))
    if keys is None:
        return pixels
    k = keys.select(*TILE_KEYS).distinct()
    # The keys' own range: prunes folders while planning, and makes the join's
    # filter one that is pushed to the scan when it runs.
    b = k.agg(*[f(c).alias(f"{n}_{c}") for c in TILE_KEYS for n, f in (("lo", F.min), ("hi", F.max))]).first()
    if b[0] is None:
        return pixels.where(F.lit(False))
    for c in TILE_KEYS:
        inside = F.col(c).between(b[f"lo_{c}"], b[f"hi_{c}"])
        k, pixels = k.where(inside), pixels.where(inside)
    return pixels.join(k, list(TILE_KEYS), "left_semi")


def broken_files(spark: SparkSession, path: str, rows: DataFrame | None = None) -> DataFrame:
    """(path, error) of the store's files that cannot be read: each file's
    footer is opened in an executor task.  With ``rows`` (what was read, with
    its hidden file metadata) also files that gave fewer rows than they hold."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path).select("path", "length")

    def footers(batches):
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq
        for pdf in batches:
            errors, counts = [], []
            for p in pdf["path"]:
                error, n = None, None
                try:
                    fs, name = pafs.FileSystem.from_uri(p.replace("file:/", "file:///", 1) if p.startswith("file:/") and not p.startswith("file://") else p)
                    with fs.open_input_file(name) as f:
                        n = pq.ParquetFile(f).metadata.num_rows
                except Exception as e:  # reported, not raised
                    error = f"{type(e).__name__}: {e}"
                errors.append(error)
                counts.append(n)
            yield pdf[["path"]].assign(error=errors, n_rows=counts)
    seen = files.mapInPandas(footers, "path string, error string, n_rows double")
    if rows is not None:
        got = rows.groupBy(F.col("_metadata.file_path").alias("_p")).agg(F.count(F.lit(1)).alias("_got"))
        plain = F.regexp_replace("path", "^file:/+", "file:/")
        seen = seen.join(got, plain == F.regexp_replace("_p", "^file:/+", "file:/"), "left").withColumn(
            "error", F.coalesce("error", F.when(F.coalesce("_got", F.lit(0)) < F.col("n_rows"), F.lit("rows are missing"))))
    return seen.where("error IS NOT NULL").select("path", "error")
