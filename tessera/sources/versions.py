"""Versioned tables: upserts that are seen whole or not at all.

A table is a folder with one folder of Parquet files per version and a pointer
file per version number under ``_versions``.  A writer writes its files first,
under a name of its own, and then claims the next number by creating the
pointer, which names the files; creating a file that exists fails, so of two
writers one wins and the other starts again from the newer version.  A reader
takes the highest pointer.  A write that fails leaves files that no pointer
names: the table is unchanged.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Conflict(RuntimeError):
    """Other writers took every number that was tried."""


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._dir = self._hadoop("_versions")
        self._fs = self._dir.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _hadoop(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def version(self) -> int:
        """The newest version, 0 before the first write."""
        if not self._fs.exists(self._dir):
            return 0
        names = [f.getPath().getName() for f in self._fs.listStatus(self._dir)]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def _files(self, version: int) -> str:
        stream = self._fs.open(self._hadoop(f"_versions/{version:012d}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        """The newest or a given version."""
        version = version or self.version()
        if not version:
            raise FileNotFoundError(f"{self.path} has no version yet")
        return self.spark.read.parquet(f"{self.path}/{self._files(version)}")

    def _claim(self, version: int, files: str) -> bool:
        try:
            out = self._fs.create(self._hadoop(f"_versions/{version:012d}"), False)
        except Exception as e:
            if "AlreadyExists" in str(e) or "already exists" in str(e):
                return False
            raise
        out.write(bytearray(files.encode()))
        out.close()
        return True

    def update(self, build: Callable[[DataFrame | None], DataFrame], tries: int = 5) -> int:
        """Write ``build(newest version or None)`` as the next version."""
        for _ in range(tries):
            base = self.version()
            files = f"data-{uuid.uuid4().hex}"
            build(self.read(base) if base else None).write.parquet(f"{self.path}/{files}")
            if self._claim(base + 1, files):
                return base + 1
        raise Conflict(f"{self.path}: {tries} writers were faster")

    def upsert(self, changes: DataFrame, key: str = "id") -> int:
        """Rows of ``changes`` replace or join those of the table and get
        ``updated`` = now, all others keep theirs; a key that stands twice in
        ``changes`` fails the write."""
        from tessera.operators.lineage import stamp_updates
        twice = changes.groupBy(key).count().where("count > 1")
        if not twice.isEmpty():
            raise ValueError(f"{key} stands twice in the changes")

        def build(current):
            if current is None:
                return changes.withColumn("updated", F.current_timestamp())
            return stamp_updates(current, changes, key)
        return self.update(build)

