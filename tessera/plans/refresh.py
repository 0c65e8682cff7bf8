"""Refresh of the materialised footprint / time / space-time views.

Full recompute in dependency order (space → time → space_time), each
written with overwrite to Parquet; the space-time view is built from the
two freshly written tables, both partitioned by product so later product
searches prune files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.catalogue import space_view, time_view


def refresh_views(spark: SparkSession, dataset: DataFrame, metadata_type: DataFrame, root: str,
                  version: str = "v2") -> dict[str, str]:
    root = root.rstrip("/")
    paths = {k: f"{root}/{k}_view" for k in ("space", "time", "space_time")}
    space_view(dataset, metadata_type, version).write.mode("overwrite").parquet(paths["space"])
    # One task per product (adaptive execution splits large ones), so a
    # product folder does not get a file from every task.
    def by_product(df):
        return df.hint("rebalance", "dataset_type_ref").write.mode("overwrite").partitionBy("dataset_type_ref")

    by_product(time_view(dataset, metadata_type, version)).parquet(paths["time"])
    st = spark.read.parquet(paths["space"]).join(spark.read.parquet(paths["time"]), "id") \
        .select("id", "dataset_type_ref", "rings", "srid", "temporal_extent")
    by_product(st).parquet(paths["space_time"])
    return paths
