"""Composite sinks (S17-S21): pixel and block layouts, product documents,
output keys.

Files are written by Spark's writers, partitioned by product and time so
each task writes its own files and a rerun overwrites only its partitions
(dynamic partition overwrite): jobs are idempotent and survive executor
loss.  GeoTIFF / Zarr codecs are replaced by Parquet layouts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.names import COMPOSITE_PRODUCT, month_end_label, tile_product_name

LAYOUTS = {"cog": "pixel", "zarr": "block"}


def product_documents(comp: DataFrame, bands, prefix: str,
                      product: str = COMPOSITE_PRODUCT) -> DataFrame:
    """S21 + S20: one metadata document per (tile, month) product: family,
    label, datetime = last day of the month, processing time, a note per
    band with its file name and the object key under ``prefix`` (key =
    prefix + path relative to the product folder's parent), file format."""
    keys = comp.select("tile_x", "tile_y", "month").distinct()
    label = tile_product_name(product, "tile_x", "tile_y", "month")
    meas = F.create_map(*[x for b in bands for x in (
        F.lit(b.lower()), F.struct(
            F.concat(label, F.lit(f"_{b}.tif")).alias("path"),
            F.concat_ws("/", F.lit(prefix.rstrip("/")), label,
                        F.concat(label, F.lit(f"_{b}.tif"))).alias("key")))])
    return keys.select(
        "tile_x", "tile_y", "month",
        label.alias("label"), F.lit(product).alias("product_family"),
        month_end_label("month").alias("datetime"),
        F.current_timestamp().alias("processed"),
        meas.alias("measurements"), F.lit("GeoTIFF").alias("file_format"))


def pixel_layout(comp: DataFrame) -> DataFrame:
    """One row per pixel; partition columns chosen by the writer."""
    return comp.withColumn("year", F.year("month")).withColumn("mon", F.month("month"))


def block_layout(comp: DataFrame, bands, chunk_rows: int = 256) -> DataFrame:
    """Chunked array form — per (tile, month, band, row chunk) the band
    values ordered by (py, px).  A chunk holds at most ``chunk_rows`` pixel
    rows of one tile, so every collected array has a fixed upper bound."""
    long = comp.select("tile_x", "tile_y", "month", "px", "py",
                       F.explode(F.map_from_arrays(F.array(*[F.lit(b) for b in bands]),
                                                   F.array(*[F.col(b).cast("double") for b in bands])))
                       .alias("band", "value"))
    long = long.withColumn("chunk", F.floor(F.col("py") / chunk_rows).cast("int"))
    g = long.groupBy("tile_x", "tile_y", "month", "band", "chunk").agg(
        F.array_sort(F.collect_list(F.struct("py", "px", "value"))).alias("_c"))
    return g.select("tile_x", "tile_y", "month", "band", "chunk",
                    F.transform("_c", lambda s: s["px"]).alias("px"),
                    F.transform("_c", lambda s: s["py"]).alias("py"),
                    F.transform("_c", lambda s: s["value"]).alias("values"))


def layout_for(storage: str) -> str:
    """S19: 'cog' → pixel layout, 'zarr' → block layout (case-insensitive)."""
    try:
        return LAYOUTS[storage.lower()]
    except KeyError:
        raise ValueError(f"Unknown storage: {storage}") from None


def save_composites(comp: DataFrame, path: str, bands, storage: str = "cog",
                    product: str = COMPOSITE_PRODUCT) -> None:
    """Write composites in the chosen layout, partitioned by
    product, year, month (dynamic partition overwrite)."""
    layout = layout_for(storage)
    out = pixel_layout(comp) if layout == "pixel" else block_layout(comp, bands)
    out = out.withColumn("product", F.lit(product)).withColumn("year", F.year("month")) \
        .withColumn("mon", F.month("month"))
    # Brought together by folder first (adaptive execution splits large ones).
    (out.hint("rebalance", "product", "year", "mon").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("product", "year", "mon").parquet(path))


def save_documents(docs: DataFrame, path: str) -> None:
    """S21 sink: documents as JSON lines, one file set per run."""
    docs.select(F.to_json(F.struct(*docs.columns)).alias("value")).write.mode("overwrite").text(path)
