"""Checked queries: sinks written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tessera.functions.geometry import wkt
from tessera.functions.names import COMPOSITE_PRODUCT, versioned_path
from tessera.operators import grid
from tessera.operators import objects as obj
from tessera.operators.composite import monthly_composite
from tessera.plans.do_work import mask_and_scale, monthly_median_products
from tessera.plans.oracle_lenses import MS, OBS, SCENE, TILE_MONTHS, name_sql
from tessera.plans.q_catalogue import _space_sql
from tessera.plans.q_composite import REGISTRY_SQL_A7
from tessera.plans.q_grid import _KEYS_SQL
from tessera.plans.q_objects import DEM
from tessera.plans.registry import query
from tessera.session import ensure_checkpoint_dir
from tessera.sources import catalogue as cat
from tessera.sources import objects as src
from tessera.sources.lenses import DEM_ROOT, dem_datasets, footprints, observations
from tessera.sources.sinks import save_composites


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sinks/{name}-{uuid.uuid4().hex}"


@query("s17_composite_pixels", covers=("S17", "S19"), sql=f"""
SELECT tile_x, tile_y, px, py, month, red, green, blue, n_obs, year(month) AS year, month(month) AS mon FROM ({REGISTRY_SQL_A7})""")
def s17_composite_pixels(spark, sf_dir):
    """Composites saved as 'COG' (the pixel layout) and read back."""
    path = _folder(spark, "cog")
    save_composites(monthly_median_products(observations(spark, sf_dir)).drop("name"), path, ("red", "green", "blue"), "COG")
    back = spark.read.parquet(path).where(F.col("product") == COMPOSITE_PRODUCT)
    return back.select("tile_x", "tile_y", "px", "py", "month", "red", "green", "blue", "n_obs",
                       F.col("year").cast("long").alias("year"), F.col("mon").cast("long").alias("mon"))


@query("s18_composite_blocks", covers=("S18", "S19"), sql=f"""
WITH a AS ({REGISTRY_SQL_A7}),
l AS (SELECT tile_x, tile_y, month, px, py, 'red' AS band, red AS value FROM a UNION ALL SELECT tile_x, tile_y, month, px, py, 'green', green FROM a
      UNION ALL SELECT tile_x, tile_y, month, px, py, 'blue', blue FROM a)
SELECT tile_x, tile_y, month, band, CAST(py // 256 AS INTEGER) AS chunk, list(px ORDER BY py, px) AS px, list(py ORDER BY py, px) AS py,
       list(value ORDER BY py, px) AS values FROM l GROUP BY ALL""")
def s18_composite_blocks(spark, sf_dir):
    """Composites saved as 'zarr' (the block layout) and read back: every
    value of every block."""
    path = _folder(spark, "zarr")
    save_composites(monthly_median_products(observations(spark, sf_dir)).drop("name"), path, ("red", "green", "blue"), "zarr")
    return spark.read.parquet(path).select("tile_x", "tile_y", "month", "band", "chunk", "px", "py", "values")


@query("s16_cell_manifest", covers=("S16", "J6"), sql=_KEYS_SQL + """,
w AS (SELECT tile_x, tile_y FROM b UNION ALL SELECT DISTINCT tile_x + 900, tile_y FROM b WHERE batch_id = 0)
SELECT w.tile_x, w.tile_y, count(c.c_custkey) AS n_datasets, count(c.c_custkey) = 0 AS missing
FROM w LEFT JOIN cells c ON c.tile_x = w.tile_x AND c.tile_y = w.tile_y GROUP BY w.tile_x, w.tile_y""")
def s16_cell_manifest(spark, sf_dir):
    """The cell manifest written by tile, then looked up for every worker's
    keys and for keys that it does not hold."""
    cells = grid.tile_cells(footprints(spark, sf_dir), 1.0)
    path = _folder(spark, "cells")
    grid.write_cells(cells.select("c_custkey", "tile_x", "tile_y"), path)
    back = grid.read_cells(spark, path)
    batches = grid.batch_keys(grid.distinct_keys(back), 8)
    work = batches.select("tile_x", "tile_y").unionByName(
        batches.where("batch_id = 0").select((F.col("tile_x") + 900).alias("tile_x"), "tile_y"))
    found, missing = grid.lookup_cells(work, back)
    hits = found.groupBy("tile_x", "tile_y").agg(F.count(F.lit(1)).alias("n_datasets"))
    miss = missing.select("tile_x", "tile_y", F.lit(0).cast("long").alias("n_datasets"))
    return hits.unionByName(miss).withColumn("missing", F.col("n_datasets") == 0)


@query("s13_document_rewrite", covers=("S13", "S12", "X5"), sql=f"""
WITH {DEM} SELECT '{DEM_ROOT}/v2020_2/' || name AS dst, true AS ok, CAST(NULL AS VARCHAR) AS error,
  name || '-v2020_2' AS label, CAST(n_chars AS BIGINT) AS n_chars FROM dem""")
def s13_document_rewrite(spark, sf_dir):
    """Copy-edit-write chained: documents parsed, edited, written as YAML files
    from executor tasks, read back from the store and parsed again."""
    root = _folder(spark, "documents")
    uri = root if "://" in root else root.replace("file:", "") if root.startswith("file:") else root
    d = dem_datasets(spark, sf_dir)
    parsed = src.yaml_documents(d.select("dir", "yaml"), "yaml", "dir")
    done = obj.write_documents(parsed.select(versioned_path("dir").alias("dst"), obj.edit_document("doc").alias("doc")), uri + "/")
    done = done.checkpoint(eager=True)
    files = src.read_paths(done.select(F.concat("dst", F.lit("/odc-metadata.yaml")).alias("path")), uri + "/") \
        .select(F.regexp_extract("path", "^(.*)/odc-metadata.yaml$", 1).alias("dst"), F.decode("content", "UTF-8").alias("y"))
    back = src.yaml_documents(files, "y", "dst").select("dst", F.parse_json("doc").alias("d"))
    return done.join(back, "dst", "left").select("dst", "ok", "error", F.variant_get("d", "$.label", "string").alias("label"),
                                                 F.variant_get("d", "$.properties.n_chars", "bigint").alias("n_chars"))


@query("s23_view_refresh", covers=("S23", "J2"), sql=f"""
WITH {SCENE}, sp AS ({_space_sql(True)})
SELECT sp.id, scene.dataset_type_ref, sp.wkt, scene.t - CASE WHEN mtype = 'eo3_landsat_ard' THEN INTERVAL 10 SECOND ELSE INTERVAL 0 SECOND END AS t_lo
FROM sp JOIN scene ON sp.id = scene.id""")
def s23_view_refresh(spark, sf_dir):
    """The three views refreshed in dependency order, the last one read back."""
    from tessera.plans.refresh import refresh_views
    paths = refresh_views(spark, cat.dataset(spark, sf_dir), cat.metadata_type(spark, sf_dir), _folder(spark, "views"))
    st = spark.read.parquet(paths["space_time"])
    return st.select("id", F.col("dataset_type_ref").cast("short").alias("dataset_type_ref"), wkt("rings").alias("wkt"),
                     F.col("temporal_extent.lo").alias("t_lo"))


@query("x3_user_aggregate", covers=("X3",), sql=f"""
WITH {OBS}, {MS}, {TILE_MONTHS}
SELECT p.tile_x, p.tile_y, p.px, p.py, c.month, round(max(o.red) - min(o.red), 8) AS red, count(o.t) AS n_obs
FROM pix p JOIN cal c ON c.tile_x = p.tile_x AND c.tile_y = p.tile_y
LEFT JOIN ms o ON o.tile_x = p.tile_x AND o.tile_y = p.tile_y AND o.px = p.px AND o.py = p.py
     AND o.t BETWEEN c.month AND c.month + INTERVAL 1 MONTH
GROUP BY ALL""")
def x3_user_aggregate(spark, sf_dir):
    """The monthly composite with the user's own aggregate, here the spread."""
    ms = mask_and_scale(observations(spark, sf_dir), bands=("red",))
    m = monthly_composite(ms, ["red"], reduce=lambda b: F.max(b) - F.min(b))
    return m.withColumn("red", F.round("red", 8))


@query("s14_cell_pixels", covers=("S14", "J6", "P7"), sql=f"""
WITH {OBS}, b AS (SELECT tile_x, tile_y FROM (SELECT DISTINCT tile_x, tile_y FROM obs) ORDER BY tile_y, tile_x LIMIT 2)
SELECT o.tile_x, o.tile_y, px, py, t, red, green, blue, qa FROM obs o JOIN b USING (tile_x, tile_y)
WHERE t BETWEEN TIMESTAMP '1995-01-01 00:00:00' AND TIMESTAMP '1996-06-30 00:00:00'""")
def s14_cell_pixels(spark, sf_dir):
    """Pixels stored by tile and read back for the first batch of work keys
    and a time slice."""
    from tessera.sources import pixel_store
    obs = observations(spark, sf_dir)
    path = _folder(spark, "pixels")
    pixel_store.write_pixels(obs, path)
    batch = grid.batch_keys(grid.distinct_keys(obs), 2).where("batch_id = 0")
    back = pixel_store.read_pixels(spark, path, obs.schema, batch, ("1995-01-01 00:00:00", "1996-06-30 00:00:00"), skip_broken=True)
    return back.select("tile_x", "tile_y", "px", "py", "t", "red", "green", "blue", "qa")


@query("s15_saved_work_list", covers=("S15", "W2"), sql=_KEYS_SQL + """
SELECT batch_id, list([tile_x, tile_y] ORDER BY tile_y, tile_x) AS keys FROM b GROUP BY batch_id""")
def s15_saved_work_list(spark, sf_dir):
    """The work list written as JSON lines and read back as a worker does."""
    cells = grid.tile_cells(footprints(spark, sf_dir), 1.0)
    path = _folder(spark, "work")
    grid.write_work_list(grid.batch_keys(grid.distinct_keys(cells), 8), path)
    return spark.read.schema("batch_id long, keys array<array<int>>").json(path)


@query("s21_saved_documents", covers=("S21", "S20"), sql=f"""
WITH {OBS}, {TILE_MONTHS}, p AS (SELECT DISTINCT tile_x, tile_y, month, {name_sql(COMPOSITE_PRODUCT, 'tile_x', 'tile_y', 'month')} AS label FROM cal)
SELECT label, '{COMPOSITE_PRODUCT}' AS product_family, strftime(CAST(month + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE), '%Y-%m-%d') AS datetime,
  'out/' || label || '/' || label || '_green.tif' AS green_key, true AS has_time
FROM p""")
def s21_saved_documents(spark, sf_dir):
    """The product documents saved as JSON lines and read back."""
    from tessera.operators.composite import tile_month_range
    from tessera.sources.sinks import product_documents, save_documents
    rng = tile_month_range(observations(spark, sf_dir))
    months = rng.select("tile_x", "tile_y", F.explode(F.sequence("first_month", "last_month", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    path = _folder(spark, "products")
    save_documents(product_documents(months, ("red", "green", "blue"), "out/"), path)
    d = spark.read.text(path).select(F.parse_json("value").alias("d"))

    def at(name):
        return F.variant_get("d", name, "string")
    return d.select(at("$.label").alias("label"), at("$.product_family").alias("product_family"), at("$.datetime").alias("datetime"),
                    at("$.measurements.green.key").alias("green_key"), at("$.processed").isNotNull().alias("has_time"))
