"""Gridding scenes into tiles and batching work.

J4 (scene × tile range join) is rewritten as an equi key: each footprint
explodes the tile keys its bounding box touches (a ``sequence`` per axis),
and only those candidate (scene, tile) rows are tested exactly with the
polygon predicate (G8).  No nested-loop join, no cross product: the work
per scene is proportional to the number of tiles it covers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.geometry import bbox, box_rings, edges, intersects, point_in_rings, project_rings, segments_touch
from tessera.session import ensure_checkpoint_dir


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def touching_tile_range(lo, hi, size: float) -> Column:
    """Tile indices whose closed extent [i*size, (i+1)*size] meets [lo, hi]
    (a tile that only touches the range is included)."""
    s = F.lit(float(size))
    return F.sequence((F.ceil(_c(lo) / s) - 1).cast("int"), F.floor(_c(hi) / s).cast("int"))


def tile_cells(scenes: DataFrame, size: float, rings: str = "rings", srid=None,
               region: Column | None = None, exact: bool = True) -> DataFrame:
    """(tile_x, tile_y) × scene rows for every tile a footprint intersects.

    ``scenes`` holds a ``rings`` column in lon/lat; with ``srid`` the rings
    are projected to the grid CRS first (G5).  ``region`` (rings literal in
    the grid CRS) additionally restricts tiles to those meeting the query
    region, as a grid workflow does for a polygon query.
    """
    g = scenes
    if srid is not None and srid != 4326:
        g = g.withColumn(rings, project_rings(rings, srid))
    g = g.withColumn("_bb", bbox(rings))
    cand = (g.withColumn("tile_x", F.explode(touching_tile_range("_bb.xmin", "_bb.xmax", size)))
             .withColumn("tile_y", F.explode(touching_tile_range("_bb.ymin", "_bb.ymax", size))))
    tile = box_rings(F.col("tile_x") * size, F.col("tile_y") * size,
                     (F.col("tile_x") + 1) * size, (F.col("tile_y") + 1) * size)
    cand = cand.withColumn("_tile", tile)
    if exact:
        cand = cand.where(intersects(rings, "_tile"))
    if region is not None:
        cand = cand.withColumn("_region", region).where(intersects("_region", "_tile")).drop("_region")
    return cand.drop("_bb", "_tile")


def _box_inside(rings, box) -> Column:
    """A box lies in the interior of the polygon: no edge of the polygon comes
    near it and a corner is inside."""
    cell = edges(box)
    free = ~F.exists(edges(rings), lambda e: F.exists(cell, lambda f: segments_touch(e, f)))
    corner = box[0][0]
    empty = ~F.exists(F.flatten(rings), lambda p: (p["x"] >= box[0][0]["x"]) & (p["x"] <= box[0][2]["x"])
                      & (p["y"] >= box[0][0]["y"]) & (p["y"] <= box[0][2]["y"]))
    return free & empty & point_in_rings(corner, rings)


def cover(areas: DataFrame, key: str, size: float, rings: str = "rings") -> DataFrame:
    """Each area as cells of a quad-tree over the tile grid: (key, level,
    cell_x, cell_y, inside).  A cell of level l is 2**l tiles wide.  Cells that
    lie inside the area stay as coarse as they are; cells at its edge are split
    down to single tiles, of which those that meet the area stay.  So an area
    costs cells in proportion to its edge, not to its surface: one of the size
    of the world is a few coarse cells and its border.

    One chain of generators, no shuffle: cells are classified and split within
    the row of their area."""
    a = areas.select(key, F.col(rings).alias("_r")).withColumn("_b", bbox("_r"))
    wide = F.greatest(F.col("_b.xmax") - F.col("_b.xmin"), F.col("_b.ymax") - F.col("_b.ymin"))
    # An area begins at the level where it is about four to eight cells wide.
    a = a.withColumn("_l", F.greatest(F.ceil(F.log2(F.greatest(wide / size, F.lit(1.0)))) - 3, F.lit(0)).cast("int"))
    top = a.agg(F.max("_l")).first()[0] or 0

    def index(lo, hi):
        step = F.lit(float(size)) * F.pow(F.lit(2.0), F.col("_l"))
        return F.explode(F.sequence((F.ceil(F.col(lo) / step) - 1).cast("long"), F.floor(F.col(hi) / step).cast("long")))
    cells = (a.withColumn("_x", index("_b.xmin", "_b.xmax")).withColumn("_y", index("_b.ymin", "_b.ymax"))
             .select(key, "_r", "_l", "_x", "_y", F.lit(False).alias("_in")))
    for level in range(top, -1, -1):
        w = F.lit(size * 2.0 ** level)
        box = box_rings(F.col("_x") * w, F.col("_y") * w, (F.col("_x") + 1) * w, (F.col("_y") + 1) * w)
        # Only the undecided cells of this level are looked at.
        here = ~F.col("_in") & (F.col("_l") == level)
        cells = cells.withColumn("_box", F.when(here, box))
        cells = cells.where(~here | intersects("_r", "_box"))
        inside = F.col("_in") | F.coalesce(F.when(here, _box_inside(F.col("_r"), F.col("_box"))), F.lit(False))

        def cell(lev, x, y, flag):
            return F.struct(lev.cast("int").alias("_l"), x.alias("_x"), y.alias("_y"), flag.alias("_in"))
        same = F.array(cell(F.col("_l"), F.col("_x"), F.col("_y"), F.col("_in2")))
        parts = F.array(*[cell(F.lit(level - 1), F.col("_x") * 2 + i, F.col("_y") * 2 + j, F.lit(False)) for i in (0, 1) for j in (0, 1)])
        new = F.when(F.col("_in2") | (F.col("_l") != level) | F.lit(level == 0), same).otherwise(parts)
        cells = cells.withColumn("_in2", inside).select(key, "_r", F.inline(new))
    return cells.select(key, F.col("_l").alias("level"), F.col("_x").alias("cell_x"), F.col("_y").alias("cell_y"), F.col("_in").alias("inside"))


def above_tiles(tiles: DataFrame, levels: list[int]) -> DataFrame:
    """Every tile with the cells of the given levels that hold it."""
    up = F.array(*[F.struct(F.lit(n).alias("level"), F.shiftright(F.col("tile_x").cast("long"), n).alias("cell_x"),
                            F.shiftright(F.col("tile_y").cast("long"), n).alias("cell_y")) for n in levels])
    return tiles.select("*", F.inline(up))


def region_tiles(regions: DataFrame, size: float, rings: str = "rings") -> DataFrame:
    """Coarse tile keys (``_gx``, ``_gy``) touched by each region's bbox."""
    r = regions.withColumn("_rb", bbox(rings))
    return (r.withColumn("_gx", F.explode(touching_tile_range("_rb.xmin", "_rb.xmax", size)))
             .withColumn("_gy", F.explode(touching_tile_range("_rb.ymin", "_rb.ymax", size)))
             .drop("_rb"))


def points_in_regions(points: DataFrame, x: str, y: str, regions: DataFrame, size: float,
                      rings: str = "rings") -> DataFrame:
    """Points inside (or on the boundary of) any region: an equi join on a
    coarse grid key, then the exact test.  A point lies in exactly one grid
    cell, so each (point, region) pair is produced once."""
    from tessera.functions.geometry import pt
    pts = points.withColumn("_gx", F.floor(F.col(x) / size).cast("int")) \
                .withColumn("_gy", F.floor(F.col(y) / size).cast("int"))
    j = pts.join(region_tiles(regions, size, rings), ["_gx", "_gy"]).withColumn("_p", pt(x, y))
    inside = point_in_rings("_p", rings) | F.exists(
        edges(rings), lambda e: segments_touch(e, F.struct(F.col("_p").alias("a"), F.col("_p").alias("b"))))
    return j.where(inside).drop("_gx", "_gy", "_p")


def distinct_keys(cells: DataFrame) -> DataFrame:
    """A10: the set of tile keys (map-side partial dedupe, then shuffle)."""
    return cells.select("tile_x", "tile_y").distinct()


def dense_index(df: DataFrame, order_cols, name: str = "idx") -> DataFrame:
    """0-based consecutive row index in ``order_cols`` order, without moving
    all rows into one partition (the DataFrame form of ``zipWithIndex``).

    The range-sorted rows get ``monotonically_increasing_id`` (partition id
    in the upper bits); per-partition row counts (one row per partition)
    give each partition's offset.  The sorted frame is checkpointed to the
    shared checkpoint folder so both passes see the same partitioning.
    """
    ensure_checkpoint_dir(df.sparkSession)
    s = df.orderBy(*order_cols).withColumn("_mid", F.monotonically_increasing_id())
    s = s.withColumn("_pid", F.shiftright("_mid", 33)).checkpoint(eager=True)
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: bounded by the partition count, safe to sort/broadcast.
    from pyspark.sql import Window
    offs = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    return (s.join(F.broadcast(offs), "_pid")
            .withColumn(name, F.col("_off") + (F.col("_mid") - F.shiftleft(F.col("_pid"), 33)))
            .drop("_mid", "_pid", "_off"))


def batch_keys(keys: DataFrame, n: int, order=("tile_y", "tile_x")) -> DataFrame:
    """Batches of at most ``n`` keys in key order, the last one short."""
    if n < 1:
        raise ValueError("tiles per worker must be >= 1")
    idx = dense_index(keys, list(order), "_i")
    return idx.select(F.floor(F.col("_i") / n).cast("long").alias("batch_id"), "tile_x", "tile_y")


def batch_order_keys(keys: DataFrame, order: str, n: int) -> DataFrame:
    """W2 per order: batches of at most ``n`` of its distinct tile keys, numbered
    from 0 in key order; no batch mixes orders.  Keys are shuffled as masks of
    8 x 8 tiles (:mod:`asked`), so an order with very many keys is few rows."""
    from tessera.operators.asked import batch_blocks, tile_blocks
    return batch_blocks(tile_blocks(keys, [order]), order, n)


def work_list(batches: DataFrame) -> DataFrame:
    """One row per batch with its keys as ``[[x, y], ...]`` in key order.
    A batch holds at most ``n`` keys, so each collected list is bounded."""
    return (batches.groupBy("batch_id")
            .agg(F.array_sort(F.collect_list(F.struct("tile_y", "tile_x"))).alias("_k"))
            .select("batch_id", F.transform("_k", lambda k: F.array(k["tile_x"], k["tile_y"])).alias("keys")))


def write_work_list(batches: DataFrame, path: str) -> None:
    """S15 sink: JSON lines ``{"batch_id":…, "keys":[[x,y],…]}``."""
    work_list(batches).write.mode("overwrite").json(path)


def write_cells(cells: DataFrame, path: str) -> None:
    """S16 sink: the cell manifest, partitioned by tile column so a worker's
    lookup (J6) prunes to its own tiles' files; rows are first brought
    together by tile column, so a folder gets few files."""
    cells.hint("rebalance", "tile_x").write.mode("overwrite").partitionBy("tile_x").parquet(path)


def read_cells(spark, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn("tile_x", F.col("tile_x").cast("int"))


def lookup_cells(work_keys: DataFrame, cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cells of the requested keys, and the requested keys with no cell
    (``left_anti``; the source fails on such a key, here they are reported)."""
    k = work_keys.select("tile_x", "tile_y").distinct()
    found = cells.join(k, ["tile_x", "tile_y"], "left_semi")
    missing = k.join(cells.select("tile_x", "tile_y"), ["tile_x", "tile_y"], "left_anti")
    return found, missing
