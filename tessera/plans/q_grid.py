"""Checked queries: footprints, geometry and gridding (entry point A, "get work")."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tessera.functions import geometry as geo
from tessera.operators import grid
from tessera.operators.ranges import table_extent
from tessera.plans.oracle_lenses import SCENE as SCENE_SQL
from tessera.plans.q_catalogue import _round, albers_sql
from tessera.plans.registry import query
from tessera.sources.lenses import ROI_RING, aoi_table, footprints, roi_rings

FP = """
fp AS (
  SELECT c_custkey, CAST(110 AS DOUBLE) + CAST(c_custkey * 37 % 4000 AS DOUBLE) / 100.0 AS lon,
         CAST(-45 AS DOUBLE) + CAST(c_custkey * 53 % 3500 AS DOUBLE) / 100.0 AS lat
  FROM customer),
bx AS (SELECT c_custkey, lon, lat, lon - 0.5 AS x0, lat - 0.5 AS y0, lon + 0.5 AS x1, lat + 0.5 AS y1 FROM fp)"""

TILES_1DEG = "tiles AS (SELECT x AS tile_x, y AS tile_y FROM range(100, 160) r1(x), range(-50, 5) r2(y))"


def _poly_box_sql(ring) -> str:
    """SQL predicate: closed polygon ``ring`` (constants) meets box x0..x1, y0..y1."""
    edges = list(zip(ring[:-1], ring[1:]))
    vin = " OR ".join(f"({x!r} BETWEEN x0 AND x1 AND {y!r} BETWEEN y0 AND y1)" for x, y in ring[:-1])

    def pip(px, py):
        terms = []
        for (ax, ay), (bx, by) in edges:
            if ay == by:
                continue
            terms.append(f"(CASE WHEN (({ay!r} > {py}) <> ({by!r} > {py})) AND "
                         f"({px} < ({bx - ax!r}) * ({py} - {ay!r}) / ({by - ay!r}) + {ax!r}) THEN 1 ELSE 0 END)")
        return f"(({' + '.join(terms)}) % 2 = 1)"
    cin = " OR ".join(pip(px, py) for px, py in (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1")))

    def orient(p, q, r):
        return f"sign(({q[0]} - {p[0]}) * ({r[1]} - {p[1]}) - ({q[1]} - {p[1]}) * ({r[0]} - {p[0]}))"
    box_edges = [(("x0", "y0"), ("x1", "y0")), (("x1", "y0"), ("x1", "y1")),
                 (("x1", "y1"), ("x0", "y1")), (("x0", "y1"), ("x0", "y0"))]
    crosses = []
    for (ax, ay), (bx, by) in edges:
        a, b = (repr(ax), repr(ay)), (repr(bx), repr(by))
        for c, d in box_edges:
            crosses.append(
                f"({orient(a, b, c)} * {orient(a, b, d)} <= 0 AND {orient(c, d, a)} * {orient(c, d, b)} <= 0 "
                f"AND least({a[0]}, {b[0]}) <= greatest({c[0]}, {d[0]}) AND least({c[0]}, {d[0]}) <= greatest({a[0]}, {b[0]}) "
                f"AND least({a[1]}, {b[1]}) <= greatest({c[1]}, {d[1]}) AND least({c[1]}, {d[1]}) <= greatest({a[1]}, {b[1]}))")
    return f"(({vin}) OR ({cin}) OR {' OR '.join(crosses)})"


# ------------------------------------------------------------------ J4, G6, G8, P8, P9, P14

@query("j4_tile_cells", covers=("J4", "G6", "G7", "G8"), sql=f"""
WITH {FP}, {TILES_1DEG}
SELECT bx.c_custkey, t.tile_x, t.tile_y FROM bx JOIN tiles t
  ON t.tile_x <= bx.x1 AND t.tile_x + 1 >= bx.x0 AND t.tile_y <= bx.y1 AND t.tile_y + 1 >= bx.y0""")
def j4_tile_cells(spark, sf_dir):
    """Every 1° tile each footprint meets (touching counts)."""
    return grid.tile_cells(footprints(spark, sf_dir), 1.0).select("c_custkey", "tile_x", "tile_y")


@query("p9_polygon_search", covers=("P9", "J5", "G8"), sql=f"""
WITH {FP} SELECT c_custkey FROM bx WHERE {_poly_box_sql(ROI_RING)}""")
def p9_polygon_search(spark, sf_dir):
    """Footprints meeting the concave query polygon: bbox prefilter, then the
    exact polygon predicate."""
    fp = footprints(spark, sf_dir)
    xs, ys = [p[0] for p in ROI_RING], [p[1] for p in ROI_RING]
    pre = fp.where((F.col("lon") + 0.5 >= min(xs)) & (F.col("lon") - 0.5 <= max(xs)) &
                   (F.col("lat") + 0.5 >= min(ys)) & (F.col("lat") - 0.5 <= max(ys)))
    return pre.withColumn("_roi", roi_rings()).where(geo.intersects("rings", "_roi")).select("c_custkey")


@query("p8_bbox_search", covers=("P8",), sql=f"""
WITH {FP} SELECT c_custkey FROM bx
WHERE y0 <= -30.0 AND y1 >= -38.5 AND x0 <= 131.25 AND x1 >= 120.0""")
def p8_bbox_search(spark, sf_dir):
    """Latitude (s, n) and longitude (w, e) closed-interval overlap search."""
    fp = footprints(spark, sf_dir)
    lat, lon = (-38.5, -30.0), (120.0, 131.25)
    return fp.where((F.col("lat") - 0.5 <= lat[1]) & (F.col("lat") + 0.5 >= lat[0]) &
                    (F.col("lon") - 0.5 <= lon[1]) & (F.col("lon") + 0.5 >= lon[0])).select("c_custkey")


_Q = (125.0, -35.0, 135.0, -25.0)
_PRED = {
    "left": "x1 < {0}", "overleft": "x1 <= {2}", "overlaps": "x0 <= {2} AND x1 >= {0} AND y0 <= {3} AND y1 >= {1}",
    "overright": "x0 >= {0}", "right": "x0 > {2}", "same": "x0 = {0} AND y0 = {1} AND x1 = {2} AND y1 = {3}",
    "contains": "x0 <= {0} AND y0 <= {1} AND x1 >= {2} AND y1 >= {3}",
    "within": "x0 >= {0} AND y0 >= {1} AND x1 <= {2} AND y1 <= {3}",
    "overbelow": "y1 <= {3}", "below": "y1 < {1}", "above": "y0 > {3}", "overabove": "y0 >= {1}",
}


@query("p14_box_predicates", covers=("P14",), sql="WITH " + FP + " SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {cond.format(*_Q)}) AS n_{name}" for name, cond in _PRED.items()) + " FROM bx")
def p14_box_predicates(spark, sf_dir):
    fp = footprints(spark, sf_dir).withColumn("bb", geo.bbox("rings"))
    q = F.struct(*[F.lit(v).alias(k) for k, v in zip(("xmin", "ymin", "xmax", "ymax"), _Q)])
    fns = {"left": geo.box_left, "overleft": geo.box_overleft, "overlaps": geo.box_overlaps,
           "overright": geo.box_overright, "right": geo.box_right, "same": geo.box_same,
           "contains": geo.box_contains, "within": geo.box_within, "overbelow": geo.box_overbelow,
           "below": geo.box_below, "above": geo.box_above, "overabove": geo.box_overabove}
    return fp.agg(*[F.count(F.when(fn("bb", q), 1)).alias(f"n_{k}") for k, fn in fns.items()])


@query("l4_nearest_footprints", covers=("L4",), sql=f"""
WITH {FP}
SELECT * FROM (
  SELECT 'centroid' AS metric, c_custkey, round(sqrt((lon - 130.0) ^ 2 + (lat + 30.0) ^ 2), 6) AS dist
  FROM bx ORDER BY sqrt((lon - 130.0) ^ 2 + (lat + 30.0) ^ 2), c_custkey LIMIT 10)
UNION ALL SELECT * FROM (
  SELECT 'box', c_custkey,
         round(sqrt(greatest(x0 - 131.0, 129.0 - x1, 0.0) ^ 2 + greatest(y0 - (-29.0), (-31.0) - y1, 0.0) ^ 2), 6)
  FROM bx ORDER BY sqrt(greatest(x0 - 131.0, 129.0 - x1, 0.0) ^ 2 + greatest(y0 - (-29.0), (-31.0) - y1, 0.0) ^ 2),
                   c_custkey LIMIT 10)""")
def l4_nearest_footprints(spark, sf_dir):
    """Top-10 nearest footprints by centre distance and by box distance
    (a TakeOrderedAndProject: per-partition top-k, then merge)."""
    fp = footprints(spark, sf_dir).withColumn("bb", geo.bbox("rings"))
    target = F.struct(F.lit(129.0).alias("xmin"), F.lit(-31.0).alias("ymin"),
                      F.lit(131.0).alias("xmax"), F.lit(-29.0).alias("ymax"))
    out = None
    for metric, fn in (("centroid", geo.centroid_distance), ("box", geo.box_distance)):
        d = fp.select(F.lit(metric).alias("metric"), "c_custkey", fn("bb", target).alias("dist"))
        d = d.orderBy("dist", "c_custkey").limit(10)
        out = d if out is None else out.unionByName(d)
    return out.select("metric", "c_custkey", F.round("dist", 6).alias("dist"))


@query("l4_nearest_of_each", covers=("L4",), sql=f"""
WITH {FP},
c AS (SELECT c_custkey, (x0 + x1) / 2 AS x, (y0 + y1) / 2 AS y FROM bx),
d AS (SELECT a.c_custkey, b.c_custkey AS neighbour, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS dist
      FROM c a JOIN c b ON a.c_custkey <> b.c_custkey)
SELECT c_custkey, CAST(row_number() OVER (PARTITION BY c_custkey ORDER BY dist, neighbour) AS INTEGER) AS rank, neighbour, round(dist, 6) AS dist
FROM d QUALIFY rank <= 5""")
def l4_nearest_of_each(spark, sf_dir):
    """The five nearest footprints of every footprint, by centre distance."""
    from tessera.operators.nearest import nearest
    c = geo.box_centre("bb")
    p = footprints(spark, sf_dir).withColumn("bb", geo.bbox("rings")).select("c_custkey", c["x"].alias("x"), c["y"].alias("y"))
    return nearest(p, p, 5, "c_custkey").withColumn("dist", F.round("dist", 6))


@query("a12_table_extent", covers=("A12",), sql=f"""
WITH {FP} SELECT round(min(x0), 6) AS xmin, round(min(y0), 6) AS ymin,
                 round(max(x1), 6) AS xmax, round(max(y1), 6) AS ymax FROM bx""")
def a12_table_extent(spark, sf_dir):
    return _round(table_extent(footprints(spark, sf_dir).withColumn("bbox", geo.bbox("rings"))))


_GX, _GY = albers_sql("lon", "lat")


@query("g6_albers_tile_keys", covers=("G5", "G6", "G7"), sql=f"""
WITH {FP}, p AS (SELECT c_custkey, {_GX} AS x, {_GY} AS y FROM fp)
SELECT c_custkey, round(x, 3) AS x, round(y, 3) AS y,
       CAST(floor(x / 61440.0) AS INTEGER) AS tile_x, CAST(floor(y / 61440.0) AS INTEGER) AS tile_y,
       CAST(floor((x - floor(x / 61440.0) * 61440.0) / 30.0) AS INTEGER) AS px,
       CAST(floor(((floor(y / 61440.0) + 1) * 61440.0 - y) / 30.0) AS INTEGER) AS py
FROM p""")
def g6_albers_tile_keys(spark, sf_dir):
    """Footprint centres in EPSG:3577, their 61440 m tile key and the
    30 m pixel (column, row from the tile's top-left) inside that tile."""
    fp = footprints(spark, sf_dir)
    p = fp.select("c_custkey", geo.project_point("lon", "lat", 3577).alias("p"))
    size, res = 61440.0, 30.0
    tx, ty = geo.tile_index("p.x", size), geo.tile_index("p.y", size)
    bb = geo.tile_bbox(tx, ty, size)
    return p.select("c_custkey", F.round("p.x", 3).alias("x"), F.round("p.y", 3).alias("y"),
                    tx.alias("tile_x"), ty.alias("tile_y"),
                    F.floor((F.col("p.x") - bb["xmin"]) / res).cast("int").alias("px"),
                    F.floor((bb["ymax"] - F.col("p.y")) / res).cast("int").alias("py"))


# ------------------------------------------------------------------ A10, W2, S15, J6, A9

_KEYS_SQL = f"""
WITH {FP}, {TILES_1DEG},
cells AS (SELECT bx.c_custkey, t.tile_x, t.tile_y FROM bx JOIN tiles t
  ON t.tile_x <= bx.x1 AND t.tile_x + 1 >= bx.x0 AND t.tile_y <= bx.y1 AND t.tile_y + 1 >= bx.y0),
k AS (SELECT DISTINCT tile_x, tile_y FROM cells),
b AS (SELECT (row_number() OVER (ORDER BY tile_y, tile_x) - 1) // 8 AS batch_id, tile_x, tile_y FROM k)"""


def _batches(spark, sf_dir):
    cells = grid.tile_cells(footprints(spark, sf_dir), 1.0)
    return cells, grid.batch_keys(grid.distinct_keys(cells), 8)


@query("w2_key_batches", covers=("W2", "A10", "A11"), sql=_KEYS_SQL + " SELECT batch_id, tile_x, tile_y FROM b")
def w2_key_batches(spark, sf_dir):
    return _batches(spark, sf_dir)[1]


@query("s15_work_list", covers=("S15",), sql=_KEYS_SQL + """
SELECT batch_id, count(*) AS n_keys,
       to_json(list([tile_x, tile_y] ORDER BY tile_y, tile_x)) AS keys_json
FROM b GROUP BY batch_id""")
def s15_work_list(spark, sf_dir):
    wl = grid.work_list(_batches(spark, sf_dir)[1])
    return wl.select("batch_id", F.size("keys").cast("long").alias("n_keys"), F.to_json("keys").alias("keys_json"))


@query("a9_aoi_union_membership", covers=("A9", "S22", "J7", "G1"), sql=f"""
WITH {FP},
n AS (SELECT r1.r_regionkey AS a, r2.r_regionkey AS b, lower(r1.r_name) || ' | ' || lower(r2.r_name) AS names
      FROM (SELECT DISTINCT o_orderkey % 5 AS k FROM orders WHERE o_orderkey % 4 = 2 AND o_orderkey % 7 <> 0) o
      JOIN region r1 ON r1.r_regionkey = o.k JOIN region r2 ON r2.r_regionkey = (o.k + 1) % 5)
SELECT names, c_custkey, round(lon, 6) AS lon, round(lat, 6) AS lat FROM fp JOIN n
  ON (lon BETWEEN 110 + 8 * a AND 120 + 8 * a AND lat BETWEEN -40 + 5 * a AND -28 + 5 * a)
  OR (lon BETWEEN 110 + 8 * b AND 120 + 8 * b AND lat BETWEEN -40 + 5 * b AND -28 + 5 * b)""")
def a9_aoi_union_membership(spark, sf_dir):
    """Footprint centres inside the union of the AOIs of every name list that
    an order gives (split on '|', looked up, parsed; a point is in the union if
    it is in any polygon, overlaps included)."""
    from tessera.operators.orders import aoi_union
    from tessera.sources.lenses import requests
    asked = requests(spark, sf_dir).select(F.get_json_object("order_json", "$.aoi_name").alias("names"))
    union, _missing = aoi_union(asked, "names", aoi_table(spark, sf_dir))
    fp = footprints(spark, sf_dir).select("c_custkey", "lon", "lat")
    hits = grid.points_in_regions(fp, "lon", "lat", union.select("names", "rings"), 1.0)
    return (hits.select("names", "c_custkey", "lon", "lat").distinct()
            .select("names", "c_custkey", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat")))


# ------------------------------------------------------------------ get work (entry point A)

def _pp_sql(a, b) -> str:
    """SQL predicate: closed rings ``a`` and ``b`` (lists of (x, y) SQL
    expressions, first point repeated last) share a point — a vertex of one
    inside the other (even-odd), or two edges touching."""
    def pip(p, ring):
        terms = []
        for (ax, ay), (bx, by) in zip(ring[:-1], ring[1:]):
            terms.append(f"(CASE WHEN (({ay}) > ({p[1]})) <> (({by}) > ({p[1]})) AND "
                         f"({p[0]}) < (({bx}) - ({ax})) * (({p[1]}) - ({ay})) / nullif(({by}) - ({ay}), 0) + ({ax}) "
                         f"THEN 1 ELSE 0 END)")
        return f"(({' + '.join(terms)}) % 2 = 1)"

    def orient(p, q, r):
        return f"sign((({q[0]}) - ({p[0]})) * (({r[1]}) - ({p[1]})) - (({q[1]}) - ({p[1]})) * (({r[0]}) - ({p[0]})))"

    def touch(p1, p2, q1, q2):
        return (f"({orient(p1, p2, q1)} * {orient(p1, p2, q2)} <= 0 AND {orient(q1, q2, p1)} * {orient(q1, q2, p2)} <= 0 "
                f"AND least({p1[0]}, {p2[0]}) <= greatest({q1[0]}, {q2[0]}) AND least({q1[0]}, {q2[0]}) <= greatest({p1[0]}, {p2[0]}) "
                f"AND least({p1[1]}, {p2[1]}) <= greatest({q1[1]}, {q2[1]}) AND least({q1[1]}, {q2[1]}) <= greatest({p1[1]}, {p2[1]}))")
    conds = [pip(p, b) for p in a] + [pip(p, a) for p in b]
    conds += [touch(a[i], a[i + 1], b[j], b[j + 1]) for i in range(len(a) - 1) for j in range(len(b) - 1)]
    return "(" + " OR ".join(conds) + ")"


_ROI_SQL = [(repr(x), repr(y)) for x, y in ROI_RING]
_QUAD = [("lon - 0.5", "lat - 0.5"), ("lon + 0.5", "lat - 0.5"), ("lon + 0.55", "lat + 0.5"),
         ("lon - 0.45", "lat + 0.5"), ("lon - 0.5", "lat - 0.5")]
_TILE = [("t.tile_x", "t.tile_y"), ("t.tile_x + 1", "t.tile_y"), ("t.tile_x + 1", "t.tile_y + 1"),
         ("t.tile_x", "t.tile_y + 1"), ("t.tile_x", "t.tile_y")]
_ORDER = ('{"driver":"lens","time_start":"1996-01-01","time_end":"1996-12-31",'
          '"boundary":{"type":"Polygon","coordinates":[[' +
          ",".join(f"[{x},{y}]" for x, y in ROI_RING) + "]]}}")


@query("x4_get_work_cells", covers=("P17", "P18", "P3", "P4", "P9", "P10", "J2", "J4", "J5", "A10", "W2"),
       sql=f"""
WITH {SCENE_SQL}, {TILES_1DEG},
s AS (SELECT id, lon, lat FROM scene
      WHERE mtype = 'eo' AND archived IS NULL AND dataset_type_ref IN (0, 5, 10, 15, 20)
        AND t BETWEEN TIMESTAMP '1996-01-01 00:00:00' AND TIMESTAMP '1996-12-31 00:00:00'),
c AS (SELECT t.tile_x, t.tile_y, s.id FROM s JOIN tiles t
        ON t.tile_x <= s.lon + 0.55 AND t.tile_x + 1 >= s.lon - 0.5
       AND t.tile_y <= s.lat + 0.5 AND t.tile_y + 1 >= s.lat - 0.5
      WHERE {_pp_sql(_QUAD, _TILE)} AND {_pp_sql(_QUAD, _ROI_SQL)} AND {_pp_sql(_TILE, _ROI_SQL)}),
k AS (SELECT DISTINCT tile_x, tile_y FROM c),
b AS (SELECT (row_number() OVER (ORDER BY tile_y, tile_x) - 1) // 8 AS batch_id, tile_x, tile_y FROM k)
SELECT b.batch_id, c.tile_x, c.tile_y, c.id FROM c JOIN b USING (tile_x, tile_y)""")
def x4_get_work_cells(spark, sf_dir):
    """An order (concave region, 1996) over the scene catalogue: cells of
    the eo products' active scenes on a 1° grid and their batches of 8."""
    from tessera.plans.get_work import generate_tiles
    from tessera.sources.catalogue import dataset, metadata_type
    orders = spark.createDataFrame([(1, _ORDER)], "order_id long, order_json string")
    batches, cells, _bad = generate_tiles(dataset(spark, sf_dir), metadata_type(spark, sf_dir), orders,
                                          aoi_table(spark, sf_dir), (0, 5, 10, 15, 20), 1.0, 8)
    return cells.join(batches, ["order_id", "tile_x", "tile_y"]).select("batch_id", "tile_x", "tile_y", "id")


def _utm_sql(lon: str, lat: str, zone: str, south: str) -> tuple[str, str]:
    from tessera.functions.geometry import K0_UTM, _kruger
    n, A, alpha, _, _ = _kruger()
    k = 2 * math.sqrt(n) / (1 + n)
    phi, lam = f"radians({lat})", f"radians({lon} - ({zone} * 6.0 - 183.0))"
    t = f"sinh(atanh(sin({phi})) - {k!r} * atanh({k!r} * sin({phi})))"
    xi = f"atan2({t}, cos({lam}))"
    eta = f"atanh(sin({lam}) / sqrt(1.0 + ({t}) * ({t})))"
    e_sum = " + ".join([eta] + [f"{a!r} * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})"
                                for j, a in enumerate(alpha, start=1)])
    n_sum = " + ".join([xi] + [f"{a!r} * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})"
                               for j, a in enumerate(alpha, start=1)])
    x = f"(500000.0 + {K0_UTM * A!r} * ({e_sum}))"
    y = f"((CASE WHEN {south} THEN 10000000.0 ELSE 0.0 END) + {K0_UTM * A!r} * ({n_sum}))"
    return x, y


_UX, _UY = _utm_sql("lon", "lat", "zone", "lat < 0")


@query("g5_utm_projection", covers=("G5", "G4"), sql=f"""
WITH {FP}, z AS (SELECT c_custkey, lon, lat, CAST(floor((lon + 180) / 6) + 1 AS INTEGER) AS zone FROM fp)
SELECT c_custkey, zone, CASE WHEN lat < 0 THEN 32700 + zone ELSE 32600 + zone END AS srid,
       round({_UX}, 3) AS x, round({_UY}, 3) AS y FROM z""")
def g5_utm_projection(spark, sf_dir):
    """Footprint centres projected to their own UTM zone (EPSG:326zz north,
    327zz south) with the Krüger series; the SRID is a per-row column."""
    fp = footprints(spark, sf_dir)
    zone = (F.floor((F.col("lon") + 180) / 6) + 1).cast("int")
    srid = F.when(F.col("lat") < 0, F.lit(32700) + zone).otherwise(F.lit(32600) + zone)
    p = fp.select("c_custkey", zone.alias("zone"), srid.alias("srid"), "lon", "lat").select(
        "c_custkey", "zone", "srid", geo.project_point("lon", "lat", F.col("srid")).alias("p"))
    return p.select("c_custkey", "zone", "srid", F.round("p.x", 3).alias("x"), F.round("p.y", 3).alias("y"))
