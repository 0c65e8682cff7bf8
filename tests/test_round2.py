"""Cases that the lenses alone do not show: bad dates, overlapping areas,
lineage with several sources and cycles, medians without exchange reuse,
regions in other projections."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.functions import geometry as geo
from tessera.operators import grid, lineage, objects, orders
from tessera.operators.composite import monthly_composite, ranked_median
from tessera.operators.geomedian import geomedian
from tessera.plans.do_work import solar_day_slices
from tessera.plans.get_work import order_regions


def _aoi(spark, boxes):
    rows = [(n, json.dumps({"type": "Polygon", "coordinates": [[[a, b], [c, b], [c, d], [a, d], [a, b]]]})) for n, a, b, c, d in boxes]
    return spark.createDataFrame(rows, "aoi_name string, aoi_polygon string")


def _orders(spark, docs):
    return spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "order_id long, order_json string")


BOX = {"bounding_box": [1, 2, 3, 4]}


@pytest.mark.parametrize("start, end, error", [
    ("2020-01-01", "someday", "Invalid date: someday"), ("someday", "2020-01-01", "Invalid date: someday"),
    (None, "2020-01-01", "Invalid date: None"), ("2020-01-01", None, "Invalid date: None"), ("1 March 2020", "2020-02-01T00:00:00+10:00", None)])
def test_each_date_is_tested_by_itself(spark, start, end, error):
    r = orders.validate_orders(_orders(spark, [{"time_start": start, "time_end": end, **BOX}]), "order_id", "order_json",
                               _aoi(spark, [])).first()
    assert r.error == error and r.is_valid == (error is None)
    if error is None:
        assert (r.time_start, r.time_end) == ("2020-01-31T14:00:00Z", "2020-03-01T00:00:00Z")


def test_points_in_an_overlap_of_areas_are_inside(spark):
    aoi = _aoi(spark, [("a", 0, 0, 10, 10), ("b", 5, 5, 15, 15), ("a", 0, 0, 10, 10)])
    names = spark.createDataFrame([("a | b",), ("a|b",), ("a | none",)], "names string")
    union, missing = orders.aoi_union(names, "names", aoi)
    pts = spark.createDataFrame([(1, 7.0, 7.0), (2, 1.0, 1.0), (3, 14.0, 14.0), (4, 20.0, 20.0)], "id int, x double, y double")
    hits = grid.points_in_regions(pts, "x", "y", union, 1.0).select("names", "id").distinct().collect()
    assert sorted((r.names, r.id) for r in hits) == [(n, i) for n in ("a | b", "a|b") for i in (1, 2, 3)]
    assert [tuple(r) for r in missing.collect()] == [("a | none", "none")]


def test_region_of_an_order_in_its_own_projection(spark):
    ring = [(149.21, -35.21), (148.98, -35.21), (148.98, -35.39), (149.21, -35.39), (149.21, -35.21)]
    one = spark.range(1)
    xy = one.select(*[geo.project_point(F.lit(x), F.lit(y), 3577).alias(f"p{i}") for i, (x, y) in enumerate(ring)]).first()
    boundary = {"type": "Polygon", "crs": {"type": "name", "properties": {"name": "EPSG:3577"}},
                "coordinates": [[[p.x, p.y] for p in xy]]}
    lonlat = {"type": "Polygon", "coordinates": [[list(p) for p in ring]]}
    dates = {"time_start": "2022-01-01", "time_end": "2022-02-28"}
    o = _orders(spark, [{**dates, "boundary": boundary}, {**dates, "boundary": lonlat}])
    regions, bad = order_regions(o, "order_id", "order_json", _aoi(spark, []))
    assert bad.count() == 0
    got = {r.order_id: [(p.x, p.y) for p in r.region[0]] for r in regions.collect()}
    for i in (0, 1):
        assert all(abs(a - c) < 1e-7 and abs(b - d) < 1e-7 for (a, b), (c, d) in zip(got[i], ring, strict=True))
    cells = grid.tile_cells(regions.select("order_id", F.col("region").alias("rings")), 61440.0, srid=3577)
    assert sorted({(r.tile_x, r.tile_y) for r in cells.where("order_id = 1").collect()}) == [(24, -65), (25, -65)]


@pytest.mark.parametrize("srid", [3577, 3085, 3857, 32755])
def test_projections_have_inverses(spark, srid):
    pts = [(149.2, -35.3), (120.0, -20.0)] if srid not in (3085, 32755) else [(-99.0, 31.0)] if srid == 3085 else [(147.5, -36.0)]
    for lon, lat in pts:
        p = spark.range(1).select(geo.project_point(F.lit(lon), F.lit(lat), srid).alias("p")) \
            .select(geo.unproject_point(F.col("p.x"), F.col("p.y"), F.lit(srid)).alias("q")).first().q
        assert abs(p.x - lon) < 1e-7 and abs(p.y - lat) < 1e-7


def test_lineage_with_two_sources_and_a_cycle(spark):
    edges = spark.createDataFrame([("b", "x", "a"), ("d", "x", "b"), ("d", "y", "c"), ("e", "x", "d"), ("e", "y", "a"),
                                   ("p", "x", "q"), ("q", "x", "p"), ("r", "x", "p"), ("d", "z", "b")],
                                  "dataset_ref string, classifier string, source_dataset_ref string")
    nodes = spark.createDataFrame([(x,) for x in "abcdepqrs"], "id string")
    got = sorted((r.node, r.root or "", r.depth, r.max_depth, r.error is not None) for r in lineage.roots(edges, nodes).collect())
    assert got == [("a", "a", 0, 0, False), ("b", "a", 1, 1, False), ("c", "c", 0, 0, False), ("d", "a", 2, 2, False),
                   ("d", "c", 1, 1, False), ("e", "a", 1, 3, False), ("e", "c", 2, 2, False), ("p", "", None, None, True),
                   ("q", "", None, None, True), ("r", "", None, None, True), ("s", "s", 0, 0, False)]


def test_document_edit_keeps_other_members(spark):
    doc = {"$schema": "s", "id": "1", "label": "S10_00_E141_x-y", "product": {"name": "n", "href": "h"}, "geometry": {"a": [1, 2.5]},
           "properties": {"eo:gsd": 30.5, "n": 7, "flag": True, "none": None}, "measurements": {"m": {"path": "p", "band": 1}}}
    df = spark.createDataFrame([(json.dumps(doc),), ("{bad",), (None,)], "doc string")
    got = [r[0] and json.loads(r[0]) for r in df.select(objects.edit_document("doc")).collect()]
    want = {**doc, "label": "S10_00_E141_x-v2020_2", "product": {"name": "copernicus_dem_30_v2020_2", "href": "h"},
            "properties": {**doc["properties"], "datetime": "2021-03-01T00:00:00", "eo:gsd": "30", "eo:platform": "GLO-30",
                           "odc:dataset_version": "2020_2", "odc:region_code": "S10E141"}}
    assert got == [want, None, None]


def test_geometric_median_does_not_depend_on_neighbours(spark):
    rows = [("a", float(i), float(i * i % 7)) for i in range(8)]
    other = [("b", 1e3 * i, -float(i)) for i in range(40)]
    schema = "g string, x double, y double"

    def run(data, **kw):
        return {r.g: (r.x, r.y, r.converged) for r in geomedian(spark.createDataFrame(data, schema), ["g"], ["x", "y"], **kw).collect()}
    alone, together, spread = run(rows), run(rows + other), run(rows + other, in_task=0)
    assert all(abs(alone["a"][i] - x["a"][i]) < 1e-12 + 1e-9 * (x is spread) for x in (together, spread) for i in (0, 1))
    assert run(rows, max_iter=1)["a"][2] is False and alone["a"][2] is True


def test_ranked_median_without_exchange_reuse(spark):
    df = spark.range(20000).select((F.col("id") % 3).alias("g"), F.rand(7).alias("value")).withColumn(
        "g", F.when(F.col("value") < 0.8, F.lit(0)).otherwise(F.col("g"))).checkpoint()
    want = {r[0]: r[1] for r in df.groupBy("g").agg(F.median("value")).collect()}
    old = spark.conf.get("spark.sql.exchange.reuse")
    try:
        spark.conf.set("spark.sql.exchange.reuse", "false")
        got = {r[0]: r[1] for r in ranked_median(df, ["g"]).collect()}
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_solar_day_slices_count_a_day_once(spark):
    rows = [(1, 0, 0, 0, 0, "2020-01-05 01:00:00", 0.1), (2, 0, 0, 0, 0, "2020-01-05 02:00:00", 0.9),
            (3, 0, 0, 0, 0, "2020-01-09 01:00:00", 0.5), (4, 0, 0, 0, 1, "2020-01-05 01:00:00", None), (5, 0, 0, 0, 1, "2020-01-05 03:00:00", 0.7)]
    df = spark.createDataFrame(rows, "id long, tile_x int, tile_y int, px int, py int, t string, red double") \
        .withColumn("t", F.col("t").cast("timestamp_ntz")).withColumn("solar_day", F.to_date("t"))
    s = solar_day_slices(df, ["red"], ("tile_x", "tile_y"))
    assert sorted((r.py, r.red, r.n_scenes) for r in s.collect()) == [(0, 0.1, 2), (0, 0.5, 1), (1, 0.7, 2)]
    m = monthly_composite(s, ["red"])
    assert sorted((r.py, r.red) for r in m.collect()) == [(0, 0.3), (1, 0.7)]


def test_order_parts_messages(spark):
    got = [r.error for r in orders.order_parts(_orders(spark, [{}, {**BOX, "aoi_name": "x"}, BOX]), "order_id", "order_json").orderBy("order_id").collect()]
    assert got == ["No bounding_box, aoi_name or boundary polygon exists in order_params",
                   "Can only have one of: boundary polygon, bounding_box or aoi_name.", None]


def test_views_scan_the_catalogue_once(spark):
    from tables import SF_SMALL
    from tessera.plans.registry import load_all
    for name in ("u1_space_view", "u2_time_view_v2", "j2_space_time_view"):
        p = load_all()[name].fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in p.split("\n") if "metadata#" in line and "FileScan" in line]
        assert len(scans) == 1 and "hashpartitioning" not in p, name
