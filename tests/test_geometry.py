import math

from pyspark.sql import functions as F

from tessera.functions import geometry as geo


def _one(spark, *cols):
    return spark.range(1).select(*cols).first()


def test_roi_tile_keys_golden(spark):
    # The test region of the tile workflow and its two tile keys.
    ring = [(149.21, -35.21), (148.98, -35.21), (148.98, -35.39), (149.21, -35.39), (149.21, -35.21)]
    df = spark.createDataFrame(ring, "lon double, lat double")
    p = df.select(geo.project_point("lon", "lat", 3577).alias("p"))
    b = p.agg(F.min("p.x"), F.max("p.x"), F.min("p.y"), F.max("p.y")).first()
    size = 61440.0
    keys = {(x, y) for x in range(math.floor(b[0] / size), math.floor(b[1] / size) + 1)
            for y in range(math.floor(b[2] / size), math.floor(b[3] / size) + 1)}
    assert keys == {(24, -65), (25, -65)}


def test_mercator_round_trip(spark):
    x, y = geo.mercator_forward(F.lit(147.5), F.lit(-42.25))
    lo, la = geo.mercator_inverse(x, y)
    r = _one(spark, lo, la, x)
    assert abs(r[0] - 147.5) < 1e-9 and abs(r[1] + 42.25) < 1e-9
    assert abs(r[2] - 147.5 * math.pi / 180 * 6378137.0) < 1e-6


def test_utm_round_trip_and_reference_point(spark):
    # Zone 55 south: central meridian 147 E maps to easting 500000.
    x, y = geo.utm_forward(F.lit(147.0), F.lit(-42.0), F.lit(55), F.lit(True))
    r = _one(spark, x, y)
    assert abs(r[0] - 500000.0) < 1e-6
    for lon, lat in [(146.3, -41.7), (148.9, -43.1), (145.0, -40.0)]:
        x, y = geo.utm_forward(F.lit(lon), F.lit(lat), F.lit(55), F.lit(True))
        lo, la = geo.utm_inverse(x, y, F.lit(55), F.lit(True))
        r = _one(spark, lo, la)
        assert abs(r[0] - lon) < 1e-9 and abs(r[1] - lat) < 1e-9


def test_point_in_polygon_with_hole_and_touching(spark):
    outer = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]
    hole = [(4, 4), (6, 4), (6, 6), (4, 6), (4, 4)]
    rings = F.array(*[F.array(*[geo.pt(F.lit(float(x)), F.lit(float(y))) for x, y in r]) for r in (outer, hole)])
    r = _one(spark, geo.point_in_rings(geo.pt(F.lit(2.0), F.lit(2.0)), rings),
             geo.point_in_rings(geo.pt(F.lit(5.0), F.lit(5.0)), rings),
             geo.point_in_rings(geo.pt(F.lit(11.0), F.lit(5.0)), rings))
    assert r[0] is True and r[1] is False and r[2] is False
    touching = geo.box_rings(F.lit(10.0), F.lit(0.0), F.lit(12.0), F.lit(3.0))
    apart = geo.box_rings(F.lit(10.5), F.lit(0.0), F.lit(12.0), F.lit(3.0))
    r = _one(spark, geo.intersects(rings, touching), geo.intersects(rings, apart))
    assert r[0] is True and r[1] is False


def test_geojson_validation(spark):
    good = '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}'
    open_ring = '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,1]]]}'
    short = '{"type":"Polygon","coordinates":[[[0,0],[1,0],[0,0]]]}'
    df = spark.createDataFrame([(good,), (open_ring,), (short,), ("nope",)], "g string")
    errs = [r[0] for r in df.select(geo.geojson_error("g")).collect()]
    assert errs[0] is None
    assert "first and last" in errs[1]
    assert "at least 4" in errs[2]
    assert errs[3] == "not valid JSON"


def test_wkt_round_trip(spark):
    r = _one(spark, geo.wkt(geo.rings_from_wkt(F.lit("POLYGON((1 2, 3 4, 5 6, 1 2))")), "%.1f"))
    assert r[0] == "POLYGON((1.0 2.0, 3.0 4.0, 5.0 6.0, 1.0 2.0))"
