"""Geometry as Column expressions.

Representation: a polygon (or multipolygon) is ``rings: array<array<struct<x
double, y double>>>`` — every ring of every part, closed — plus an SRID.
Containment uses the even-odd rule over all rings, which handles holes
and multiple parts alike.  Everything is built from higher-order
functions (``transform``, ``exists``, ``aggregate``), so it runs inside
the JVM with no Python per row.

Projections (G5) are closed-form formulae from the published map
projection literature: spherical Web Mercator (EPSG:3857), Albers equal
area on GRS80 (EPSG:3577 Australia, EPSG:3085 Texas), and transverse
Mercator / UTM on WGS84 by the 4th-order Krüger series (EPSG:326zz north,
327zz south).  Datum shifts (< 2 m between GDA94 and WGS84) are ignored.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

RINGS_TYPE = "array<array<struct<x:double,y:double>>>"


def _memo(fn):
    """Reuse the Column built for the same column names / constants.

    Building a nested higher-order expression costs thousands of calls
    into the JVM on the driver; the resulting (unresolved) Column does not
    depend on any DataFrame, so one built from plain names is reused."""
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        plain = (str, int, float, bool, type(None))
        if all(isinstance(a, plain) for a in args) and all(isinstance(v, plain) for v in kwargs.values()):
            key = (args, tuple(sorted(kwargs.items())))
            if key not in cache:
                cache[key] = fn(*args, **kwargs)
            return cache[key]
        return fn(*args, **kwargs)
    return wrapper


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def pt(x, y) -> Column:
    return F.struct(_c(x).cast("double").alias("x"), _c(y).cast("double").alias("y"))


# ----------------------------------------------------------------- G1 / G3

_GJ = "struct<type:string,coordinates:string>"


@_memo
def _gj_coords(text) -> tuple[Column, Column]:
    """(type, coordinates as rings of [x, y]) of GeoJSON text, read with
    ``from_json`` (streaming parse of only these two members)."""
    s = F.from_json(_c(text), _GJ)
    typ = s["type"]
    poly = F.from_json(s["coordinates"], "array<array<array<double>>>")
    multi = F.from_json(s["coordinates"], "array<array<array<array<double>>>>")
    return typ, F.when(typ == "Polygon", poly).when(typ == "MultiPolygon", F.flatten(multi))


@_memo
def rings_from_geojson(text) -> Column:
    """G1: GeoJSON Polygon / MultiPolygon text → rings (NULL if neither)."""
    _typ, coords = _gj_coords(text)
    return F.transform(coords, lambda ring: F.transform(ring, lambda p: pt(p[0], p[1])))


@_memo
def polygons_from_geojson(text) -> Column:
    """GeoJSON Polygon / MultiPolygon text → its polygons, each a list of rings."""
    s = F.from_json(_c(text), _GJ)
    poly = F.array(F.from_json(s["coordinates"], "array<array<array<double>>>"))
    multi = F.from_json(s["coordinates"], "array<array<array<array<double>>>>")
    coords = F.when(s["type"] == "Polygon", poly).when(s["type"] == "MultiPolygon", multi)
    return F.transform(coords, lambda p: F.transform(p, lambda ring: F.transform(ring, lambda q: pt(q[0], q[1]))))


def geojson_crs(text) -> Column:
    """CRS name of a GeoJSON object (``crs.properties.name``), else NULL."""
    return F.try_variant_get(F.try_parse_json(_c(text)), "$.crs.properties.name", "string")


@_memo
def geojson_parts(text) -> tuple[Column, Column, Column]:
    """(parsed-ok flag, geometry type, coordinates as rings of [x, y] arrays)
    — project these once, then derive rings and errors from the columns."""
    typ, coords = _gj_coords(text)
    ok = typ.isNotNull() | F.try_parse_json(_c(text)).isNotNull()
    return ok, typ, coords


def rings_from_coords(coords) -> Column:
    return F.transform(_c(coords), lambda ring: F.transform(ring, lambda p: pt(p[0], p[1])))


def geojson_error_from(ok, typ, coords) -> Column:
    """G1 validity from ``geojson_parts`` columns: NULL when valid, else the
    first failure."""
    ok, typ, coords = _c(ok), _c(typ), _c(coords)
    return (F.when(~ok, F.lit("not valid JSON"))
            .when(~typ.isin("Polygon", "MultiPolygon"), F.concat(F.lit("unsupported geometry type: "),
                                                               F.coalesce(typ, F.lit("null"))))
            .when(coords.isNull() | (F.size(coords) == 0), F.lit("coordinates are not rings of positions"))
            .when(F.exists(coords, lambda r: F.size(r) < 4),
                  F.lit("each linear ring must contain at least 4 positions"))
            .when(F.exists(coords, lambda r: F.element_at(r, 1) != F.element_at(r, -1)),
                  F.lit("the first and last positions in each linear ring must be equivalent")))


@_memo
def geojson_error(text) -> Column:
    """G1 validity: NULL when valid, else the reason (first failure)."""
    return geojson_error_from(*geojson_parts(text))


def rings_from_wkt(text) -> Column:
    """G3 in: ``POLYGON((x y, ...), (...))`` → rings."""
    body = F.regexp_extract(F.upper(F.trim(_c(text))), r"^POLYGON\s*\(\((.*)\)\)$", 1)
    rings = F.split(body, r"\)\s*,\s*\(")
    return F.transform(rings, lambda r: F.transform(
        F.split(F.trim(r), r"\s*,\s*"),
        lambda p: pt(F.split(F.trim(p), r"\s+")[0].cast("double"),
                     F.split(F.trim(p), r"\s+")[1].cast("double"))))


@_memo
def wkt(rings, fmt: str = "%.6f") -> Column:
    """G3 out: rings → ``POLYGON((x y, ...), (...))`` text."""
    ring_txt = F.transform(_c(rings), lambda r: F.concat(F.lit("("), F.array_join(
        F.transform(r, lambda p: F.format_string(f"{fmt} {fmt}", p["x"], p["y"])), ", "), F.lit(")")))
    return F.concat(F.lit("POLYGON("), F.array_join(ring_txt, ", "), F.lit(")"))


# ----------------------------------------------------------------- G4

def with_srid(rings, srid) -> Column:
    """A geometry that carries its reference system: struct<srid, rings>."""
    s = F.lit(srid) if isinstance(srid, int) else _c(srid)
    return F.struct(s.cast("int").alias("srid"), _c(rings).alias("rings"))


def ewkt(geometry, fmt: str = "%.6f") -> Column:
    """``SRID=n;POLYGON(...)`` of :func:`with_srid`; without a reference
    system (NULL or 0) the plain text."""
    g = _c(geometry)
    text = wkt(g["rings"], fmt)
    return F.when(F.coalesce(g["srid"], F.lit(0)) != 0, F.concat(F.lit("SRID="), g["srid"].cast("string"), F.lit(";"), text)).otherwise(text)


def from_ewkt(text) -> Column:
    """The inverse: struct<srid, rings>, srid 0 where none is named."""
    t = _c(text)
    srid = F.regexp_extract(t, r"^\s*SRID\s*=\s*(\d+)\s*;", 1)
    return with_srid(rings_from_wkt(F.regexp_replace(t, r"^\s*SRID\s*=\s*\d+\s*;", "")), F.coalesce(srid.try_cast("int"), F.lit(0)))


def geojson_dims(text) -> Column:
    """Numbers of the first position of a GeoJSON polygon (2, 3 or 4)."""
    doc = F.try_parse_json(_c(text))
    first = F.coalesce(F.try_variant_get(doc, "$.coordinates[0][0][0]", "array<double>"), F.try_variant_get(doc, "$.coordinates[0][0]", "array<double>"))
    return F.size(first)


def box_rings(x0, y0, x1, y1) -> Column:
    x0, y0, x1, y1 = map(_c, (x0, y0, x1, y1))
    return F.array(F.array(pt(x0, y0), pt(x1, y0), pt(x1, y1), pt(x0, y1), pt(x0, y0)))


# ----------------------------------------------------------------- bbox, A12

@_memo
def bbox(rings) -> Column:
    """struct<xmin, ymin, xmax, ymax> of all vertices."""
    pts = F.flatten(_c(rings))
    xs = F.transform(pts, lambda p: p["x"])
    ys = F.transform(pts, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"),
                    F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


# Bounding-box operators (a, b are bbox structs).
def box_left(a, b):       # <<  strictly left
    return _c(a)["xmax"] < _c(b)["xmin"]


def box_overleft(a, b):   # &<  does not extend to the right of
    return _c(a)["xmax"] <= _c(b)["xmax"]


def box_overlaps(a, b):   # &&
    a, b = _c(a), _c(b)
    return (a["xmin"] <= b["xmax"]) & (a["xmax"] >= b["xmin"]) & \
           (a["ymin"] <= b["ymax"]) & (a["ymax"] >= b["ymin"])


def box_overright(a, b):  # &>  does not extend to the left of
    return _c(a)["xmin"] >= _c(b)["xmin"]


def box_right(a, b):      # >>
    return _c(a)["xmin"] > _c(b)["xmax"]


def box_same(a, b):       # ~=
    a, b = _c(a), _c(b)
    return (a["xmin"] == b["xmin"]) & (a["ymin"] == b["ymin"]) & \
           (a["xmax"] == b["xmax"]) & (a["ymax"] == b["ymax"])


def box_contains(a, b):   # ~
    a, b = _c(a), _c(b)
    return (a["xmin"] <= b["xmin"]) & (a["ymin"] <= b["ymin"]) & \
           (a["xmax"] >= b["xmax"]) & (a["ymax"] >= b["ymax"])


def box_within(a, b):     # @
    return box_contains(b, a)


def box_overbelow(a, b):  # &<|  does not extend above
    return _c(a)["ymax"] <= _c(b)["ymax"]


def box_below(a, b):      # <<|
    return _c(a)["ymax"] < _c(b)["ymin"]


def box_above(a, b):      # |>>
    return _c(a)["ymin"] > _c(b)["ymax"]


def box_overabove(a, b):  # |&>  does not extend below
    return _c(a)["ymin"] >= _c(b)["ymin"]


def box_centre(b) -> Column:
    b = _c(b)
    return pt((b["xmin"] + b["xmax"]) / 2, (b["ymin"] + b["ymax"]) / 2)


def centroid_distance(a, b) -> Column:
    """L4 ``<->``: distance between bbox centres."""
    ca, cb = box_centre(a), box_centre(b)
    return F.sqrt((ca["x"] - cb["x"]) ** 2 + (ca["y"] - cb["y"]) ** 2)


def box_distance(a, b) -> Column:
    """L4 ``<#>``: distance between boxes (0 when they overlap)."""
    a, b = _c(a), _c(b)
    dx = F.greatest(a["xmin"] - b["xmax"], b["xmin"] - a["xmax"], F.lit(0.0))
    dy = F.greatest(a["ymin"] - b["ymax"], b["ymin"] - a["ymax"], F.lit(0.0))
    return F.sqrt(dx * dx + dy * dy)


# ----------------------------------------------------------------- G8

@_memo
def edges(rings) -> Column:
    """All ring edges as array<struct<a, b>>."""
    return F.flatten(F.transform(_c(rings), lambda r: F.zip_with(
        F.slice(r, 1, F.size(r) - 1), F.slice(r, 2, F.size(r) - 1),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")))))


@_memo
def point_in_rings(p, rings) -> Column:
    """Even-odd rule over every ring (holes and parts included)."""
    p = _c(p)
    crossings = F.aggregate(edges(rings), F.lit(0), lambda acc, e: acc + F.when(
        ((e["a"]["y"] > p["y"]) != (e["b"]["y"] > p["y"])) &
        (p["x"] < F.try_divide((e["b"]["x"] - e["a"]["x"]) * (p["y"] - e["a"]["y"]),
                               e["b"]["y"] - e["a"]["y"]) + e["a"]["x"]), 1).otherwise(0))
    return (crossings % 2) == 1


def _orient(p, q, r) -> Column:
    v = (q["x"] - p["x"]) * (r["y"] - p["y"]) - (q["y"] - p["y"]) * (r["x"] - p["x"])
    return F.signum(v)


def segments_touch(e, f) -> Column:
    """Closed segments intersect (touching and collinear overlap count)."""
    p1, p2, q1, q2 = e["a"], e["b"], f["a"], f["b"]
    o1, o2 = _orient(p1, p2, q1), _orient(p1, p2, q2)
    o3, o4 = _orient(q1, q2, p1), _orient(q1, q2, p2)
    boxes = (F.least(p1["x"], p2["x"]) <= F.greatest(q1["x"], q2["x"])) & \
            (F.least(q1["x"], q2["x"]) <= F.greatest(p1["x"], p2["x"])) & \
            (F.least(p1["y"], p2["y"]) <= F.greatest(q1["y"], q2["y"])) & \
            (F.least(q1["y"], q2["y"]) <= F.greatest(p1["y"], p2["y"]))
    return (o1 * o2 <= 0) & (o3 * o4 <= 0) & boxes


@_memo
def intersects(a, b) -> Column:
    """Polygons share a point (boundary contact included)."""
    a, b = _c(a), _c(b)
    ea, eb = edges(a), edges(b)
    return (F.exists(F.flatten(a), lambda p: point_in_rings(p, b)) |
            F.exists(F.flatten(b), lambda p: point_in_rings(p, a)) |
            F.exists(ea, lambda e: F.exists(eb, lambda f: segments_touch(e, f))))


def contains_point(rings, x, y) -> Column:
    return point_in_rings(pt(x, y), rings)


# ----------------------------------------------------------------- G5

R_SPHERE = 6378137.0
A_GRS80 = 6378137.0
F_GRS80 = 1 / 298.257222101
A_WGS84 = 6378137.0
F_WGS84 = 1 / 298.257223563

# Albers equal-area parameters (lat1, lat2, lat0, lon0,
# false easting, false northing) of the supported Albers CRSs.
ALBERS = {
    3577: (-18.0, -36.0, 0.0, 132.0, 0.0, 0.0),
    3085: (27.5, 35.0, 18.0, -100.0, 1500000.0, 6000000.0),
}


def mercator_forward(lon, lat) -> tuple[Column, Column]:
    lon, lat = _c(lon), _c(lat)
    return (F.radians(lon) * R_SPHERE,
            F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * R_SPHERE)


def mercator_inverse(x, y) -> tuple[Column, Column]:
    x, y = _c(x), _c(y)
    return (F.degrees(x / R_SPHERE),
            F.degrees(F.lit(2.0) * F.atan(F.exp(y / R_SPHERE)) - F.lit(math.pi / 2)))


def _albers_consts(srid: int):
    lat1, lat2, lat0, lon0, fe, fn = ALBERS[srid]
    a, f = A_GRS80, F_GRS80
    e2 = 2 * f - f * f
    e = math.sqrt(e2)

    def q(phi):
        s = math.sin(phi)
        return (1 - e2) * (s / (1 - e2 * s * s) - (1 / (2 * e)) * math.log((1 - e * s) / (1 + e * s)))

    def m(phi):
        s = math.sin(phi)
        return math.cos(phi) / math.sqrt(1 - e2 * s * s)
    p1, p2, p0 = map(math.radians, (lat1, lat2, lat0))
    n = (m(p1) ** 2 - m(p2) ** 2) / (q(p2) - q(p1))
    C = m(p1) ** 2 + n * q(p1)
    rho0 = a * math.sqrt(C - n * q(p0)) / n
    return a, e, e2, n, C, rho0, lon0, fe, fn


def albers_forward(lon, lat, srid: int = 3577) -> tuple[Column, Column]:
    a, e, e2, n, C, rho0, lon0, fe, fn = _albers_consts(srid)
    s = F.sin(F.radians(_c(lat)))
    q = F.lit(1 - e2) * (s / (F.lit(1.0) - F.lit(e2) * s * s) -
                         F.lit(1 / (2 * e)) * F.log((F.lit(1.0) - F.lit(e) * s) / (F.lit(1.0) + F.lit(e) * s)))
    rho = F.lit(a) * F.sqrt(F.lit(C) - F.lit(n) * q) / F.lit(n)
    theta = F.lit(n) * F.radians(_c(lon) - F.lit(lon0))
    return F.lit(fe) + rho * F.sin(theta), F.lit(fn) + F.lit(rho0) - rho * F.cos(theta)


def albers_inverse(x, y, srid: int = 3577) -> tuple[Column, Column]:
    """Lon/lat of projected coordinates, the latitude by its series in the
    authalic one (the terms left out are below a millimetre)."""
    a, e, e2, n, C, rho0, lon0, fe, fn = _albers_consts(srid)
    sign = math.copysign(1.0, n)
    dx, dy = _c(x) - fe, F.lit(rho0) - (_c(y) - fn)
    rho2 = dx * dx + dy * dy
    lon = F.lit(lon0) + F.degrees(F.atan2(dx * sign, dy * sign)) / n
    q = (F.lit(C) - rho2 * (n / a) ** 2) / n
    q_pole = 1 - (1 - e2) / (2 * e) * math.log((1 - e) / (1 + e))
    beta = F.asin(F.greatest(F.least(q / q_pole, F.lit(1.0)), F.lit(-1.0)))
    phi = beta + (e2 / 3 + 31 * e2 ** 2 / 180 + 517 * e2 ** 3 / 5040) * F.sin(2 * beta) \
        + (23 * e2 ** 2 / 360 + 251 * e2 ** 3 / 3780) * F.sin(4 * beta) + 761 * e2 ** 3 / 45360 * F.sin(6 * beta)
    return lon, F.degrees(phi)


def _kruger():
    f = F_WGS84
    n = f / (2 - f)
    A = A_WGS84 / (1 + n) * (1 + n ** 2 / 4 + n ** 4 / 64)
    alpha = (n / 2 - 2 * n ** 2 / 3 + 5 * n ** 3 / 16 + 41 * n ** 4 / 180,
             13 * n ** 2 / 48 - 3 * n ** 3 / 5 + 557 * n ** 4 / 1440,
             61 * n ** 3 / 240 - 103 * n ** 4 / 140,
             49561 * n ** 4 / 161280)
    beta = (n / 2 - 2 * n ** 2 / 3 + 37 * n ** 3 / 96 - n ** 4 / 360,
            n ** 2 / 48 + n ** 3 / 15 - 437 * n ** 4 / 1440,
            17 * n ** 3 / 480 - 37 * n ** 4 / 840,
            4397 * n ** 4 / 161280)
    delta = (2 * n - 2 * n ** 2 / 3 - 2 * n ** 3 + 116 * n ** 4 / 45,
             7 * n ** 2 / 3 - 8 * n ** 3 / 5 - 227 * n ** 4 / 45,
             56 * n ** 3 / 15 - 136 * n ** 4 / 35,
             4279 * n ** 4 / 630)
    return n, A, alpha, beta, delta


K0_UTM = 0.9996


def utm_zone_lon0(zone) -> Column:
    return _c(zone).cast("double") * 6.0 - 183.0


def utm_forward(lon, lat, zone, south) -> tuple[Column, Column]:
    """Transverse Mercator (Krüger 4th order), WGS84, UTM zone ``zone``."""
    n, A, alpha, _, _ = _kruger()
    phi = F.radians(_c(lat))
    lam = F.radians(_c(lon) - utm_zone_lon0(zone))
    k = 2 * math.sqrt(n) / (1 + n)
    t = F.sinh(F.atanh(F.sin(phi)) - F.lit(k) * F.atanh(F.lit(k) * F.sin(phi)))
    xi = F.atan2(t, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(F.lit(1.0) + t * t))
    e_sum, n_sum = eta, xi
    for j, a in enumerate(alpha, start=1):
        e_sum = e_sum + F.lit(a) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        n_sum = n_sum + F.lit(a) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    x = F.lit(500000.0) + F.lit(K0_UTM * A) * e_sum
    y = F.when(_c(south), F.lit(10000000.0)).otherwise(F.lit(0.0)) + F.lit(K0_UTM * A) * n_sum
    return x, y


def utm_inverse(x, y, zone, south) -> tuple[Column, Column]:
    n, A, _, beta, delta = _kruger()
    xi = (_c(y) - F.when(_c(south), F.lit(10000000.0)).otherwise(F.lit(0.0))) / F.lit(K0_UTM * A)
    eta = (_c(x) - F.lit(500000.0)) / F.lit(K0_UTM * A)
    xi_p, eta_p = xi, eta
    for j, b in enumerate(beta, start=1):
        xi_p = xi_p - F.lit(b) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta_p = eta_p - F.lit(b) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi_p) / F.cosh(eta_p))
    phi = chi
    for j, d in enumerate(delta, start=1):
        phi = phi + F.lit(d) * F.sin(2 * j * chi)
    lon = utm_zone_lon0(zone) + F.degrees(F.atan2(F.sinh(eta_p), F.cos(xi_p)))
    return lon, F.degrees(phi)


def _is_utm(srid: Column) -> tuple[Column, Column, Column]:
    north = (srid >= 32601) & (srid <= 32660)
    south = (srid >= 32701) & (srid <= 32760)
    zone = F.when(north, srid - 32600).when(south, srid - 32700)
    return north | south, zone, south


def project_point(lon, lat, srid) -> Column:
    """G5 forward: lon/lat (EPSG:4326) → struct<x, y> in ``srid`` (an int or
    an int Column; unsupported codes give NULL)."""
    if isinstance(srid, int):
        if srid == 4326:
            return pt(lon, lat)
        if srid == 3857:
            return pt(*mercator_forward(lon, lat))
        if srid in ALBERS:
            return pt(*albers_forward(lon, lat, srid))
        if 32601 <= srid <= 32660 or 32701 <= srid <= 32760:
            return pt(*utm_forward(lon, lat, F.lit(srid % 100), F.lit(srid > 32700)))
        raise ValueError(f"unsupported EPSG:{srid}")
    s = _c(srid)
    is_utm, zone, south = _is_utm(s)
    out = (F.when(s == 4326, pt(lon, lat))
           .when(s == 3857, pt(*mercator_forward(lon, lat))))
    for code in ALBERS:
        out = out.when(s == code, pt(*albers_forward(lon, lat, code)))
    return out.when(is_utm, pt(*utm_forward(lon, lat, zone, south)))


def unproject_point(x, y, srid) -> Column:
    """G5 inverse to lon/lat for 4326, 3857, Albers and UTM (NULL otherwise)."""
    s = F.lit(srid) if isinstance(srid, int) else _c(srid)
    is_utm, zone, south = _is_utm(s)
    out = F.when(s == 4326, pt(x, y)).when(s == 3857, pt(*mercator_inverse(x, y)))
    for code in ALBERS:
        out = out.when(s == code, pt(*albers_inverse(x, y, code)))
    return out.when(is_utm, pt(*utm_inverse(x, y, zone, south)))


@_memo
def project_rings(rings, srid) -> Column:
    return F.transform(_c(rings), lambda r: F.transform(
        r, lambda p: project_point(p["x"], p["y"], srid)))


@_memo
def inverse_projection(rings, srid) -> Column:
    """Rings in ``srid`` → rings in lon/lat."""
    return F.transform(_c(rings), lambda r: F.transform(
        r, lambda p: unproject_point(p["x"], p["y"], srid)))


def parse_epsg(crs) -> Column:
    """'EPSG:3577' / 'epsg:3577' / 'urn:ogc:def:crs:EPSG::3577' → 3577."""
    return F.regexp_extract(F.upper(_c(crs)), r"EPSG:+(\d+)$", 1).try_cast("int")


# ----------------------------------------------------------------- G6 / G7

def tile_index(v, size: float) -> Column:
    """Grid index of a projected coordinate (origin 0)."""
    return F.floor(_c(v) / F.lit(float(size))).cast("int")


def tile_bbox(tx, ty, size: float) -> Column:
    """Projected bounds of tile (tx, ty)."""
    tx, ty = _c(tx), _c(ty)
    return F.struct((tx * size).cast("double").alias("xmin"), (ty * size).cast("double").alias("ymin"),
                    ((tx + 1) * size).cast("double").alias("xmax"),
                    ((ty + 1) * size).cast("double").alias("ymax"))


def tile_shape(size: float, resolution) -> tuple[int, int]:
    """Pixels per tile (rows, cols) from tile size and (y, x) resolution."""
    ry, rx = resolution
    return int(round(size / abs(ry))), int(round(size / abs(rx)))


def pixel_to_coord(col, row, transform) -> tuple[Column, Column]:
    """Affine transform [a, b, c, d, e, f] maps (col, row) → (x, y)."""
    a, b, c, d, e, f = transform[:6]
    col, row = _c(col), _c(row)
    return col * a + row * b + c, col * d + row * e + f
