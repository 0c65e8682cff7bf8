"""Checked queries: scene catalogue (entry point C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.fields import doc_variant, flatten_ranges, get_path, range_overlaps, make_range
from tessera.functions.geometry import wkt
from tessera.operators import catalogue as cat
from tessera.operators import ranges as rng
from tessera.plans.oracle_lenses import MTYPE, SCENE
from tessera.plans.registry import query
from tessera.sources import catalogue as src
from tessera.sources.tables import broadcast_if_small

R6 = 6


def _round(df, digits=R6):
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if f.dataType.typeName() == "double" else F.col(f.name)
                       for f in df.schema.fields])


# EPSG:3577 on GRS80 (equatorial radius, eccentricity squared,
# eccentricity; cone constant n, C and rho0 from the standard parallels -18 and
# -36, latitude of origin 0), worked out from the published formulae.
_A, _E2, _E = "6378137.0", "0.006694380022900787", "0.08181919104281579"
_N, _C, _RHO0 = "(-0.448478997168302)", "1.1805242276692356", "(-15452159.644039396)"


def albers_sql(lon: str, lat: str) -> tuple[str, str]:
    s = f"sin(radians({lat}))"
    q = f"((1 - {_E2}) * ({s} / (1.0 - {_E2} * {s} * {s}) - 1 / (2 * {_E}) * ln((1.0 - {_E} * {s}) / (1.0 + {_E} * {s}))))"
    rho = f"({_A} * sqrt({_C} - {_N} * {q}) / {_N})"
    th = f"({_N} * radians({lon} - 132.0))"
    return f"({rho} * sin({th}))", f"({_RHO0} - {rho} * cos({th}))"


# ------------------------------------------------------------------ S1, S2, S4

@query("s1_copy_text_scan", covers=("S1",), sql=f"""
WITH {SCENE}
SELECT id, metadata_type_ref, dataset_type_ref, archived, added, 'lens' AS added_by,
       CAST(id AS VARCHAR) AS doc_id
FROM scene""")
def s1_copy_text_scan(spark, sf_dir):
    """Dataset rows rendered in COPY text form and parsed back (S1 reader)."""
    lines = src.to_copy_text(src.dataset(spark, sf_dir))
    d = src.parse_copy_text(lines)
    return d.select("id", "metadata_type_ref", "dataset_type_ref", "archived", "added", "added_by",
                    get_path(doc_variant("metadata"), ["id"]).alias("doc_id"))


@query("s2_location_uri", covers=("S2", "J9"), sql=f"""
WITH {SCENE}
SELECT s.id, s.product, 's3:' || printf('//lens-bucket/scenes/%d/odc-metadata.yaml', s.id) AS uri
FROM scene s JOIN orders o ON o.o_orderkey = s.id
WHERE s.archived IS NULL""")
def s2_location_uri(spark, sf_dir):
    """Active locations joined to their dataset (FK join) with full URI."""
    loc = cat.active(src.dataset_location(spark, sf_dir))
    d = cat.active(src.scene_base(spark, sf_dir)).select(
        "id", F.col("dataset_type_ref"))
    dt = src.dataset_type(spark, sf_dir).select(F.col("id").alias("pid"), F.col("name").alias("product"))
    return (loc.join(d, loc.dataset_ref == d.id).join(broadcast_if_small(dt), F.col("dataset_type_ref") == F.col("pid"))
            .select(d.id, "product", F.concat(loc.uri_scheme, F.lit(":"), loc.uri_body).alias("uri")))


@query("s4_product_measurements", covers=("S4", "P6", "F22"), sql="""
WITH m(name, dtype, nodata, aliases) AS (VALUES
  ('blue', 'int16', -999, 'band_2,sr_band2'), ('green', 'int16', -999, 'band_3,sr_band3'),
  ('red', 'int16', -999, 'band_4,sr_band4'), ('pixel_qa', 'uint16', 1, 'qa')),
f(flag, lo_bit, n_bits, n_values) AS (VALUES
  ('nodata', 0, 1, 2), ('water', 1, 1, 2), ('clear', 2, 1, 2), ('cloud_confidence', 3, 2, 4))
SELECT lower(n.n_name) AS product, m.name AS measurement, m.dtype, CAST(m.nodata AS BIGINT) AS nodata,
       m.aliases, f.flag, f.lo_bit, f.n_bits, CAST(f.n_values AS INTEGER) AS n_values
FROM nation n CROSS JOIN m LEFT JOIN f ON m.name = 'pixel_qa'""")
def s4_product_measurements(spark, sf_dir):
    """Product definitions exploded to measurements and QA flag bit fields."""
    dt = src.dataset_type(spark, sf_dir)
    meas = dt.select(F.col("name").alias("product"), F.explode(F.from_json(
        F.get_json_object("definition", "$.measurements"),
        "array<struct<name string, dtype string, nodata bigint, aliases array<string>, "
        "flags_definition map<string, struct<bits array<int>, values map<string,string>>>>>")).alias("m"))
    return meas.select(
        "product", F.col("m.name").alias("measurement"), F.col("m.dtype").alias("dtype"),
        F.col("m.nodata").alias("nodata"), F.array_join("m.aliases", ",").alias("aliases"),
        F.explode_outer("m.flags_definition").alias("flag", "fd")).select(
        "product", "measurement", "dtype", "nodata", "aliases", "flag",
        F.array_min("fd.bits").alias("lo_bit"), F.size("fd.bits").alias("n_bits"),
        F.size(F.map_keys("fd.values")).alias("n_values"))


# ------------------------------------------------------------------ P1 views

_EO_COLS = ("id, added AS indexed_time, 'lens' AS indexed_by, product, dataset_type_ref AS dataset_type_id, "
            "mtype AS metadata_type, metadata_type_ref AS metadata_type_id")


def _view(spark, sf_dir, mtype_id, product_id=None, fields=None):
    v = cat.dataset_view(src.dataset(spark, sf_dir), src.dataset_type(spark, sf_dir),
                         src.metadata_type(spark, sf_dir), mtype_id, product_id, fields=fields)
    v = v.drop("metadata_doc")
    ranges = [f.name for f in v.schema.fields if f.dataType.typeName() == "struct"]
    return _round(flatten_ranges(v, ranges))


_EO_SQL = f"""
WITH {SCENE}
SELECT {_EO_COLS}, added AS creation_time, 'GeoTIFF' AS format, CAST(NULL AS VARCHAR) AS label,
       round(lat - 0.5, 6) AS lat_lo, round(lat + 0.5, 6) AS lat_hi,
       round(lon - 0.5, 6) AS lon_lo, round(lon + 0.55, 6) AS lon_hi,
       t AS time_lo, t AS time_hi, 'LANDSAT_8' AS platform, 'OLI_TIRS' AS instrument,
       'level1' AS product_type
FROM scene WHERE archived IS NULL AND metadata_type_ref = 0"""


@query("p1a_eo_dataset_view", covers=("P1a", "P2", "P3", "J1", "F1", "F11", "F18", "F19", "X1", "X6"),
       sql=_EO_SQL)
def p1a_eo_dataset_view(spark, sf_dir):
    return _view(spark, sf_dir, 0)


@query("p1b_product_dataset_view", covers=("P1b", "P4"), sql=_EO_SQL + " AND dataset_type_ref = 5")
def p1b_product_dataset_view(spark, sf_dir):
    return _view(spark, sf_dir, 0, product_id=5)


_EO3_SELECT = f"""
SELECT {_EO_COLS}, 'landsat-8' AS platform, 'oli_tirs' AS instrument, 'ard' AS product_family,
       printf('%03d%03d', o_custkey % 97, o_custkey % 89) AS region_code, 'final' AS dataset_maturity,
       'GeoTIFF' AS format, printf('scene_%d', id) AS label, round(CAST(o_orderkey % 10001 AS DOUBLE) / 100.0, 6) AS cloud_cover,
       added AS creation_time,
       round(lat - 0.5, 6) AS lat_lo, round(lat + 0.5, 6) AS lat_hi,
       round(lon - 0.5, 6) AS lon_lo, round(lon + 0.55, 6) AS lon_hi"""


@query("p1c_eo3_dataset_view", covers=("P1c",), sql=f"""
WITH {SCENE}
{_EO3_SELECT}, t AS time_lo, t AS time_hi
FROM scene WHERE archived IS NULL AND metadata_type_ref = 1""")
def p1c_eo3_dataset_view(spark, sf_dir):
    return _view(spark, sf_dir, 1)


@query("p2_declared_fields_ard", covers=("P2",), sql=f"""
WITH {SCENE}
{_EO3_SELECT}, t - INTERVAL 10 SECOND AS time_lo, t + INTERVAL 10 SECOND AS time_hi
FROM scene WHERE archived IS NULL AND metadata_type_ref = 2""")
def p2_declared_fields_ard(spark, sf_dir):
    """The eo3 declaration applied to ARD documents: the time range picks
    the dtr:start/end bounds through least/greatest over declared paths."""
    return _view(spark, sf_dir, 2)


@query("p1d_telemetry_view", covers=("P1d",), sql=f"""
WITH {SCENE}
SELECT {_EO_COLS}, 'LANDSAT_8' AS platform, 'OLI_TIRS' AS instrument,
       'satellite_telemetry_data' AS product_type, 'ASA' AS gsi, CAST(o_orderkey AS INTEGER) AS orbit,
       'MD' AS format, printf('telemetry_%d', id) AS label, added AS creation_time,
       CAST(o_custkey % 233 + 1 AS INTEGER) AS sat_path_lo,
       CAST(greatest(o_custkey % 233 + 1, o_custkey % 233 + 1 + CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END) AS INTEGER) AS sat_path_hi,
       CAST(o_orderkey % 248 + 3 AS INTEGER) AS sat_row_lo,
       CAST(greatest(o_orderkey % 248 + 3, o_orderkey % 248 + 3 + CASE WHEN o_orderkey % 3 = 0 THEN -2 ELSE 2 END) AS INTEGER) AS sat_row_hi,
       t AS time_lo, t + INTERVAL 9 MINUTE AS time_hi
FROM scene WHERE archived IS NULL AND metadata_type_ref = 3""")
def p1d_telemetry_view(spark, sf_dir):
    return _view(spark, sf_dir, 3)


# ------------------------------------------------------------------ J3, U1, U2, J2

@query("j3_type_semi_join", covers=("J3", "P4", "A11"), sql=f"""
WITH {SCENE}, {MTYPE}
SELECT dataset_type_ref, count(*) AS n_datasets, count(archived) AS n_archived
FROM scene WHERE metadata_type_ref IN (SELECT id FROM mtype WHERE name IN ('eo', 'eo3'))
GROUP BY dataset_type_ref""")
def j3_type_semi_join(spark, sf_dir):
    d = cat.of_type_names(src.scene_base(spark, sf_dir), src.metadata_type(spark, sf_dir), ("eo", "eo3"))
    return d.groupBy("dataset_type_ref").agg(F.count(F.lit(1)).alias("n_datasets"),
                                             F.count("archived").alias("n_archived"))


def _ring_sql(pts):
    return "'POLYGON((' || " + " || ', ' || ".join(
        f"printf('%.6f %.6f', {x}, {y})" for x, y in pts) + " || '))'"


_BOX = [("lon - 0.5", "lat - 0.5"), ("lon + 0.55", "lat - 0.5"), ("lon + 0.55", "lat + 0.5"),
        ("lon - 0.5", "lat + 0.5"), ("lon - 0.5", "lat - 0.5")]
_CORNER = [("lon - 0.5", "lat - 0.5"), ("lon + 0.5", "lat - 0.5"), ("lon + 0.55", "lat + 0.5"),
           ("lon - 0.45", "lat + 0.5"), ("lon - 0.5", "lat - 0.5")]
_ARD = [("lon - 0.5", "lat - 0.5"), ("lon + 0.5", "lat - 0.5"), ("lon + 0.55", "lat + 0.5"),
        ("lon - 0.45", "lat + 0.5"), ("lon - 0.5", "lat - 0.5")]


def _space_sql(active: bool) -> str:
    act = " AND archived IS NULL" if active else ""
    return f"""
SELECT id, {_ring_sql(_BOX)} AS wkt FROM scene WHERE mtype = 'eo3'{act}
UNION SELECT id, {_ring_sql(_CORNER)} AS wkt FROM scene WHERE mtype = 'eo'{act}
UNION SELECT id, {_ring_sql(_ARD)} AS wkt FROM scene WHERE mtype = 'eo3_landsat_ard'{act}"""


@query("u1_space_view", covers=("U1", "G2", "G3", "G4", "G5", "F3", "F4", "J3"),
       sql=f"WITH {SCENE} {_space_sql(False)}")
def u1_space_view(spark, sf_dir):
    s = cat.space_view(src.dataset(spark, sf_dir), src.metadata_type(spark, sf_dir), "v1")
    return s.select("id", wkt("rings").alias("wkt"))


@query("u1_space_view_v2", covers=("U1", "P3"), sql=f"WITH {SCENE} {_space_sql(True)}")
def u1_space_view_v2(spark, sf_dir):
    s = cat.space_view(src.dataset(spark, sf_dir), src.metadata_type(spark, sf_dir), "v2")
    return s.select("id", wkt("rings").alias("wkt"))


def _time_cols(df):
    return df.select("dataset_type_ref", "id", F.col("temporal_extent.lo").alias("t_lo"),
                     F.col("temporal_extent.hi").alias("t_hi"),
                     F.col("temporal_extent.lo_inc").alias("lo_inc"),
                     F.col("temporal_extent.hi_inc").alias("hi_inc"))


@query("u2_time_view", covers=("U2", "F17", "F11"), sql=f"""
WITH {SCENE}
SELECT dataset_type_ref, id, t AS t_lo, t + INTERVAL 1 MICROSECOND AS t_hi, true AS lo_inc, false AS hi_inc
FROM scene WHERE mtype = 'eo'
UNION SELECT dataset_type_ref, id, t, t + INTERVAL 1 DAY, true, false FROM scene WHERE mtype = 'eo3'
UNION SELECT dataset_type_ref, id, t - INTERVAL 10 SECOND, t + INTERVAL 10 SECOND, true, false
FROM scene WHERE mtype = 'eo3_landsat_ard'""")
def u2_time_view(spark, sf_dir):
    return _time_cols(cat.time_view(src.dataset(spark, sf_dir), src.metadata_type(spark, sf_dir), "v1"))


@query("u2_time_view_v2", covers=("U2", "F17"), sql=f"""
WITH {SCENE}
SELECT dataset_type_ref, id, t AS t_lo, t AS t_hi, true AS lo_inc, true AS hi_inc
FROM scene WHERE mtype = 'eo' AND archived IS NULL
UNION SELECT dataset_type_ref, id, t, t, true, true FROM scene WHERE mtype = 'eo3' AND archived IS NULL
UNION SELECT dataset_type_ref, id, t - INTERVAL 10 SECOND, t + INTERVAL 10 SECOND, true, true
FROM scene WHERE mtype = 'eo3_landsat_ard' AND archived IS NULL""")
def u2_time_view_v2(spark, sf_dir):
    return _time_cols(cat.time_view(src.dataset(spark, sf_dir), src.metadata_type(spark, sf_dir), "v2"))


@query("j2_space_time_view", covers=("J2",), sql=f"""
WITH {SCENE}, sp AS ({_space_sql(False)}),
tm AS (SELECT dataset_type_ref, id, t AS t_lo, t + INTERVAL 1 MICROSECOND AS t_hi FROM scene WHERE mtype = 'eo'
       UNION SELECT dataset_type_ref, id, t, t + INTERVAL 1 DAY FROM scene WHERE mtype = 'eo3'
       UNION SELECT dataset_type_ref, id, t - INTERVAL 10 SECOND, t + INTERVAL 10 SECOND
       FROM scene WHERE mtype = 'eo3_landsat_ard')
SELECT sp.id, tm.dataset_type_ref, sp.wkt, tm.t_lo, tm.t_hi FROM sp JOIN tm ON sp.id = tm.id""")
def j2_space_time_view(spark, sf_dir):
    d, mt = src.dataset(spark, sf_dir), src.metadata_type(spark, sf_dir)
    st = cat.space_time_view(d, mt)
    return st.select("id", "dataset_type_ref", wkt("rings").alias("wkt"),
                     F.col("temporal_extent.lo").alias("t_lo"), F.col("temporal_extent.hi").alias("t_hi"))


# ------------------------------------------------------------------ A1-A6, L3, S5

_PRODUCTS = (0, 5, 10, 4)


@query("a1_a2_corner_extremes", covers=("A1", "A2", "X2", "F18"), sql=f"""
WITH {SCENE}, s AS (SELECT * FROM scene WHERE dataset_type_ref IN {_PRODUCTS} AND archived IS NULL
                    AND mtype IN ('eo', 'middle east'))
SELECT round(max(lat + 0.5), 6) AS lat_max, round(min(lat - 0.5), 6) AS lat_min,
       round(max(lon + 0.55), 6) AS lon_max, round(min(lon - 0.5), 6) AS lon_min FROM s""")
def a1_a2_corner_extremes(spark, sf_dir):
    return _round(rng.corner_extremes(src.dataset(spark, sf_dir), _PRODUCTS))


def _a3_sql(key_expr: str, key_name: str, extra_where: str = "") -> str:
    # Corner points of eo documents, the lat/lon box of eo3 and ARD ones.
    left = "lon - CASE WHEN mtype IN ('eo', 'middle east') THEN 0.45 ELSE 0.5 END"
    right = "lon + CASE WHEN mtype IN ('eo', 'middle east') THEN 0.5 ELSE 0.55 END"
    xs = [albers_sql(lo, la) for lo, la in
          ((left, "lat + 0.5"), ("lon + 0.55", "lat + 0.5"), ("lon - 0.5", "lat - 0.5"), (right, "lat - 0.5"))]
    xl = ", ".join(x for x, _ in xs)
    yl = ", ".join(y for _, y in xs)
    return f"""
WITH {SCENE}, e AS (
  SELECT {key_expr} AS {key_name}, lat - 0.5 AS lat_lo, lat + 0.5 AS lat_hi, lon - 0.5 AS lon_lo, lon + 0.55 AS lon_hi,
         CAST(t + to_microseconds(CAST(round((lon + 0.025) * 240 * 1000000) AS BIGINT)) AS DATE) AS sd,
         least({xl}) AS x_lo, greatest({xl}) AS x_hi, least({yl}) AS y_lo, greatest({yl}) AS y_hi
  FROM scene WHERE archived IS NULL AND mtype <> 'telemetry' {extra_where}),
g AS (SELECT {key_name}, min(lat_lo) AS lat_min, max(lat_hi) AS lat_max, min(lon_lo) AS lon_min,
             max(lon_hi) AS lon_max, list_sort(list_distinct(list(sd))) AS dates,
             min(x_lo) AS x0, max(x_hi) AS x1, min(y_lo) AS y0, max(y_hi) AS y1
      FROM e GROUP BY {key_name})
SELECT {key_name}, round(lat_min, 6) AS lat_min, round(lat_max, 6) AS lat_max, round(lon_min, 6) AS lon_min,
       round(lon_max, 6) AS lon_max, dates,
       round(x0, 6) AS b3577_left, round(x1, 6) AS b3577_right, round(y0, 6) AS b3577_bottom, round(y1, 6) AS b3577_top,
       round(radians(lon_min) * 6378137.0, 6) AS b3857_left, round(radians(lon_max) * 6378137.0, 6) AS b3857_right,
       round(ln(tan(pi() / 4 + radians(lat_min) / 2)) * 6378137.0, 6) AS b3857_bottom,
       round(ln(tan(pi() / 4 + radians(lat_max) / 2)) * 6378137.0, 6) AS b3857_top
FROM g"""


def _flat_bboxes(df, key_cols):
    cols = [*key_cols, "lat_min", "lat_max", "lon_min", "lon_max", "dates"]
    for crs in ("3577", "3857"):
        for side in ("left", "right", "bottom", "top"):
            cols.append(F.col("bboxes")[f"EPSG:{crs}"][side].alias(f"b{crs}_{side}"))
    return _round(df.select(*cols))


@query("a3_product_ranges", covers=("A3", "A6", "L3", "G5"), sql=_a3_sql("dataset_type_ref", "id"))
def a3_product_ranges(spark, sf_dir):
    return _flat_bboxes(rng.product_ranges(src.dataset(spark, sf_dir)), ["id"])


@query("a4_multiproduct_ranges", covers=("A4",), sql=_a3_sql("'layer_' || CAST(dataset_type_ref % 2 AS VARCHAR)",
                                                              "wms_product_name"))
def a4_multiproduct_ranges(spark, sf_dir):
    layers = src.dataset_type(spark, sf_dir).select(
        F.col("id").alias("product_id"),
        F.concat(F.lit("layer_"), (F.col("id") % 2).cast("string")).alias("wms_product_name"))
    return _flat_bboxes(rng.multiproduct_ranges(src.dataset(spark, sf_dir), layers), ["wms_product_name"])


@query("a5_sub_product_ranges", covers=("A5", "A3"), sql=f"""
WITH a AS ({_a3_sql("dataset_type_ref", "product_id")}),
     b AS ({_a3_sql("dataset_type_ref * 1000 + id % 3", "k")})
SELECT product_id, CAST(NULL AS BIGINT) AS sub_product_id, lat_min, lat_max, lon_min, lon_max, dates,
       b3577_left, b3577_right, b3577_bottom, b3577_top, b3857_left, b3857_right, b3857_bottom, b3857_top FROM a
UNION ALL
SELECT CAST(k // 1000 AS SMALLINT), k % 1000, lat_min, lat_max, lon_min, lon_max, dates,
       b3577_left, b3577_right, b3577_bottom, b3577_top, b3857_left, b3857_right, b3857_bottom, b3857_top FROM b""")
def a5_sub_product_ranges(spark, sf_dir):
    d = src.dataset(spark, sf_dir)
    return _flat_bboxes(rng.sub_product_ranges(d, F.col("id") % 3), ["product_id", "sub_product_id"])


@query("s5_product_range_scan", covers=("S5",), sql=f"""
WITH r AS ({_a3_sql("dataset_type_ref", "id")})
SELECT id, len(dates) AS n_dates, dates[1] AS first_date, dates[len(dates)] AS last_date,
       b3577_left, b3577_top FROM r""")
def s5_product_range_scan(spark, sf_dir):
    """Product ranges stored as text JSON (the table form) and parsed back."""
    pr = rng.product_ranges(src.dataset(spark, sf_dir))
    stored = pr.select("id", F.to_json("dates").alias("dates"), F.to_json("bboxes").alias("bboxes"))
    p = rng.parse_product_ranges(stored)
    return _round(p.select("id", F.size("dates").alias("n_dates"), F.col("dates")[0].alias("first_date"),
                           F.element_at("dates", -1).alias("last_date"),
                           F.col("bboxes")["EPSG:3577"]["left"].alias("b3577_left"),
                           F.col("bboxes")["EPSG:3577"]["top"].alias("b3577_top")))


# ------------------------------------------------------------------ P10, F19, P11, P12

@query("p10_time_search", covers=("P10", "F19"), sql=f"""
WITH {SCENE}
SELECT dataset_type_ref, count(*) AS n_match
FROM scene WHERE mtype = 'eo' AND archived IS NULL
  AND t <= TIMESTAMP '1996-06-30 00:00:00' AND t >= TIMESTAMP '1996-01-01 00:00:00'
GROUP BY dataset_type_ref""")
def p10_time_search(spark, sf_dir):
    """Scenes whose time range overlaps the closed search period."""
    # Index columns prune the scan first; the declared range test is exact.
    d = cat.search_index(src.dataset(spark, sf_dir), time=("1996-01-01 00:00:00", "1996-06-30 00:00:00"))
    v = cat.dataset_view(d, src.dataset_type(spark, sf_dir), src.metadata_type(spark, sf_dir), 0)
    period = make_range(F.lit("1996-01-01 00:00:00").cast("timestamp_ntz"),
                        F.lit("1996-06-30 00:00:00").cast("timestamp_ntz"), "[]")
    return (v.where(range_overlaps("time", period)).groupBy(F.col("dataset_type_id").alias("dataset_type_ref"))
            .agg(F.count(F.lit(1)).alias("n_match")))


@query("p11_name_check", covers=("P11",), sql="""
SELECT 'metadata_type' AS tbl, CAST(r_regionkey AS SMALLINT) AS id,
       CASE r_regionkey WHEN 0 THEN 'eo' WHEN 1 THEN 'eo3' WHEN 2 THEN 'eo3_landsat_ard'
            WHEN 3 THEN 'telemetry' ELSE lower(r_name) END AS name
FROM region WHERE NOT regexp_matches(CASE r_regionkey WHEN 0 THEN 'eo' WHEN 1 THEN 'eo3' WHEN 2 THEN 'eo3_landsat_ard'
            WHEN 3 THEN 'telemetry' ELSE lower(r_name) END, '^\\w+$', 'i')
UNION ALL
SELECT 'dataset_type', CAST(n_nationkey AS SMALLINT), lower(n_name) FROM nation
WHERE NOT regexp_matches(lower(n_name), '^\\w+$', 'i')""")
def p11_name_check(spark, sf_dir):
    """Names violating the alphanumeric constraint ``^\\w+$`` (case-insensitive)."""
    bad = F.col("name").rlike(r"(?i)^\w+$")
    mt = src.metadata_type(spark, sf_dir).select(F.lit("metadata_type").alias("tbl"), "id", "name")
    dt = src.dataset_type(spark, sf_dir).select(F.lit("dataset_type").alias("tbl"), "id", "name")
    return mt.unionByName(dt).where(~bad)


@query("p12_integrity", covers=("P12",), sql=f"""
WITH {SCENE}
SELECT 'dataset.id duplicates' AS check_name, count(*) AS n_violations FROM (
  SELECT id FROM scene GROUP BY id HAVING count(*) > 1)
UNION ALL SELECT 'dataset.dataset_type_ref orphans', count(*) FROM scene
  WHERE dataset_type_ref NOT IN (SELECT n_nationkey FROM nation)
UNION ALL SELECT 'dataset_type.name duplicates', count(*) FROM (
  SELECT lower(n_name) FROM nation GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'orders.o_custkey orphans', count(*) FROM orders
  WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def p12_integrity(spark, sf_dir):
    """Violated key values per constraint (a duplicate counts once, an orphan
    by its rows), every table read once."""
    from tessera.operators.quality import Reference, Unique, integrity
    from tessera.sources.tables import read_table
    unique = [Unique("dataset.id duplicates", "dataset", ("id",)), Unique("dataset_type.name duplicates", "dataset_type", ("name",))]
    refs = [Reference("dataset.dataset_type_ref orphans", "dataset", ("dataset_type_ref",), "dataset_type", ("id",)),
            Reference("orders.o_custkey orphans", "orders", ("o_custkey",), "customer", ("c_custkey",))]
    tables = {"dataset": src.scene_base(spark, sf_dir), "dataset_type": src.dataset_type(spark, sf_dir),
              "orders": read_table(spark, sf_dir, "orders"), "customer": read_table(spark, sf_dir, "customer")}
    found = integrity(tables, unique + refs)
    return found.select(F.col("constraint").alias("check_name"),
                        F.when(F.col("constraint").endswith("duplicates"), F.col("n_keys")).otherwise(F.col("n_rows")).alias("n_violations"))


@query("p12_violating_keys", covers=("P12",), sql="""
SELECT 'lineitem.(l_orderkey, l_linenumber) duplicates' AS "constraint", '["' || l_orderkey || '","' || l_linenumber || '"]' AS key, count(*) AS n_rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
UNION ALL SELECT 'lineitem.l_suppkey -> orders.o_custkey', '["' || l_suppkey || '"]', count(*) FROM lineitem
  WHERE l_suppkey IS NOT NULL AND l_suppkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL) GROUP BY l_suppkey
UNION ALL SELECT 'orders.o_custkey -> lineitem.l_suppkey', '["' || o_custkey || '"]', count(*) FROM orders
  WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL) GROUP BY o_custkey
UNION ALL SELECT 'orders.o_orderdate duplicates', '["' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '"]', count(*) FROM orders
  GROUP BY o_orderdate HAVING count(*) > 1""")
def p12_violating_keys(spark, sf_dir):
    """The violating keys themselves, of constraints that the tables do
    violate: composite keys and references in both directions, two scans."""
    from tessera.operators.quality import Reference, Unique, violations
    from tessera.sources.tables import read_table
    rules = [Unique("lineitem.(l_orderkey, l_linenumber) duplicates", "lineitem", ("l_orderkey", "l_linenumber")),
             Unique("orders.o_orderdate duplicates", "orders", ("o_orderdate",)),
             Reference("lineitem.l_suppkey -> orders.o_custkey", "lineitem", ("l_suppkey",), "orders", ("o_custkey",)),
             Reference("orders.o_custkey -> lineitem.l_suppkey", "orders", ("o_custkey",), "lineitem", ("l_suppkey",))]
    return violations({"lineitem": read_table(spark, sf_dir, "lineitem"), "orders": read_table(spark, sf_dir, "orders")}, rules)


@query("g9_geo_ref_footprint", covers=("G9", "G3"), sql=f"""
WITH {SCENE}
SELECT id, 'POLYGON((' || printf('%.6f %.6f', lon - 0.45, lat + 0.5) || ', ' || printf('%.6f %.6f', lon + 0.55, lat + 0.5)
       || ', ' || printf('%.6f %.6f', lon + 0.5, lat - 0.5) || ', ' || printf('%.6f %.6f', lon - 0.5, lat - 0.5)
       || ', ' || printf('%.6f %.6f', lon - 0.45, lat + 0.5) || '))' AS wkt,
       'EPSG:4326' AS spatial_reference
FROM scene WHERE mtype IN ('eo', 'middle east') AND archived IS NULL""")
def g9_geo_ref_footprint(spark, sf_dir):
    """Footprint polygon from a document's geo reference points
    (ul → ur → lr → ll, closed) in the document's spatial reference."""
    from tessera.functions.geometry import pt
    d = cat.active(src.dataset(spark, sf_dir)).select("id", doc_variant("metadata").alias("doc"))

    def corner(c):
        return pt(get_path("doc", ["grid_spatial", "projection", "geo_ref_points", c, "x"], "double"),
                  get_path("doc", ["grid_spatial", "projection", "geo_ref_points", c, "y"], "double"))
    rings = F.array(F.array(*[corner(c) for c in ("ul", "ur", "lr", "ll", "ul")]))
    srs = get_path("doc", ["grid_spatial", "projection", "spatial_reference"])
    return (d.where(srs.isNotNull())
            .select("id", wkt(rings).alias("wkt"), srs.alias("spatial_reference")))
