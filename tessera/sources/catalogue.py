"""Scene catalogue sources (S1-S5) and the "scenes" lens.

Catalogue tables (as in an ODC-style index):

    dataset          id, metadata_type_ref, dataset_type_ref, metadata (JSON
                     text), archived, added, added_by
    dataset_type     id, name, metadata_type_ref, definition (JSON text)
    metadata_type    id, name, definition (JSON text: search-field declaration)
    dataset_location id, dataset_ref, uri_scheme, uri_body, added, archived
    dataset_source   dataset_ref, classifier, source_dataset_ref

The scenes lens (FIXTURES.md §7) derives them from ``orders``, ``nation``
and ``region``: one scene per order, its product = nation ``custkey % 25``,
its metadata type = that nation's region.  Documents are built with
``to_json`` in the shape of the metadata family of their type.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.sources.tables import broadcast_if_small, clustered, read_table

# Metadata-type name per region key in the scenes lens
# (other keys keep their lower-cased region name).
LENS_MTYPE_NAMES = {0: "eo", 1: "eo3", 2: "eo3_landsat_ard", 3: "telemetry"}
# Names of metadata types of each document family, as used
# by the footprint/time views (v1 = older catalogue, v2 = newer one).
EO_NAMES_V1 = ("eo", "gqa_eo", "eo_plus")
EO_NAMES_V2 = ("eo", "eo_s2_nrt", "gqa_eo", "eo_plus")
EO_CORNER_NAMES_V2 = ("eo", "eo_s2_nrt", "gqa_eo", "eo_plus", "boku")
EO3_NAMES = ("eo3",)
ARD_NAMES = ("eo3_landsat_ard",)

# Search-field declarations of the metadata families.
# Same form as a metadata type's ``dataset.search_fields``: a field has a
# ``type`` (default string) and either ``offset`` (one JSON path) or
# ``min_offset`` / ``max_offset`` (lists of paths; least / greatest).
_CORNERS = ("ur", "lr", "ul", "ll")
SEARCH_FIELDS = {
    "eo": {
        "platform": {"offset": ["platform", "code"]},
        "instrument": {"offset": ["instrument", "name"]},
        "product_type": {"offset": ["product_type"]},
        "format": {"offset": ["format", "name"]},
        "label": {"offset": ["ga_label"]},
        "creation_time": {"type": "datetime", "offset": ["creation_dt"]},
        "lat": {"type": "double-range",
                "min_offset": [["extent", "coord", c, "lat"] for c in _CORNERS],
                "max_offset": [["extent", "coord", c, "lat"] for c in _CORNERS]},
        "lon": {"type": "double-range",
                "min_offset": [["extent", "coord", c, "lon"] for c in ("ul", "ur", "ll", "lr")],
                "max_offset": [["extent", "coord", c, "lon"] for c in ("ul", "ur", "ll", "lr")]},
        "time": {"type": "datetime-range",
                 "min_offset": [["extent", "from_dt"], ["extent", "center_dt"]],
                 "max_offset": [["extent", "to_dt"], ["extent", "center_dt"]]},
    },
    "eo3": {
        "platform": {"offset": ["properties", "eo:platform"]},
        "instrument": {"offset": ["properties", "eo:instrument"]},
        "product_family": {"offset": ["properties", "odc:product_family"]},
        "region_code": {"offset": ["properties", "odc:region_code"]},
        "dataset_maturity": {"offset": ["properties", "dea:dataset_maturity"]},
        "format": {"offset": ["properties", "odc:file_format"]},
        "label": {"offset": ["label"]},
        "cloud_cover": {"type": "double", "offset": ["properties", "eo:cloud_cover"]},
        "creation_time": {"type": "datetime", "offset": ["properties", "odc:processing_datetime"]},
        "lat": {"type": "double-range", "min_offset": [["extent", "lat", "begin"]],
                "max_offset": [["extent", "lat", "end"]]},
        "lon": {"type": "double-range", "min_offset": [["extent", "lon", "begin"]],
                "max_offset": [["extent", "lon", "end"]]},
        "time": {"type": "datetime-range",
                 "min_offset": [["properties", "dtr:start_datetime"], ["properties", "datetime"]],
                 "max_offset": [["properties", "dtr:end_datetime"], ["properties", "datetime"]]},
    },
    "telemetry": {
        "platform": {"offset": ["platform", "code"]},
        "instrument": {"offset": ["instrument", "name"]},
        "product_type": {"offset": ["product_type"]},
        "gsi": {"offset": ["acquisition", "groundstation", "code"]},
        "orbit": {"type": "integer", "offset": ["acquisition", "platform_orbit"]},
        "format": {"offset": ["format", "name"]},
        "label": {"offset": ["ga_label"]},
        "creation_time": {"type": "datetime", "offset": ["creation_dt"]},
        "sat_path": {"type": "integer-range",
                     "min_offset": [["image", "satellite_ref_point_start", "x"]],
                     "max_offset": [["image", "satellite_ref_point_end", "x"], ["image", "satellite_ref_point_start", "x"]]},
        "sat_row": {"type": "integer-range",
                    "min_offset": [["image", "satellite_ref_point_start", "y"]],
                    "max_offset": [["image", "satellite_ref_point_end", "y"], ["image", "satellite_ref_point_start", "y"]]},
        "time": {"type": "datetime-range", "min_offset": [["acquisition", "aos"]],
                 "max_offset": [["acquisition", "los"]]},
    },
}
FAMILY_OF = {"eo": "eo", "eo3": "eo3", "eo3_landsat_ard": "eo3", "telemetry": "telemetry"}

# Measurements and QA flags of every lens product.
LENS_MEASUREMENTS = [
    {"name": "blue", "dtype": "int16", "units": "1", "nodata": -999, "aliases": ["band_2", "sr_band2"]},
    {"name": "green", "dtype": "int16", "units": "1", "nodata": -999, "aliases": ["band_3", "sr_band3"]},
    {"name": "red", "dtype": "int16", "units": "1", "nodata": -999, "aliases": ["band_4", "sr_band4"]},
    {"name": "pixel_qa", "dtype": "uint16", "units": "bit_index", "nodata": 1, "aliases": ["qa"],
     "flags_definition": {
         "nodata": {"bits": [0], "values": {"0": False, "1": True}, "description": "Fill"},
         "water": {"bits": [1], "values": {"0": "land_or_cloud", "1": "water"}, "description": "Water"},
         "clear": {"bits": [2], "values": {"0": "clear", "1": "cloud"}, "description": "Cloud"},
         "cloud_confidence": {"bits": [3, 4], "values": {"0": "none", "1": "low", "2": "medium", "3": "high"},
                              "description": "Cloud confidence"}}},
]

TS_FMT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSS'Z'"
# Bump when the rendered documents change, so stored copies are rebuilt.
LENS_VERSION = "scenes-v4"


def mtype_name(regionkey: Column, region_name: Column) -> Column:
    expr = None
    for k, v in LENS_MTYPE_NAMES.items():
        expr = (F.when(regionkey == k, F.lit(v)) if expr is None
                else expr.when(regionkey == k, F.lit(v)))
    return expr.otherwise(F.lower(region_name))


def family_of(name: Column) -> Column:
    expr = None
    for k, v in FAMILY_OF.items():
        expr = (F.when(name == k, F.lit(v)) if expr is None else expr.when(name == k, F.lit(v)))
    return expr.otherwise(F.lit("eo"))


def metadata_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata types (one per region) with their search-field declaration."""
    r = read_table(spark, sf_dir, "region")
    name = mtype_name(F.col("r_regionkey"), F.col("r_name"))
    decl = F.create_map(*[x for fam, d in SEARCH_FIELDS.items()
                          for x in (F.lit(fam), F.lit(json.dumps(
                              {"name": fam, "dataset": {"search_fields": d}})))])
    return r.select(
        F.col("r_regionkey").cast("short").alias("id"),
        name.alias("name"),
        F.element_at(decl, family_of(name)).alias("definition"),
        F.lit("lens").alias("added_by"))


def dataset_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products (one per nation) with measurement definitions."""
    n = read_table(spark, sf_dir, "nation")
    definition = F.to_json(F.struct(
        F.lower("n_name").alias("name"),
        F.struct(F.lower("n_name").alias("name")).alias("metadata"),
        F.from_json(F.lit(json.dumps(LENS_MEASUREMENTS)),
                    "array<struct<name string, dtype string, units string, nodata bigint, "
                    "aliases array<string>, flags_definition map<string, struct<bits array<int>, "
                    "values map<string, string>, description string>>>>").alias("measurements")))
    return n.select(
        F.col("n_nationkey").cast("short").alias("id"),
        F.lower("n_name").alias("name"),
        F.col("n_regionkey").cast("short").alias("metadata_type_ref"),
        definition.alias("definition"),
        F.lit("lens").alias("added_by"))


def _pt(lat: Column, lon: Column) -> Column:
    return F.struct(lat.alias("lat"), lon.alias("lon"))


def _ts(c: Column) -> Column:
    return F.date_format(c, TS_FMT)


def mercator_xy(lon: Column, lat: Column) -> tuple[Column, Column]:
    r = 6378137.0
    x = F.radians(lon) * F.lit(r)
    y = F.log(F.tan(F.lit(3.141592653589793 / 4) + F.radians(lat) / 2)) * F.lit(r)
    return x, y


def scene_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scene attributes of the lens before documents are rendered."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    n = broadcast_if_small(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"))
    r = broadcast_if_small(read_table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    base = (o.join(n, (o.o_custkey % 25) == n.n_nationkey)
            .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    return base.select(
        F.col("o_orderkey").alias("id"),
        F.col("n_regionkey").cast("short").alias("metadata_type_ref"),
        (F.col("o_custkey") % 25).cast("short").alias("dataset_type_ref"),
        mtype_name(F.col("r_regionkey"), F.col("r_name")).alias("mtype"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate")).alias("archived"),
        F.col("o_orderdate").alias("added"),
        (F.col("o_orderdate") + F.make_dt_interval(
            F.lit(0), F.lit(0), F.lit(0), (F.col("o_orderkey") % 86400).cast("decimal(18,6)"))).alias("t"),
        (F.lit(110.0) + (F.col("o_custkey") * 37 % 4000) / 100.0).alias("lon"),
        (F.lit(-45.0) + (F.col("o_custkey") * 53 % 3500) / 100.0).alias("lat"),
        F.col("o_custkey"), F.col("o_orderkey"))


def render_documents(base: DataFrame) -> DataFrame:
    """JSON document per scene, shaped by the family of its metadata type.
    Each family's scenes are brought into order of product and time before
    they are rendered: the scenes are narrow, the documents are not."""
    lat, lon, t = F.col("lat"), F.col("lon"), F.col("t")
    fam = family_of(F.col("mtype"))
    coord = F.struct(
        _pt(lat + 0.5, lon - 0.45).alias("ul"), _pt(lat + 0.5, lon + 0.55).alias("ur"),
        _pt(lat - 0.5, lon - 0.5).alias("ll"), _pt(lat - 0.5, lon + 0.5).alias("lr"))
    geo_ref = F.struct(*[F.struct((lon + dx).alias("x"), (lat + dy).alias("y")).alias(k)
                         for k, dx, dy in (("ul", -0.45, 0.5), ("ur", 0.55, 0.5),
                                           ("ll", -0.5, -0.5), ("lr", 0.5, -0.5))])
    bands = F.create_map(*[x for i, b in ((2, "blue"), (3, "green"), (4, "red"))
                           for x in (F.lit(b), F.struct(
                               F.format_string(f"scene_%d_B{i}.TIF", F.col("id")).alias("path"),
                               F.lit(1).alias("layer")))])
    eo = F.to_json(F.struct(
        F.col("id").cast("string").alias("id"),
        F.format_string("scene_%d", F.col("id")).alias("label"),
        _ts(F.col("added")).alias("creation_dt"),
        F.lit("level1").alias("product_type"),
        F.lit("L1T").alias("processing_level"),
        F.struct(F.lit("LANDSAT_8").alias("code")).alias("platform"),
        F.struct(F.lit("OLI_TIRS").alias("name")).alias("instrument"),
        F.struct(F.lit("GeoTIFF").alias("name")).alias("format"),
        F.struct(bands.alias("bands")).alias("image"),
        F.struct(coord.alias("coord"), _ts(t).alias("from_dt"), _ts(t).alias("to_dt"),
                 _ts(t).alias("center_dt")).alias("extent"),
        F.struct(F.struct(geo_ref.alias("geo_ref_points"),
                          F.lit("EPSG:4326").alias("spatial_reference")).alias("projection")
                 ).alias("grid_spatial"),
        F.struct(F.create_map().cast("map<string,string>").alias("source_datasets")).alias("lineage")))
    # eo3: footprint in Web Mercator (crs epsg:3857), ranges in degrees.
    ring_ll = [(-0.5, -0.5), (0.5, -0.5), (0.55, 0.5), (-0.45, 0.5), (-0.5, -0.5)]
    ring = F.array(*[F.array(*mercator_xy(lon + dx, lat + dy)) for dx, dy in ring_ll])
    is_ard = F.col("mtype") == "eo3_landsat_ard"
    props = F.struct(
        _ts(t).alias("datetime"),
        F.when(is_ard, _ts(t - F.expr("INTERVAL 10 SECONDS"))).alias("dtr:start_datetime"),
        F.when(is_ard, _ts(t + F.expr("INTERVAL 10 SECONDS"))).alias("dtr:end_datetime"),
        ((F.col("o_orderkey") % 10001) / 100.0).alias("eo:cloud_cover"),
        F.format_string("%03d%03d", F.col("o_custkey") % 97, F.col("o_custkey") % 89).alias("odc:region_code"),
        F.lit("ard").alias("odc:product_family"),
        F.lit("final").alias("dea:dataset_maturity"),
        F.lit("GeoTIFF").alias("odc:file_format"),
        F.lit("landsat-8").alias("eo:platform"),
        F.lit("oli_tirs").alias("eo:instrument"),
        _ts(F.col("added")).alias("odc:processing_datetime"))
    grids = F.create_map(
        F.lit("default"), F.struct(F.array(F.lit(7681), F.lit(7531)).alias("shape"),
                                   F.array(*[F.lit(v) for v in (30.0, 0.0, 1.0e5, 0.0, -30.0, 2.0e5, 0.0, 0.0, 1.0)]).alias("transform")),
        F.lit("g60m"), F.struct(F.array(F.lit(3841), F.lit(3766)).alias("shape"),
                                F.array(*[F.lit(v) for v in (60.0, 0.0, 1.0e5, 0.0, -60.0, 2.0e5, 0.0, 0.0, 1.0)]).alias("transform")))
    meas = F.create_map(
        F.lit("red"), F.struct(F.format_string("scene_%d_red.tif", F.col("id")).alias("path"),
                               F.lit(None).cast("string").alias("grid")),
        F.lit("green"), F.struct(F.format_string("scene_%d_green.tif", F.col("id")).alias("path"),
                                 F.lit(None).cast("string").alias("grid")),
        F.lit("aerosol"), F.struct(F.format_string("scene_%d_aerosol.tif", F.col("id")).alias("path"),
                                   F.lit("g60m").alias("grid")))
    eo3 = F.to_json(F.struct(
        F.col("id").cast("string").alias("id"),
        F.format_string("scene_%d", F.col("id")).alias("label"),
        F.lit("epsg:3857").alias("crs"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
        F.struct(F.struct((lat - 0.5).alias("begin"), (lat + 0.5).alias("end")).alias("lat"),
                 F.struct((lon - 0.5).alias("begin"), (lon + 0.55).alias("end")).alias("lon")).alias("extent"),
        grids.alias("grids"), meas.alias("measurements"), props.alias("properties"),
        F.struct(F.create_map(F.lit("thumbnail"), F.struct(
            F.format_string("scene_%d_thumb.jpg", F.col("id")).alias("path")))).alias("accessories"),
        F.struct(F.create_map().cast("map<string,string>").alias("source_datasets")).alias("lineage")))
    path = (F.col("o_custkey") % 233 + 1).cast("int")
    row = (F.col("o_orderkey") % 248 + 3).cast("int")
    # Descending passes end below their start.
    step = F.when(F.col("o_orderkey") % 3 == 0, F.lit(-1)).otherwise(F.lit(1))
    tele = F.to_json(F.struct(
        F.col("id").cast("string").alias("id"),
        F.format_string("telemetry_%d", F.col("id")).alias("ga_label"),
        _ts(F.col("added")).alias("creation_dt"),
        F.struct(F.lit("MD").alias("name")).alias("format"),
        F.lit("satellite_telemetry_data").alias("product_type"),
        F.struct(F.lit("LANDSAT_8").alias("code")).alias("platform"),
        F.struct(F.lit("OLI_TIRS").alias("name")).alias("instrument"),
        F.struct(_ts(t).alias("aos"), _ts(t + F.expr("INTERVAL 9 MINUTES")).alias("los"),
                 F.struct(F.lit("ASA").alias("code")).alias("groundstation"),
                 F.col("o_orderkey").alias("platform_orbit")).alias("acquisition"),
        F.struct(F.struct(path.alias("x"), row.alias("y")).alias("satellite_ref_point_start"),
                 F.struct((path + step).alias("x"), (row + 2 * step).alias("y")).alias("satellite_ref_point_end")
                 ).alias("image")))
    # One projection per family (a union of three filtered branches) keeps
    # each generated method small enough for whole-stage codegen.
    docs = {"eo": eo, "eo3": eo3, "telemetry": tele}

    def branch(name):
        b = base.where(fam == name)
        return clustered(b, "dataset_type_ref", "t", share=len(docs)).withColumn("metadata", docs[name])
    first, *others = [branch(name) for name in docs]
    for b in others:
        first = first.unionByName(b)
    return first


def render_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 (lens): the dataset table with JSON documents, computed."""
    return render_documents(scene_base(spark, sf_dir)).select(
        "id", "metadata_type_ref", "dataset_type_ref", "metadata", "archived", "added",
        F.lit("lens").alias("added_by"))


INDEX_COLUMNS = ("lat_lo", "lat_hi", "lon_lo", "lon_hi", "t_lo", "t_hi")


def shred_search_extents(dataset: DataFrame) -> DataFrame:
    """Index columns next to the document (the role of the catalogue's
    spatial/temporal indexes): lat/lon/time ranges read through every
    family's declaration (a document only has its own family's paths, so
    the others are NULL and ``coalesce`` picks the right one).  Stored
    sorted, their Parquet min/max statistics let searches skip row groups
    and files (pushed filters) before any document is parsed."""
    from tessera.functions.fields import field_specs, parse_paths, search_field_struct
    wanted = ("lat", "lon", "time")
    decls = [{k: v for k, v in fields.items() if k in wanted} for fields in SEARCH_FIELDS.values()]
    specs = [sp for d in decls for sp in field_specs(d)]
    d = dataset.withColumn("_ix", parse_paths("metadata", specs))
    cols = {}
    for name in wanted:
        rs = [search_field_struct("_ix", d_[name]) for d_ in decls if name in d_]
        cols[name] = (F.coalesce(*[r["lo"] for r in rs]), F.coalesce(*[r["hi"] for r in rs]))
    return d.select(*dataset.columns,
                    cols["lat"][0].cast("double").alias("lat_lo"), cols["lat"][1].cast("double").alias("lat_hi"),
                    cols["lon"][0].cast("double").alias("lon_lo"), cols["lon"][1].cast("double").alias("lon_hi"),
                    cols["time"][0].alias("t_lo"), cols["time"][1].alias("t_hi"))


def dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dataset table as stored: the lens is ingested once per input into
    Parquet under the shared checkpoint folder (as a catalogue dump is
    loaded once) with shredded index columns (:func:`shred_search_extents`),
    in ranges of product and start time so row groups prune on them; later
    reads scan the stored documents instead of re-rendering them."""
    from tessera.sources.tables import stored
    return stored(spark, "dataset", LENS_VERSION, sf_dir, ("orders", "nation", "region"),
                  lambda: shred_search_extents(render_dataset(spark, sf_dir)))


def dataset_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2 (lens): one location per scene; scheme/body split as stored."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return o.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("dataset_ref"),
        F.lit("s3").alias("uri_scheme"),
        F.format_string("//lens-bucket/scenes/%d/odc-metadata.yaml", F.col("o_orderkey")).alias("uri_body"),
        F.col("o_orderdate").alias("added"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_orderdate")).alias("archived"))


# ---------------------------------------------------------------- S1 text form

DATASET_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("metadata_type_ref", T.ShortType()),
    T.StructField("dataset_type_ref", T.ShortType()),
    T.StructField("metadata", T.StringType()),
    T.StructField("archived", T.TimestampNTZType()),
    T.StructField("added", T.TimestampNTZType()),
    T.StructField("added_by", T.StringType()),
])


def to_copy_text(df: DataFrame, schema: T.StructType = DATASET_SCHEMA) -> DataFrame:
    """Render rows as COPY text lines: tab separated, ``\\N`` for NULL and
    backslashes doubled (the text format of a database dump block)."""
    fields = []
    for f in schema.fields:
        c = F.col(f.name).cast("string")
        c = F.regexp_replace(c, r"\\", r"\\\\")
        fields.append(F.coalesce(c, F.lit("\\N")))
    return df.select(F.concat_ws("\t", *fields).alias("value"))


def parse_copy_text(lines: DataFrame, schema: T.StructType = DATASET_SCHEMA,
                    json_cols=("metadata",)) -> DataFrame:
    """Parse COPY text lines (column ``value``) into typed columns.

    Quoting is off (the format has none), ``\\N`` is NULL and the escapes
    for backslash, tab, newline and carriage return are undone in every
    column; JSON columns must parse as JSON.
    """
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    parsed = lines.select(F.from_csv("value", text_schema.simpleString(),
                                     {"sep": "\t", "nullValue": "\\N", "quote": "\u0000",
                                      "escape": "\u0000", "mode": "PERMISSIVE"}).alias("r")).select("r.*")
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if f.name in json_cols:
            c = F.regexp_replace(c, r"\\\\", r"\\")
        else:
            c = c.try_cast(f.dataType)
        cols.append(c.alias(f.name))
    return parsed.select(*cols)


def read_copy_block(spark: SparkSession, path: str, schema: T.StructType = DATASET_SCHEMA,
                    json_cols=("metadata",)) -> DataFrame:
    """S1 for files: a text file holding the rows of one COPY block (lines
    up to the ``\\.`` terminator), read in parallel by line."""
    lines = spark.read.text(path).where(F.col("value") != "\\.")
    return parse_copy_text(lines, schema, json_cols)
