"""Catalogue views (P1-P4, J1-J3, U1-U2, J2) over dataset / product / type tables.

* Typed dataset views are generated from the metadata type's search-field
  declaration (P2), not hand-written per product.
* Products and metadata types are dimension tables: joined with a
  size-checked broadcast (J1), so the dataset side is never shuffled.
* ``IN (SELECT id FROM metadata_type WHERE name IN …)`` is a left-semi
  join against the (small) type table (J3).
* Footprint, time-extent and space × time views (U1, U2, J2) choose by the
  dataset's type inside one projection of one scan: the branches of their
  unions are disjoint and the join is on the dataset's own key.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.fields import (at, common_timestamp, doc_variant, field_specs, get_path,
                                      make_range, parse_paths, search_field_struct)
from tessera.functions.geometry import inverse_projection, rings_from_geojson
from tessera.functions.names import epsg_code
from tessera.sources.catalogue import (ARD_NAMES, EO3_NAMES, EO_CORNER_NAMES_V2, EO_NAMES_V1,
                                       EO_NAMES_V2)
from tessera.sources.tables import broadcast_if_small


def active(df: DataFrame, active_only: bool = True) -> DataFrame:
    """Rows not archived."""
    return df.where(F.col("archived").isNull()) if active_only else df


def of_products(df: DataFrame, ids, col: str = "dataset_type_ref") -> DataFrame:
    """``dataset_type_ref = ANY(ids)``."""
    return df.where(F.col(col).isin(list(ids)))


def search_index(dataset: DataFrame, lat=None, lon=None, time=None) -> DataFrame:
    """Closed-range overlap search on the shredded index columns (P8, P10):
    ``lat``/``lon`` = (lo, hi) degrees, ``time`` = (start, end).  These are
    plain column comparisons, so Parquet pushes them into the scan and
    skips row groups by min/max statistics.  The result is a superset of the
    matches; exact predicates run after."""
    def meets(lo, hi, a, b):
        # NULL: not indexed, so left to the exact test.
        return (F.col(hi).isNull() | (F.col(hi) >= a)) & (F.col(lo).isNull() | (F.col(lo) <= b))

    d = dataset
    if lat is not None:
        d = d.where(meets("lat_lo", "lat_hi", *lat))
    if lon is not None:
        d = d.where(meets("lon_lo", "lon_hi", *lon))
    if time is not None:
        # One day wider: a v1 extent may run a day past the indexed time.
        t0 = F.lit(time[0]).cast("timestamp_ntz") - F.expr("INTERVAL 1 DAY")
        t1 = F.lit(time[1]).cast("timestamp_ntz")
        d = d.where(meets("t_lo", "t_hi", t0, t1))
    return d


def declaration(metadata_type: DataFrame, mtype_id: int) -> dict:
    """Read one metadata type's search-field declaration (a single small
    row: schema information, not data)."""
    rows = metadata_type.where(F.col("id") == mtype_id).select("definition").limit(2).collect()
    if len(rows) != 1:
        raise KeyError(f"metadata type {mtype_id} not found")
    return json.loads(rows[0][0])["dataset"]["search_fields"]


def dataset_view(dataset: DataFrame, dataset_type: DataFrame, metadata_type: DataFrame,
                 mtype_id: int, product_id: int | None = None, active_only: bool = True,
                 fields: dict | None = None) -> DataFrame:
    """P1a-d: typed view of the datasets of one metadata type.

    Joins dataset → product → metadata type (J1).  Faithful to the source
    views: the metadata type is joined through the *product's* reference
    while the filter applies to the *dataset's* reference.
    """
    fields = fields if fields is not None else declaration(metadata_type, mtype_id)
    d = dataset.where(F.col("metadata_type_ref") == mtype_id)
    if product_id is not None:
        d = d.where(F.col("dataset_type_ref") == product_id)
    d = active(d, active_only)
    dt = broadcast_if_small(dataset_type.select(
        F.col("id").alias("_dt_id"), F.col("name").alias("product"),
        F.col("metadata_type_ref").alias("_dt_mt")))
    mt = broadcast_if_small(metadata_type.select(
        F.col("id").alias("_mt_id"), F.col("name").alias("metadata_type")))
    j = (d.join(dt, d.dataset_type_ref == dt._dt_id)
         .join(mt, F.col("_dt_mt") == F.col("_mt_id")))
    # Schema-on-read: parse each document once, reading only declared paths.
    j = j.withColumn("_doc", parse_paths("metadata", field_specs(fields)))
    return j.select(
        "id", F.col("added").alias("indexed_time"), F.col("added_by").alias("indexed_by"),
        "product", F.col("dataset_type_ref").alias("dataset_type_id"), "metadata_type",
        F.col("metadata_type_ref").alias("metadata_type_id"), F.col("metadata").alias("metadata_doc"),
        *[search_field_struct("_doc", spec).alias(name) for name, spec in fields.items()])


def _types_named(metadata_type: DataFrame, names) -> DataFrame:
    return broadcast_if_small(metadata_type.where(F.col("name").isin(list(names))).select(
        F.col("id").alias("_mt")))


def of_type_names(dataset: DataFrame, metadata_type: DataFrame, names) -> DataFrame:
    """Datasets whose metadata type is one of ``names`` (left semi join)."""
    return dataset.join(_types_named(metadata_type, names),
                        F.col("metadata_type_ref") == F.col("_mt"), "left_semi")


def _pt(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def _box_ring(x0, y0, x1, y1) -> Column:
    return F.array(F.array(_pt(x0, y0), _pt(x1, y0), _pt(x1, y1), _pt(x0, y1), _pt(x0, y0)))


_EXTENT_PATHS = (
    [(["extent", a, b], "double") for a in ("lat", "lon") for b in ("begin", "end")]
    + [(["extent", "coord", k, a], "double") for k in ("ll", "lr", "ur", "ul") for a in ("lat", "lon")]
    + [(["extent", k], "string") for k in ("from_dt", "to_dt", "center_dt")]
    + [(["properties", k], "string") for k in ("datetime", "dtr:start_datetime", "dtr:end_datetime")]
    + [(["crs"], "string"), (["geometry"], "string")])


def _parsed(dataset: DataFrame, metadata_type: DataFrame, version: str) -> DataFrame:
    """One scan: datasets with their type's name and the document parsed once
    for every path that a footprint or a time extent may need."""
    types = broadcast_if_small(metadata_type.select(F.col("id").alias("_mt"), F.col("name").alias("_type")))
    known = {*EO3_NAMES, *ARD_NAMES, *EO_NAMES_V1, *EO_NAMES_V2, *EO_CORNER_NAMES_V2}
    base = active(dataset, version == "v2").select("id", "dataset_type_ref", "metadata_type_ref", "metadata")
    return base.join(types.where(F.col("_type").isin(sorted(known))), F.col("metadata_type_ref") == F.col("_mt")) \
        .select("id", "dataset_type_ref", "_type", parse_paths("metadata", _EXTENT_PATHS).alias("doc"))


def _rings(version: str) -> tuple[Column, Column]:
    """(has a footprint, EPSG:4326 rings) of a parsed dataset: eo3 lat/lon
    ranges, eo corner points, or the projected geometry of ARD documents."""
    def g(*p):
        return at("doc", list(p)).cast("double")

    corner_names = EO_CORNER_NAMES_V2 if version == "v2" else EO_NAMES_V1
    box = _box_ring(g("extent", "lon", "begin"), g("extent", "lat", "begin"),
                    g("extent", "lon", "end"), g("extent", "lat", "end"))
    c = {k: _pt(g("extent", "coord", k, "lon"), g("extent", "coord", k, "lat")) for k in ("ll", "lr", "ur", "ul")}
    corners = F.array(F.array(*[c[k] for k in ("ll", "lr", "ur", "ul", "ll")]))
    projected = inverse_projection(rings_from_geojson(at("doc", ["geometry"])), epsg_code(at("doc", ["crs"])))
    kind = F.col("_type")
    return (kind.isin(*EO3_NAMES, *corner_names, *ARD_NAMES),
            F.when(kind.isin(*EO3_NAMES), box).when(kind.isin(*corner_names), corners).otherwise(projected))


def _extent(version: str) -> tuple[Column, Column]:
    """(has a time extent, range) of a parsed dataset.

    v1: eo ``[from_dt, to_dt + 1 µs)``; eo3 ``[datetime, datetime + 1 day)``;
        ARD ``[dtr:start, dtr:end)``.
    v2: eo ``[center, center]`` when from_dt is NULL else ``[from, to]``;
        eo3 and ARD ``[coalesce(start, datetime), coalesce(end, datetime)]``.
    """
    def raw(*p):
        return at("doc", list(p))

    def ts(*p):
        return common_timestamp(raw(*p))

    kind, start = F.col("_type"), ts("extent", "from_dt")
    if version != "v2":
        return kind.isin(*EO_NAMES_V1, *EO3_NAMES, *ARD_NAMES), F.when(
            kind.isin(*EO_NAMES_V1), make_range(start, ts("extent", "to_dt") + F.expr("INTERVAL 0.000001 SECOND"), "[)")) \
            .when(kind.isin(*EO3_NAMES), make_range(ts("properties", "datetime"),
                                                    ts("properties", "datetime") + F.expr("INTERVAL 1 DAY"), "[)")) \
            .otherwise(make_range(ts("properties", "dtr:start_datetime"), ts("properties", "dtr:end_datetime"), "[)"))
    return kind.isin(*EO_NAMES_V2, *EO3_NAMES, *ARD_NAMES), F.when(
        kind.isin(*EO_NAMES_V2), F.when(
            raw("extent", "from_dt").isNull(), make_range(ts("extent", "center_dt"), ts("extent", "center_dt"), "[]"))
        .otherwise(make_range(start, ts("extent", "to_dt"), "[]"))) \
        .otherwise(make_range(common_timestamp(F.coalesce(raw("properties", "dtr:start_datetime"), raw("properties", "datetime"))),
                              F.coalesce(ts("properties", "dtr:end_datetime"), ts("properties", "datetime")), "[]"))


def space_view(dataset: DataFrame, metadata_type: DataFrame, version: str = "v1") -> DataFrame:
    """Footprint per dataset (EPSG:4326 rings).  The view's three branches
    select disjoint types and ``id`` is the key, so their set union is one
    conditional projection: one scan, no shuffle.  v1 keeps archived rows."""
    has, rings = _rings(version)
    return _parsed(dataset, metadata_type, version).where(has).select("id", rings.alias("rings"), F.lit(4326).alias("srid"))


def time_view(dataset: DataFrame, metadata_type: DataFrame, version: str = "v1") -> DataFrame:
    """U2 + F17: temporal extent per dataset as a range struct, likewise in
    one projection (see :func:`_extent`)."""
    has, extent = _extent(version)
    return _parsed(dataset, metadata_type, version).where(has).select("dataset_type_ref", "id", extent.alias("temporal_extent"))


def space_time_view(dataset: DataFrame, metadata_type: DataFrame, version: str = "v1") -> DataFrame:
    """Footprint x time extent.  Both views key by the dataset's id, so
    their join is the projection of both from the same scan."""
    has_rings, rings = _rings(version)
    has_extent, extent = _extent(version)
    return _parsed(dataset, metadata_type, version).where(has_rings & has_extent).select(
        "id", "dataset_type_ref", rings.alias("rings"), F.lit(4326).alias("srid"), extent.alias("temporal_extent"))
