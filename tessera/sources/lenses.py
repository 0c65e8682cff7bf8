"""Lenses: the driver tables read as the domain tables of the engine.

The test tables carry no imagery or satellite catalogue, so each domain
table is a fixed, documented arithmetic view of one driver table (see
FIXTURES.md §7).  Every lens is a lazy projection: only the columns it uses
are read, and filters placed on its output reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.names import INPUT_PRODUCT
from tessera.sources.tables import broadcast_if_small, clustered, read_table

# QA flag table of the observation lens ("pixel_qa").
# bit 0: fill; bit 1: water; bit 2: cloud.  Shape as in a product's
# measurement flags_definition: {flag: {bits, values{code: label}}}.
OBS_FLAGS = {
    "nodata": {"bits": [0], "values": {"0": False, "1": True}},
    "water": {"bits": [1], "values": {"0": "land_or_cloud", "1": "water"}},
    "clear": {"bits": [2], "values": {"0": "clear", "1": "cloud"}},
}
# Band nodata of the observation lens.
OBS_NODATA = {"red": 50.0, "green": None, "blue": None}
OBS_BANDS = ("red", "green", "blue")
TILE_KEYS = ("tile_x", "tile_y")
PIXEL_KEYS = ("px", "py")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as a pixel observation table.

    tile_x = suppkey % 2, tile_y = -1 - floor((suppkey % 4) / 2),
    pixel (px, py) = (linenumber, 0), t = shipdate,
    red/green/blue = quantity/extendedprice/discount,
    qa = fill(A,O) + 2 * class(N→0 land, R→1 water, A→2 cloud).
    """
    li = read_table(spark, sf_dir, "lineitem")
    cls = (F.when(F.col("l_returnflag") == "N", 0)
           .when(F.col("l_returnflag") == "R", 1)
           .when(F.col("l_returnflag") == "A", 2))
    fill = F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), 1).otherwise(0)
    return li.select(
        F.lit(INPUT_PRODUCT).alias("product"),
        (F.col("l_suppkey") % 2).cast("int").alias("tile_x"),
        (F.lit(-1) - F.floor((F.col("l_suppkey") % 4) / 2)).cast("int").alias("tile_y"),
        F.col("l_linenumber").cast("int").alias("px"),
        F.lit(0).alias("py"),
        F.col("l_shipdate").alias("t"),
        F.col("l_quantity").alias("red"),
        F.col("l_extendedprice").alias("green"),
        F.col("l_discount").alias("blue"),
        (fill + 2 * cls).cast("int").alias("qa"),
    )


def scene_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as the pixels of the scenes of the catalogue lens: scene id
    = orderkey, pixel (px, py) = (linenumber, suppkey % 2), bands and qa as in
    :func:`observations`."""
    li = read_table(spark, sf_dir, "lineitem")
    cls = (F.when(F.col("l_returnflag") == "N", 0).when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 2))
    fill = F.when((F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "O"), 1).otherwise(0)
    return li.select(
        F.col("l_orderkey").alias("id"), F.col("l_linenumber").cast("int").alias("px"), (F.col("l_suppkey") % 2).cast("int").alias("py"),
        F.col("l_quantity").alias("red"), F.col("l_extendedprice").alias("green"), F.col("l_discount").alias("blue"),
        (fill + 2 * cls).cast("int").alias("qa"))


def vectors(spark: SparkSession, sf_dir: str, n_bands: int = 64) -> DataFrame:
    """``embeddings`` as pixels with many bands: tile = label, pixel = vec_id,
    band_i = embedding[i], all 64 of them."""
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("label").cast("int").alias("tile"),
        F.col("vec_id").alias("px"),
        *[F.col("embedding")[i].cast("double").alias(f"band_{i}") for i in range(n_bands)])


# The query region of the footprint lens — a concave polygon
# in lon/lat (closed ring).
ROI_RING = [(115.0, -42.0), (145.0, -38.0), (138.0, -30.0), (126.0, -33.0),
            (130.0, -18.0), (117.0, -22.0), (115.0, -42.0)]


def footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` as scene footprints: centre lon = 110 + (custkey*37 % 4000)/100,
    lat = -45 + (custkey*53 % 3500)/100, footprint = box ±0.5 degrees."""
    from tessera.functions.geometry import box_rings
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    lon = F.lit(110.0) + (F.col("c_custkey") * 37 % 4000) / 100.0
    lat = F.lit(-45.0) + (F.col("c_custkey") * 53 % 3500) / 100.0
    return c.select("c_custkey", "c_nationkey", lon.alias("lon"), lat.alias("lat")).withColumn(
        "rings", box_rings(F.col("lon") - 0.5, F.col("lat") - 0.5, F.col("lon") + 0.5, F.col("lat") + 0.5))


def roi_rings():
    from tessera.functions.geometry import pt
    return F.array(F.array(*[pt(F.lit(x), F.lit(y)) for x, y in ROI_RING]))


def aoi_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S22 (lens): one area of interest per region, ``aoi_name`` = lower-case
    region name, ``aoi_polygon`` = GeoJSON box lon [110+8k, 120+8k],
    lat [-40+5k, -28+5k] for region key k; neighbours overlap."""
    r = read_table(spark, sf_dir, "region")
    k = F.col("r_regionkey")
    x0, x1 = F.lit(110.0) + k * 8, F.lit(120.0) + k * 8
    y0, y1 = F.lit(-40.0) + k * 5, F.lit(-28.0) + k * 5
    ring = F.format_string('[[%s,%s],[%s,%s],[%s,%s],[%s,%s],[%s,%s]]',
                           x0, y0, x1, y0, x1, y1, x0, y1, x0, y0)
    return r.select(F.lower("r_name").alias("aoi_name"),
                    F.concat(F.lit('{"type":"Polygon","coordinates":['), ring, F.lit("]}")).alias("aoi_polygon"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order documents as stored (rendered once per input, see
    :func:`render_requests`)."""
    from tessera.sources.tables import stored
    return stored(spark, "requests", "requests-v3", sf_dir, ("orders", "region"),
                  lambda: render_requests(spark, sf_dir))


def render_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as order documents (JSON text), one per order key k.

    time_start = orderdate; time_end = orderdate + (k % 61 - 30) days, with a
    '+10:00' offset when k % 3 = 0 and missing when k % 50 = 7; time_start is
    written out ('2 January 1996') when k % 17 = 3 and 'someday' when
    k % 19 = 5; time_end is null when k % 23 = 6.  Space by
    k % 4: 0 bbox text 'w,s,e,n' (3 values when k % 13 = 0; a boundary too
    when k % 9 = 0), 1 bbox list, 2 AOI names 'r(k%5) | r(k+1 %5)' or the
    unknown 'atlantis' when k % 7 = 0, 3 GeoJSON box (ring left open when
    k % 5 = 0).  api_params: invalid JSON text when k % 11 = 0, an object
    when k % 11 = 1.  Centre as in the scenes lens, box ±1 degree.
    """
    o = clustered(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), "o_orderkey")
    r = broadcast_if_small(read_table(spark, sf_dir, "region").select("r_regionkey", "r_name"))
    r1 = r.select(F.col("r_regionkey").alias("_k1"), F.lower("r_name").alias("_n1"))
    r2 = r.select(F.col("r_regionkey").alias("_k2"), F.lower("r_name").alias("_n2"))
    k = F.col("o_orderkey")
    o = (o.join(r1, (k % 5) == F.col("_k1")).join(r2, ((k + 1) % 5) == F.col("_k2")))
    lon = F.lit(110.0) + (F.col("o_custkey") * 37 % 4000) / 100.0
    lat = F.lit(-45.0) + (F.col("o_custkey") * 53 % 3500) / 100.0
    x0, y0, x1, y1 = lon - 1, lat - 1, lon + 1, lat + 1
    end = F.col("o_orderdate") + F.make_interval(days=(k % 61 - 30).cast("int"))
    m = k % 4

    def kv(name, value_json):
        return F.concat(F.lit(f'"{name}":'), value_json)

    def q(s):
        return F.concat(F.lit('"'), s, F.lit('"'))
    bbox_txt = F.when(k % 13 == 0, F.format_string("%.2f,%.2f,%.2f", x0, y0, x1)) \
        .otherwise(F.format_string("%.2f,%.2f,%.2f,%.2f", x0, y0, x1, y1))
    ring_pts = F.format_string("[%.2f,%.2f],[%.2f,%.2f],[%.2f,%.2f],[%.2f,%.2f]", x0, y0, x1, y0, x1, y1, x0, y1)
    ring = F.when(k % 5 == 0, ring_pts).otherwise(
        F.concat(ring_pts, F.format_string(",[%.2f,%.2f]", x0, y0)))
    geojson = F.concat(F.lit('{"type":"Polygon","coordinates":[['), ring, F.lit("]]}"))
    parts = F.array(
        kv("driver", F.lit('"lens"')),
        kv("time_start", q(F.when(k % 19 == 5, F.lit("someday")).when(k % 17 == 3, F.date_format("o_orderdate", "d MMMM yyyy"))
                           .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))),
        F.when(k % 50 == 7, F.lit(None)).when(k % 23 == 6, kv("time_end", F.lit("null"))).otherwise(kv("time_end", q(
            F.when(k % 3 == 0, F.concat(F.date_format(end, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+10:00")))
            .otherwise(F.date_format(end, "yyyy-MM-dd HH:mm:ss"))))),
        F.when(m == 0, kv("bounding_box", q(bbox_txt))),
        F.when(m == 1, kv("bounding_box", F.format_string("[%.2f,%.2f,%.2f,%.2f]", x0, y0, x1, y1))),
        F.when(m == 2, kv("aoi_name", q(F.when(k % 7 == 0, F.lit("atlantis")).otherwise(
            F.concat(F.col("_n1"), F.lit(" | "), F.col("_n2")))))),
        F.when((m == 3) | ((m == 0) & (k % 9 == 0)), kv("boundary", geojson)),
        F.when(k % 11 == 0, kv("api_params", F.lit('"{bad json"')))
        .when(k % 11 == 1, kv("api_params", F.lit('{"cloud":10}'))),
    )
    doc = F.concat(F.lit("{"), F.array_join(F.array_compact(parts), ","), F.lit("}"))
    return o.select(k.alias("order_id"), doc.alias("order_json"))


def page_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` as an object inventory: url scheme/host/path read as
    scheme/bucket/key; each page is the object ``bucket/<url path>/<page_id>.html``
    (query and fragment dropped), ``length`` = bytes of its html,
    ``modificationTime`` = 2024-01-01 + page_id minutes."""
    p = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    bucket = F.regexp_extract("url", r"^[a-z]+://([^/?#]+)", 1)
    key = F.regexp_replace(F.regexp_extract("url", r"^[a-z]+://[^/?#]+/([^?#]*)", 1), "/+$", "")
    path = F.concat_ws("/", bucket, F.when(key != "", key), F.format_string("%d.html", F.col("page_id")))
    return p.select("page_id", path.alias("path"),
                    (F.lit("2024-01-01 00:00:00").cast("timestamp")
                     + F.make_dt_interval(F.lit(0), F.lit(0), F.col("page_id").cast("int"))).alias("modificationTime"),
                    F.octet_length("html").cast("long").alias("length"), "url", "html")


DEM_ROOT = "dem-bucket/products-index/dem_30"


def dem_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as DEM dataset folders, one per document:
    ``<DEM_ROOT>/Copernicus_DSM_COG_<doc_id:05>_<N|S><doc_id%90:02>_00_<E|W><doc_id*7%180:03>_00_DEM``
    (S when doc_id is even, W when doc_id % 3 = 0) holding the document text
    as ``<name>.txt`` and an ``odc-metadata.yaml`` whose label is
    ``<name>-<source>``."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    k = F.col("doc_id")
    name = F.format_string("Copernicus_DSM_COG_%05d_%s%02d_00_%s%03d_00_DEM", k,
                           F.when(k % 2 == 0, "S").otherwise("N"), k % 90,
                           F.when(k % 3 == 0, "W").otherwise("E"), k * 7 % 180)
    dt = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (k % 365).cast("int")), "yyyy-MM-dd")
    yaml_text = F.format_string(
        "$schema: https://example.org/schema/dataset\nid: dem-%d\nlabel: %s-%s\nproduct:\n  name: dem_30\n"
        "  href: https://example.org/dem_30\ncrs: epsg:4326\nproperties:\n"
        "  datetime: '%s'\n  odc:file_format: GeoTIFF\n  eo:gsd: 30.5\n  lang: %s\n  n_chars: %d\n"
        "measurements:\n  elevation:\n    path: %s.txt\n    band: 1\nlineage:\n  parent: [parent-%d]\n",
        k, name, F.col("source"), dt, F.col("lang"), F.col("n_chars"), name, k)
    return d.select("doc_id", F.concat(F.lit(DEM_ROOT + "/"), name).alias("dir"), name.alias("name"),
                    "text", "source", "n_chars", yaml_text.alias("yaml"))


def dem_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects of the DEM folders: the metadata document and the data file."""
    d = dem_datasets(spark, sf_dir)
    meta = d.select(F.concat("dir", F.lit("/odc-metadata.yaml")).alias("path"),
                    F.octet_length("yaml").cast("long").alias("length"))
    data = d.select(F.concat("dir", F.lit("/"), "name", F.lit(".txt")).alias("path"),
                    F.octet_length("text").cast("long").alias("length"))
    return meta.unionByName(data)


def lineage_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3 (lens): ``conversations`` turns as datasets, each derived from the
    previous turn of its conversation (classifier 'previous'); turns 2 and 3
    also from the first turn of the next conversation (classifier 'other')."""
    c = read_table(spark, sf_dir, "conversations").select("conv_id", "turn")
    first = c.where(F.col("turn") == 0).select(F.col("conv_id").alias("other"))
    previous = c.where(F.col("turn") > 0).select(
        F.format_string("c%d-t%d", "conv_id", "turn").alias("dataset_ref"),
        F.lit("previous").alias("classifier"),
        F.format_string("c%d-t%d", F.col("conv_id"), F.col("turn") - 1).alias("source_dataset_ref"))
    other = c.where(F.col("turn").isin(2, 3)).join(first, F.col("conv_id") + 1 == F.col("other")).select(
        F.format_string("c%d-t%d", "conv_id", "turn").alias("dataset_ref"), F.lit("other").alias("classifier"),
        F.format_string("c%d-t%d", "other", F.lit(0)).alias("source_dataset_ref"))
    return previous.unionByName(other)
