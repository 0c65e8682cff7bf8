"""Checked queries: object inventories, listings, copy plans, dataset
documents and lineage (bulk object jobs, entry point D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.names import normalise_key, region_code, versioned_path
from tessera.operators import lineage as lin
from tessera.operators import objects as obj
from tessera.plans.registry import query
from tessera.sources import objects as src
from tessera.sources.lenses import DEM_ROOT, dem_datasets, dem_inventory, lineage_edges, page_inventory

INV = """
inv AS (
  SELECT page_id, url, html,
         concat_ws('/', regexp_extract(url, '^[a-z]+://([^/?#]+)', 1),
                   nullif(regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]+/([^?#]*)', 1), '/+$', ''), ''),
                   printf('%d.html', page_id)) AS path,
         CAST(octet_length(encode(html)) AS BIGINT) AS length
  FROM pages)"""


def _inv(spark, sf_dir):
    return page_inventory(spark, sf_dir).select("path", "modificationTime", "length")


_GLOBS = ("*.example.com/en/*", "**/fr/*", "blog.*/??/*", "*.example.[no][er][gt]/de/**")


@query("s6_glob_listing", covers=("S6", "U4"), sql=f"""
WITH {INV}
SELECT '*.example.com/en/*' AS pattern, path FROM inv WHERE regexp_matches(path, '^[^/]*\\.example\\.com/en/[^/]*$')
UNION ALL SELECT '**/fr/*', path FROM inv WHERE regexp_matches(path, '^.*/fr/[^/]*$')
UNION ALL SELECT 'blog.*/??/*', path FROM inv WHERE regexp_matches(path, '^blog\\.[^/]*/[^/][^/]/[^/]*$')
UNION ALL SELECT '*.example.[no][er][gt]/de/**', path FROM inv
  WHERE regexp_matches(path, '^[^/]*\\.example\\.[no][er][gt]/de/.*$')""")
def s6_glob_listing(spark, sf_dir):
    """Several glob patterns over one inventory (files only), unioned."""
    asked = spark.createDataFrame([(g,) for g in _GLOBS], "pattern string")
    return src.glob(_inv(spark, sf_dir), asked, include_dirs=False).select("pattern", "path")


_TREE = """
t AS (SELECT DISTINCT array_to_string(list_slice(p, 1, n - 1), '/') AS parent, p[n] AS seg, array_to_string(list_slice(p, 1, n), '/') AS path,
        CASE WHEN n = len(p) THEN 'file' ELSE 'directory' END AS type, CASE WHEN n = len(p) THEN length END AS size
      FROM (SELECT string_split(path, '/') AS p, length FROM inv), range(1, 20) r(n) WHERE n <= len(p))"""


@query("s6_ls", covers=("S6",), sql=f"WITH {INV}, {_TREE} SELECT parent, path, type, size FROM t")
def s6_ls(spark, sf_dir):
    """The immediate children of every directory, with their sizes."""
    return src.ls(_inv(spark, sf_dir))


@query("s6_expand_path", covers=("S6", "U4"), sql=f"""
WITH {INV}, {_TREE},
w AS (SELECT DISTINCT parent || '/' || seg AS wanted, path FROM t WHERE parent <> '' AND strpos(parent, '/') = 0
      UNION SELECT '?' || substr(b.parent, 2) || '/[!a-e]*', x.path FROM (SELECT DISTINCT parent FROM t WHERE parent <> '' AND strpos(parent, '/') = 0) b
        JOIN t x ON substr(x.parent, 2) = substr(b.parent, 2) AND x.parent <> '' AND strpos(x.parent, '/') = 0 AND NOT regexp_matches(x.seg, '^[a-e]'))
SELECT DISTINCT wanted, t.path, t.type FROM w JOIN t ON t.path = w.path OR starts_with(t.path, w.path || '/')""")
def s6_expand_path(spark, sf_dir):
    """Names and patterns of every bucket expanded to all entries at and
    under them (``find`` for each): its children by name, and by a pattern with
    an open first character and a negated class."""
    from tessera.operators import patterns
    inv = _inv(spark, sf_dir)
    t = patterns.tree(inv).where("parent <> '' AND parent NOT LIKE '%/%'")
    wanted = t.select(F.explode(F.array("path", F.concat(F.lit("?"), F.substring("parent", 2, 1 << 20), F.lit("/[!a-e]*")))).alias("wanted"))
    return src.expand_paths(inv, wanted.distinct(), recursive=True)


@query("s7_walk", covers=("S7", "S6"), sql=f"""
WITH {INV}, {_TREE} SELECT parent AS root, type AS kind, seg AS name FROM t WHERE parent <> ''""")
def s7_walk(spark, sf_dir):
    """Walk every bucket: per directory, its sub-directories and files."""
    return src.walk(_inv(spark, sf_dir))


@query("s8_object_info", covers=("S8",), sql=f"""
WITH {INV},
w AS (SELECT path AS wanted FROM inv
      UNION SELECT regexp_extract(path, '^(.*)/[^/]+$', 1) FROM inv
      UNION SELECT path || '.missing' FROM inv),
d AS (SELECT DISTINCT array_to_string(list_slice(string_split(path, '/'), 1, n), '/') AS dir
      FROM inv, range(1, 10) r(n) WHERE n < len(string_split(path, '/')))
SELECT w.wanted, (i.path IS NOT NULL OR d.dir IS NOT NULL) AS exists, i.path IS NOT NULL AS isfile,
       d.dir IS NOT NULL AS isdir, i.length AS size,
       CASE WHEN i.path IS NOT NULL THEN 'file' WHEN d.dir IS NOT NULL THEN 'directory' END AS type
FROM w LEFT JOIN inv i ON i.path = w.wanted LEFT JOIN d ON d.dir = w.wanted""")
def s8_object_info(spark, sf_dir):
    """exists / isfile / isdir / size for every object, every object's
    folder and a missing sibling of every object."""
    inv = _inv(spark, sf_dir)
    wanted = inv.select(F.explode(F.array("path", F.regexp_extract("path", r"^(.*)/[^/]+$", 1), F.concat("path", F.lit(".missing")))).alias("wanted"))
    return src.info(inv, wanted)


@query("s9_du_rollup", covers=("S9", "A11"), sql=f"""
WITH {INV}, p AS (
  SELECT string_split(path, '/') AS parts, length FROM inv)
SELECT CASE WHEN len(parts) > 1 THEN parts[1] END AS level0, CASE WHEN len(parts) > 2 THEN parts[2] END AS level1,
       sum(length) AS bytes, count(*) AS n_objects
FROM p GROUP BY ROLLUP (1, 2)""")
def s9_du_rollup(spark, sf_dir):
    return src.du(_inv(spark, sf_dir), depth=2)


@query("s10_object_head", covers=("S10",), sql=f"""
WITH {INV} SELECT path, substr(hex(encode(html)), 1, 360) AS head_hex, length AS n_bytes,
                  md5(html) AS content_md5 FROM inv""")
def s10_object_head(spark, sf_dir):
    """First 180 bytes and a digest of each whole object."""
    p = page_inventory(spark, sf_dir)
    return p.select("path", F.hex(src.head("html", 180)).alias("head_hex"), F.col("length").alias("n_bytes"),
                    F.md5("html").alias("content_md5"))


@query("p13_regex_filter", covers=("P13",), sql=f"""
WITH {INV} SELECT path FROM inv WHERE regexp_matches(path, '/(en|fr)/[0-9]{{2}}5') AND path LIKE '%.html'""")
def p13_regex_filter(spark, sf_dir):
    f = src.filter_regex(_inv(spark, sf_dir), r"/(en|fr)/[0-9]{2}5")
    return f.where(F.col("path").endswith(".html")).select("path")


@query("s11_copy_plan", covers=("S11", "F10"), sql=f"""
WITH {INV},
b AS (SELECT DISTINCT regexp_extract(path, '^([^/]+)', 1) AS bucket FROM inv),
g AS (SELECT bucket, count(*) AS n FROM b JOIN inv i ON regexp_matches(i.path, '^' || replace(bucket, '.', '\\.') || '/fr/[^/]*/[^/]*5\\.html$') GROUP BY 1)
SELECT i.path AS src, 'backup/' || b.bucket || '/en/' || substring(i.path, length(b.bucket || '/en/') + 1) AS dst, i.length, CAST(NULL AS VARCHAR) AS error
FROM b JOIN inv i ON starts_with(i.path, b.bucket || '/en/')
UNION ALL
SELECT bucket || '/en', 'backup/' || bucket || '/', NULL, 'source not found' FROM b
WHERE NOT EXISTS (SELECT 1 FROM inv i WHERE starts_with(i.path, b.bucket || '/en/'))
UNION ALL
SELECT bucket, 'flat/', NULL, 'is a directory: not recursive' FROM b
UNION ALL
SELECT i.path, 'globbed/' || regexp_extract(path, '([^/]*)$', 1), length, NULL
FROM b JOIN inv i ON regexp_matches(i.path, '^' || replace(bucket, '.', '\\.') || '/fr/[^/]*/[^/]*5\\.html$')
UNION ALL
SELECT bucket || '/fr/*/*5.html', 'globbed/', NULL, 'source not found' FROM b WHERE bucket NOT IN (SELECT bucket FROM g)
UNION ALL
SELECT path || '.gone', 'lost/', NULL, 'source not found' FROM inv WHERE page_id % 2 = 0
UNION ALL
SELECT path, 'archive/' || regexp_extract(path, '([^/]*)$', 1), length, NULL FROM inv
UNION ALL
SELECT path, 'single/' || CAST(page_id AS VARCHAR) || '.bin', length, NULL FROM inv
UNION ALL
SELECT i.path, 'open/' || regexp_extract(i.path, '([^/]*)$', 1), i.length, NULL
FROM inv p JOIN inv i ON substr(i.path, 2) = substr(p.path, 2)
UNION ALL
SELECT bucket || '/en/[z-a]*', 'bad/', NULL, 'malformed pattern' FROM b
UNION ALL
SELECT bucket || '/e[n/*', 'odd/', NULL, 'source not found' FROM b""")
def s11_copy_plan(spark, sf_dir):
    """Copy requests expanded to object pairs: each bucket's 'en' folder
    into 'backup/<bucket>/' (directory lands under its basename), each bucket
    without recursion (an error row), a glob in each bucket, missing objects
    (error rows), every object into 'archive/' (trailing slash = into folder),
    to a file name (no trailing slash) and by a glob that begins with a
    wildcard; malformed globs (error rows) and unclosed ones.  Sources given as 's3://', '/' or
    bare keys are normalised first."""
    inv = page_inventory(spark, sf_dir).select("page_id", "path", "length")
    path, b = F.col("path"), F.regexp_extract("path", "^([^/]+)", 1)

    def req(source, dst, recursive=False):
        return F.struct(source.alias("src"), dst.alias("dst"), F.lit(recursive).alias("recursive"))
    asked = [req(F.concat(F.lit("s3://"), b, F.lit("/en")), F.concat(F.lit("backup/"), b, F.lit("/")), True), req(b, F.lit("flat/")),
             req(F.concat(b, F.lit("/fr/*/*5.html")), F.lit("globbed/")), req(F.concat(b, F.lit("/en/[z-a]*")), F.lit("bad/")),
             req(F.concat(b, F.lit("/e[n/*")), F.lit("odd/")),
             req(F.when(F.col("page_id") % 2 == 0, F.concat(path, F.lit(".gone"))), F.lit("lost/")),
             req(F.concat(F.lit("/"), path), F.lit("archive/")), req(path, F.format_string("single/%d.bin", F.col("page_id"))),
             req(F.concat(F.lit("?"), F.substring("path", 2, 1 << 20)), F.lit("open/"))]
    reqs = inv.select(F.inline(F.array(*asked))).where("src IS NOT NULL").distinct()
    return obj.copy_plan(inv, reqs.withColumn("src", normalise_key("src")))


@query("l1_first_objects", covers=("L1",), sql=f"""
WITH {INV}, e AS (SELECT path, row_number() OVER (ORDER BY path) - 1 AS i FROM inv)
SELECT i, path FROM e WHERE i <= 1000""")
def l1_first_objects(spark, sf_dir):
    """The job's cut: the first 1001 enumerated keys (positions 0 to 1000)."""
    return obj.enumerate_paths(obj.first_n(_inv(spark, sf_dir).select("path"), 1001)).select("i", "path")


@query("l2_first_items", covers=("L2", "L1"), sql=f"""
WITH {INV} SELECT path FROM inv ORDER BY path LIMIT 4""")
def l2_first_items(spark, sf_dir):
    """Early-out listing: the first four keys in order."""
    return obj.first_n(_inv(spark, sf_dir).select("path"), 4)


# ------------------------------------------------------------------ DEM copy-and-edit

DEM = f"""
dem AS (
  SELECT doc_id, source, n_chars,
         printf('Copernicus_DSM_COG_%05d_%s%02d_00_%s%03d_00_DEM', doc_id,
                CASE WHEN doc_id % 2 = 0 THEN 'S' ELSE 'N' END, doc_id % 90,
                CASE WHEN doc_id % 3 = 0 THEN 'W' ELSE 'E' END, doc_id * 7 % 180) AS name
  FROM documents)"""


@query("x5_copy_edit_plan", covers=("X5", "W3", "F7", "S6"), sql=f"""
WITH {DEM}, d AS (SELECT '{DEM_ROOT}/' || name AS path FROM dem),
e AS (SELECT row_number() OVER (ORDER BY path) - 1 AS i, path FROM d)
SELECT i, path AS src, '{DEM_ROOT}/v2020_2/' || regexp_extract(path, '([^/]+)$', 1) AS dst,
       printf('Completed [%03d]: %s -> %s', i, path, '{DEM_ROOT}/v2020_2/' || regexp_extract(path, '([^/]+)$', 1)) AS msg
FROM e""")
def x5_copy_edit_plan(spark, sf_dir):
    """Dataset folders matched by glob, enumerated from 0 in path order, all
    planned to their versioned targets."""
    inv = dem_inventory(spark, sf_dir)
    dirs = src.glob(inv, f"{DEM_ROOT}/Copernicus_DSM_COG_*_DEM").where(F.col("type") == "directory")
    return obj.copy_edit_plan(dirs)


@query("f8_document_edit", covers=("F8", "F6", "S12"), sql=f"""
WITH {DEM}
SELECT '{DEM_ROOT}/v2020_2/' || name AS dst, CAST(NULL AS VARCHAR) AS error, name || '-v2020_2' AS label,
       'copernicus_dem_30_v2020_2' AS product_name, 'https://example.org/dem_30' AS product_href,
       regexp_extract(name, '([NS]\\w{{2}})_\\d{{2}}_([EW]\\w{{3}})', 1)
         || regexp_extract(name, '([NS]\\w{{2}})_\\d{{2}}_([EW]\\w{{3}})', 2) AS region_code,
       '30' AS gsd, 'GLO-30' AS platform, '2020_2' AS version, '2021-03-01T00:00:00' AS datetime,
       CAST(n_chars AS BIGINT) AS n_chars, 'GeoTIFF' AS file_format, 'https://example.org/schema/dataset' AS schema_name,
       1 AS band, 'parent-' || doc_id AS parent
FROM dem""")
def f8_document_edit(spark, sf_dir):
    """Every dataset document parsed from YAML and edited (label, product,
    datetime, gsd, platform, version, region code) for its new location; all
    other members stay as they are."""
    d = dem_datasets(spark, sf_dir)
    parsed = src.yaml_documents(d.select("dir", "yaml"), "yaml", "dir")
    e = parsed.select(versioned_path("dir").alias("dst"), "error", F.parse_json(obj.edit_document("doc")).alias("d"))

    def at(path, kind="string"):
        return F.variant_get("d", path, kind)
    return e.select("dst", "error", at("$.label").alias("label"), at("$.product.name").alias("product_name"),
                    at("$.product.href").alias("product_href"), at("$.properties['odc:region_code']").alias("region_code"),
                    at("$.properties['eo:gsd']").alias("gsd"), at("$.properties['eo:platform']").alias("platform"),
                    at("$.properties['odc:dataset_version']").alias("version"), at("$.properties.datetime").alias("datetime"),
                    at("$.properties.n_chars", "bigint").alias("n_chars"), at("$.properties['odc:file_format']").alias("file_format"),
                    at("$['$schema']").alias("schema_name"), at("$.measurements.elevation.band", "int").alias("band"),
                    at("$.lineage.parent[0]").alias("parent"))


@query("f6_region_codes", covers=("F6",), sql=f"""
WITH {DEM}
SELECT regexp_extract(name, '([NS]\\w{{2}})_\\d{{2}}_([EW]\\w{{3}})', 1)
         || regexp_extract(name, '([NS]\\w{{2}})_\\d{{2}}_([EW]\\w{{3}})', 2) AS region_code,
       count(*) AS n_datasets, sum(n_chars) AS n_chars
FROM dem GROUP BY 1""")
def f6_region_codes(spark, sf_dir):
    d = dem_datasets(spark, sf_dir)
    return d.groupBy(region_code("name").alias("region_code")).agg(
        F.count(F.lit(1)).alias("n_datasets"), F.sum("n_chars").alias("n_chars"))


# ------------------------------------------------------------------ lineage, J11, S24

EDGES = """
edges AS (
  SELECT printf('c%d-t%d', conv_id, turn) AS dataset_ref, 'previous' AS classifier,
         printf('c%d-t%d', conv_id, turn - 1) AS source_dataset_ref
  FROM conversations WHERE turn > 0
  UNION ALL
  SELECT printf('c%d-t%d', a.conv_id, a.turn), 'other', printf('c%d-t%d', b.conv_id, 0)
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id + 1 AND b.turn = 0 WHERE a.turn IN (2, 3))"""


@query("s3_lineage_edges", covers=("S3",), sql=f"WITH {EDGES} SELECT * FROM edges")
def s3_lineage_edges(spark, sf_dir):
    return lineage_edges(spark, sf_dir)


@query("j10_lineage_roots", covers=("J10",), sql=f"""
WITH RECURSIVE {EDGES},
walk(node, anc, depth) AS (
  SELECT printf('c%d-t%d', conv_id, turn), printf('c%d-t%d', conv_id, turn), 0 FROM conversations
  UNION SELECT walk.node, edges.source_dataset_ref, walk.depth + 1 FROM walk JOIN edges ON edges.dataset_ref = walk.anc)
SELECT node, anc AS root, min(depth) AS depth, max(depth) AS max_depth FROM walk
WHERE anc NOT IN (SELECT dataset_ref FROM edges) GROUP BY node, anc""")
def j10_lineage_roots(spark, sf_dir):
    """Every root of each dataset, with the fewest and the most hops to it;
    datasets with two sources have several."""
    from tessera.sources.tables import read_table
    c = read_table(spark, sf_dir, "conversations")
    nodes = c.select(F.format_string("c%d-t%d", "conv_id", "turn").alias("id"))
    return lin.roots(lineage_edges(spark, sf_dir), nodes).select("node", "root", "depth", "max_depth")


@query("j10_one_hop", covers=("J10",), sql=f"""
WITH {EDGES}
SELECT e.dataset_ref, e.classifier, c.role AS source_role
FROM edges e JOIN conversations c ON printf('c%d-t%d', c.conv_id, c.turn) = e.source_dataset_ref WHERE e.classifier = 'other'""")
def j10_one_hop(spark, sf_dir):
    """Each derived dataset's source by classifier, with its attributes."""
    from tessera.sources.tables import read_table
    c = read_table(spark, sf_dir, "conversations")
    nodes = c.select(F.format_string("c%d-t%d", "conv_id", "turn").alias("id"), "role")
    return lin.one_hop(lineage_edges(spark, sf_dir), nodes, "other").select("dataset_ref", "classifier", "source_role")


@query("j11_measurement_grids", covers=("J11", "F25"), sql="""
WITH s AS (
  SELECT o.o_orderkey AS id FROM orders o JOIN nation n ON o.o_custkey % 25 = n.n_nationkey
  WHERE n.n_regionkey IN (1, 2))
SELECT id, m.name AS measurement, m.grid, m.h, m.w FROM s,
  (VALUES ('red', 'default', 7681, 7531), ('green', 'default', 7681, 7531),
          ('aerosol', 'g60m', 3841, 3766)) m(name, grid, h, w)""")
def j11_measurement_grids(spark, sf_dir):
    """Each eo3 measurement's grid (a missing grid name means 'default')
    looked up in the document's grids map."""
    from tessera.sources.catalogue import dataset
    d = dataset(spark, sf_dir).select("id", F.from_json("metadata", (
        "struct<grids map<string, struct<shape array<int>, transform array<double>>>, "
        "measurements map<string, struct<path string, grid string>>>")).alias("doc"))
    m = d.select("id", "doc.grids", F.explode("doc.measurements").alias("measurement", "mm"))
    g = F.coalesce(F.col("mm.grid"), F.lit("default"))
    return m.select("id", "measurement", g.alias("grid"), F.element_at("grids", g)["shape"][0].alias("h"),
                    F.element_at("grids", g)["shape"][1].alias("w"))


@query("s24_row_update_stamp", covers=("S24",), sql="""
SELECT o_orderkey AS id, CASE WHEN o_orderpriority = '1-URGENT' THEN 'lens-v2' ELSE 'lens' END AS added_by,
       o_orderpriority = '1-URGENT' AS was_updated
FROM orders""")
def s24_row_update_stamp(spark, sf_dir):
    """Upsert of changed rows stamps ``updated`` with the current time."""
    from tessera.sources.catalogue import scene_base
    from tessera.sources.tables import read_table
    cur = scene_base(spark, sf_dir).select("id", F.lit("lens").alias("added_by"))
    o = read_table(spark, sf_dir, "orders").where(F.col("o_orderpriority") == "1-URGENT")
    changes = o.select(F.col("o_orderkey").alias("id"), F.lit("lens-v2").alias("added_by"))
    up = lin.stamp_updates(cur, changes)
    return up.select("id", "added_by", F.col("updated").isNotNull().alias("was_updated"))


@query("s24_stored_upserts", covers=("S24",), sql="""
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN 'lens-v3' WHEN o_orderpriority = '1-URGENT' THEN 'lens-v2' ELSE 'lens' END AS added_by,
       CASE WHEN o_orderkey % 5 = 0 THEN 3 WHEN o_orderpriority = '1-URGENT' THEN 2 ELSE 1 END AS stamped_by
FROM orders
UNION ALL SELECT -o_orderkey, 'new', 3 FROM orders WHERE o_orderkey % 97 = 0 AND o_orderkey > 0""")
def s24_stored_upserts(spark, sf_dir):
    """Two upserts into a stored table of versions: ``stamped_by`` is the
    version whose write gave a row its ``updated`` stamp, told from the stored
    versions themselves."""
    import uuid

    from tessera.session import ensure_checkpoint_dir
    from tessera.sources.catalogue import scene_base
    from tessera.sources.tables import read_table
    from tessera.sources.versions import VersionedTable
    table = VersionedTable(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/versions/dataset-{uuid.uuid4().hex}")
    o = read_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("long")
    table.upsert(scene_base(spark, sf_dir).select(F.col("id").cast("long").alias("id"), F.lit("lens").alias("added_by")))
    table.upsert(o.where(F.col("o_orderpriority") == "1-URGENT").select(key.alias("id"), F.lit("lens-v2").alias("added_by")))
    third = F.array(F.when(key % 5 == 0, F.struct(key.alias("id"), F.lit("lens-v3").alias("added_by"))),
                    F.when((key % 97 == 0) & (key > 0), F.struct((-key).alias("id"), F.lit("new").alias("added_by"))))
    table.upsert(o.select(F.inline(F.array_compact(third))))
    stamps = None
    for v in (1, 2, 3):
        one = table.read(v).select(F.col("id").alias("_id"), F.col("updated").alias("_at"), F.lit(v).alias("_v"))
        stamps = one if stamps is None else stamps.unionByName(one)
    # The first version that holds the row's present stamp wrote it.
    wrote = stamps.groupBy("_id", "_at").agg(F.min("_v").alias("stamped_by"))
    now = table.read()
    return now.join(wrote, (now["id"] == wrote["_id"]) & (now["updated"] == wrote["_at"])).select("id", "added_by", "stamped_by")
