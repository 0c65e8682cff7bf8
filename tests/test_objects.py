import os

from pyspark.sql import functions as F

from tessera.operators import objects as obj
from tessera.sources import objects as src
from tessera.sources.sinks import layout_for


def _tree(root):
    files = {"b/p/Copernicus_DSM_COG_10_S10_00_E141_00_DEM/odc-metadata.yaml":
             "id: x\nlabel: Copernicus_DSM_COG_10_S10_00_E141_00_DEM-2019\nproduct:\n  name: dem\n"
             "properties:\n  datetime: '2019-01-01'\n",
             "b/p/Copernicus_DSM_COG_10_S10_00_E141_00_DEM/data.tif": "x" * 500,
             "b/p/other/readme.txt": "hello"}
    for k, v in files.items():
        os.makedirs(os.path.join(root, os.path.dirname(k)), exist_ok=True)
        with open(os.path.join(root, k), "w") as f:
            f.write(v)
    return files


KEYS = ["b/p/Copx/odc.yaml", "b/p/Copx/sub/odc.yaml", "b/p/other/readme.txt", "b/axc.txt", "b/abc.txt", "b/a^c.txt", "b/a[c.txt", "b/a[c]d.txt",
        "b/a-c.txt", "c/x", "cx", "b/a.c.txt", "b/a\\c.txt", "d/é/日.txt", "fr/x", "a/fr/x", "b/a&c.txt"]
GLOBS = {
    "b/p/Cop*/*.y?ml": {"b/p/Copx/odc.yaml"}, "b/**/*.txt": {"b/p/other/readme.txt"},
    "b/[op]*": set(), "b/a[^x]c.txt": {"b/abc.txt", "b/a^c.txt", "b/a[c.txt", "b/a-c.txt", "b/a.c.txt", "b/a\\c.txt", "b/a&c.txt"},
    "b/a[!x-z]c.txt": {"b/abc.txt", "b/a^c.txt", "b/a[c.txt", "b/a-c.txt", "b/a.c.txt", "b/a\\c.txt", "b/a&c.txt"},
    "b/a[c.txt": {"b/a[c.txt"}, "b/a[c]d.txt": set(), "b/a[[]c[]]d.txt": {"b/a[c]d.txt"}, "b/a[z-a]c.txt": set(), "b/a.c.txt": {"b/a.c.txt"},
    "b/a[x^-]c.txt": {"b/axc.txt", "b/a^c.txt", "b/a-c.txt"}, "?/x": {"c/x"}, "??": {"cx"}, "**": set(KEYS), "**/fr/*": {"a/fr/x"}, "c/x/": {"c/x"},
    "b/a\\c.txt": {"b/a\\c.txt"}, "?/[!a]/?.txt": {"d/é/日.txt"}, "b/p/**": {k for k in KEYS if k.startswith("b/p/")}, "b/a[&]c.txt": {"b/a&c.txt"},
    "b/p/**/odc*": {"b/p/Copx/odc.yaml", "b/p/Copx/sub/odc.yaml"}, "[bc]/a[a-c&&]c.txt": {"b/abc.txt", "b/a&c.txt"}, "": set(), "b//x": set()}


def test_one_matcher_for_listing_and_copying(spark):
    inv = spark.createDataFrame([(k, 1) for k in KEYS], "path string, length long")
    asked = spark.createDataFrame([(g,) for g in GLOBS], "pattern string")
    got = {g: set() for g in GLOBS}
    for r in src.glob(inv, asked, include_dirs=False).collect():
        got[r.pattern].add(r.path)
    assert got == GLOBS
    assert {(r.path, r.type) for r in src.glob(inv, "b/p/*").collect()} == {("b/p/Copx", "directory"), ("b/p/other", "directory")}
    reqs = spark.createDataFrame([(g, "to/", False) for g in GLOBS if g], "src string, dst string, recursive boolean")
    rows = obj.copy_plan(inv, reqs).collect()
    by = {(r.src, r.dst): r.error for r in rows}
    assert by[("b/a[z-a]c.txt", "to/")] == "malformed pattern" and by[("b/a[c]d.txt", "to/")] == "source not found"
    for g, paths in GLOBS.items():
        for p in paths:
            assert by[(p, "to/" + p.rsplit("/", 1)[-1])] is None


def test_many_open_globs_and_scans(spark):
    inv = spark.range(3000).select(F.format_string("b%d/f%d.txt", F.col("id") % 7, "id").alias("path"), F.lit(1).cast("long").alias("length"))
    reqs = inv.select(F.concat(F.lit("*"), F.substring("path", 3, 99)).alias("src"), F.lit("to/").alias("dst"), F.lit(False).alias("recursive")).limit(2000)
    plan = obj.copy_plan(inv, reqs)
    assert plan.where("error IS NULL").count() == 2000 and plan.count() == 2000
    # All that is read is what was written: the inventory itself is behind it.
    assert "Range" not in plan._jdf.queryExecution().executedPlan().toString()


def test_listing_copy_and_edit_on_files(spark, tmp_dir):
    files = _tree(tmp_dir)
    inv = src.list_files(spark, tmp_dir)
    root = tmp_dir.lstrip("/")
    inv = inv.select(F.regexp_replace("path", "^" + root + "/", "").alias("path"), "modificationTime", "length")
    assert {r.path for r in inv.collect()} == set(files)
    info = {r.wanted: r for r in src.info(inv, spark.createDataFrame(
        [("b/p",), ("b/p/other/readme.txt",), ("b/nope",)], "wanted string")).collect()}
    assert info["b/p"].isdir and info["b/p/other/readme.txt"].isfile and not info["b/nope"].exists
    du = {(r.level0, r.level1): r.bytes for r in src.du(inv).collect()}
    assert du[(None, None)] == sum(len(v) for v in files.values())
    ls = {r.path: r.type for r in src.ls(inv, "b/p").collect()}
    assert ls == {"b/p/Copernicus_DSM_COG_10_S10_00_E141_00_DEM": "directory", "b/p/other": "directory"}

    dirs = src.glob(inv, "b/p/Copernicus_DSM_COG_*_DEM").where("type = 'directory'")
    plan = obj.copy_edit_plan(dirs)
    p = plan.first()
    assert p.dst == "b/p/v2020_2/Copernicus_DSM_COG_10_S10_00_E141_00_DEM"
    reqs = plan.select("src", "dst", F.lit(True).alias("recursive"))
    cp = obj.copy_plan(inv, reqs.select("src", F.regexp_replace("dst", "/[^/]+$", "/").alias("dst"), "recursive"))
    res = obj.execute_copies(cp, src_root=tmp_dir + "/", dst_root=tmp_dir + "/").collect()
    assert len(res) == 2 and all(r.ok for r in res)
    assert os.path.getsize(os.path.join(tmp_dir, p.dst, "data.tif")) == 500

    docs = spark.read.format("binaryFile").load(os.path.join(tmp_dir, p.dst, "odc-metadata.yaml")) \
        .select(F.lit(p.dst).alias("dst"), F.decode("content", "UTF-8").alias("y"))
    parsed = src.yaml_documents(docs, "y", "dst")
    edited = parsed.select("dst", obj.edit_document("doc").alias("doc"))
    assert all(r.ok for r in obj.write_documents(edited, tmp_dir + "/").collect())
    import yaml
    out = yaml.safe_load(open(os.path.join(tmp_dir, p.dst, "odc-metadata.yaml")))
    assert out["label"] == "Copernicus_DSM_COG_10_S10_00_E141_00_DEM-v2020_2"
    assert out["properties"]["odc:region_code"] == "S10E141"
    assert out["product"]["name"] == "copernicus_dem_30_v2020_2"


def test_storage_dispatch():
    assert layout_for("COG") == "pixel" and layout_for("zarr") == "block"
    try:
        layout_for("tiff")
        raise AssertionError("expected ValueError")
    except ValueError as e:
        assert "Unknown storage" in str(e)


def test_refresh_writes_the_three_views(spark, tmp_dir):
    from tessera.plans.refresh import refresh_views
    from tessera.sources.catalogue import dataset, metadata_type
    from tables import SF_SMALL
    d, mt = dataset(spark, SF_SMALL), metadata_type(spark, SF_SMALL)
    paths = refresh_views(spark, d, mt, os.path.join(tmp_dir, "views"))
    st = spark.read.parquet(paths["space_time"])
    assert st.count() == spark.read.parquet(paths["space"]).count() > 0
