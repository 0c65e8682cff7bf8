"""Lineage by doubling, integrity in one pass, versioned tables."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from tessera.operators import lineage, quality
from tessera.sources.versions import VersionedTable


def _roots(spark, edges, nodes):
    e = spark.createDataFrame([(a, "x", b) for a, b in edges], "dataset_ref string, classifier string, source_dataset_ref string")
    n = spark.createDataFrame([(x,) for x in nodes], "id string")
    return {(r.node, r.root, r.depth, r.max_depth, r.error is not None) for r in lineage.roots(e, n).collect()}


def test_roots_of_random_graphs(spark):
    rng = random.Random(2)
    for cyclic in (False, True):
        nodes = [f"n{i}" for i in range(40)]
        edges = {(f"n{i}", f"n{rng.randrange(i)}") for i in range(1, 40) for _ in range(rng.randint(0, 2))}
        if cyclic:
            edges |= {("n30", "n33"), ("n33", "n30"), ("n39", "n30"), ("n5", "n5"), ("n8", "n5")}
        up = {}
        for a, b in edges:
            up.setdefault(a, set()).add(b)

        def walk(x, seen=()):
            if x in seen:
                return None
            if x not in up:
                return {x: (0, 0)}
            out = {}
            for p in up[x]:
                got = walk(p, (*seen, x))
                if got is None:
                    return None
                for r, (lo, hi) in got.items():
                    a, b = out.get(r, (10**9, -1))
                    out[r] = (min(a, lo + 1), max(b, hi + 1))
            return out
        want = set()
        for x in nodes:
            got = walk(x)
            want |= {(x, None, None, None, True)} if got is None else {(x, r, lo, hi, False) for r, (lo, hi) in got.items()}
        assert _roots(spark, edges, nodes) == want


def test_a_chain_of_ten_thousand_takes_few_rounds(spark, monkeypatch):
    seen = []
    kept = lineage.kept
    monkeypatch.setattr(lineage, "kept", lambda df, name: seen.append(name) or kept(df, name))
    ids = spark.range(10_001)
    edges = ids.where("id > 0").select(F.col("id").alias("dataset_ref"), F.lit("x").alias("classifier"), (F.col("id") - 1).alias("source_dataset_ref"))
    out = lineage.roots(edges, ids).agg(F.count("*"), F.min("root"), F.max("root"), F.sum("depth"), F.sum("max_depth")).first()
    assert tuple(out) == (10_001, 0, 0, 10_000 * 10_001 // 2, 10_000 * 10_001 // 2)
    assert seen.count("lineage") <= 15


def test_integrity_reads_each_table_once(spark, tmp_dir):
    a = [(1, "x", 5), (1, "y", 6), (2, "x", None), (None, "x", 9), (3, None, 9), (3, None, 7)]
    spark.createDataFrame(a, "id int, name string, ref int").write.parquet(tmp_dir + "/a")
    spark.createDataFrame([(5,), (6,), (6,), (None,)], "pk long").write.parquet(tmp_dir + "/b")
    tables = {t: spark.read.parquet(f"{tmp_dir}/{t}") for t in "ab"}
    rules = [quality.Unique("a.id", "a", ("id",)), quality.Unique("a.id,name", "a", ("id", "name")), quality.Unique("b.pk", "b", ("pk",)),
             quality.Reference("a.ref", "a", ("ref",), "b", ("pk",)), quality.Reference("b.pk in a", "b", ("pk",), "a", ("id",)),
             quality.Reference("self", "a", ("ref",), "a", ("ref",))]
    found = quality.violations(tables, rules)
    assert {tuple(r) for r in found.collect()} == {("a.id", '["1"]', 2), ("a.id", '["3"]', 2), ("b.pk", '["6"]', 2), ("a.ref", '["9"]', 2),
                                                   ("a.ref", '["7"]', 1), ("b.pk in a", '["5"]', 1), ("b.pk in a", '["6"]', 2)}
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 2 and plan.count("Exchange") <= 2
    assert {(r.constraint, r.n_keys, r.n_rows) for r in quality.integrity(tables, rules).collect()} == {
        ("a.id", 2, 4), ("a.id,name", 0, 0), ("b.pk", 1, 2), ("a.ref", 2, 3), ("b.pk in a", 2, 3), ("self", 0, 0)}


def test_versions_are_whole_or_not_there(spark, tmp_dir):
    def rows(t, v=None):
        return {(r.id, r.x) for r in t.read(v).collect()}
    t = VersionedTable(spark, tmp_dir + "/t")
    with pytest.raises(FileNotFoundError):
        t.read()
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    assert t.upsert(first) == 1
    stamp = {r.id: r.updated for r in t.read().collect()}
    assert t.upsert(spark.createDataFrame([(2, "B"), (3, "c")], "id long, x string")) == 2
    now = {r.id: (r.x, r.updated) for r in t.read().collect()}
    assert now[1] == ("a", stamp[1]) and now[2][0] == "B" and now[2][1] > stamp[2] and now[3][0] == "c"
    assert rows(t, 1) == {(1, "a"), (2, "b")}
    # A write that fails half-way, and one with a key that stands twice, change nothing.
    broken = spark.range(4).select(F.col("id"), F.when(F.col("id") < 3, F.lit("z")).otherwise(F.raise_error(F.lit("no"))).alias("x"))
    for bad in (broken, spark.createDataFrame([(1, "p"), (1, "q")], "id long, x string")):
        with pytest.raises(Exception):
            t.upsert(bad)
        assert t.version() == 2 and rows(t) == {(1, "a"), (2, "B"), (3, "c")}


def test_two_writers_do_not_lose_updates(spark, tmp_dir):
    t = VersionedTable(spark, tmp_dir + "/t")
    t.upsert(spark.createDataFrame([(0, "start")], "id long, x string"))
    gate = threading.Barrier(3, timeout=60)

    def write(i):
        tried = []

        def build(base):
            if not tried:
                gate.wait()               # all begin from the same version
            tried.append(1)
            return base.select("id", "x").unionByName(spark.createDataFrame([(i, f"w{i}")], "id long, x string"))
        VersionedTable(spark, tmp_dir + "/t").update(build)
    workers = [threading.Thread(target=write, args=(i,)) for i in (1, 2, 3)]
    for w in workers:
        w.start()
    for w in workers:
        w.join()
    assert t.version() == 4 and {r.id for r in t.read().collect()} == {0, 1, 2, 3}


def test_nearest_of_crowded_and_lonely_points(spark):
    from tessera.operators.nearest import nearest
    rng = random.Random(8)
    pts = [(i, rng.gauss(0, 0.1), rng.gauss(0, 0.1)) for i in range(250)]             # a crowd
    pts += [(300 + i, 5.0, 5.0) for i in range(120)]                                    # one place
    pts += [(500 + i, rng.uniform(-50, 50), rng.uniform(-50, 50)) for i in range(60)]
    pts += [(900, None, 1.0), (901, float("nan"), 1.0), (None, 0.0, 0.0)]
    df = spark.createDataFrame(pts, "id long, x double, y double")
    far = spark.createDataFrame([(-1, 1e4, -1e4), (-2, 0.0, 0.0), (7, 0.0, 0.0)], "id long, x double, y double")
    real = [p for p in pts if p[0] is not None and p[1] is not None and p[1] == p[1]]

    def want(q, k):
        d = sorted((((q[1] - p[1]) ** 2 + (q[2] - p[2]) ** 2) ** 0.5, p[0]) for p in real if p[0] != q[0])
        return [i for _, i in d[:k]]
    for queries, rows in ((df, real), (far, [(-1, 1e4, -1e4), (-2, 0.0, 0.0), (7, 0.0, 0.0)])):
        got = {}
        for r in nearest(df, queries, 4).orderBy("id", "rank").collect():
            got.setdefault(r.id, []).append(r.neighbour)
        assert got == {q[0]: want(q, 4) for q in rows}
    few = df.where("id < 3")
    assert nearest(few, few, 5).count() == 6 and nearest(df.limit(0), df, 5).count() == 0


def _ring(pts):
    return [[{"x": float(x), "y": float(y)} for x, y in [*pts, pts[0]]]]


def test_cover_is_exact_and_bounded(spark):
    import math

    from tessera.operators import grid
    rng = random.Random(3)
    shapes = {"world": [(-2000, -1000), (2000, -1000), (2000, 1000), (-2000, 1000)], "box": [(0, 0), (8, 0), (8, 4), (0, 4)],
              "point": [(3.5, 3.5), (3.5, 3.5), (3.5, 3.5)], "thin": [(-6.2, 0.1), (30.7, 9.9), (30.7, 10.0)],
              "concave": [(0, 0), (20, 0), (20, 20), (10, 3), (0, 20)]}
    for i in range(4):
        n, r = rng.randint(3, 7), rng.uniform(1, 12)
        at = sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))
        shapes[f"r{i}"] = [(5 + r * math.cos(a), -3 + r * math.sin(a)) for a in at]
    areas = spark.createDataFrame([(k, _ring(p)) for k, p in shapes.items()], "area string, rings array<array<struct<x:double,y:double>>>")
    cells = grid.cover(areas, "area", 1.0).collect()
    world = [c for c in cells if c.area == "world"]
    # 8,000,000 tiles as a few cells for each of the 12,000 along the border.
    assert len(world) < 60_000 and max(c.level for c in world) >= 8
    got = {}
    for c in cells:
        if c.area != "world":
            w = 1 << c.level
            got.setdefault(c.area, []).extend((c.cell_x * w + i, c.cell_y * w + j) for i in range(w) for j in range(w))
    small = areas.where("area <> 'world'")
    want = {}
    for r in grid.tile_cells(small, 1.0).select("area", "tile_x", "tile_y").collect():
        want.setdefault(r.area, set()).add((r.tile_x, r.tile_y))
    assert {k: len(v) for k, v in got.items()} == {k: len(set(v)) for k, v in got.items()}        # no tile twice
    assert {k: set(v) for k, v in got.items()} == want


def test_pixel_store_prunes_and_skips_broken_files(spark, tmp_dir):
    import glob
    import os

    from tables import SF_SMALL
    from tessera.sources import pixel_store
    from tessera.sources.lenses import observations
    obs = observations(spark, SF_SMALL)
    path = os.path.join(tmp_dir, "pixels")
    pixel_store.write_pixels(obs, path)
    keys = spark.createDataFrame([(0, -1), (1, -2)], "tile_x int, tile_y int")
    got = pixel_store.read_pixels(spark, path, obs.schema, keys, ("1995-01-01 00:00:00", "1995-12-31 00:00:00"))
    t = F.col("t")
    want = obs.where(((F.col("tile_x") == 0) & (F.col("tile_y") == -1) | (F.col("tile_x") == 1) & (F.col("tile_y") == -2))
                     & t.between(F.lit("1995-01-01").cast("timestamp_ntz"), F.lit("1995-12-31").cast("timestamp_ntz")))
    assert got.count() == want.count() > 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "GreaterThanOrEqual(t" in plan
    # A truncated file, and one that is no Parquet at all.
    files = sorted(glob.glob(f"{path}/tile_x=0/tile_y=-1/*.parquet"))
    lost = spark.read.parquet(files[0]).count()
    size = os.path.getsize(files[0])
    with open(files[0], "r+b") as f:
        f.truncate(size // 2)
    for c in glob.glob(os.path.join(os.path.dirname(files[0]), ".*.crc")):
        os.unlink(c)
    with open(f"{path}/tile_x=1/tile_y=-2/part-junk.parquet", "wb") as f:
        f.write(b"nothing")
    with pytest.raises(Exception):
        pixel_store.read_pixels(spark, path, obs.schema).count()
    left = pixel_store.read_pixels(spark, path, obs.schema, skip_broken=True)
    assert left.count() == obs.count() - lost
    bad = pixel_store.broken_files(spark, path, left).collect()
    assert {os.path.basename(r.path) for r in bad} == {os.path.basename(files[0]), "part-junk.parquet"} and all(r.error for r in bad)
    none = spark.createDataFrame([], "tile_x int, tile_y int")
    assert pixel_store.read_pixels(spark, path, obs.schema, none).count() == 0


def test_orders_of_the_same_scenes_share_a_reduction(spark):
    from tessera.plans.do_work import scene_sets
    rows = [(1, 0, 0, s) for s in (5, 6, 7)] + [(2, 0, 0, s) for s in (7, 5, 6)] + [(3, 0, 0, 5)] + [(1, 1, 0, 9), (3, 1, 0, 9), (2, 1, 0, 8)]
    cells = spark.createDataFrame(rows, "order_id int, tile_x int, tile_y int, id int")
    got = {(r.order_id, r.tile_x): r.rep for r in scene_sets(cells, "order_id").collect()}
    assert got == {(1, 0): 1, (2, 0): 1, (3, 0): 3, (1, 1): 1, (3, 1): 1, (2, 1): 2}
