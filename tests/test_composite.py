import datetime as dt

from pyspark.sql import functions as F

from tessera.functions.names import region_code, tile_product_name
from tessera.functions.pixels import from_reflectance, make_mask, valid_data
from tessera.operators.composite import geomedian_objective, monthly_composite
from tessera.operators.geomedian import geomedian
from tessera.sources.lenses import OBS_FLAGS, observations
from tables import SF_SMALL


def test_product_name_golden(spark):
    r = spark.range(1).select(tile_product_name("landsat8_geomedian_monthly", F.lit(24), F.lit(-65),
                                                F.lit("2022-01-01").cast("date"))).first()[0]
    assert r == "landsat8_geomedian_monthly_S065E024_202201"
    r = spark.range(1).select(tile_product_name("p", F.lit(0), F.lit(0), F.lit("2022-12-01").cast("date"))).first()[0]
    assert r == "p_N000E000_202212"


def test_region_code_golden(spark):
    r = spark.range(1).select(region_code(F.lit("Copernicus_DSM_COG_10_S10_00_E141_00_DEM"))).first()[0]
    assert r == "S10E141"


def test_month_boundary_and_empty_months(spark):
    rows = [(0, 0, 1, 0, dt.datetime(2022, 1, 10), 1.0), (0, 0, 1, 0, dt.datetime(2022, 2, 1), 3.0),
            (0, 0, 1, 0, dt.datetime(2022, 4, 5), 5.0), (0, 0, 2, 0, dt.datetime(2022, 1, 3), float("nan"))]
    df = spark.createDataFrame(rows, "tile_x int, tile_y int, px int, py int, t timestamp_ntz, red double")
    df = df.select("tile_x", "tile_y", "px", "py", "t", valid_data("red").alias("red"))
    out = {(r.px, r.month.month): (r.red, r.n_obs) for r in monthly_composite(df, ["red"]).collect()}
    # Feb 1 00:00 belongs to January and February; March has no data; every
    # pixel gets every month of the tile; NaN counts as missing.
    assert out[(1, 1)] == (2.0, 2)
    assert out[(1, 2)] == (3.0, 1)
    assert out[(1, 3)] == (None, 0)
    assert out[(2, 4)] == (None, 0)
    assert out[(2, 1)] == (None, 1)
    assert len(out) == 8


def test_mask_and_int16(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (4,)], "qa int")
    m = [r[0] for r in df.select(make_mask("qa", OBS_FLAGS, water="land_or_cloud", clear="clear",
                                           nodata=False)).collect()]
    assert m == [True, False, False, False]
    r = spark.range(1).select(from_reflectance(F.lit(None).cast("double")), from_reflectance(F.lit(1.0)),
                              from_reflectance(F.lit(0.1))).first()
    assert r[0] == -999 and r[1] == -999 and r[2] == 3636


def test_geomedian_is_minimal_and_paths_agree(spark):
    obs = observations(spark, SF_SMALL).select("tile_x", "tile_y", "px",
                                               (F.col("red") / 50).alias("a"), (F.col("green") / 1e5).alias("b"),
                                               (F.col("blue") * 10).alias("c"))
    g, bands = ["tile_x", "tile_y", "px"], ["a", "b", "c"]
    gm = geomedian(obs, g, bands).checkpoint()
    dist = geomedian(obs, g, bands, in_task=0)
    mean = obs.groupBy(*g).agg(F.avg("a").alias("a"), F.avg("b").alias("b"), F.avg("c").alias("c"))
    o1 = {tuple(r[:3]): r[3] for r in geomedian_objective(obs, gm, g, bands).collect()}
    o2 = {tuple(r[:3]): r[3] for r in geomedian_objective(obs, mean, g, bands).collect()}
    one = {tuple(r[:3]): r for r in gm.collect()}
    many = {tuple(r[:3]): r for r in dist.collect()}
    assert o1.keys() == o2.keys() == one.keys() == many.keys() and len(o1) > 0
    for k in o1:
        assert o1[k] <= o2[k] + 1e-9
        assert one[k].converged and many[k].converged and one[k].subgradient <= 1e-9
        assert all(abs(one[k][b] - many[k][b]) < 1e-7 for b in bands) and one[k].n_obs == many[k].n_obs


def test_geomedian_of_odd_groups(spark):
    rows = {"one": [(1, 2)], "two": [(0, 0), (2, 4)], "line": [(0, 0), (1, 1), (3, 3), (9, 9)], "same": [(5, 5)] * 4,
            "corner": [(0, 0), (0, 0), (0, 0), (4, 1), (1, 7)], "triangle": [(0, 0), (4, 0), (2, 2 * 3 ** 0.5)],
            "cross": [(-1, 0), (1, 0), (0, 3), (0, -3)], "thin": [(0, 0), (1, 1e-5), (2, -1e-5), (9, 2e-5)]}
    data = [(g, float(x), float(y)) for g, pts in rows.items() for x, y in pts] + [("one", None, 3.0), ("one", float("nan"), 3.0), ("none", None, None)]
    df = spark.createDataFrame(data, "g string, x double, y double")
    want = {"one": (1, 2), "two": (1, 2), "line": (2, 2), "same": (5, 5), "corner": (0, 0), "triangle": (2, 2 / 3 ** 0.5), "cross": (0, 0)}
    for kw in ({}, {"in_task": 0}):
        got = {r.g: r for r in geomedian(df, ["g"], ["x", "y"], **kw).collect()}
        assert set(got) == set(rows) and all(r.converged and r.subgradient < 1e-9 for r in got.values())
        assert got["one"].n_obs == 1
        for g, (x, y) in want.items():
            if kw and g in ("two", "line"):       # any point between the middle two
                assert abs(got[g].x - x) <= 1 and abs(got[g].y - got[g].x * y / x) < 1e-9
            else:
                assert abs(got[g].x - x) < 1e-9 and abs(got[g].y - y) < 1e-9, (g, got[g])


def test_large_groups_are_passed_over_in_blocks(spark):
    # What every search step reads: some hundred numbers a row, none lost.
    import numpy as np

    from tessera.operators.geomedian import BLOCK, packed
    rows = [(k % 3 if k % 50 else None, [float(k), float(k % 7)]) for k in range(9000)]
    df = spark.createDataFrame(rows, "g int, _x array<double>").repartition(3)
    got = packed(df, ["g"], 2, "`g` int").collect()
    assert all(len(r._p) <= 8 * BLOCK for r in got) and len(got) < len(rows) / 50
    seen = sorted((str(r.g), *v) for r in got for v in np.frombuffer(r._p).reshape(-1, 2).tolist())
    assert seen == sorted((str(g), *v) for g, v in rows)


def test_a_search_ends_where_slopes_are_rounding():
    # At rest but for a damped step of rounding size: taken and refused for hundreds of rounds.
    import numpy as np

    from tessera.operators.geomedian import State, advance, moments
    x = np.repeat(np.random.default_rng(3).normal(size=(50, 2)), 100, axis=0)[None]
    mask = np.ones((1, 5000), bool)
    s = State.start(x.mean(1), mask.sum(1))
    while s.done[0] == 0:
        advance(s, moments(x, s.trial, mask), 1e-7, 500)
    best, m = s.y.copy(), moments(x, s.y, mask)
    s = State.start(best, mask.sum(1))
    s.y[:], s.f[:], s.r[:], s.g[:], s.h[:] = best, m[:, 0], 1e-10, [[1e-10, 0]], m[:, 5:9]
    s.near[:], s.near_d[:], s.tested[:], s.mu[:] = m[:, 10:], m[:, 9], m[:, 10:], 1.0
    s.trial[:] = best + 1e-3                      # a step that is refused
    advance(s, moments(x, s.trial, mask), 1e-7, 500)
    assert s.done[0] == 1 and s.ok[0] == 1 and np.abs(s.y - best).max() < 1e-9


def test_vector_aggregate_sees_all_bands(spark):
    # A principal axis per group: a covariance matrix needs every pair of bands.
    import numpy as np

    from tessera.operators.vector_aggregate import vector_aggregate
    rng = np.random.default_rng(1)
    x = {g: rng.normal(size=(500, 3)) @ rng.normal(size=(3, 3)) + g for g in range(3)}
    df = spark.createDataFrame([(g, *map(float, v)) for g, m in x.items() for v in m] + [(0, None, 1.0, 1.0)], "g int, a double, b double, c double").repartition(5)

    def partial(v):
        return np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()])

    def finish(s):
        n, mean = s[0], s[1:4] / s[0]
        w, axes = np.linalg.eigh(s[4:].reshape(3, 3) / n - np.outer(mean, mean))
        return axes[:, -1] * np.sign(axes[0, -1])
    got = {r.g: r.result for r in vector_aggregate(df, ["g"], ["a", "b", "c"], partial, lambda s: s.sum(0), finish).collect()}
    for g, m in x.items():
        w, axes = np.linalg.eigh(np.cov(m.T, bias=True))
        assert np.allclose(got[g], axes[:, -1] * np.sign(axes[0, -1]))


def test_refined_median_of_any_group(spark):
    from tessera.operators.selection import refined_median, value_bin
    obs = observations(spark, SF_SMALL)
    long = obs.select("tile_x", "px", F.col("green").alias("value"))
    a = {tuple(r[:2]): r[2] for r in refined_median(long, ["tile_x", "px"]).collect()}
    b = {tuple(r[:2]): r[2] for r in long.groupBy("tile_x", "px").agg(F.median("value")).collect()}
    assert a == b
    # One group of a million distinct values, most of them in one bin of round one.
    hot = spark.range(1_000_000).select(F.lit(1).alias("g"), (F.lit(1.0) + F.pmod(F.col("id") * 7919, F.lit(1_000_003)) / 1e9).alias("value"))
    assert refined_median(hot, ["g"]).first()[1] == hot.agg(F.median("value")).first()[0]
    odd = [0.0, -0.0, 1e-320, -1e300, 1e300, 5.0, 5.0, 5.000000000000001, float("inf"), -2.5, None, float("nan")]
    rows = [(k, v) for k in range(1, len(odd) + 1) for v in odd[:k]] + [(99, float("nan")), (98, None)]
    df = spark.createDataFrame(rows, "g int, value double")
    got = {r.g: r.median for r in refined_median(df, ["g"]).collect()}
    import statistics
    for k in range(1, len(odd) + 1):
        assert got[k] == statistics.median([v for v in odd[:k] if v is not None and v == v])
    assert 99 not in got and 98 not in got
    order = spark.createDataFrame([(v,) for v in sorted([2.0 ** e * f for e in range(-1074, 1023, 7) for f in (1, 1.001, 1.9999999, -1, -1.5)])], "value double")
    seen = [r[1] for r in order.select("value", value_bin("value")).orderBy("value").collect()]
    assert seen == sorted(seen)


def test_ranked_median_matches_median_including_one_hot_group(spark):
    from tessera.operators.composite import ranked_median
    obs = observations(spark, SF_SMALL)
    long = obs.select("tile_x", "px", F.col("green").alias("value"))
    a = {tuple(r[:2]): r[2] for r in ranked_median(long, ["tile_x", "px"]).collect()}
    b = {tuple(r[:2]): r[2] for r in long.groupBy("tile_x", "px").agg(F.median("value")).collect()}
    assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-9 for k in b)
    hot = long.withColumn("g", F.lit(1)).repartition(6)
    assert abs(ranked_median(hot, ["g"]).first()[1] - long.agg(F.median("value")).first()[0]) < 1e-9
