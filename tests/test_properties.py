"""Property tests (hypothesis): tile keys contain their points; masked
output never carries nodata; batches partition the keys."""

import math

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tessera.functions import geometry as geo
from tessera.functions.pixels import valid_data
from tessera.operators import grid

coords = st.lists(st.tuples(st.floats(-1e6, 1e6, allow_nan=False), st.floats(-1e6, 1e6, allow_nan=False)),
                  min_size=1, max_size=40)


@settings(max_examples=8, deadline=None)
@given(coords, st.sampled_from([1.0, 30.0, 61440.0]))
def test_tile_key_contains_point(spark, pts, size):
    df = spark.createDataFrame(pts, "x double, y double")
    out = df.select("x", "y", geo.tile_index("x", size).alias("tx"), geo.tile_index("y", size).alias("ty"))
    for r in out.collect():
        assert r.tx * size <= r.x < (r.tx + 1) * size or math.isclose(r.x, (r.tx + 1) * size)
        assert r.ty * size <= r.y < (r.ty + 1) * size or math.isclose(r.y, (r.ty + 1) * size)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 60).map(float), st.just(float("nan"))), min_size=1, max_size=50))
def test_valid_data_drops_nodata_and_nan(spark, vals):
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    out = [r[0] for r in df.select(valid_data("v", 50)).collect()]
    assert all(o is None or (o == o and o != 50.0) for o in out)
    assert sum(o is not None for o in out) == sum(v == v and v != 50.0 for v in vals)


@settings(max_examples=5, deadline=None)
@given(st.sets(st.tuples(st.integers(-20, 20), st.integers(-20, 20)), min_size=1, max_size=60),
       st.integers(1, 9))
def test_batches_partition_keys(spark, keys, n):
    df = spark.createDataFrame(sorted(keys), "tile_x int, tile_y int")
    rows = grid.batch_keys(df, n).collect()
    assert {(r.tile_x, r.tile_y) for r in rows} == keys and len(rows) == len(keys)
    counts = {}
    for r in rows:
        counts[r.batch_id] = counts.get(r.batch_id, 0) + 1
    assert all(c <= n for c in counts.values())
    assert sorted(counts) == list(range(len(counts)))
