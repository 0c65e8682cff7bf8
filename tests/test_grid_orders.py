from pyspark.sql import functions as F

from tessera.operators import grid
from tessera.operators.orders import normalise_period, split_names, to_utc_iso, validate_orders
from tessera.sources.lenses import aoi_table
from tables import SF_SMALL


def test_batches_partition_keys(spark):
    keys = spark.createDataFrame([(x, y) for x in range(7) for y in range(5)], "tile_x int, tile_y int")
    b = grid.batch_keys(keys, 8).collect()
    assert len(b) == 35 and len({(r.tile_x, r.tile_y) for r in b}) == 35
    sizes = {}
    for r in b:
        sizes[r.batch_id] = sizes.get(r.batch_id, 0) + 1
    assert sorted(sizes) == list(range(5)) and all(v == 8 for k, v in sizes.items() if k < 4) and sizes[4] == 3
    order = [(r.tile_y, r.tile_x) for r in sorted(b, key=lambda r: (r.batch_id, r.tile_y, r.tile_x))]
    assert order == sorted(order)


def test_dense_index_is_consecutive(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("k"))
    idx = grid.dense_index(df, ["k"], "i").collect()
    assert sorted(r.i for r in idx) == list(range(5000))
    assert all(r.i == r.k for r in idx)


def test_utc_iso_and_period(spark):
    df = spark.createDataFrame([("2020-01-01", "2020-03-01T05:00:00+10:00")], "a string, b string")
    r = df.select(to_utc_iso("a"), to_utc_iso("b"), *normalise_period("b", "a"), split_names(F.lit(" a | b|c "))).first()
    assert r[0] == "2020-01-01T00:00:00Z" and r[1] == "2020-02-29T19:00:00Z"
    assert str(r[2]).startswith("2020-01-01") and str(r[3]).startswith("2020-02-29 19:00")
    assert r[4] == ["a", "b", "c"]


def test_order_messages(spark):
    docs = [
        (1, '{"time_start":"2020-01-01","bounding_box":"1,2,3,4"}'),
        (2, '{"time_start":"2020-01-01","time_end":"2020-02-01","bounding_box":"1,2,3,4","aoi_name":"asia"}'),
        (3, '{"time_start":"2020-01-01","time_end":"2020-02-01","aoi_name":"asia | mars"}'),
        (4, '{"time_start":"2020-03-01","time_end":"2020-02-01","bounding_box":[1,2,3,4]}'),
        (5, '{"time_start":"2020-01-01","time_end":"2020-02-01","aoi_name":["asia","europe"]}'),
    ]
    df = spark.createDataFrame(docs, "id long, doc string")
    v = {r.id: r for r in validate_orders(df, "id", "doc", aoi_table(spark, SF_SMALL)).collect()}
    assert v[1].error == "This key must be given: time_end"
    assert v[2].error.startswith("Only one of these keys")
    assert v[3].error == "AOI name not found in database: mars"
    assert v[4].is_valid and v[4].time_start == "2020-02-01T00:00:00Z" and v[4].bounding_box == [1.0, 2.0, 3.0, 4.0]
    assert v[5].is_valid and v[5].n_aoi == 2 and len(v[5].boundary) == 2
