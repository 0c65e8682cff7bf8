"""Checked queries: events and vectors lenses (solar day, bit flags, JSON
numbers, durations, band maps, aliases, block layout)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.names import elapsed_text
from tessera.functions.pixels import decode_flag
from tessera.operators.ranges import solar_day
from tessera.plans.registry import query
from tessera.sources.tables import read_table

# The bit-field table of the events lens (props.k, 7 bits).
EVENT_FLAGS = {
    "confidence": {"bits": [0, 1], "values": {"0": "none", "1": "low", "2": "medium", "3": "high"}},
    "cloud": {"bits": [2], "values": {"0": "clear", "1": "cloud"}},
    "class": {"bits": [3, 4, 5, 6], "values": {str(i): f"class_{i}" for i in range(16)}},
}

EV = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         CAST(user_id % 360 - 180 AS DOUBLE) AS lon
  FROM events)"""


def _events(spark, sf_dir):
    e = read_table(spark, sf_dir, "events")
    return e.select("event_id", "ts", "user_id", "event_type", "value",
                    F.get_json_object("props", "$.k").cast("decimal(10,0)").cast("double").alias("k_num"),
                    F.get_json_object("props", "$.k").cast("int").alias("k"),
                    (F.col("user_id") % 360 - 180).cast("double").alias("lon"))


@query("a6_solar_day_groups", covers=("A6",), sql=f"""
WITH {EV}, s AS (
  SELECT *, user_id % 10 AS tile,
         CAST(ts + to_microseconds(CAST(round(lon * 240 * 1000000) AS BIGINT)) AS DATE) AS solar_day
  FROM ev),
r AS (SELECT *, row_number() OVER (PARTITION BY tile, solar_day ORDER BY value IS NULL, ts, event_id) AS rn FROM s)
SELECT tile, solar_day, count(*) AS n_events, max(CASE WHEN rn = 1 THEN round(value, 6) END) AS first_value
FROM r GROUP BY tile, solar_day""")
def a6_solar_day_groups(spark, sf_dir):
    """Observations of one tile on the same local solar day form one time
    slice; the slice value is the first valid one in acquisition order
    (``min_by`` with NULL order keys for invalid values: a partial
    aggregate, no per-group row collection)."""
    e = _events(spark, sf_dir)
    s = e.select((F.col("user_id") % 10).alias("tile"), solar_day("ts", "lon").alias("solar_day"),
                 "value", "ts", "event_id")
    return s.groupBy("tile", "solar_day").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.round(F.min_by("value", F.when(F.col("value").isNotNull(), F.struct("ts", "event_id"))), 6)
        .alias("first_value"))


@query("f22_bit_flags", covers=("F22", "F24"), sql=f"""
WITH {EV}
SELECT CASE k & 3 WHEN 0 THEN 'none' WHEN 1 THEN 'low' WHEN 2 THEN 'medium' ELSE 'high' END AS confidence,
       CASE (k >> 2) & 1 WHEN 0 THEN 'clear' ELSE 'cloud' END AS cloud,
       count(*) AS n_events, round(sum(CAST(k AS DOUBLE)), 6) AS sum_k,
       count(DISTINCT (k >> 3) & 15) AS n_classes
FROM ev GROUP BY 1, 2""")
def f22_bit_flags(spark, sf_dir):
    """Bit fields of ``props.k`` decoded through a value table; ``k`` read
    as a JSON decimal and converted to double."""
    e = _events(spark, sf_dir)
    return (e.select(decode_flag("k", EVENT_FLAGS, "confidence").alias("confidence"),
                     decode_flag("k", EVENT_FLAGS, "cloud").alias("cloud"),
                     decode_flag("k", EVENT_FLAGS, "class").alias("cls"), "k_num")
            .groupBy("confidence", "cloud")
            .agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum("k_num"), 6).alias("sum_k"),
                 F.countDistinct("cls").alias("n_classes")))


def _fmt_sql(expr: str, unit: str) -> str:
    # Formatting rounds half up on the shortest decimal form of the value.
    return f"printf('%.2f {unit}', round(CAST({expr} AS DECIMAL(18, 6)), 2))"


@query("f23_elapsed_text", covers=("F23", "A11"), sql=f"""
WITH {EV}, g AS (
  SELECT user_id, CAST(ts AS DATE) AS day,
         CAST(epoch_us(max(ts)) - epoch_us(min(ts)) AS DOUBLE) / 1000000.0 AS secs
  FROM ev GROUP BY user_id, CAST(ts AS DATE))
SELECT user_id, day, CASE WHEN secs < 120 THEN {_fmt_sql('secs', 'seconds')}
                         WHEN secs < 3600 THEN {_fmt_sql('secs / 60.0', 'minutes')}
                         ELSE {_fmt_sql('secs / 3600.0', 'hours')} END AS elapsed
FROM g""")
def f23_elapsed_text(spark, sf_dir):
    """Activity span per user and day as human-readable text."""
    e = _events(spark, sf_dir)
    g = e.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        ((F.unix_micros(F.max("ts").cast("timestamp")) - F.unix_micros(F.min("ts").cast("timestamp")))
         / 1e6).alias("secs"))
    return g.select("user_id", "day", elapsed_text("secs").alias("elapsed"))


# ------------------------------------------------------------------ vectors lens

VEC = """
vec AS (SELECT vec_id, label, embedding FROM embeddings)"""


@query("f25_band_map_explode", covers=("F25", "P6"), sql=f"""
WITH {VEC}
SELECT label AS tile, vec_id AS px, b.name AS band,
       round(CAST(embedding[b.i + 1] AS DOUBLE), 6) AS value
FROM vec, (VALUES (0, 'blue'), (1, 'green'), (2, 'red')) b(i, name)""")
def f25_band_map_explode(spark, sf_dir):
    """Band values as a map (band → value) exploded to rows; bands are
    asked for by alias (band_2/3/4 → blue/green/red)."""
    from tessera.sources.catalogue import LENS_MEASUREMENTS
    alias = {a: m["name"] for m in LENS_MEASUREMENTS for a in m["aliases"]}
    e = read_table(spark, sf_dir, "embeddings")
    asked = ["band_2", "band_3", "band_4"]
    cols = {alias[a]: F.col("embedding")[i].cast("double") for i, a in enumerate(asked)}
    m = F.create_map(*[x for k, v in cols.items() for x in (F.lit(k), v)])
    return e.select(F.col("label").alias("tile"), F.col("vec_id").alias("px"),
                    F.explode(m).alias("band", "value")).withColumn("value", F.round("value", 6))


@query("s18_block_layout", covers=("S18",), sql=f"""
WITH {VEC}, l AS (
  SELECT label AS tile, vec_id AS px, CAST(vec_id // 64 AS INTEGER) AS chunk, b.name AS band,
         CAST(embedding[b.i + 1] AS DOUBLE) AS value
  FROM vec, (VALUES (0, 'blue'), (1, 'green'), (2, 'red')) b(i, name))
SELECT tile, band, chunk, count(*) AS n_values, min(px) AS first_px,
       round(list(value ORDER BY px)[1], 6) AS first_value
FROM l GROUP BY tile, band, chunk""")
def s18_block_layout(spark, sf_dir):
    """Chunked array layout: per (tile, band, chunk of 64 pixels) the values
    in pixel order."""
    from tessera.sources.sinks import block_layout
    e = read_table(spark, sf_dir, "embeddings")
    comp = e.select(F.col("label").alias("tile_x"), F.lit(0).alias("tile_y"),
                    F.lit("2024-01-01").cast("date").alias("month"), F.lit(0).alias("px"),
                    F.col("vec_id").alias("py"),
                    *[F.col("embedding")[i].cast("double").alias(b)
                      for i, b in enumerate(("blue", "green", "red"))])
    blk = block_layout(comp, ("blue", "green", "red"), chunk_rows=64)
    return blk.select(F.col("tile_x").alias("tile"), "band", "chunk",
                      F.size("values").cast("long").alias("n_values"),
                      F.col("py")[0].alias("first_px"), F.round(F.col("values")[0], 6).alias("first_value"))


_A8_ROUNDS = 400      # rounds of the plain iteration: in 64 bands it settles well before


@query("a8_geomedian_vectors", covers=("A8", "X3"), sql=f"""
WITH RECURSIVE x AS (SELECT label AS tile, vec_id AS px, CAST(embedding AS DOUBLE[64]) AS v FROM embeddings),
n AS (SELECT label AS tile, count(*) AS n_obs FROM embeddings GROUP BY label),
b AS (SELECT unnest(range(1, 65)) AS i),
it(k, tile, m) AS (
  SELECT 0, tile, CAST(list(a ORDER BY i) AS DOUBLE[64]) FROM (SELECT tile, i, avg(v[i]) AS a FROM x, b GROUP BY tile, i) GROUP BY tile
  UNION ALL
  SELECT k + 1, tile, CAST(list(a ORDER BY i) AS DOUBLE[64]) FROM (
    SELECT k, tile, i, sum(v[i] / d) / sum(1 / d) AS a FROM (
      SELECT it.k, it.tile, x.v, greatest(array_distance(x.v, it.m), 1e-12) AS d FROM it JOIN x ON x.tile = it.tile WHERE it.k < {_A8_ROUNDS}), b
    GROUP BY k, tile, i) GROUP BY k, tile)
SELECT it.tile, CAST(i - 1 AS INTEGER) AS band, round(m[i], 6) AS value, n_obs, true AS converged, 0.0::DOUBLE AS subgradient
FROM it JOIN n ON it.tile = n.tile, b WHERE k = {_A8_ROUNDS}""")
def a8_geomedian_vectors(spark, sf_dir):
    """Geometric median of all 64 embedding bands per label, by distributed
    rounds: no label's vectors are gathered."""
    from tessera.operators.geomedian import geomedian
    from tessera.session import ensure_checkpoint_dir
    from tessera.sources.lenses import vectors
    ensure_checkpoint_dir(spark)
    bands = [f"band_{i}" for i in range(64)]
    # As stored columns: filters on 64 aliased array items take the optimizer
    # exponentially long to relate.
    v = vectors(spark, sf_dir).checkpoint(eager=True)
    gm = geomedian(v, ["tile"], bands, in_task=16)
    return gm.select("tile", "n_obs", "converged", F.round("subgradient", 6).alias("subgradient"), F.posexplode(F.array(*bands)).alias("band", "value")) \
        .select("tile", "band", F.round("value", 6).alias("value"), "n_obs", "converged", "subgradient")


@query("x3_band_covariances", covers=("X3",), sql="""
WITH o AS (SELECT CAST(l_suppkey % 2 AS INTEGER) AS tile_x, CAST(-1 - floor((l_suppkey % 4) / 2) AS INTEGER) AS tile_y,
  CAST(l_quantity AS DOUBLE) AS red, CAST(l_extendedprice AS DOUBLE) / 1000 AS green, CAST(l_discount AS DOUBLE) * 100 AS blue FROM lineitem)
SELECT tile_x, tile_y, count(*) AS n_obs, round(covar_pop(red, green), 4) AS red_green, round(covar_pop(red, blue), 4) AS red_blue,
  round(covar_pop(green, blue), 4) AS green_blue, round(var_pop(red) + var_pop(green) + var_pop(blue), 4) AS total_variance
FROM o GROUP BY tile_x, tile_y""")
def x3_band_covariances(spark, sf_dir):
    """A user aggregate of the whole band vector: covariances of every pair of
    bands per tile, merged from shifted partial sums."""
    import numpy as np

    from tessera.operators.vector_aggregate import vector_aggregate
    from tessera.sources.lenses import observations
    bands = ["red", "green", "blue"]
    obs = observations(spark, sf_dir).select("tile_x", "tile_y", F.col("red").cast("double").alias("red"),
                                             (F.col("green").cast("double") / 1000).alias("green"), (F.col("blue").cast("double") * 100).alias("blue"))

    def partial(v):
        mean = v.mean(0)
        return np.concatenate([[len(v)], mean, ((v - mean).T @ (v - mean)).ravel()])

    def merge(s):
        # Pairwise update of means and scatter matrices.
        n = s[:, 0]
        mean = (n[:, None] * s[:, 1:4]).sum(0) / n.sum()
        off = s[:, 1:4] - mean
        return np.concatenate([[n.sum()], mean, s[:, 4:].sum(0) + np.einsum("k,ka,kb->ab", n, off, off).ravel()])

    def finish(s):
        c = s[4:].reshape(3, 3) / s[0]
        return np.array([s[0], c[0, 1], c[0, 2], c[1, 2], np.trace(c)])
    r = F.col("r")
    return vector_aggregate(obs, ["tile_x", "tile_y"], bands, partial, merge, finish, "r").select(
        "tile_x", "tile_y", r[0].cast("long").alias("n_obs"),
        *[F.round(r[i + 1], 4).alias(c) for i, c in enumerate(("red_green", "red_blue", "green_blue", "total_variance"))])
