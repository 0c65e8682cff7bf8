"""Checked queries: pixel observations and monthly composites (entry point B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.names import COMPOSITE_PRODUCT, tile_product_name
from tessera.functions.pixels import decode_flag, from_reflectance, make_mask
from tessera.operators.composite import month_keys, tile_month_range
from tessera.operators.geomedian import geomedian
from tessera.plans.do_work import CLEAR_MASK, mask_and_scale, monthly_median_products
from tessera.plans.oracle_lenses import MS, OBS, TILE_MONTHS, name_sql
from tessera.plans.registry import query
from tessera.sources.lenses import OBS_FLAGS, observations

_P = COMPOSITE_PRODUCT


REGISTRY_SQL_A7 = f"""
WITH {OBS}, {MS}, {TILE_MONTHS}
SELECT {name_sql(_P, 'p.tile_x', 'p.tile_y', 'c.month')} AS name,
       p.tile_x, p.tile_y, p.px, p.py, c.month,
       round(median(o.red), 10) AS red, round(median(o.green), 10) AS green,
       round(median(o.blue), 10) AS blue, count(o.t) AS n_obs
FROM pix p JOIN cal c ON c.tile_x = p.tile_x AND c.tile_y = p.tile_y
LEFT JOIN ms o ON o.tile_x = p.tile_x AND o.tile_y = p.tile_y AND o.px = p.px AND o.py = p.py
     AND o.t BETWEEN c.month AND c.month + INTERVAL 1 MONTH
GROUP BY ALL"""


@query("a7_monthly_median", covers=("S14", "P5", "P7", "P15", "P16", "F20", "J8", "W1", "A7", "F9", "F15", "X4"), sql=REGISTRY_SQL_A7)
def a7_monthly_median(spark, sf_dir):
    """Flagship: masked, scaled monthly median of every tile, pixel, month."""
    return monthly_median_products(observations(spark, sf_dir))


@query("a7_monthly_median_ranked", covers=("A7", "J8", "W1"), sql=REGISTRY_SQL_A7)
def a7_monthly_median_ranked(spark, sf_dir):
    """The flagship with the rank-based exact median: no group's values are
    gathered in one task or buffer (continuous bands, hot pixel-months)."""
    return monthly_median_products(observations(spark, sf_dir), method="ranked")


# ------------------------------------------------------------------ composite parts


@query("a13_tile_month_range", covers=("A13", "F15"), sql=f"""
WITH {OBS}, {TILE_MONTHS} SELECT tile_x, tile_y, m0 AS first_month, m1 AS last_month FROM tiles""")
def a13_tile_month_range(spark, sf_dir):
    return tile_month_range(observations(spark, sf_dir))


@query("j8_month_membership", covers=("J8", "W1"), sql=f"""
WITH {OBS}, {TILE_MONTHS}
SELECT c.tile_x, c.tile_y, c.month, count(o.t) AS n_obs,
       count(o.t) FILTER (WHERE o.t = CAST(c.month + INTERVAL 1 MONTH AS TIMESTAMP)) AS n_boundary
FROM cal c LEFT JOIN obs o ON o.tile_x = c.tile_x AND o.tile_y = c.tile_y
     AND o.t BETWEEN c.month AND c.month + INTERVAL 1 MONTH
GROUP BY ALL""")
def j8_month_membership(spark, sf_dir):
    """Observations per tile and calendar month under the inclusive slice
    (boundary instants counted in both months; empty months kept)."""
    obs = observations(spark, sf_dir)
    rng = tile_month_range(obs)
    cal = rng.select("tile_x", "tile_y", F.explode(F.sequence(
        "first_month", "last_month", F.expr("INTERVAL 1 MONTH"))).alias("month"), F.lit(1).alias("_cal"))
    m = obs.select("tile_x", "tile_y", "t", F.explode(month_keys("t")).alias("month"))
    data = m.select("tile_x", "tile_y", "month", F.lit(1).alias("_n"),
                    (F.col("t") == F.add_months("month", 1).cast("timestamp_ntz")).cast("int").alias("_b"),
                    F.lit(0).alias("_cal"))
    u = data.unionByName(cal.select("tile_x", "tile_y", "month", F.lit(0).alias("_n"), F.lit(0).alias("_b"),
                                    "_cal"))
    g = u.groupBy("tile_x", "tile_y", "month").agg(F.sum("_n").alias("n_obs"), F.sum("_b").alias("n_boundary"),
                                                   F.max("_cal").alias("_cal"))
    return g.where("_cal = 1").select("tile_x", "tile_y", "month", F.col("n_obs").cast("long"),
                                      F.col("n_boundary").cast("long"))


@query("p16_qa_mask_counts", covers=("P15", "P16", "F22", "P5"), sql=f"""
WITH {OBS}
SELECT tile_x, tile_y, count(*) AS n_obs,
       count(*) FILTER (WHERE qa & 1 = 0 AND (qa >> 1) & 1 = 0 AND (qa >> 2) & 1 = 0) AS n_clear,
       count(*) FILTER (WHERE qa & 1 = 0 AND (qa >> 1) & 1 = 0 AND (qa >> 2) & 1 = 0 AND red <> 50) AS n_red_valid,
       count(*) FILTER (WHERE (qa >> 2) & 1 = 1) AS n_cloud,
       count(*) FILTER (WHERE (qa >> 1) & 1 = 1) AS n_water,
       count(*) FILTER (WHERE qa & 1 = 1) AS n_fill
FROM obs GROUP BY tile_x, tile_y""")
def p16_qa_mask_counts(spark, sf_dir):
    obs = observations(spark, sf_dir)
    ms = mask_and_scale(obs, bands=("red",), keep=("tile_x", "tile_y", "qa"), scale=False)
    clear = make_mask("qa", OBS_FLAGS, **CLEAR_MASK)
    return ms.groupBy("tile_x", "tile_y").agg(
        F.count(F.lit(1)).alias("n_obs"), F.count(F.when(clear, 1)).alias("n_clear"),
        F.count("red").alias("n_red_valid"),
        F.count(F.when(decode_flag("qa", OBS_FLAGS, "clear") == "cloud", 1)).alias("n_cloud"),
        F.count(F.when(decode_flag("qa", OBS_FLAGS, "water") == "water", 1)).alias("n_water"),
        F.count(F.when(decode_flag("qa", OBS_FLAGS, "nodata") == "true", 1)).alias("n_fill"))


@query("f21_int16_composite", covers=("F21", "F20"), sql=f"""
WITH {OBS}, {MS}, {TILE_MONTHS},
med AS (
  SELECT p.tile_x, p.tile_y, p.px, p.py, c.month, median(o.red) AS red, median(o.green) AS green,
         median(o.blue) AS blue
  FROM pix p JOIN cal c ON c.tile_x = p.tile_x AND c.tile_y = p.tile_y
  LEFT JOIN ms o ON o.tile_x = p.tile_x AND o.tile_y = p.tile_y AND o.px = p.px AND o.py = p.py
       AND o.t BETWEEN c.month AND c.month + INTERVAL 1 MONTH
  GROUP BY ALL)
SELECT tile_x, tile_y, px, py, month,
       CAST(CASE WHEN red IS NULL OR NOT (red * (1 / 0.0000275) > -32769 AND red * (1 / 0.0000275) < 32768)
                 THEN -999 ELSE trunc(red * (1 / 0.0000275)) END AS SMALLINT) AS red,
       CAST(CASE WHEN green IS NULL OR NOT (green * (1 / 0.0000275) > -32769 AND green * (1 / 0.0000275) < 32768)
                 THEN -999 ELSE trunc(green * (1 / 0.0000275)) END AS SMALLINT) AS green,
       CAST(CASE WHEN blue IS NULL OR NOT (blue * (1 / 0.0000275) > -32769 AND blue * (1 / 0.0000275) < 32768)
                 THEN -999 ELSE trunc(blue * (1 / 0.0000275)) END AS SMALLINT) AS blue
FROM med""")
def f21_int16_composite(spark, sf_dir):
    """Monthly composite encoded back to int16 (nodata −999; overflow → nodata)."""
    m = monthly_median_products(observations(spark, sf_dir), digits=None)
    return m.select("tile_x", "tile_y", "px", "py", "month",
                    *[from_reflectance(b).alias(b) for b in ("red", "green", "blue")])


@query("s21_product_documents", covers=("S21", "F16", "F9", "S20"), sql=f"""
WITH {OBS}, {TILE_MONTHS}
SELECT {name_sql(_P, 'tile_x', 'tile_y', 'month')} AS label, '{_P}' AS product_family,
       strftime(CAST(month + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE), '%Y-%m-%d') AS datetime,
       'GeoTIFF' AS file_format, 3 AS n_measurements,
       'out-prefix/' || {name_sql(_P, 'tile_x', 'tile_y', 'month')} || '/' ||
         {name_sql(_P, 'tile_x', 'tile_y', 'month')} || '_red.tif' AS red_key
FROM (SELECT DISTINCT tile_x, tile_y, month FROM cal)""")
def s21_product_documents(spark, sf_dir):
    """One metadata document per output product (tile × month) and the
    object key of its red band under the output prefix."""
    from tessera.sources.sinks import product_documents
    # The products are the tiles' months: no pixel is reduced to list them.
    rng = tile_month_range(observations(spark, sf_dir))
    months = rng.select("tile_x", "tile_y", F.explode(F.sequence("first_month", "last_month", F.expr("INTERVAL 1 MONTH"))).alias("month")) \
        .withColumn("name", tile_product_name(_P, "tile_x", "tile_y", "month"))
    docs = product_documents(months, bands=("red", "green", "blue"), prefix="out-prefix")
    return docs.select("label", "product_family", "datetime", "file_format",
                       F.size("measurements").alias("n_measurements"),
                       F.col("measurements")[F.lit("red")]["key"].alias("red_key"))


# The SQL finds the minimum its own way: observations whose pull by the others
# is not above their weight are minima (two of them bound a segment of minima);
# elsewhere Levenberg's damped Newton steps, with the 3 x 3 system solved by
# cofactors, from the mean to rest.
_K = "tile_x, tile_y, px, py, month"
_A8_STEPS = 150


@query("a8_geomedian_monthly", covers=("A8",), sql=f"""
WITH RECURSIVE {OBS}, {MS},
mk AS (SELECT tile_x, tile_y, px, py, CAST(date_trunc('month', t) AS DATE) AS month, red, green, blue FROM ms
       UNION ALL SELECT tile_x, tile_y, px, py, CAST(t - INTERVAL 1 MONTH AS DATE), red, green, blue FROM ms WHERE t = date_trunc('month', t)),
p AS (SELECT {_K}, red AS a, green AS b, blue AS c, count(*) AS m FROM mk WHERE red IS NOT NULL AND green IS NOT NULL AND blue IS NOT NULL GROUP BY ALL),
n AS (SELECT {_K}, sum(m) AS n, sum(m * a) / sum(m) AS a, sum(m * b) / sum(m) AS b, sum(m * c) / sum(m) AS c FROM p GROUP BY ALL),
pr AS (SELECT {_K}, p.a, p.b, p.c, p.m, o.m * (p.a - o.a) AS x, o.m * (p.b - o.b) AS y, o.m * (p.c - o.c) AS z,
         sqrt((p.a - o.a) ** 2 + (p.b - o.b) ** 2 + (p.c - o.c) ** 2) AS d
       FROM p LEFT JOIN p o USING ({_K})),
pull AS (SELECT {_K}, a, b, c, m, sqrt(coalesce(sum(x / d) FILTER (d > 0), 0) ** 2 + coalesce(sum(y / d) FILTER (d > 0), 0) ** 2
           + coalesce(sum(z / d) FILTER (d > 0), 0) ** 2) AS r FROM pr GROUP BY ALL),
corner AS (SELECT {_K}, avg(pull.a) AS a, avg(pull.b) AS b, avg(pull.c) AS c FROM pull JOIN n USING ({_K}) WHERE r <= m + 1e-12 * n GROUP BY ALL),
open AS (SELECT n.* FROM n ANTI JOIN corner USING ({_K})),
it(k, tile_x, tile_y, px, py, month, a, b, c, f, ga, gb, gc, haa, hab, hac, hbb, hbc, hcc, mu, ta, tb, tc) AS (
  SELECT 0, {_K}, a, b, c, CAST('inf' AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 1.0::DOUBLE,
    0.0::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE, a, b, c FROM open
  UNION ALL
  SELECT * FROM (
    WITH cur AS (SELECT * FROM it WHERE k < {_A8_STEPS}),
    e AS (SELECT cur.{_K.replace(', ', ', cur.')}, p.m, cur.ta - p.a AS x, cur.tb - p.b AS y, cur.tc - p.c AS z,
            greatest(sqrt((cur.ta - p.a) ** 2 + (cur.tb - p.b) ** 2 + (cur.tc - p.c) ** 2), 1e-14) AS d FROM cur JOIN p USING ({_K})),
    s AS (SELECT {_K}, sum(m * d) AS f, sum(m * x / d) AS ga, sum(m * y / d) AS gb, sum(m * z / d) AS gc,
            sum(m * (y * y + z * z) / d ** 3) AS haa, -sum(m * x * y / d ** 3) AS hab, -sum(m * x * z / d ** 3) AS hac,
            sum(m * (x * x + z * z) / d ** 3) AS hbb, -sum(m * y * z / d ** 3) AS hbc, sum(m * (x * x + y * y) / d ** 3) AS hcc FROM e GROUP BY ALL),
    j AS (SELECT cur.*, s.f AS nf, s.ga AS nga, s.gb AS ngb, s.gc AS ngc, s.haa AS nhaa, s.hab AS nhab, s.hac AS nhac, s.hbb AS nhbb, s.hbc AS nhbc,
            s.hcc AS nhcc, cur.ga * (ta - a) + cur.gb * (tb - b) + cur.gc * (tc - c) AS s0, s.ga * (ta - a) + s.gb * (tb - b) + s.gc * (tc - c) AS s1
          FROM cur JOIN s USING ({_K})),
    t AS (SELECT *, nf < f * (1 - 1e-13) OR (nf <= f * (1 + 1e-12) AND s0 < 0 AND s1 <= -0.5 * s0) AS take FROM j),
    u AS (SELECT k + 1 AS k, {_K}, CASE WHEN take THEN ta ELSE a END AS a, CASE WHEN take THEN tb ELSE b END AS b, CASE WHEN take THEN tc ELSE c END AS c,
            CASE WHEN take THEN nf ELSE f END AS f, CASE WHEN take THEN nga ELSE ga END AS ga, CASE WHEN take THEN ngb ELSE gb END AS gb,
            CASE WHEN take THEN ngc ELSE gc END AS gc, CASE WHEN take THEN nhaa ELSE haa END AS haa, CASE WHEN take THEN nhab ELSE hab END AS hab,
            CASE WHEN take THEN nhac ELSE hac END AS hac, CASE WHEN take THEN nhbb ELSE hbb END AS hbb, CASE WHEN take THEN nhbc ELSE hbc END AS hbc,
            CASE WHEN take THEN nhcc ELSE hcc END AS hcc, CASE WHEN NOT take THEN greatest(mu * 6, 1e-7 * (haa + hbb + hcc))
              WHEN mu < 1e-9 * (haa + hbb + hcc) THEN 0 ELSE mu / 12 END AS mu FROM t),
    q AS (SELECT *, haa + mu AS i, hbb + mu AS o, hcc + mu AS v FROM u),
    w AS (SELECT *, o * v - hbc * hbc AS c11, hac * hbc - hab * v AS c12, hab * hbc - hac * o AS c13, i * v - hac * hac AS c22,
            hab * hac - i * hbc AS c23, i * o - hab * hab AS c33 FROM q),
    x AS (SELECT *, i * c11 + hab * c12 + hac * c13 AS det FROM w)
    SELECT k, {_K}, a, b, c, f, ga, gb, gc, haa, hab, hac, hbb, hbc, hcc, mu,
      CASE WHEN det > 0 THEN a - (c11 * ga + c12 * gb + c13 * gc) / det ELSE a END,
      CASE WHEN det > 0 THEN b - (c12 * ga + c22 * gb + c23 * gc) / det ELSE b END,
      CASE WHEN det > 0 THEN c - (c13 * ga + c23 * gb + c33 * gc) / det ELSE c END FROM x)),
solved AS (SELECT {_K}, a, b, c FROM corner UNION ALL SELECT {_K}, a, b, c FROM it WHERE k = {_A8_STEPS})
SELECT {_K}, round(s.a, 6) AS red, round(s.b, 6) AS green, round(s.c, 6) AS blue, CAST(n.n AS BIGINT) AS n_obs,
  true AS converged, 0.0::DOUBLE AS subgradient
FROM solved s JOIN n USING ({_K})""")
def a8_geomedian_monthly(spark, sf_dir):
    """Geometric median of (red, green, blue) reflectance per tile, pixel and
    month; ``subgradient`` is the certificate, to six digits."""
    ms = mask_and_scale(observations(spark, sf_dir))
    mk = ms.select("tile_x", "tile_y", "px", "py", F.explode(month_keys("t")).alias("month"), "red", "green", "blue")
    gm = geomedian(mk, ["tile_x", "tile_y", "px", "py", "month"], ["red", "green", "blue"])
    return gm.select("tile_x", "tile_y", "px", "py", "month", *[F.round(b, 6).alias(b) for b in ("red", "green", "blue")], "n_obs",
                     "converged", F.round("subgradient", 6).alias("subgradient"))
