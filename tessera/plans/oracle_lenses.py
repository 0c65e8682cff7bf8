"""DuckDB formulations of the lenses (FIXTURES.md §7), shared by oracle SQL.

These restate each lens independently in SQL; they are the other side of
the correctness check, not used by the Spark plans.
"""

OBS = """
obs AS (
  SELECT CAST(l_suppkey % 2 AS INTEGER) AS tile_x,
         CAST(-1 - floor((l_suppkey % 4) / 2) AS INTEGER) AS tile_y,
         CAST(l_linenumber AS INTEGER) AS px, 0 AS py, l_shipdate AS t,
         l_quantity AS red, l_extendedprice AS green, l_discount AS blue,
         (CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 1 ELSE 0 END
          + 2 * CASE l_returnflag WHEN 'N' THEN 0 WHEN 'R' THEN 1 WHEN 'A' THEN 2 END) AS qa
  FROM lineitem)"""

# Clear = fill bit 0 is 0, water bit 1 is 0 (land_or_cloud), cloud bit 2 is 0.
CLEAR = "((qa >> 0) & 1 = 0 AND (qa >> 1) & 1 = 0 AND (qa >> 2) & 1 = 0)"
SCALE = "CAST(0.0000275 AS DOUBLE)"
OFFSET = "CAST(-0.2 AS DOUBLE)"

MS = f"""
ms AS (
  SELECT tile_x, tile_y, px, py, t,
         CASE WHEN {CLEAR} AND red <> 50 THEN red * {SCALE} + {OFFSET} END AS red,
         CASE WHEN {CLEAR} THEN green * {SCALE} + {OFFSET} END AS green,
         CASE WHEN {CLEAR} THEN blue * {SCALE} + {OFFSET} END AS blue
  FROM obs)"""

TILE_MONTHS = """
tiles AS (
  SELECT tile_x, tile_y, CAST(min(date_trunc('month', t)) AS DATE) AS m0,
         CAST(max(date_trunc('month', t)) AS DATE) AS m1
  FROM obs GROUP BY tile_x, tile_y),
cal AS (
  SELECT tile_x, tile_y,
         CAST(unnest(generate_series(CAST(m0 AS TIMESTAMP), CAST(m1 AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS month
  FROM tiles),
pix AS (SELECT DISTINCT tile_x, tile_y, px, py FROM obs)"""


def name_sql(product: str, x: str = "tile_x", y: str = "tile_y", m: str = "month") -> str:
    return (f"printf('%s_%s%03d%s%03d_%04d%02d', '{product}', "
            f"CASE WHEN {y} < 0 THEN 'S' ELSE 'N' END, abs({y}), "
            f"CASE WHEN {x} < 0 THEN 'W' ELSE 'E' END, abs({x}), "
            f"year({m}), month({m}))")

SCENE = """
scene AS (
  SELECT o.o_orderkey AS id, CAST(n.n_regionkey AS SMALLINT) AS metadata_type_ref,
         CAST(o.o_custkey % 25 AS SMALLINT) AS dataset_type_ref,
         CASE r.r_regionkey WHEN 0 THEN 'eo' WHEN 1 THEN 'eo3' WHEN 2 THEN 'eo3_landsat_ard'
              WHEN 3 THEN 'telemetry' ELSE lower(r.r_name) END AS mtype,
         CASE WHEN o.o_orderstatus = 'P' THEN o.o_orderdate END AS archived,
         o.o_orderdate AS added,
         o.o_orderdate + to_seconds(o.o_orderkey % 86400) AS t,
         CAST(110 AS DOUBLE) + CAST(o.o_custkey * 37 % 4000 AS DOUBLE) / 100.0 AS lon,
         CAST(-45 AS DOUBLE) + CAST(o.o_custkey * 53 % 3500 AS DOUBLE) / 100.0 AS lat,
         o.o_custkey, o.o_orderkey, lower(n.n_name) AS product
  FROM orders o JOIN nation n ON o.o_custkey % 25 = n.n_nationkey
  JOIN region r ON r.r_regionkey = n.n_regionkey)"""

MTYPE = """
mtype AS (
  SELECT CAST(r_regionkey AS SMALLINT) AS id,
         CASE r_regionkey WHEN 0 THEN 'eo' WHEN 1 THEN 'eo3' WHEN 2 THEN 'eo3_landsat_ard'
              WHEN 3 THEN 'telemetry' ELSE lower(r_name) END AS name
  FROM region)"""
