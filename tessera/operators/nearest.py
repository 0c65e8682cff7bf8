"""L4 for many query points: a nearest-neighbour join by growing grid cells.

Equal points are one location that keeps its k + 1 smallest ids.  A query looks
at the 3 x 3 cells around it, from fine cells to coarse ones (each level four
times the size), first at the level where these cells hold enough points; it is
settled once its k-th distance is smaller than the distance to the border of
the cells looked at, since anything outside is farther.  Only unsettled queries
go on to the next level, so every query meets about as many points as it needs:
no cross join, and a crowded place is looked at in its own small cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.sources.tables import kept

CROWD = 32       # locations a finest cell may hold before cells are made finer still


def _cell(size):
    return F.struct(F.floor((F.col("x") - F.col("_x0")) / size).cast("long").alias("cx"),
                    F.floor((F.col("y") - F.col("_y0")) / size).cast("long").alias("cy"))


def _around(df: DataFrame, size) -> DataFrame:
    """Each row with its own cell and the eight around it."""
    near = [(i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    c = df.withColumn("_c", _cell(size))
    cells = F.array(*[F.struct((F.col("_c.cx") + i).alias("cx"), (F.col("_c.cy") + j).alias("cy")) for i, j in near])
    return c.withColumn("_n", F.explode(cells)).select("*", "_n.*").drop("_n")


def nearest(points: DataFrame, queries: DataFrame, k: int, key: str = "id") -> DataFrame:
    """(key, rank, neighbour, dist): the ``k`` points nearest to each row of
    ``queries`` (both with ``key``, ``x``, ``y``; a query never meets its own
    key), ties to the smaller key.  Rows with a NULL or NaN coordinate take no
    part; fewer points than ``k`` give fewer rows."""
    def clean(df):
        x, y = F.col("x").cast("double"), F.col("y").cast("double")
        return df.select(F.col(key), x.alias("x"), y.alias("y")).where(
            F.col(key).isNotNull() & (F.abs(x) < float("inf")) & (F.abs(y) < float("inf")))
    pts, asked = clean(points), clean(queries)
    # The k + 1 smallest ids of a location: at most one of them is the query's own.
    by = Window.partitionBy("x", "y").orderBy(key)
    locs = kept(pts.distinct().withColumn("_r", F.row_number().over(by)).where(F.col("_r") <= k + 1)
                .groupBy("x", "y").agg(F.array_sort(F.collect_list(key)).alias("ids")), "locations")
    x0, x1, y0, y1, n = locs.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y"), F.count(F.lit(1))).first()
    todo = kept(asked.select("x", "y").distinct(), "queries")
    kind = dict(asked.dtypes)[key]
    if not n:
        return asked.sparkSession.createDataFrame([], f"{key} {kind}, rank int, neighbour {kind}, dist double")
    extent = max(x1 - x0, y1 - y0) or 1.0
    origin = {"_x0": F.lit(x0), "_y0": F.lit(y0)}
    # Finest level: as many halvings of the extent as it takes until no cell is crowded.
    steps = list(range(0, 41, 2))
    seen = locs.withColumns(origin).select(F.explode(F.array(*[F.struct(F.lit(s).alias("s"), _cell(extent / 2.0 ** s).alias("c")) for s in steps])).alias("e"))
    crowd = {r.s: r.most for r in seen.groupBy("e").agg(F.count(F.lit(1)).alias("n")).groupBy("e.s").agg(F.max("n").alias("most")).collect()}
    fine = next((s for s in steps if crowd[s] <= CROWD), steps[-1])
    found = None
    for level in [*range(fine, -1, -2), -1]:
        size = extent / 2.0 ** level
        whole = level < 0                              # fewer points than k + 1, or queries far outside: every point
        cells = locs.withColumns(origin).withColumn("_c", _cell(size)).select("x", "y", "ids", "_c.cx", "_c.cy")
        here = todo.withColumns(origin)
        q = _around(here, size) if not whole else here.withColumn("cx", F.lit(0)).withColumn("cy", F.lit(0)).withColumn("_c", _cell(size))
        if whole:
            cells = cells.withColumn("cx", F.lit(0)).withColumn("cy", F.lit(0))
        counts = cells.groupBy("cx", "cy").agg(F.sum(F.size("ids")).alias("n"))
        full = q.join(counts, ["cx", "cy"]).groupBy("x", "y").agg(F.sum("n").alias("n"))
        if not whole:
            full = full.where(F.col("n") > k)
        near = q.join(full.select("x", "y"), ["x", "y"]).join(cells.withColumnsRenamed({"x": "_px", "y": "_py"}), ["cx", "cy"])
        dx, dy = F.col("x") - F.col("_px"), F.col("y") - F.col("_py")
        edge = F.least(F.col("x") - F.col("_x0") - (F.col("_c.cx") - 1) * size, (F.col("_c.cx") + 2) * size - (F.col("x") - F.col("_x0")),
                       F.col("y") - F.col("_y0") - (F.col("_c.cy") - 1) * size, (F.col("_c.cy") + 2) * size - (F.col("y") - F.col("_y0")))
        cand = near.select("x", "y", edge.alias("edge"), F.sqrt(dx * dx + dy * dy).alias("dist"), F.explode("ids").alias("neighbour"))
        order = Window.partitionBy("x", "y").orderBy("dist", "neighbour")
        top = kept(cand.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1), "nearest")
        reach = top.groupBy("x", "y").agg(F.max("dist").alias("far"), F.count(F.lit(1)).alias("n"), F.first("edge").alias("edge"))
        good = reach if whole else reach.where((F.col("n") > k) & (F.col("far") < F.col("edge") * (1 - 1e-9)))
        one = top.join(good.select("x", "y"), ["x", "y"], "left_semi")
        found = one if found is None else found.unionByName(one)
        todo = kept(todo.join(good.select("x", "y"), ["x", "y"], "left_anti"), "queries")
        if todo.isEmpty():
            break
    mine = asked.distinct().join(found, ["x", "y"]).where(F.col("neighbour") != F.col(key))
    order = Window.partitionBy(key, "x", "y").orderBy("dist", "neighbour")
    return mine.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(key, "rank", "neighbour", "dist")
