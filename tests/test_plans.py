"""Plan checks: no nested-loop or cartesian joins where an equi key exists,
filters and column pruning reach the Parquet scan, reductions aggregate
map-side."""

from pyspark.sql import functions as F

from tessera.plans.registry import load_all
from tessera.sources.lenses import observations
from tables import SF_SMALL

REG = load_all()


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_nested_loop_or_cartesian_joins(spark):
    for name in ("j4_tile_cells", "a9_aoi_union_membership", "s11_copy_plan", "j2_space_time_view",
                 "a7_monthly_median", "j10_lineage_roots", "p17_validate_orders"):
        p = _plan(REG[name].fn(spark, SF_SMALL))
        assert "NestedLoopJoin" not in p and "CartesianProduct" not in p, name


def test_time_filter_and_projection_reach_scan(spark):
    df = observations(spark, SF_SMALL).where(F.col("t") >= F.lit("1999-01-01").cast("timestamp_ntz")) \
        .select("tile_x", "red")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate), GreaterThanOrEqual(l_shipdate" in p
    assert "l_extendedprice" not in p.split("ReadSchema:")[1].split("\n")[0]


def test_median_counts_before_the_shuffle(spark):
    from tessera.operators.selection import binned
    obs = observations(spark, SF_SMALL).select("tile_x", "px", F.col("green").alias("value"))
    p = _plan(binned(obs, ["tile_x", "px"]))
    # Counts, least and greatest values are combined on both sides of one exchange.
    assert p.count("HashAggregate") == 2 and p.count("Exchange hashpartitioning") == 1 and "partial_count" in p


def test_composites_gather_and_sort_no_values(spark):
    p = _plan(REG["a7_monthly_median"].fn(spark, SF_SMALL))
    assert not any(x in p for x in ("percentile", "median(", "collect_list", "lineitem.parquet"))
