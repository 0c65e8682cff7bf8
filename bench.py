"""Benchmark: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row is
computed, nothing is collected to the driver).  Prints ONE JSON line:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

BENCH_QUERIES=all runs every registered query; default is the headline set.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "a7_monthly_median",        # do work: mask, scale, month calendar, median
    "f21_int16_composite",      # composite encoded to int16
    "a8_geomedian_monthly",     # geometric median (iterative)
    "j8_month_membership",      # inclusive month slicing
    "p1a_eo_dataset_view",      # typed view from a search-field declaration
    "u1_space_view",            # footprint union view
    "j2_space_time_view",       # space x time join
    "a3_product_ranges",        # product ranges with projections and solar days
    "j4_tile_cells",            # scene x tile gridding
    "x4_get_work_cells",        # get work: one order -> cells -> batches
    "x4_orders_to_composites",  # every stored order: cells -> pixels -> solar days -> medians
    "w2_key_batches",           # batching of tile keys
    "p9_polygon_search",        # exact polygon search
    "p17_validate_orders",      # order validation
    "s11_copy_plan",            # object copy plan
    "f8_document_edit",         # YAML documents parsed and edited
    "j10_lineage_roots",        # lineage closure by pointer jumping
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tessera.session import get_session
    scratch = tempfile.mkdtemp(prefix="bench-", dir="/tmp")
    spark = get_session(f"local[{cpus}]", app="tessera-bench", shuffle_partitions=int(cpus) * 2,
                        extra={"spark.driver.memory": "16g",
                               "spark.local.dir": scratch,
                               "spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    from tessera.plans.registry import load_all
    reg = load_all()
    names = HEADLINE if os.environ.get("BENCH_QUERIES", "") != "all" else sorted(reg)
    if os.environ.get("BENCH_QUERIES", "") not in ("", "all"):
        names = [n for n in sorted(reg) if re.search(os.environ["BENCH_QUERIES"], n)]
    # Warm-up: JVM start, class loading and the first scan/shuffle/codegen
    # are not query time (a long-running cluster has warm executors).
    w = spark.range(200_000).selectExpr("id % 97 AS k", "id * 1.5 AS v", "CAST(id AS STRING) AS s")
    w.groupBy("k").agg({"v": "median", "s": "max"}).join(w.limit(1000), "k").collect()
    # Python workers (reused across tasks) start once, as on a warm cluster.
    w.repartition(int(cpus) * 2).mapInPandas(lambda it: (p.head(1) for p in it), w.schema).collect()
    # Setup, part of the total: render and store the catalogue and order
    # tables that some queries read.
    from tessera.sources.catalogue import dataset
    from tessera.sources.lenses import requests
    t0 = time.perf_counter()
    dataset(spark, sf_dir)
    requests(spark, sf_dir)
    setup = round(time.perf_counter() - t0, 3)
    print(f"# setup (catalogue + order ingest): {setup}s", file=sys.stderr, flush=True)
    times = {"setup_catalogue_and_orders": setup}
    for name in names:
        t0 = time.perf_counter()
        reg[name].fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(sf.group(1)) if sf else None}))
    spark.stop()


if __name__ == "__main__":
    main()
