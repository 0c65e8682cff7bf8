"""Lineage graph operators on the edge list (S3, J10) and row-update stamps.

The graph is an edge-list DataFrame ``(dataset_ref, classifier,
source_dataset_ref)``.  One hop is an equi join; roots are found by path
doubling, a dataset with several sources having several roots; cycles are
reported, not followed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.tables import kept


def one_hop(edges: DataFrame, datasets: DataFrame, classifier: str | None = None,
            key: str = "id") -> DataFrame:
    """Derived dataset → its source dataset's attributes (by classifier)."""
    e = edges if classifier is None else edges.where(F.col("classifier") == classifier)
    src = datasets.select(*[F.col(c).alias(f"source_{c}") for c in datasets.columns])
    return e.join(src, F.col("source_dataset_ref") == F.col(f"source_{key}"))


def roots(edges: DataFrame, nodes: DataFrame, key: str = "id") -> DataFrame:
    """J10 closure: one row per (node, root) pair — every ancestor without a
    source, with the least and the greatest number of hops to it — and, for
    nodes on or derived from a cycle, one row with a NULL root and the error.

    Path doubling: after round k a node knows the roots within 2^k hops and the
    ancestors at exactly 2^k; the next round replaces each of these by what it
    knows itself.  Rounds grow with the logarithm of the longest chain.  A walk
    as long as there are nodes has passed one twice: what is still open then
    lies on or behind a cycle."""
    parent = kept(edges.select(F.col("dataset_ref").alias("node"), F.col("source_dataset_ref").alias("anc")).distinct(), "edges")
    derived = parent.select("node").distinct()
    names = nodes.select(F.col(key).alias("node")).union(parent.select("anc")).union(parent.select("node")).distinct()
    tops = kept(names.join(derived, "node", "left_anti"), "roots")
    n = derived.count()
    known = kept(parent.join(tops.select(F.col("node").alias("anc"), F.lit(True).alias("top")), "anc", "left").select(
        "node", "anc", F.coalesce("top", F.lit(False)).alias("top"), F.lit(1).alias("lo"), F.lit(1).alias("hi")), "lineage")
    reach = 1
    while reach < n and not known.where("NOT top").isEmpty():
        step = known.select(F.col("node").alias("anc"), F.col("anc").alias("far"), F.col("top").alias("_top"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"))
        on = known.where("NOT top").join(step, "anc").select(
            "node", F.col("far").alias("anc"), F.col("_top").alias("top"), (F.col("lo") + F.col("_lo")).alias("lo"), (F.col("hi") + F.col("_hi")).alias("hi"))
        known = kept(known.where("top").unionByName(on).groupBy("node", "anc", "top").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), "lineage")
        reach *= 2
    open_ = known.where("NOT top").select("node").distinct()
    none = F.lit(None)
    found = known.where("top").join(open_, "node", "left_anti").select(
        "node", F.col("anc").alias("root"), F.col("lo").alias("depth"), F.col("hi").alias("max_depth"), none.cast("string").alias("error"))
    own = tops.select("node", F.col("node").alias("root"), F.lit(0).alias("depth"), F.lit(0).alias("max_depth"), none.cast("string").alias("error"))
    cyclic = open_.select("node", none.cast(dict(names.dtypes)["node"]).alias("root"), none.cast("int").alias("depth"),
                          none.cast("int").alias("max_depth"), F.lit("on or derived from a cycle").alias("error"))
    return found.unionByName(own).unionByName(cyclic).join(nodes.select(F.col(key).alias("node")).distinct(), "node", "left_semi")


def stamp_updates(current: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """Upsert ``changes`` into ``current``; changed or new rows get
    ``updated = current_timestamp()``, untouched rows keep their value."""
    cols = [c for c in current.columns if c != "updated"]
    ch = changes.select(*[F.col(c).alias(f"_n_{c}") for c in cols])
    j = current.join(ch, F.col(key) == F.col(f"_n_{key}"), "full_outer")
    changed = F.col(f"_n_{key}").isNotNull()
    prev = F.col("updated") if "updated" in current.columns else F.lit(None).cast("timestamp")
    return j.select(*[F.when(changed, F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) for c in cols],
                    F.when(changed, F.current_timestamp()).otherwise(prev).alias("updated"))
