"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target in words: the total times its share of the weights,
but no more than ``cap`` times its size; what a capped source leaves is shared
again among the others by weight, until none is above its cap.  A target of r
times a source's size takes floor(r) whole copies of every document for
certain.  The rest is realised by a Pareto order sample: document i is due
with inclusion probability p_i (the remaining share of the source, times the
document's preference if a preference column is given), draws u_i uniform by
hash, and ranks by (u_i / (1 - u_i)) / (p_i / (1 - p_i)).  Documents are taken
in rank order until their words come nearest to the words still due, so the
sample has a fixed size in words whatever the probabilities.

Where the cut lies is found without sorting a source in one task: ranks,
mapped to (0, 1), fall into bins per source, words are summed per bin, and the
bin that holds the cut is divided again until it has few enough documents to
order one by one.  Of the documents after the cut, the one whose size fits
best what is then left completes the sample (the first in rank order if
several fit alike), unless none brings the words nearer.

DataFrame operations only.  Defined cases: a null or empty text has size 0 and
takes 0; a null source is a source of its own, after all others; rows that
share a doc_id draw by their text as well, wholly equal rows draw alike and
are interchangeable; a null doc_id hashes as an empty one; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut
from tessera.operators.grid import dense_index

BINS = 256             # bins of a source's ranks at each division
IN_ORDER = 10_000      # documents that are ordered in one task
SEED = "1729"


def n_words(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space."""
    one_each = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "w")
    return F.coalesce(F.length(F.regexp_replace(one_each, r"[\x20\x09-\x0D]+", "")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size) -> with target.  Sources are numbered in code
    point order (null last) and take the weights in turn."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.pmod("idx", F.lit(len(weights))) + 1).cast("int"))
    numbered = dense_index(sizes.withColumn("none", F.col("source").isNull()), ["none", "source"]).drop("none")
    s = cut(numbered.select("source", "source_size", weight.alias("weight"),
                            (F.lit(cap) * F.col("source_size")).alias("most")), "sources")
    total = share * float(s.agg(F.sum("source_size")).first()[0] or 0)
    # Capping a source only raises the others, so a source above its cap stays
    # capped; each round caps at least one more source or ends.
    per_weight, capped = None, 0
    while True:
        full = F.lit(False) if per_weight is None else F.col("weight") * F.lit(per_weight) > F.col("most")
        n, due, weight_sum = s.agg(
            F.sum(full.cast("int")), F.sum(F.when(full, F.col("most")).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight")))).first()
        if per_weight is not None and n == capped or not weight_sum:
            break
        capped, per_weight = n, (total - due) / weight_sum
    value = F.lit(0.0) if per_weight is None else F.least(F.col("weight") * F.lit(per_weight), F.col("most"))
    return s.select("source", "source_size", value.alias("target"))


def mix(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, cap: float = 2.0,
        prefer: str | None = None) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of ``docs``.

    ``prefer`` names a column of positive preferences (null: 1): documents of
    a source are sampled with probabilities in that proportion, below 1."""
    text = F.col("text").cast("string")
    digest = F.md5(F.concat_ws("|", F.lit(SEED), F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")),
                               F.coalesce(text, F.lit(""))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))
    liking = F.lit(1.0) if prefer is None else F.coalesce(F.col(prefer).cast("double"), F.lit(1.0))
    rows = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                           n_words(text).alias("size"), u.alias("u"), liking.alias("liking"),
                           F.monotonically_increasing_id().alias("row")), "sizes")
    per_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"),
                                            F.sum(F.col("liking") * F.col("size")).alias("liked"))
    goal = targets(per_source.select("source", "source_size"), weights, share, cap)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    goal = goal.join(per_source.select(F.col("source").alias("name"), "liked", "n"), F.col("source").eqNullSafe(F.col("name"))) \
        .select("source", "source_size", "target", "liked", "n", F.floor(ratio).alias("copies"), ratio.alias("ratio"))
    goal = cut(goal.select(
        F.col("source").alias("name"), "source_size", "target", "copies", "n",
        F.when(F.col("liked") > 0, (F.col("ratio") - F.col("copies")) * F.col("source_size") / F.col("liked"))
        .otherwise(F.lit(0.0)).alias("unit"),
        (F.col("target") - F.col("copies") * F.col("source_size")).alias("due")), "targets")
    p = F.least(F.col("unit") * F.col("liking"), F.lit(1 - 1e-9))
    rank = (F.col("u") / (1 - F.col("u"))) / (p / (1 - p))
    # v grows with the rank and lies in (0, 1); null: nothing is due.
    v = F.when((F.col("due") > 0) & (p > 0), rank / (1 + rank))
    same = F.col("source").eqNullSafe(F.col("name"))
    ranked = cut(rows.join(goal.drop("n"), same).select(
        "doc_id", "row", "source", "size", "source_size", "target", "copies", v.alias("v")), "ranked")
    drawn = ranked.where("v IS NOT NULL").select("source", "size", "v", "doc_id", "row")
    state = goal.where("due > 0 AND unit > 0").select("name", "due", F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"), "n")
    while True:
        most, span = state.agg(F.max("n"), F.max(F.when(F.col("n") > IN_ORDER, F.col("hi") - F.col("lo")))).first()
        if most is None or most <= IN_ORDER or span < 1e-12:
            break
        wide = state.where(F.col("n") > IN_ORDER).drop("n")
        width = (F.col("hi") - F.col("lo")) / BINS
        bins = drawn.join(wide, same).where("v >= lo AND v < hi") \
            .groupBy("name", "due", "lo", "hi", F.least(F.floor((F.col("v") - F.col("lo")) / width), F.lit(BINS - 1)).alias("bin")) \
            .agg(F.sum("size").alias("words"), F.count("*").alias("n"))
        # At most BINS rows of a source from here on.
        by = Window.partitionBy("name").orderBy("bin")
        hit = bins.withColumn("upto", F.sum("words").over(by)) \
            .withColumn("last", F.max("bin").over(Window.partitionBy("name"))) \
            .where("upto >= due OR bin = last").withColumn("k", F.row_number().over(by)).where("k = 1")
        state = cut(hit.select(
            "name", (F.col("due") - F.col("upto") + F.col("words")).alias("due"), (F.col("lo") + F.col("bin") * width).alias("lo"),
            F.when(F.col("bin") == BINS - 1, F.col("hi")).otherwise(F.col("lo") + (F.col("bin") + 1) * width).alias("hi"), "n")
            .union(state.where(F.col("n") <= IN_ORDER)), "bins")
    # Whole bins before the cut are taken; the documents of the cut bin one by
    # one while their words do not exceed what is due.
    so_far = Window.partitionBy("name").orderBy("v", "doc_id", "row").rowsBetween(Window.unboundedPreceding, 0)
    inside = drawn.join(state.drop("n"), same).where("v >= lo AND v < hi").withColumn("upto", F.sum("size").over(so_far))
    fits = cut(inside.where("upto <= due").select("row", "name", "size"), "fits")
    left = state.join(fits.groupBy("name").agg(F.sum("size").alias("got")).withColumnRenamed("name", "of"),
                      F.col("name").eqNullSafe(F.col("of")), "left") \
        .select("name", "lo", (F.col("due") - F.coalesce("got", F.lit(0))).alias("due"))
    best = drawn.join(left, same).where("v >= lo").join(fits.select("row"), "row", "left_anti") \
        .where(F.abs(F.col("size") - F.col("due")) < F.col("due")) \
        .groupBy("name").agg(F.min(F.struct(F.abs(F.col("size") - F.col("due")), "v", "doc_id", "row")).alias("best")).select("best.row")
    more = fits.select("row").union(best).withColumn("more", F.lit(1))
    out = ranked.join(more, "row", "left").join(state.select("name", "lo"), same, "left")
    taken = F.when(F.col("more").isNotNull() | (F.col("v") < F.col("lo")), F.lit(1)).otherwise(F.lit(0))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * (F.col("copies") + taken)).alias("taken"))
