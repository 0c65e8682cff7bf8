r"""Licences of files: notices by TF-IDF cosine, inheritance by path.

Every line of every file is a possible notice.  Lines and templates are
vectors of terms (runs of letters and digits, lower case, hyphens and dots
within kept apart); a term weighs its count times ln((1 + N) / (1 + df)) + 1,
with N files and df the files that hold it, counted over all files, whether a
template has the term or not: foreign words lower a line's score, rare ones
more than common ones, and equal shares of files give equal scores in a small
and in a large table.  A file's licence is that of the best template, if the
cosine of its best line reaches ``threshold``.

Most lines cannot reach it.  A line that holds none of a template's heaviest
terms scores at most the length of the template's remaining part; terms are
called heavy from the top until that is below the threshold, and only lines
with a heavy term of some template are scored.  A term weighs at least 1, so
lines that would miss the threshold if every foreign word weighed 1 are left
out before the foreign words of the others are counted.  No match is lost.

A directory's licence is that of its licence file: of the files with a notice
of their own, the one with the smallest key.  A file without a notice inherits
from its nearest ancestor directory that has a licence.  Directories, not
files, are expanded into ancestors, so a directory with a third of all files
is one row there; the way back to the files is one join on the directory.

DataFrame operations only.  Defined cases: a null or empty text has no lines
with terms and no notice; a null path has no directory and inherits nothing;
rows with equal keys or paths are files of their own (wholly equal rows get
equal results); of equal scores the
template listed first wins; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut
from tessera.sources.tables import broadcast_if_small

THRESHOLD = 0.6

# Usual one-line notices of well-known licences.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("LGPL-2.1", "This library is free software under the GNU Lesser General Public License, version 2.1."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def term_counts(text: str) -> dict[str, int]:
    found: dict[str, int] = {}
    for t in re.split(r"[^a-z0-9]+", text.lower()):
        if t:
            found[t] = found.get(t, 0) + 1
    return found


def _vectors(templates, df: dict[str, int], n: int):
    """Template vectors of length one, their heavy terms and the term weights."""
    def idf(k):
        return math.log((1 + n) / (1 + k)) + 1

    weight = {t: idf(df.get(t, 0)) for _, text in templates for t in term_counts(text)}
    vectors = []
    for name, text in templates:
        v = {t: c * weight[t] for t, c in term_counts(text).items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        vectors.append((name, {t: x / size for t, x in v.items()}))
    return weight, idf(1), vectors


def _heavy(vectors, threshold: float) -> set[str]:
    out: set[str] = set()
    for _, v in vectors:
        rest = 1.0
        for t, x in sorted(v.items(), key=lambda i: (-i[1], i[0])):
            if math.sqrt(max(rest, 0.0)) < threshold - 1e-9:
                break
            out.add(t)
            rest -= x * x
    return out


def _frequencies(files: DataFrame, terms: DataFrame, words) -> DataFrame:
    """(term, df) of the given terms: the files that hold them."""
    wanted = cut(terms.select("term").distinct(), "foreign")
    few, found = broadcast_if_small(wanted), files.select(F.explode(words).alias("term"))
    if few is not wanted:
        return found.join(few, "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))
    return found.groupBy("term").agg(F.count("*").alias("df")).join(wanted, "term", "left_semi")


def scan(files: DataFrame, templates=TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(key, path, text) -> key, path, own (licence of its own notice), score
    (of the best line, 0 without one), licence (own or inherited), origin (the
    directory it is inherited from, null if own)."""
    files = files.select("key", "path", F.lower(F.col("text").cast("string")).alias("text")) \
        .withColumn("file", F.md5(F.concat_ws("\u0001", F.coalesce(F.col("key").cast("string"), F.lit("")),
                                             F.coalesce("path", F.lit("")), F.coalesce("text", F.lit("")))))
    # Document frequencies of the template terms, over all files: at most one
    # row per term reaches the driver, and their number is the templates'.
    vocabulary = sorted({t for _, text in templates for t in term_counts(text)})
    words = F.array_distinct(F.split("text", "[^a-z0-9]+"))
    seen = files.select(F.explode(F.array_intersect(words, F.array(*map(F.lit, vocabulary)))).alias("term"))
    df = {r.term: r["count"] for r in seen.groupBy("term").count().collect()}
    n = files.count()
    weight, _, vectors = _vectors(templates, df, n)
    heavy = "|".join(sorted(_heavy(vectors, threshold)))
    with_heavy = f"(?<![a-z0-9])({heavy})(?![a-z0-9])"
    lines = files.where(F.col("text").rlike(with_heavy)).select(
        "file", F.explode(F.filter(F.split("text", "\n"), lambda x: x.rlike(with_heavy))).alias("line"))
    terms = F.filter(F.split("line", "[^a-z0-9]+"), lambda t: t != "")
    weights = F.create_map(*[x for t in vocabulary for x in (F.lit(t), F.lit(weight[t]))])
    # tf-idf per distinct template term of the line (count times weight), and
    # the foreign terms with their counts.
    known, times = F.array(*map(F.lit, vocabulary)), lambda t: F.size(F.filter("terms", lambda x: x == t))
    counted = lines.withColumn("terms", F.array_sort(terms)).withColumn("weights", weights) \
        .withColumn("v", F.transform(F.array_intersect("terms", known), lambda t: F.struct(
            t.alias("t"), (times(t) * F.element_at("weights", t)).alias("x")))) \
        .withColumn("others", F.transform(F.array_except("terms", known), lambda t: F.struct(t.alias("term"), times(t).alias("c"))))

    def squares(column, part):
        return F.aggregate(column, F.lit(0.0), lambda a, e: a + e[part] * e[part])

    def cosine(v, size):
        m = F.create_map(*[x for t, y in v.items() for x in (F.lit(t), F.lit(y))])
        return F.aggregate("v", F.lit(0.0), lambda a, e: a + e["x"] * F.coalesce(F.element_at(m, e["t"]), F.lit(0.0))) / size

    def best_of(size):
        return F.array_max(F.array(*[F.struct(F.round(cosine(v, size), 6).alias("score"), F.lit(-i).alias("turn"), F.lit(name).alias("name"))
                                     for i, (name, v) in enumerate(vectors)]))

    # Equal terms, equal score: the lines are scored once per bag of terms.
    near = cut(counted.withColumn("least", F.sqrt(squares("v", "x") + squares("others", "c")))
               .where(best_of(F.col("least"))["score"] >= threshold - 1e-6)
               .select("file", F.array_join("terms", " ").alias("bag"), "v", "others"), "near")
    bags = near.select("bag", "v", "others").distinct()
    other = bags.select("bag", F.explode("others").alias("o")).select("bag", "o.term", "o.c")
    size = bags.join(other.join(_frequencies(files, other, words), "term")
                     .groupBy("bag").agg(F.sum(F.pow(F.col("c") * (F.log((1.0 + n) / (1 + F.col("df"))) + 1), 2)).alias("x")), "bag", "left") \
        .withColumn("size", F.sqrt(squares("v", "x") + F.coalesce("x", F.lit(0.0))))
    scores = cut(size.select("bag", best_of(F.col("size")).alias("best")).where(F.col("best.score") >= threshold), "bags")
    best = near.select("file", "bag").join(broadcast_if_small(scores), "bag").groupBy("file").agg(F.max("best").alias("best")) \
        .select("file", F.col("best.score").alias("score"), F.col("best.name").alias("own"))
    found = cut(best, "notices")
    folder = F.when(F.col("path").contains("/"), F.regexp_extract("path", "^(.*)/", 1))
    named = cut(files.select("file", "key", "path", folder.alias("folder")).join(found, "file", "left"), "files")
    declared = named.where("own IS NOT NULL AND folder IS NOT NULL") \
        .groupBy("folder").agg(F.min_by("own", F.struct(F.col("key").isNull(), "key", "path", "own")).alias("licence"))
    # Each directory without its own licence looks at its ancestors.
    parts = F.split("folder", "/")
    up = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.struct(
        k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("dir")))
    above = named.where("folder IS NOT NULL").select("folder").distinct() \
        .select("folder", F.explode(up).alias("a")).select("folder", "a.depth", "a.dir")
    nearest = above.join(declared.withColumnRenamed("folder", "dir"), "dir") \
        .groupBy("folder").agg(F.max(F.struct("depth", "dir", "licence")).alias("n")) \
        .select("folder", F.col("n.dir").alias("dir"), F.col("n.licence").alias("licence"))
    out = named.join(nearest, "folder", "left")
    return out.select("key", "path", "own", F.coalesce("score", F.lit(0.0)).alias("score"),
                      F.coalesce("own", "licence").alias("licence"), F.when(F.col("own").isNull(), F.col("dir")).alias("origin"))
