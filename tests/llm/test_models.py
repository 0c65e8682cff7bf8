"""Toxicity, quality, decontamination and nearest neighbours."""

import random

import numpy as np
import pytest

from helpers import empty_documents, held_out, odd_documents, words
from tessera.llm import ann, decontam, quality, toxicity

SF = "/root/testdata/sf0.01"


def labelled(spark, doc_rows, label):
    return spark.createDataFrame([(d, y) for d, _, y in doc_rows], f"doc_id long, {label} int")


def toxic_rows(n=600):
    """Toxic only where an insult stands next to a group: neither alone is."""
    rng = random.Random(6)
    rows = []
    for i in range(n):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        t = words(rng, 30).split()
        if insult:
            t.insert(rng.randrange(len(t)), rng.choice(["vile", "awful"]))
        if group:
            t.insert(rng.randrange(len(t)), rng.choice(["foreigners", "neighbours"]))
        rows.append((i, " ".join(t), int(insult and group)))
    return rows


def test_machine_learns_pairs_of_terms(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labelled(spark, rows, "toxic")).collect()}
    out = [(got[d].score, y) for d, _, y in rows if held_out(d, 3, 1)]
    assert all(got[d].held_out == held_out(d, 3, 1) for d, _, _ in rows)
    assert np.mean([(s >= 0.5) == (y == 1) for s, y in out]) > 0.95
    assert all(r.predicted == (r.score >= 0.7) for r in got.values())


def test_machine_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    text = "some words of a text, some twice"
    slots = toxicity.terms(text)
    m = toxicity.Machine(slots, 0.3, rng.normal(size=len(slots)), rng.normal(size=(len(slots), 4)))
    z = m.w0 + m.w.sum() + sum(m.v[i] @ m.v[j] for i in range(len(slots)) for j in range(i))
    assert np.isclose(m.score(text), 1 / (1 + np.exp(-z)))


def test_toxicity_is_repeatable_and_ignores_held_out_labels(spark):
    rows = toxic_rows(300)
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int")
    flipped = [(d, t, 1 - y if held_out(d, 3, 1) else y) for d, t, y in rows]
    a = {r.doc_id: r.score for r in toxicity.toxicity(docs, labelled(spark, rows, "toxic")).collect()}
    b = {r.doc_id: r.score for r in toxicity.toxicity(docs.repartition(3), labelled(spark, flipped, "toxic")).collect()}
    assert a == b


def test_quality_on_labelled_documents(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = {r.doc_id: r for r in quality.quality(docs, labels).collect()}
    out = [(got[r.doc_id], r.quality) for r in labels.collect() if held_out(r.doc_id, 5, 0)]
    assert len(got) == docs.count() and np.mean([g.predicted == y for g, y in out]) > 0.95


def test_prior_and_risk_on_known_mixture():
    rng = np.random.default_rng(2)

    def sample(n, share):
        good = rng.random(n) < share
        x = rng.normal(size=(n, quality.FEATURES))
        x[:, 0] += np.where(good, 2.5, -2.5)
        return x, good
    p, _ = sample(4000, 1.0)
    u, y = sample(4000, 0.7)
    prior = quality.estimate_prior(p, u)
    assert 0.62 < prior < 0.74
    model = quality.fit(p, u)
    assert ((model.score(u) >= 0.5) == y).mean() > 0.95


def test_models_on_odd_and_empty_tables(spark):
    docs, none = odd_documents(spark), empty_documents(spark)
    n = docs.count()
    labels = spark.createDataFrame([(3, 1, 1), (6, 0, 0), (6, 1, 1), (None, 1, 1), (9, None, None), (12, 0, 0), (12, 0, 0)],
                                   "doc_id long, toxic int, quality int")
    nothing = labels.where("false")
    for of, label in ((toxicity.toxicity, "toxic"), (quality.quality, "quality")):
        for d, y, size in ((docs, labels, n), (docs, nothing, n), (none, labels, 0), (none, nothing, 0)):
            rows = of(d, y).collect()
            assert len(rows) == size and all(0 <= r.score <= 1 for r in rows), label


def distance_by_force(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        last, row = row, [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (a != b)))
    return min(row)


def test_bit_parallel_distance():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a, b = (rng.integers(0, 4, rng.integers(lo, 90)).astype(np.uint64) for lo in (1, 0))
        assert decontam.myers(a, b) == distance_by_force(a.tolist(), b.tolist())


def test_contamination_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(decontam, "SLICE_BYTES", 3000)        # several slices
    rng = random.Random(8)
    items = [(i, words(rng, rng.randint(5, 60), 30)) for i in range(25)] + [(90, None), (91, ""), (None, words(rng, 20)), (0, words(rng, 20))]
    rows = []
    for i in range(120):
        t = words(rng, 30, 30).split()
        if i % 2:
            w = items[rng.randrange(25)][1].split()
            for _ in range(rng.randint(0, 6)):
                w[rng.randrange(len(w))] = "other"
            t[10:10] = w
        rows.append((i, ", ".join(t).upper() if i % 3 else " ".join(t)))
    rows += [(500, None), (501, ""), (None, items[3][1]), (502, items[3][1]), (502, items[4][1])]
    docs, bench = (spark.createDataFrame(x, f"{n} long, text string") for x, n in ((rows, "doc_id"), (items, "item_id")))
    got = {}
    for r in decontam.contamination(docs, bench).collect():
        assert r.contaminated == bool(r.item_ids)
        if r.doc_id is not None:
            got[r.doc_id] = dict(zip(r.item_ids, r.distances, strict=True))
    want = {d: {} for d, _ in rows if d is not None}
    for d, t in rows:
        for n, x in items:
            w = decontam.words(x).tolist()
            if d is not None and n is not None and len(w) >= decontam.MIN_WORDS:
                k = distance_by_force(w, decontam.words(t).tolist())
                if k <= len(w) // 10:
                    want[d][n] = min(k, want[d].get(n, k))
    assert got == want and sum(map(len, want.values())) > 30
    clean = decontam.drop_contaminated(docs, bench).collect()
    assert sorted(r.doc_id for r in clean if r.doc_id is not None) == sorted(d for d, _ in rows if d is not None and not want[d] )
    empty = empty_documents(spark)
    assert decontam.contamination(empty, bench).count() == 0
    assert not any(r.contaminated for r in decontam.contamination(docs, bench.where("false")).collect())


def test_short_items_and_unspaced_scripts_are_found(spark):
    chinese = "水在标准大气压下的沸点是多少摄氏度呢请回答"
    items = [(1, "What is 2 + 2?"), (2, "Paris"), (3, "水的沸点是多少"), (4, chinese), (5, "one two three four five six seven eight nine ten eleven"),
             (6, "...")]
    rows = [(10, "Asked: what is 2+2? And more."), (11, "what is 2 and 2"), (12, "They saw Paris\u2014twice."), (13, "Parish"),
            (14, "前面水的沸点是多少后面"), (15, "前面水的沸点是几多后面"), (16, "前面" + chinese.replace("标", "表") + "后面"),
            (17, "\u201cone\u00a0two\u2013three\u2026four five six se\u00adven eight nine ten eleven\u201d")]
    docs, bench = (spark.createDataFrame(x, f"{n} long, text string") for x, n in ((rows, "doc_id"), (items, "item_id")))
    got = {r.doc_id: dict(zip(r.item_ids, r.distances, strict=True)) for r in decontam.contamination(docs, bench).collect()}
    assert got == {10: {1: 0}, 11: {}, 12: {2: 0}, 13: {}, 14: {3: 0}, 15: {}, 16: {4: 1}, 17: {5: 0}}


@pytest.mark.parametrize("d", [1, 5, 64])
def test_neighbours_match_brute_force(spark, d):
    rng = np.random.default_rng(d)
    x = rng.normal(size=(400, d)).astype(np.float32)
    x[7] = x[3] = x[50]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(1000, None), (1050, [0.0] * d), (1100, [float("nan")] * d), (1150, [float("inf")] * d), (1200, []), (None, x[0].tolist()),
           (1250, [None] * d), (1300, [1.0] * (d + 1)), (1350, [2.0] * (d + 1)), (50, x[50].tolist()), (60, x[9].tolist())]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("score", df_lit())
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 50 = 0")).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == {*range(0, 400, 50), 1300, 1350}
    assert [v for v, _ in got[1300].values()] == [1350]
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    for q in range(0, 400, 50):
        best = {}
        for i, s in [*enumerate(u @ u[q]), (60, u[9] @ u[q])]:
            if i != q:
                best[i] = max(best.get(i, -2), s)
        want = sorted(best.values(), reverse=True)[:5]
        assert np.allclose([got[q][r][1] for r in range(1, 6)], want, atol=1e-12)
        assert all(np.isclose(best[v], s, atol=1e-12) for v, s in got[q].values())
        order = [(-s, v) for _, (v, s) in sorted(got[q].items())]
        assert order == sorted(order)
    assert ann.nearest(df.where("false"), df).count() == 0


def df_lit():
    from pyspark.sql import functions as F
    return F.lit("clash")


def test_error_bound_holds():
    rng = np.random.default_rng(0)
    x, q = rng.normal(size=(2000, 64)), rng.normal(size=(50, 64))
    bits, c = ann.encode(x)
    est, error = ann.estimates(bits, c, ann.units(q) @ ann.rotation(64))
    true = ann.units(x) @ ann.units(q).T
    assert (np.abs(est - true) <= error).mean() > 0.985


def test_samples_are_the_smallest_hashes_whatever_the_partitions(spark):
    from pyspark.sql import functions as F
    rows = [(i % 900, (i * 7) % 3 > 0) for i in range(1800)] + [(901, None), (None, True)]
    labels = spark.createDataFrame([(d, None if y is None else int(y)) for d, y in rows], "doc_id long, toxic int")
    hashes = {r.doc_id: r.h for r in labels.select("doc_id", F.xxhash64(F.col("doc_id")).alias("h")).distinct().collect()}
    votes = {}
    for d, y in rows:
        if d is not None and y is not None and not held_out(d, 3, 1):
            votes.setdefault(d, []).append(y)
    plain = sorted((hashes[d], d, int(2 * sum(v) >= len(v))) for d, v in votes.items())[:40]
    for parts in (1, 50):
        got = toxicity.labelled_ids(labels.repartition(parts), "toxic", 3, 1, 40)
        assert sorted((hashes[r.doc_id], r.doc_id, r.y) for r in got.collect()) == plain


@pytest.mark.parametrize("name", ["toxic", "quality"])
def test_a_labelled_id_on_a_third_of_all_rows_is_one_row_of_the_sample(spark, monkeypatch, name):
    from pyspark.sql import functions as F
    rng = random.Random(4)
    rows = [(i, words(rng, 25) + (" vile foreigners" if i % 2 else ""), i % 2) for i in range(120)]
    hot = next(d for d, _, y in rows if y == 1 and not held_out(d, 3, 1) and not held_out(d, 5, 0))
    docs = spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string")
    many = docs.union(spark.range(3000).select(F.lit(hot).alias("doc_id"), F.concat(F.lit("zz "), F.col("id").cast("string")).alias("text"))).repartition(12)
    labels = labelled(spark, rows, name)
    sizes = []
    if name == "toxic":
        monkeypatch.setattr(toxicity, "fit", lambda x, y, chosen, **kw: sizes.append(len(y)))
        toxicity.train(many, labels)
        assert sizes == [sum(not held_out(d, 3, 1) for d, _, _ in rows)]
    else:
        monkeypatch.setattr(quality, "fit", lambda p, u, **kw: sizes.append((len(p), len(u))))
        quality.train(quality.describe(many), labels)
        assert sizes == [(sum(y == 1 and not held_out(d, 5, 0) for d, _, y in rows), 120)]


def test_scores_of_the_queries_are_those_of_the_models_text_by_text(spark):
    # Plain references: the machine's pair sum, the network's value on each text's features.
    rows = toxic_rows(200)
    docs = spark.createDataFrame(rows, "doc_id long, text string, y int")
    machine = toxicity.train(docs, labelled(spark, rows, "toxic"))
    texts = {d: t for d, t, _ in rows}

    def plain(text):
        slots = toxicity.terms(text)
        at = [int(machine.place[s]) for s in slots if machine.place[s] >= 0]
        z = machine.w0 + sum(machine.w[i] for i in at) + sum(float(machine.v[a] @ machine.v[b]) for k, a in enumerate(at) for b in at[:k])
        return 1 / (1 + np.exp(-z))
    for r in toxicity.toxicity(docs, labelled(spark, rows, "toxic")).collect():
        assert np.isclose(r.score, plain(texts[r.doc_id])) and r.predicted == (r.score >= 0.7)
    model = quality.train(quality.describe(docs), labelled(spark, rows, "quality"))
    for r in quality.quality(docs, labelled(spark, rows, "quality")).collect():
        assert np.isclose(r.score, model.score(np.array([quality.features(texts[r.doc_id])]))[0])
