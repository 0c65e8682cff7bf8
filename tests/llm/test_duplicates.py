"""Near-duplicates, chunks and suffixes against brute force."""

import hashlib
from collections import Counter

import numpy as np
import pytest

from helpers import empty_documents, odd_documents, pairs_of, shingle_set, words
from tessera.llm import chunks, graph, neardup, suffix

LAST = 2**63 - 1


def components_by_force(pairs):
    sets = [(d, shingle_set(t)) for d, t in pairs if d is not None]
    root = {d: d for d, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in root}


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_match_brute_force(spark, seed):
    docs = odd_documents(spark, seed)
    pairs = pairs_of(docs)
    want = components_by_force(pairs)
    got = neardup.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.n_shingles) for r in got) == Counter((d, len(shingle_set(t))) for d, t in pairs)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_large_group_of_near_copies_is_one_component(spark):
    import random
    rng = random.Random(4)
    base = words(rng, 120).split()
    rows = []
    for i in range(700):
        t = list(base)
        for _ in range(rng.randint(1, 3)):
            t[rng.randrange(len(t))] = f"edit{rng.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    rows += [(1000 + i, words(rng, 80)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = components_by_force(rows)
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()}
    assert got == want and len({got[i] for i in range(700)}) < 20


def dense_group(rng, n, lonely):
    """Near copies of a text that lie around the threshold, and texts that are
    linked with a single one of them, not with the text they come from."""
    base = words(rng, 160).split()
    rows = [" ".join(base)]
    for _ in range(n):
        t = list(base)
        for at in rng.sample(range(0, 160, 5), rng.randint(4, 7)):
            t[at] = f"edit{rng.randrange(10**6)}"
        rows.append(" ".join(t))
    for k in rng.sample(range(1, n), lonely):
        t = rows[k].split()
        for at in rng.sample(range(0, 160, 5), 4):
            t[at] = f"edit{rng.randrange(10**6)}"
        rows.append(" ".join(t))
    rng.shuffle(rows)
    return rows


def test_lone_links_of_a_dense_group_are_found(spark, monkeypatch):
    """Small nodes, blocks, tiles and parts, so that every path is taken."""
    import random
    for name, value in (("SMALL", 6), ("DEPTH", 2), ("BLOCK", 8), ("TILE", 9000), ("SPLIT", 5), ("DEAL", 3)):
        monkeypatch.setattr(neardup, name, value)
    rng = random.Random(11)
    rows = list(enumerate(dense_group(rng, 260, 60) + dense_group(rng, 90, 30) + [words(rng, 50) for _ in range(40)]))
    want = components_by_force(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()}
    assert got == want


def test_finish_links_every_pair_of_components(spark, monkeypatch):
    import random
    monkeypatch.setattr(neardup, "TILE", 3000)
    monkeypatch.setattr(neardup, "DEAL", 4)
    texts = list(enumerate(dense_group(random.Random(12), 70, 25)))
    sets = [shingle_set(t) for _, t in texts]
    comp = {i: min(i, 40) for i, _ in texts}        # the main component and forty alone
    members = spark.createDataFrame(
        [(5, i, len(sets[i]), comp[i]) for i, _ in texts] + [(6, i, len(sets[i]), 1) for i in range(9)],
        "cell long, cid long, n_shingles long, component long")
    dealt = neardup.tiles(members)
    assert dealt.where("cell = 6").isEmpty() and dealt.select("xt", "yt").distinct().count() > 4
    got = {tuple(r) for r in neardup.finish(members, spark.createDataFrame(texts, "cid long, text string")).collect()}
    linked = {(i, j) for j in range(len(texts)) for i in range(j) if comp[i] != comp[j]
              and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])}
    assert got <= linked and {(comp[a], comp[b]) for a, b in got} == {(comp[a], comp[b]) for a, b in linked}
    assert len(linked) > 20


def test_map_of_ids_loses_none_and_passes_few(spark):
    rows = spark.createDataFrame([(k, f"t{k}") for k in [None, *range(-500, 500), *range(-20, 20), 2**62, -2**63]], "doc_id long, text string")
    ids = spark.createDataFrame([(k,) for k in [None, *range(-500, 500, 50), 2**62, -2**63, 7**20]], "doc_id long")
    asked = {r[0] for r in ids.collect()} - {None}
    for most, extra in ((neardup.MAP, 5), (1 << 15, 5), (64, 500)):
        passed = Counter(r.doc_id for r in neardup.may_hold(rows, ids, "doc_id", most).collect())
        want = Counter(r.doc_id for r in rows.collect() if r.doc_id in asked)
        assert not want - passed and None not in passed
        assert sum((passed - want).values()) <= extra
    assert neardup.may_hold(rows, ids.where("doc_id IS NULL"), "doc_id").count() == 0


def test_only_asked_texts_are_joined(spark, monkeypatch):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 10**6, 40)) for _ in range(300)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([*texts, *(t + " end" for t in texts[:10])])], "doc_id long, text string")
    passed, real = [], neardup.may_hold

    def spy(rows, ids, key, **kw):
        out = real(rows, ids, key, **kw)
        if key == "doc_id":
            passed.append((rows.count(), out.count()))
        return out
    monkeypatch.setattr(neardup, "may_hold", spy)
    got = neardup.near_duplicates(docs).collect()
    assert {r.doc_id: r.component_id for r in got} == {k: k % 300 if k < 310 else k for k in range(310)}
    assert len(passed) == 1 and passed[0][0] == 310 and passed[0][1] <= 40


def test_pairs_of_groups_of_all_sizes():
    import pyarrow as pa
    rng = np.random.default_rng(6)
    groups = []
    for n in [*range(1, neardup.SMALL + 1)] * 3 + [90]:
        base = rng.integers(-2**63, 2**63 - 1, 2)
        flips = [np.packbits(rng.random(128) < 0.14).view(np.int64) for _ in range(n)]
        groups.append([{"cid": int(rng.integers(-2**63, 2**63 - 1)), "s1": int(base[0] ^ f[0]), "s2": int(base[1] ^ f[1]), "copies": k}
                       for k, f in enumerate(flips)])
    kind = pa.list_(pa.struct([(k, pa.int64()) for k in ("cid", "s1", "s2", "copies")]))
    batch = pa.RecordBatch.from_arrays([pa.array(groups, kind), pa.array([len(g) > neardup.SMALL for g in groups])], names=["members", "nearest"])
    for part in (batch, batch.slice(5, 40), batch.slice(0, 0)):
        got = {tuple(r.values()) for out in neardup._pairs([part]) for r in out.to_pylist()}
        want, some = set(), set()
        for members, nearest in zip(*(c.to_pylist() for c in part.columns), strict=True):
            for x in members:
                for y in members:
                    agree = 128 - sum(((x[k] ^ y[k]) % 2**64).bit_count() for k in ("s1", "s2"))
                    if x["cid"] < y["cid"] and agree >= neardup.SKETCH_MIN:
                        (some if nearest else want).add((x["cid"], y["cid"], agree, x["copies"], y["copies"]))
        assert want <= got <= want | some and (not some or some & got)


def test_a_large_group_takes_few_tasks(spark, monkeypatch):
    """On many partitions the tasks count, not the rows: the levels of a large
    group, its pairs and its links are to pass few shuffles."""
    import random
    for name, value in (("SMALL", 6), ("BLOCK", 16), ("SPLIT", 20)):
        monkeypatch.setattr(neardup, name, value)
    rows = list(enumerate(dense_group(random.Random(13), 120, 20)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sc, conf = spark.sparkContext, {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "13"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        sc.setJobGroup("few-tasks", "near duplicates of a large group")
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()}
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    track = sc.statusTracker()
    stages = {s for j in track.getJobIdsForGroup("few-tasks") for s in track.getJobInfo(j).stageIds}
    tasks = sum(i.numCompletedTasks for i in map(track.getStageInfo, stages) if i)
    assert got == components_by_force(rows)
    assert tasks < 1400      # 1758 with five passes over the levels, 1112 with three


def test_a_dense_group_does_not_branch(spark, monkeypatch):
    """Nodes that no level takes apart end where they are found; the others go
    on, and either way every link is found."""
    import random
    rng, real, made = random.Random(14), neardup.cut, Counter()

    def spy(df, name, *args):
        out = real(df, name, *args)
        made[name] += out.count()
        return out
    monkeypatch.setattr(neardup, "cut", spy)

    def edited(t, n):
        t = list(t)
        for at in rng.sample(range(0, 160, 5), n):
            t[at] = f"edit{rng.randrange(10**6)}"
        return t
    base = words(rng, 160).split()
    near = [edited(base, rng.randint(2, 6)) for _ in range(150)]
    far = [edited(t, 3) for t in near[:30]]                 # some are linked with their own text alone
    head = words(rng, 8)
    texts = [" ".join(t) for t in [base] * 10 + near + far] \
        + [f"{head} {words(rng, 14)}" for _ in range(200)]  # large nodes of unlike texts
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == components_by_force(rows)
    assert 0 < made["children"] < 6000 and made["dense"] > 5      # 23682 children when every large node branched, 2614 now


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, 2000 + i) for i in range(50)] + [(7, 7)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, 1: 1, **{2000 + i: 1 for i in range(50)}}


def suffixes_by_force(pairs, match):
    first = {}
    for d, t in pairs:
        for i in range(len(t) - match + 1):
            w = t[i:i + match]
            first[w] = min(first.get(w, LAST), LAST if d is None else d)
    out = Counter()
    for d, t in pairs:
        gone, seen = bytearray(len(t)), set()
        for i in range(len(t) - match + 1):
            w = t[i:i + match]
            if first[w] < (LAST if d is None else d) or w in seen:
                gone[i:i + match] = b"\1" * match
            seen.add(w)
        runs = sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out[(d, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("match", [100, 40])
def test_suffixes_match_brute_force(spark, monkeypatch, match):
    docs = odd_documents(spark, 3)
    pairs = [(d, (t or "").encode()) for d, t in pairs_of(docs)]
    # Several rounds and buckets.
    monkeypatch.setattr(suffix, "ROUND_SHARE", 2.0)
    monkeypatch.setattr(suffix, "BUCKET_KEYS", 2000)
    got = Counter(tuple(r) for r in suffix.repeated_strings(docs, match).collect())
    assert got == suffixes_by_force(pairs, match)


def test_covers_are_difference_covers():
    for v, d in suffix.COVERS.items():
        assert {(a - b) % v for a in d for b in d} == set(range(v))


def test_chunks_match_brute_force(spark):
    docs = odd_documents(spark, 5)
    pairs = [(d, (t or "").encode()) for d, t in pairs_of(docs)]
    split, first = [], {}
    for d, t in pairs:
        ends = chunks.cuts(np.frombuffer(t, np.uint8)).tolist()
        c = [t[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        assert b"".join(c) == t and all(len(x) <= chunks.MAX_CHUNK for x in c)
        split.append(c)
        for x in c:
            first[x] = min(first.get(x, LAST), LAST if d is None else d)
    want = Counter()
    for (d, t), c in zip(pairs, split, strict=True):
        seen, again = set(), []
        for x in c:
            again.append(first[x] < (LAST if d is None else d) or x in seen)
            seen.add(x)
        kept, removed, spans, i = [], 0, 0, 0
        while i < len(c):
            j = i
            while j < len(c) and again[j]:
                j += 1
            run = b"".join(c[i:j])
            if len(run) >= chunks.MIN_RUN:
                removed, spans = removed + len(run), spans + 1
            else:
                kept.append(run)
            if j < len(c):
                kept.append(c[j])
            i = j + 1
        want[(d, len(t), len(c), sum(again), removed, spans, b"".join(kept).decode())] += 1
    got = Counter((r.doc_id, r.n_bytes, r.n_chunks, r.n_repeated, r.n_removed, r.n_spans, r.kept)
                  for r in chunks.repeated_passages(docs).collect())
    assert got == want


def test_shared_passage_is_cut_from_all_but_the_first(spark):
    import random
    rng = random.Random(9)
    passage = words(rng, 60)
    rows = [(i, words(rng, 40) + "\n" + passage + "\n" + words(rng, 40)) for i in range(6)]
    got = {r.doc_id: r for r in chunks.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0].n_removed == 0 and got[0].kept == rows[0][1]
    for i in range(1, 6):
        assert passage not in got[i].kept and got[i].n_removed > len(passage) // 2


@pytest.mark.parametrize("letters", [[chr(c) for c in range(0x4E00, 0x5200)], [chr(c) for c in range(0x0E01, 0x0E2F)],
                                     list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")])
def test_passages_without_white_space_are_found(spark, letters):
    import random
    rng = random.Random(11)
    def run(n):
        return "".join(rng.choice(letters) for _ in range(n))
    n = 40
    passages = [run(900 // len(letters[0].encode())) for _ in range(n)]
    rows = [(k * n + i, run(rng.randrange(200, 900)) + p + run(rng.randrange(200, 900))) for k in (0, 1) for i, p in enumerate(passages)]
    got = {r.doc_id: r for r in chunks.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert not any(got[i].n_removed for i in range(n))
    assert all(450 < got[n + i].n_removed <= 900 for i in range(n))


def test_gear_hash_is_a_rolling_hash():
    buf = np.frombuffer(b"some bytes that roll through the hash window of thirty-two", np.uint8)
    h, want = 0, []
    for b in buf:
        h = ((h << 1) + int(chunks.GEAR[b])) & 0xFFFFFFFF
        want.append(h)
    assert chunks.gear_hash(buf).tolist() == want


def test_empty_tables(spark):
    docs = empty_documents(spark)
    assert neardup.near_duplicates(docs).count() == 0
    assert suffix.repeated_strings(docs).count() == 0
    assert chunks.repeated_passages(docs).count() == 0
