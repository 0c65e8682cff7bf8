"""Token counts, mixing and licences."""

import re
from collections import defaultdict

import pytest

from helpers import empty_documents, odd_documents, pairs_of
from tessera.llm import licenses, mixing, tokens

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_token_counts_are_the_library_s(spark):
    extra = [(5_000_001 + i, t) for i, t in enumerate([
        "x<|endoftext|><|endoftext|> y", "<|endoftext|>", "<|endo", "it's we'll 12 !!  \t\n z", "\n\n\n", " a", "a\x85b\x1c\x1dc",
        "😀 emoji    x", "Ωmega 3½ ²", "՘ new letters \U000323b0", "tabs\t\tand  spaces   end  "])]
    docs = odd_documents(spark).select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    t = tokenizers.Tokenizer.from_file(PATH)
    want = sorted((d or -1, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids)) for d, x in pairs_of(docs))
    got = tokens.token_counts(docs, PATH).collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in got)


def test_blocks_and_buckets_do_not_change_counts(spark, monkeypatch):
    docs = odd_documents(spark, 8)
    one = sorted(map(tuple, tokens.token_counts(docs, PATH).collect()), key=str)
    monkeypatch.setattr(tokens, "BLOCK_TERMS", 300)
    monkeypatch.setattr(tokens, "BUCKET_BYTES", 2000)
    assert sorted(map(tuple, tokens.token_counts(docs, PATH).collect()), key=str) == one


def targets_by_force(sizes, weights=(3, 1, 2)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {n: weights[i % 3] for i, n in enumerate(names)}
    full, total = set(), 1.5 * sum(sizes.values())
    while True:
        rest = sum(w[n] for n in names if n not in full)
        unit = (total - sum(2 * sizes[n] for n in full)) / rest if rest else 0
        more = {n for n in names if n not in full and unit * w[n] > 2 * sizes[n]}
        if not more:
            return {n: 2 * sizes[n] if n in full else unit * w[n] for n in names}
        full |= more


@pytest.mark.parametrize("in_order", [10_000, 7])
def test_mix_meets_targets(spark, monkeypatch, in_order):
    monkeypatch.setattr(mixing, "IN_ORDER", in_order)
    monkeypatch.setattr(mixing, "BINS", 8)
    docs = odd_documents(spark, 2, n=160)
    rows = [(r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in docs.collect()]
    sizes = defaultdict(int)
    for s, n in rows:
        sizes[s] += n
    want = targets_by_force(sizes)
    got = mixing.mix(docs).collect()
    assert sorted(r["size"] for r in got) == sorted(n for _, n in rows)
    by = defaultdict(list)
    for r in got:
        by[(r.source_size, round(r.target, 6))].append(r)
        assert 0 <= r.taken <= 2 * r["size"] and r.taken % max(r["size"], 1) == 0
    assert set(by) == {(sizes[s], round(t, 6)) for s, t in want.items()}
    for (_, target), rs in by.items():
        assert abs(sum(r.taken for r in rs) - target) <= max(r["size"] for r in rs) / 2
    again = mixing.mix(docs.repartition(5)).collect()
    assert sorted((r.doc_id or -1, r["size"], r.taken) for r in got) == sorted((r.doc_id or -1, r["size"], r.taken) for r in again)


def test_division_into_bins_gives_the_same_sample(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "w " * (i % 9 + 1), "ab"[i % 3 == 0]) for i in range(900)], "doc_id long, text string, source string")
    whole = sorted(map(tuple, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "IN_ORDER", 5)
    monkeypatch.setattr(mixing, "BINS", 4)
    assert sorted(map(tuple, mixing.mix(docs).collect())) == whole


def test_preferred_documents_are_taken_more_often(spark):
    docs = spark.createDataFrame([(i, "w " * 10, "a" if i % 2 else "b", 4.0 if i % 4 < 2 else 1.0) for i in range(4000)],
                                 "doc_id long, text string, source string, liked double")
    got = mixing.mix(docs, weights=(1, 3), share=0.4, prefer="liked").collect()
    taken = defaultdict(int)
    for r in got:
        taken[r.doc_id % 4 < 2] += r.taken
    assert taken[True] > 2 * taken[False]


NOTICE = "Released under the MIT License."


def test_licences_and_inheritance(spark):
    files = [(1, "a/x.txt", "Some text.\n" + NOTICE), (2, "a/y.txt", "no notice here"), (3, "a/b/z.txt", "nothing"),
             (4, "a/b/c/w.txt", "Licensed under the Apache License, Version 2.0.\ncode"), (5, "a/b/c/d/v.txt", None),
             (6, "e/f.txt", ""), (7, None, "x"), (8, "a/u.txt", "The license of the work was released to the public."),
             (9, "top.txt", NOTICE.upper()), (10, "a/x.txt", "licensed under cc by-nc 4.0"), (2, "a/y.txt", "no notice here")]
    got = {(r.key, r.path): r for r in licenses.scan(spark.createDataFrame(files, "key long, path string, text string")).collect()}
    assert got[(1, "a/x.txt")].own == "MIT" and got[(1, "a/x.txt")].score > 0.99
    assert (got[(2, "a/y.txt")].licence, got[(2, "a/y.txt")].origin) == ("MIT", "a")
    assert (got[(3, "a/b/z.txt")].licence, got[(3, "a/b/z.txt")].origin) == ("MIT", "a")
    assert got[(4, "a/b/c/w.txt")].own == "Apache-2.0"
    assert (got[(5, "a/b/c/d/v.txt")].licence, got[(5, "a/b/c/d/v.txt")].origin) == ("Apache-2.0", "a/b/c")
    assert got[(6, "e/f.txt")].licence is None and got[(7, None)].licence is None
    assert got[(8, "a/u.txt")].own is None and got[(9, "top.txt")].own == "MIT" and got[(9, "top.txt")].origin is None
    assert got[(10, "a/x.txt")].own == "CC-BY-NC-4.0"


def test_heavy_terms_lose_no_line(spark):
    """Every line that reaches the threshold by brute force is found."""
    import math
    import random
    rng = random.Random(3)
    pool = sorted({t for _, x in licenses.TEMPLATES for t in licenses.term_counts(x)}) + [f"zz{i}" for i in range(8)]
    files = [(i, f"d/{i}", " ".join(rng.choice(pool) for _ in range(rng.randint(1, 12)))) for i in range(300)]
    files += [(1000 + i, f"e/{i}", " ".join(rng.sample(x.split(), max(1, len(x.split()) - i % 4)))) for i, (_, x) in enumerate(licenses.TEMPLATES * 4)]
    df = defaultdict(int)
    for _, _, t in files:
        for term in set(licenses.term_counts(t)):
            df[term] += 1
    weight, foreign, vectors = licenses._vectors(licenses.TEMPLATES, df, len(files))
    got = {r.key: r for r in licenses.scan(spark.createDataFrame(files, "key long, path string, text string")).collect()}
    for key, _, t in files:
        v = {term: c * weight.get(term, foreign) for term, c in licenses.term_counts(t).items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        best = max(((round(sum(x * u.get(term, 0) for term, x in v.items()) / size, 6), -i, name) for i, (name, u) in enumerate(vectors)))
        assert got[key].own == (best[2] if best[0] >= licenses.THRESHOLD else None), (t, best, got[key])


def test_foreign_words_weigh_what_they_are_worth(spark):
    """Equal shares of files, equal scores: the table's size decides nothing."""
    def score(n):
        def text(i):
            return "\n".join((["Released under the MIT License by Foo"] if i % 50 == 0 else []) +
                             (["by the way"] if i % 2 else []) + (["foo stands under the bar"] if i % 5 == 0 else []))
        files = [(i, f"s/{i}", text(i)) for i in range(n)]
        got = licenses.scan(spark.createDataFrame(files, "key long, path string, text string")).where("key = 0").first()
        return got.own, got.score
    small, large = score(200), score(20_000)
    assert small[0] == large[0] == "MIT" and abs(small[1] - large[1]) < 0.01


def test_empty_tables(spark):
    docs = empty_documents(spark)
    assert tokens.token_counts(docs, PATH).count() == 0
    assert mixing.mix(docs).count() == 0
    assert licenses.scan(docs.selectExpr("doc_id AS key", "lang AS path", "text")).count() == 0


def test_odd_documents_have_licences_scanned(spark):
    docs = odd_documents(spark)
    assert licenses.scan(docs.selectExpr("doc_id AS key", "concat(source, '/', doc_id) AS path", "text")).count() == docs.count()
