"""The pipeline's stages take effect and keep what they should; the contract
of the queries."""

import os
import random

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from helpers import shingle_set, words
from tessera.llm import decontam, queries
from tools.check_oracle import digest, duck

SF = "/root/testdata/sf0.001"


def test_stages_on_the_smallest_tables(spark, tmp_dir):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [decontam.words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        stage(spark, docs, SF).write.parquet(os.path.join(tmp_dir, name))
        out = spark.read.parquet(os.path.join(tmp_dir, name))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        seen[name], docs = {r.doc_id: r for r in out.collect()}, out
    kept = seen["minhash_neardup"]
    sets = [(d, shingle_set(r.text)) for d, r in kept.items()]
    for i, (_, s) in enumerate(sets):
        for _, t in sets[:i]:
            assert not s or not t or 100 * len(s & t) < 75 * len(s | t)
    cut = seen["substring_dedup"]
    assert set(cut) == set(kept) and all(len(r.text) == r.n_chars or r.text == kept[d].text for d, r in cut.items())
    for r in seen["decontamination"].values():
        w = decontam.words(r.text)
        assert not any(len(b) >= decontam.MIN_WORDS and decontam.myers(b, w) == 0 for b in bench)
    assert set(seen["mixing"]) == set(seen["decontamination"])
    assert 0.5 * 200 < len(seen["mixing"]) <= 200


def test_stages_on_odd_and_empty_tables(spark, tmp_dir):
    rng = random.Random(3)
    text = words(rng, 80)
    rows = [(i, words(rng, 60), "en", "a", 9, "x", 1) for i in range(40)] + [
        (50, text, "en", "a", 9, "x", 1), (51, text + " end", None, None, None, None, None), (50, text, "en", "a", 9, "x", 1),
        (None, text, "en", "b", 1, "x", 1), (None, None, None, None, None, None, None), (60, "", "en", "b", 0, "x", 1),
        (61, words(rng, 30) + "\n" + text, "en", "b", 7, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, kept string, key long")
    for at, d in enumerate((docs, docs.where("false"))):
        for name, stage in corpus_pipeline.STAGES:
            path = os.path.join(tmp_dir, f"{at}-{name}")
            out = stage(spark, d, SF)
            assert name == "mixing" or out.columns == d.columns
            out.write.parquet(path)
            d = spark.read.schema(out.schema).parquet(path)
        got = [r.doc_id for r in d.collect()]
        assert got == [] if at else (got.count(50) == 1 and 51 not in got and 61 in got and None in got and 60 in got)


def test_queries_are_registered():
    names = list(entry.queries())
    for n in range(1, 14):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    cur = duck(SF).execute(queries.ORACLE[name])
    columns = [c[0] for c in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(columns) and len(rows) == len(want)
    assert digest(df.columns, rows)[0] == digest(columns, want)[0]
