"""Ranked search, hard negatives and main text of pages."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from helpers import empty_documents, odd_documents, words
from tessera.llm import hardneg, htmltext, ranked

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------ ranked search
def terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low))


def brute_rank(docs, items, k=10):
    bags = [(d, terms(t)) for d, t in docs]
    n = sum(1 for _, b in bags if b)
    total = sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = {}
    for item, text in items.items():
        found = []
        for d, b in bags:
            m8 = 8 * (25 + 75 * b.total() * n // max(total, 1))
            s = sum(c * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + m8))
                    for t, c in terms(text).items() if b[t])
            if s > 0:
                found.append((-s, math.inf if d is None else d))
        out[item] = [(None if d == math.inf else d, -s) for s, d in sorted(found)[:k]]
    return out


def test_terms():
    assert ranked.term_counts("Ab-aB_1é 日本 x y\x00ab") == {t.encode(): c for t, c in terms("Ab-aB_1é 日本 x y\x00ab").items()}
    assert ranked.term_counts(None) == {} and ranked.term_counts(" .,-") == {}


def test_long_texts_are_counted_piece_by_piece(monkeypatch):
    text = words(random.Random(3), 500)
    whole = ranked.term_counts(text)
    monkeypatch.setattr(ranked, "PIECE", 17)
    assert ranked.term_counts(text) == whole


def test_varints():
    v = np.array([0, 1, 127, 128, 16383, 16384, 2**21, 2**28, 2**31 - 1, 5])
    data, ends = ranked.varints(v)
    assert list(ranked.unvarint(data)) == list(v) and ends[-1] == len(data)
    assert list(ranked.unvarint(data[ends[2]:ends[5]])) == list(v[3:6])


@pytest.mark.parametrize("block,window", [(1, 3), (4, 16), (128, 4096)])
def test_blocks_and_windows_of_any_size_give_the_same_ranks(monkeypatch, block, window):
    monkeypatch.setattr(ranked, "BLOCK", block)
    monkeypatch.setattr(ranked, "WINDOW", window)
    rng = random.Random(block)
    docs = [(i * 2, " ".join(rng.choices([f"t{int(rng.paretovariate(0.6)) % 60}" for _ in range(90)], k=rng.randint(1, 80)))) for i in range(150)]
    docs += [(1000 + i, docs[0][1]) for i in range(30)]
    items = {i: " ".join(rng.choices([f"t{j}" for j in range(70)], k=rng.randint(1, 25))) for i in range(25)}
    want = brute_rank(docs, items)
    shards = [ranked.shard_row([d for d, _ in part], [ranked.term_counts(t) for _, t in part]) for part in (docs[:70], docs[70:110], docs[110:])]
    n, total = len(docs), sum(terms(t).total() for _, t in docs)
    df = Counter(t for _, text in docs for t in terms(text))
    for item, text in items.items():
        query = [(t.encode(), c * w) for t, c in terms(text).items() if df[t] and (w := math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))) > 0]
        heap = ranked.Heap(10)
        for s in shards:
            ranked.search_shard(ranked.Shard({f: s.column(f)[0].as_py() for f in ranked.FIELDS}, n, total), query, heap)
        assert list(zip(heap.id.tolist(), heap.score.tolist(), strict=True)) == want[item]


def test_rejected_blocks_are_not_unpacked(monkeypatch):
    # One rare and one common term: the common list is read only where the rare one's documents stand.
    docs = [(i, "common " * (1 + i % 3) + "rare " * (50 if i == 507 else i % 100 == 7)) for i in range(2000)]
    row = ranked.shard_row([d for d, _ in docs], [ranked.term_counts(t) for _, t in docs])
    shard = ranked.Shard({f: row.column(f)[0].as_py() for f in ranked.FIELDS}, len(docs), sum(terms(t).total() for _, t in docs))
    seen = []
    unpack = ranked.Postings.unpack
    monkeypatch.setattr(ranked.Postings, "unpack", lambda self, i, j: seen.append((self, j - i)) or unpack(self, i, j))
    heap = ranked.Heap(10)
    heap.add(np.full(10, 3 * 10**9), np.arange(5000, 5010))
    ranked.search_shard(shard, [(b"common", 1), (b"rare", 5000)], heap)
    common = sum(n for p, n in seen if p is shard.find(b"common"))
    assert common <= 2 < len(shard.find(b"common").last)
    assert heap.id[0] == 507 and heap.score[0] > 3 * 10**9


def test_rank_with_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(1, rows[0][1], 0), (2, "w1 w2 w3 w3 changed日本", 1), (3, None, 2), (4, "", 3), (5, "w7 w7 w8", 4), (5, "w9", 5), (6, "nowhere", 6),
             (None, "w5 w6", 7), (7, "日本語のテキスト日本語のテキスト", 8)]
    asked = spark.createDataFrame(items, "item_id long, text string, score int")
    got = {}
    for r in ranked.rank(docs, asked).orderBy("item_id", "rank").collect():
        got.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r.rank == len(got[r.item_id])
    texts = {1: rows[0][1], 2: "w1 w2 w3 w3 changed日本", 5: "w7 w7 w8", None: "w5 w6", 7: "日本語のテキスト日本語のテキスト"}
    want = {k: v for k, v in brute_rank(rows, texts).items() if v}
    assert got == want
    for d, i in ((empty_documents(spark), asked), (docs, asked.limit(0)), (docs.where("doc_id IS NULL AND text IS NULL"), asked)):
        out = ranked.rank(d, i)
        assert out.count() == 0 and out.columns == ["item_id", "rank", "doc_id", "score"]


# ----------------------------------------------------------- hard negatives
def brute_negatives(rows, positives=5, negatives=3):
    kept = []
    for vec, label, v in rows:
        if vec is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((vec, (label + 1) % 10 if vec % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    anchors = {}
    for vec, label, v in kept:
        if vec % 50 == 0:
            anchors[vec] = min(anchors.get(vec, (label, v)), (label, v))
    out = set()
    for a, (label, v) in anchors.items():
        same, other = {}, {}
        for vec, l2, w in kept:
            if vec != a and len(w) == len(v):
                s = sum(x * y for x, y in zip(v, w, strict=True))
                side = same if l2 == label else other
                side.setdefault(vec, []).append(s)
        for vec, s in sorted(((p, max(s)) for p, s in same.items()), key=lambda x: (-x[1], x[0]))[:positives]:
            fit = [(n, max(fit)) for n, t in other.items() if (fit := [x for x in t if 50 * s <= 100 * x <= 95 * s])]
            for rank, (n, t) in enumerate(sorted(fit, key=lambda x: (-x[1], x[0]))[:negatives], 1):
                out.add((a, vec, rank, n, s, t))
    return out


def vectors(spark, seed, n=700, d=12):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, d))
    rows = [(i, int(rng.integers(0, 4)), (centre[rng.integers(0, 6)] * rng.choice([0.3, 1, 4]) + rng.normal(0, 0.3, d)).tolist()) for i in range(n)]
    same = rows[3][2]
    rows += [(n + i, int(rng.integers(0, 2)), same) for i in range(300)]                # one very common vector
    rows += [(5000, 1, [0.0] * d), (5001, 1, [0.0] * d), (5002, 2, [0.0] * d), (5050, 1, None), (5100, None, [1.0] * d),
             (5150, 1, [math.nan] * d), (5200, 1, [None] + [1.0] * (d - 1)), (None, 1, [1.0] * d), (5250, 1, [1.0, 2.0]), (5251, 1, [1.0, 2.0]),
             (5252, 2, [0.7, 1.4]), (5300, 1, []), (5301, 1, []), (5350, 9, [math.inf] * d), rows[50], rows[50], rows[77],
             (50, 2, rows[9][2]), (60, 3, rows[0][2])]
    return rows, spark.createDataFrame([(a, c, b, 1, 2) for a, b, c in rows], "vec_id long, embedding array<double>, label int, score int, v int")


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_negatives_match_brute_force(spark, seed):
    rows, df = vectors(spark, seed)
    got = [tuple(r) for r in hardneg.hard_negatives(df, df.where("vec_id % 50 = 0")).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_negatives(rows)
    assert len(got) > 100


def test_hard_negatives_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hardneg.hard_negatives(df, df).count() == 0
    one = spark.createDataFrame([(0, [1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert hardneg.hard_negatives(one, one).count() == 0


def test_pruning_passes_over_rows_but_loses_none():
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(400, 8)) * 200).astype(np.int64)
    x[200:] = (x[:1] + rng.normal(0, 20, (200, 8))).astype(np.int64)
    order = np.argsort(hardneg.scaled(x)[0], axis=0).T.astype(np.uint16)
    bucket = hardneg.Bucket(np.arange(400).tobytes(), np.zeros(400, np.int64).tobytes(), x.tobytes(), order.tobytes(), 8)
    unit, length = hardneg.scaled(x[:1])
    score = x @ x[0]
    looked = 0
    for least in sorted(score[score > 0]):
        at = bucket.candidates(unit[0], np.argsort(-np.abs(unit[0]))[:4], float(length[0]), int(least))
        at = np.arange(400) if at is None else at
        looked += len(at)
        assert set(np.flatnonzero(score >= least)) <= set(at.tolist())
    assert looked < 0.9 * 400 * (score > 0).sum()
    assert len(bucket.candidates(unit[0], np.arange(4), float(length[0]), int(length[0] * bucket.length * 1.01))) == 0


# ------------------------------------------------------------------- pages
def test_leaves_of_broken_markup():
    def blocks(html):
        return [leaf.text for leaf in htmltext.leaves(html)]
    assert blocks("<p>a <b>b</b>c\n d<p>e<br>f &amp; &lt;g&gt; &eacute;</p>h") == ["a bc d", "e f & <g> é", "h"]
    assert blocks('<script>var t="</p><p>no";</script>yes<style>p{}</style><!-- <p>no</p> -->!') == ["yes!"]
    assert blocks("1 < 2 and 3<4 <p title='a>b' data-x=\"<p>\">x") == ["1 < 2 and 3<4", "x"]
    assert blocks("a<!-- never closed <p>b") == ["a"] and blocks("a<script>b") == ["a"] and blocks("a <p class='b") == ["a"]
    assert blocks("<noscript>a<p>b") == ["a", "b"] and blocks("<noscript>a</noscript>b") == ["b"]
    assert blocks("</div></p>a</li>") == ["a"] and blocks("<title>t</title>") == [] and blocks(None) == [] and blocks("") == []
    assert blocks("a&nbsp;b　c") == ["a b c"] and blocks("<li>a<li>b<ul><li>c</ul><td>d<td>e") == ["a", "b", "c", "d", "e"]


def test_paths_close_as_in_browsers():
    page = htmltext.leaves("<div><p><b>x<br><p>y<ul><li>z</div>w<a href=q>link</a>")
    assert [[t for t, _ in leaf.path] for leaf in page] == [["div", "p", "b"], ["div", "p"], ["div", "ul", "li"], []]
    assert page[-1].linked == 4


def test_gradient_of_the_labeller():
    draw = htmltext.Layouts(["some main text here."], ["menu"], seed=1)
    pages = [draw.example() for _ in range(3)]
    model = htmltext.Labeller()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    blocks, y = htmltext.Blocks([p for p, _ in pages], {}), np.concatenate([y for _, y in pages])
    _, grad = model.gradient(blocks, y)
    for key in model.p:
        at = np.unravel_index(np.abs(grad[key]).argmax(), grad[key].shape)
        step, old = 1e-2, model.p[key][at]
        model.p[key][at] = old + step
        up, _ = model.gradient(blocks, y)
        model.p[key][at] = old - step
        down, _ = model.gradient(blocks, y)
        model.p[key][at] = old
        assert np.isclose((up - down) / (2 * step), grad[key][at], rtol=0.05, atol=1e-4), key


def reference(html):
    """The given pages keep their main text in one article."""
    body = re.search(r"<article>(.*?)</article>", html, re.S)[1]
    import html as h
    blocks = re.sub(r"<(?!/?b>)[^>]*>", "\0", body).replace("<b>", "").replace("</b>", "").split("\0")
    return " ".join(t for b in blocks if (t := " ".join(h.unescape(b).split())))


@pytest.fixture(scope="module")
def model(spark):
    return htmltext.train(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_pages_give_their_article(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {r.page_id: r for r in htmltext.main_text(pages, model).collect()}
    for r in pages.collect():
        assert rows[r.page_id].text == reference(r.html) and rows[r.page_id].n_chars == len(rows[r.page_id].text)


def test_other_layouts_are_read_too(model):
    draw = htmltext.Layouts(["A sentence of the article, as it stands.", "Another one that is rather longer, with more to say in it."], ["x"], seed=77)
    pages = [draw.example() for _ in range(200)]
    labels = model.label([p for p, _ in pages], {})
    wrong = sum(int(((p >= 0.5) != (y > 0)).sum()) for p, (_, y) in zip(labels, pages, strict=True))
    assert wrong <= 0.02 * sum(len(y) for _, y in pages)


def test_parts_around_an_article_go(model):
    html = """<html><body><div id="cookie-bar">We use cookies. <button>OK</button></div><header class="top"><a href="/">Site</a></header>
    <ul class="menu"><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul>
    <div class="post-content"><h1>A title</h1><p>The first  paragraph &amp; its <i>words</i>, which goes on for a while.</p>
    <div class="ad-slot">Buy a thing today!</div><p>The second paragraph of the text, also with several words.</p></div>
    <aside><h3>Related</h3><a href="/c">Another page</a></aside><section id="comments"><h3>2 comments</h3><div class="comment"><p>I liked the first
    paragraph a lot, it has words.</p></div></section><form class="newsletter"><label>Your mail</label></form><footer>© Site</footer></body></html>"""
    assert htmltext.texts(model, [html], {}) == ["A title The first paragraph & its words, which goes on for a while. "
                                                 "The second paragraph of the text, also with several words."]


def test_main_text_of_odd_rows(spark, model):
    long = "<article>" + "<p>word " * 30_000 + "</article>"
    rows = [(1, "u", None, "x"), (2, "u", "", "x"), (None, None, "<article><p>a b c d e</article>", "x"), (3, "u", "<nav><a href=x>menu</a></nav>", None),
            (4, "u", long, "x"), (4, "u", long, "x"), (5, "u", "<" * 1000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = htmltext.main_text(df, model).collect()
    by = {r.page_id: r for r in got}
    assert len(got) == len(rows) and by[1].text == by[2].text == "" and by[1].n_chars == 0
    assert by[4].text.count("word") == 30_000 and sum(r.page_id == 4 for r in got) == 2
    none = df.limit(0)
    assert htmltext.main_text(none).count() == 0 and htmltext.main_text(none, model).columns == ["page_id", "url", "text", "n_chars"]


def test_training_repeats_itself(spark, monkeypatch):
    monkeypatch.setattr(htmltext, "DRAWN", 64)
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    a, b = htmltext.train(pages), htmltext.train(pages.repartition(7).union(pages))
    assert all((a.p[k] == b.p[k]).all() for k in a.p)
