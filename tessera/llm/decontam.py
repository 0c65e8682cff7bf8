"""Benchmark contamination within an edit budget.

Texts and items are sequences of words (runs of letters and digits, A-Z
lowered), so case, marks and white space do not matter, in ASCII or beyond it;
format characters (soft hyphens, joiners) are left out.  Each character of
a script that puts no space between words (Chinese, Japanese, Thai, ...) and
each pictograph is a word of its own.  A document is contaminated by an item if
some stretch of it is at most k word edits (insertions, deletions,
replacements) from the whole item, k being a tenth of the item's words: items
with fewer than ten words are found word for word only.

k edits touch at most k of k + 1 pieces, so each item is split into k + 1
pieces of nearly equal length and at least one piece stands in the stretch
exactly.  Documents look up their runs of q words among the first q words of
the pieces, q the shortest piece of five words or more, and the shorter pieces
(whole short items) by their own lengths; around each hit the whole item is verified
with Myers' bit-parallel distance over words, on the merged windows of its
hits, so a frequent piece costs no more than a pass over the document.

The items are worked off in slices of at most ``SLICE_BYTES`` of text, which
bounds what is sent to the tasks however large the benchmark is; every slice
reads all documents once and nothing is shuffled but the hits.

Defined cases: a null or empty text has no words and no hits; items without a
word are not looked for, nor are those with fewer than ``min_words`` words if a
caller asks for more than one; an item_id with several texts is hit by any of them;
rows that share a doc_id share their hits; rows with a null doc_id or items
with a null item_id have none; extra columns are ignored; empty tables give no
hits.
"""

from __future__ import annotations

import functools
import math
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, cut, grams, span_hash
from tessera.llm.toxicity import WORD

BUDGET = 0.1
MIN_WORDS = 1
PIECE = 5                # pieces of so many words or more are looked up together
SLICE_BYTES = 8 << 20


# Kinds of characters: marks and spaces, parts of words, words by themselves, left out.
MARK, PART, ALONE, SKIP = range(4)
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x3005, 0x3007), (0x3040, 0x312F),
            (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA000, 0xA4CF), (0xA9E0, 0xA9FF), (0xAA60, 0xAA7F),
            (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B2FF), (0x20000, 0x3FFFF))


@functools.cache
def kinds() -> np.ndarray:
    """The kind of every code point."""
    of = {"Cc": MARK, "Cf": SKIP, "So": ALONE}
    out = np.array([of.get(c := unicodedata.category(chr(i)), MARK if c[0] in "PZS" else PART) for i in range(0x110000)], np.uint8)
    for a, b in UNSPACED:
        out[a:b + 1][out[a:b + 1] == PART] = ALONE
    for a, b in ((0xFE00, 0xFE0F), (0xE0100, 0xE01EF)):        # variation selectors
        out[a:b + 1] = SKIP
    return out


def _wide_words(text: str) -> np.ndarray:
    """``words`` of a text beyond ASCII."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = kinds()[code]
    if (kind == SKIP).any():
        code, kind = code[kind != SKIP], kind[kind != SKIP]
        text = code.tobytes().decode("utf-32-le", "surrogatepass")
    if not len(kind):
        return np.zeros(0, np.uint64)
    buf = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(LOWER), np.uint8)
    at = np.append(np.flatnonzero((buf & 0xC0) != 0x80), len(buf))       # first bytes of the characters
    part = kind == PART
    alone = kind == ALONE
    starts = np.flatnonzero(alone | part & ~np.concatenate([[False], part[:-1]]))
    ends = np.flatnonzero(alone | part & ~np.concatenate([part[1:], [False]])) + 1
    return span_hash(buf, at[starts], at[ends])


def words(text: str | None) -> np.ndarray:
    """Hashes of the words of a text."""
    if not text:
        return np.zeros(0, np.uint64)
    if not text.isascii():
        return _wide_words(text)
    buf = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(LOWER), np.uint8)
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = WORD[buf]
    step = np.diff(inside)
    return span_hash(buf, np.flatnonzero(step == 1), np.flatnonzero(step == -1))


def myers(item: np.ndarray, text: np.ndarray) -> int:
    """Smallest edit distance of the whole item to any stretch of the text, by
    Myers' bit vectors: one machine word per 64 pattern words, as one integer."""
    m = len(item)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    at: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        at[w] = at.get(w, 0) | 1 << i
    pv, mv, score = mask, 0, m
    best = score
    for w in text.tolist():
        eq = at.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & mask        # a match may begin anywhere: no bit comes in
        pv = (mh << 1 & mask) | ~(xv | ph) & mask
        mv = ph & xv
        if score < best:
            best = score
    return best


class Items:
    """Pieces of the items of a slice, looked up by their first words."""

    def __init__(self, items: list[tuple[int, str]], budget: float, min_words: int):
        self.items = []
        for item_id, text in items:
            w = words(text)
            if len(w) >= max(min_words, 1):
                self.items.append((item_id, w, math.floor(budget * len(w))))
        pieces = []
        for n, (_, w, k) in enumerate(self.items):
            edge = [len(w) * i // (k + 1) for i in range(k + 2)]
            pieces += [(n, a, b) for a, b in zip(edge, edge[1:], strict=False)]
        # By how many words the pieces are looked up: (q, sorted hashes, pieces).
        shared = min((b - a for _, a, b in pieces if b - a >= PIECE), default=0)
        by: dict[int, list[tuple[int, int, int]]] = {}
        for n, a, b in pieces:
            by.setdefault(shared if b - a >= PIECE else b - a, []).append((n, a, b))
        self.tables = []
        for q, some in sorted(by.items()):
            first = np.array([grams(self.items[n][1][a:a + q], q)[0] for n, a, _ in some], np.uint64)
            order = np.argsort(first, kind="stable")
            self.tables.append((q, first[order], [some[i] for i in order]))

    def hits(self, text: str | None) -> list[tuple[int, int]]:
        """(item_id, distance) of the items found in a text, smallest first."""
        if not self.tables:
            return []
        w = words(text)
        windows: dict[int, list[tuple[int, int]]] = {}
        for q, first, pieces in self.tables:
            g = grams(w, q)
            if not len(g):
                continue
            lo = np.searchsorted(first, g)
            found = np.flatnonzero(first[np.minimum(lo, len(first) - 1)] == g)
            for j in found.tolist():
                i = int(lo[j])
                while i < len(first) and first[i] == g[j]:
                    n, a, b = pieces[i]
                    _, item, k = self.items[n]
                    if np.array_equal(w[j:j + b - a], item[a:b]):
                        windows.setdefault(n, []).append((max(0, j - a - k), min(len(w), j - a + len(item) + k)))
                    i += 1
        best: dict[int, int] = {}
        for n, spans in windows.items():
            item_id, item, k = self.items[n]
            start, end = None, None
            for s, e in [*sorted(spans), (len(w) + 1, len(w) + 1)]:
                if start is not None and s <= end:
                    end = max(end, e)
                    continue
                if start is not None and (d := myers(item, w[start:end])) <= k:
                    best[item_id] = min(d, best.get(item_id, d))
                start, end = s, e
        return sorted(best.items())


HITS = "doc_id long, items array<struct<item_id:long,distance:int>>"


def slices(benchmark: DataFrame, budget: float = BUDGET, min_words: int = MIN_WORDS):
    """The items, a slice of bounded size at a time."""
    bench = cut(benchmark.where("item_id IS NOT NULL AND text IS NOT NULL")
                .select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).distinct(), "items")
    size = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / SLICE_BYTES))
    for part in range(n):
        some = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == part)
        yield Items(sorted((r.item_id, r.text) for r in some.collect()), budget, min_words)


def find(docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, items) of the documents with hits, one row each; ``items``
    holds (item_id, smallest distance), by item_id."""
    docs = docs.where("doc_id IS NOT NULL AND text IS NOT NULL") \
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for items in slices(benchmark, budget, min_words):
        def run(batches, items=items):
            for batch in batches:
                hits = [items.hits(t) for t in batch.column(1).to_pylist()]
                on = [i for i, h in enumerate(hits) if h]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(on, pa.int64())),
                     pa.array([[{"item_id": a, "distance": b} for a, b in hits[i]] for i in on],
                              pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32())])))],
                    names=["doc_id", "items"])

        one = docs.mapInArrow(run, HITS)
        found = one if found is None else found.union(one)
    best = found.select("doc_id", F.explode("items").alias("i")) \
        .groupBy("doc_id", F.col("i.item_id").alias("item_id")).agg(F.min("i.distance").alias("distance"))
    return best.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("item_id", "distance"))).alias("items"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``docs`` without a hit, all columns; nothing is shuffled."""
    at = docs.columns.index("text")
    for items in slices(benchmark, budget, min_words):
        def run(batches, items=items):
            for batch in batches:
                yield batch.filter(pa.array([not items.hits(t) for t in batch.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs


def contamination(docs: DataFrame, benchmark: DataFrame, budget: float = BUDGET, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, contaminated, item_ids, distances for every row of ``docs``."""
    hits = cut(find(docs, benchmark, budget, min_words), "leaks")
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(hits, "doc_id", "left")
    items = F.coalesce("items", F.array().cast("array<struct<item_id:bigint,distance:int>>"))
    return out.select("doc_id", (F.size(items) > 0).alias("contaminated"),
                      items["item_id"].alias("item_ids"), items["distance"].alias("distances"))
