"""Ranked lexical search by Block-Max MaxScore over document shards.

Index.  Every task packs its documents into shards of about ``SHARD_BYTES`` of
text and writes one row per shard: document ids and lengths, the sorted terms,
and each term's postings in blocks of ``BLOCK`` documents, packed as variable
length differences.  Beside a block stand its last document and those of its
(tf, length) pairs that no other pair of the block beats in both; a score rises
with tf and falls with length, so the largest score of a block under any
collection statistics is the largest among these pairs.

Search.  A term's score in a document is w * ((1000000000 * tf) div
(1000 * tf + 8 * m)) with w from its document frequency and m from the
document's length.  For each item and shard, lists are ordered by their bound
in the shard (the largest block maximum).  The lists whose bounds together
cannot reach the item's tenth best score so far are not essential: only
documents of the other lists are candidates.  Candidates are then checked
against the remaining lists from the largest bound down; one whose score,
block maximum and remaining bounds stay below the tenth best is rejected
before the block is unpacked.  Heaps are carried from shard to shard within a
task, and the tasks' heaps are merged.

Items are worked off in slices of at most about ``SLICE_BYTES`` of text, which
bounds what is sent to the tasks; each slice reads the index once.

Defined cases: a null text has no terms; a document without terms is in no
list and does not count towards N; a document may be of any length (it is
counted piece by piece, and one longer than a shard is a shard of its own);
rows with a null doc_id count towards the statistics and stand last among
equal scores; repeated rows of documents are documents of their own; rows that
share an item_id are one item, with the smallest text; a null item_id is an
item like any other; equal scores stand by ascending doc_id, and equal rows
beyond that in any order; extra columns are ignored; empty tables give an
empty result.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.blocks import spread, squeeze
from tessera.llm.common import cut

SHARD_BYTES = 16 << 20
PIECE = 4 << 20              # bytes of one text counted at a time
BLOCK = 128                  # postings of a block
WINDOW = 4096                # documents of a shard scored at a time
SLICE_BYTES = 4 << 20        # text of the items worked off at a time
NO_ID = 2**63 - 1            # order of a null doc_id

# Letters and digits of ASCII and every byte of other characters are kept, A-Z lowered.
_KEEP = bytes((b if b >= 0x80 or chr(b).isalnum() else 0x20) for b in range(256))
TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in _KEEP)


def term_counts(text: str | None) -> Counter:
    """Occurrences of each term (as UTF-8) of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass").translate(TERMS)
    counts, at = Counter(), 0
    while at < len(raw):
        end = len(raw) if len(raw) - at <= PIECE else raw.find(b" ", at + PIECE)
        end = len(raw) if end < 0 else end
        counts.update(raw[at:end].split())
        at = end + 1
    return counts


# ------------------------------------------------------------------- index
def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values below 2**35 as 7-bit groups, low ones first, the last with its
    high bit set; and the end offset of each."""
    size = np.ones(len(values), np.int64)
    for k in range(1, 5):
        size += values >= 1 << (7 * k)
    ends = np.cumsum(size)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint8)
    starts = ends - size
    for k in range(5):
        has = np.flatnonzero(size > k)
        out[starts[has] + k] = (values[has] >> (7 * k)) & 0x7F
    out[ends - 1] |= 0x80
    return out, ends


def unvarint(data: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(data & 0x80)
    if len(last) == len(data):
        return (data & 0x7F).astype(np.int64)
    first = np.empty_like(last)
    first[:1], first[1:] = 0, last[:-1] + 1
    shift = (np.arange(len(data)) - np.repeat(first, last - first + 1)) * 7
    return np.add.reduceat((data & 0x7F).astype(np.int64) << shift, first)


FIELDS = ["ids", "lens", "terms", "df", "firsts", "last", "doc_ends", "tf_ends", "pair_ends", "pair_tf", "pair_len", "docs", "tfs"]
INDEX = "n_docs long, n_terms long, " + ", ".join(f"{f} binary" for f in FIELDS)
_SCHEMA = pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), *((f, pa.binary()) for f in FIELDS)])


def shard_row(ids: list, counts: list[Counter]) -> pa.RecordBatch:
    """One shard: documents are numbered by doc_id within it."""
    order = sorted(range(len(ids)), key=lambda i: NO_ID if ids[i] is None else ids[i])
    ids = np.array([NO_ID if ids[i] is None else ids[i] for i in order], np.int64)
    counts = [counts[i] for i in order]
    lens = np.array([c.total() for c in counts], np.int64)
    names = sorted(set().union(*counts))
    number = {t: i for i, t in enumerate(names)}
    doc = np.repeat(np.arange(len(counts)), [len(c) for c in counts])
    term = np.fromiter((number[t] for c in counts for t in c), np.int64, len(doc))
    tf = np.fromiter((n for c in counts for n in c.values()), np.int64, len(doc))
    del number
    by = np.argsort(term, kind="stable")                     # documents stay in order
    term, doc, tf = term[by], doc[by], tf[by]
    df = np.bincount(term, minlength=len(names))
    start = np.cumsum(df) - df
    place = np.arange(len(term)) - start[term]
    head = place % BLOCK == 0                                # a block begins
    step = np.where(place == 0, doc + 1, np.diff(doc, prepend=0))
    docs, doc_ends = varints(step)
    tfs, tf_ends = varints(tf)
    begins = np.flatnonzero(head)
    stops = np.append(begins[1:], len(term))[:len(begins)] - 1
    block = np.cumsum(head) - 1
    # Pairs of a block by falling tf: one stays if it is shorter than all before.
    length = lens[doc]
    by = np.lexsort((length, -tf, block))
    far = (lens.max() + 1) if len(lens) else 1
    low = length[by] - block[by] * far
    best = np.minimum.accumulate(low)
    keep = np.ones(len(by), bool)
    keep[1:] = low[1:] < best[:-1]
    by = by[keep]
    pairs = np.cumsum(np.bincount(block[by], minlength=len(begins))) if len(begins) else np.zeros(0, np.int64)
    row = [squeeze(ids), squeeze(lens), pa.compress(b" ".join(names), codec="zstd", asbytes=True) if names else b"",
           squeeze(df.astype(np.int32)), squeeze(np.cumsum(-(-df // BLOCK)).astype(np.int32)), squeeze(doc[stops].astype(np.int32)),
           squeeze(doc_ends[stops]), squeeze(tf_ends[stops]), squeeze(pairs), squeeze(tf[by].astype(np.int32)),
           squeeze(length[by]), docs.tobytes(), tfs.tobytes()]
    size = sum(map(len, names)) + max(len(names) - 1, 0)
    row[2] = size.to_bytes(8, "little") + row[2]
    return pa.RecordBatch.from_arrays(
        [pa.array([len(ids)], pa.int64()), pa.array([int(lens.sum())], pa.int64()), *(pa.array([x], pa.binary()) for x in row)], schema=_SCHEMA)


def _index(batches):
    ids, counts, size = [], [], 0
    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            c = term_counts(text.as_py())
            if not c:
                continue
            n = c.total() * 6
            if ids and size + n > SHARD_BYTES:
                yield shard_row(ids, counts)
                ids, counts, size = [], [], 0
            ids.append(doc)
            counts.append(c)
            size += n
    if ids:
        yield shard_row(ids, counts)


def build(docs: DataFrame) -> DataFrame:
    """The index, one row per shard, written to the checkpoint folder."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return cut(rows.mapInArrow(_index, INDEX), "ranked", 1)


def _terms(data: bytes) -> list[bytes]:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True).split(b" ") if size else []


# ------------------------------------------------------------------ search
class Shard:
    """A shard with statistics applied: lists are looked up by term."""

    def __init__(self, row: dict, n: int, total: int):
        self.ids = spread(row["ids"], np.int64)
        self.m8 = 8 * self._m(spread(row["lens"], np.int64), n, total)
        self.names = _terms(row["terms"])
        self.kinds = {f: spread(row[f], kind) for f, kind in (
            ("firsts", np.int32), ("last", np.int32), ("doc_ends", np.int64), ("tf_ends", np.int64), ("pair_ends", np.int64), ("pair_tf", np.int32))}
        self.pair_m8 = 8 * self._m(spread(row["pair_len"], np.int64), n, total)
        self.docs, self.tfs = (np.frombuffer(row[f], np.uint8) for f in ("docs", "tfs"))
        self.lists = {}

    @staticmethod
    def _m(length: np.ndarray, n: int, total: int) -> np.ndarray:
        return 25 + (75 * length * n) // total

    def find(self, term: bytes) -> "Postings | None":
        if term not in self.lists:
            from bisect import bisect_left
            i = bisect_left(self.names, term)
            self.lists[term] = Postings(self, i) if i < len(self.names) and self.names[i] == term else None
        return self.lists[term]


def impact(tf: np.ndarray, m8: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + m8)


class Postings:
    """One list: block maxima at hand, blocks unpacked on demand."""

    def __init__(self, shard: Shard, i: int):
        k = shard.kinds
        self.shard, self.a, self.b = shard, int(k["firsts"][i - 1]) if i else 0, int(k["firsts"][i])
        self.last = k["last"][self.a:self.b]
        lo = int(k["pair_ends"][self.a - 1]) if self.a else 0
        ends = k["pair_ends"][self.a:self.b]
        hi = int(ends[-1])
        score = impact(k["pair_tf"][lo:hi].astype(np.int64), shard.pair_m8[lo:hi])
        self.block_max = np.maximum.reduceat(score, np.append(lo, ends[:-1]) - lo)
        self.max = int(self.block_max.max())

    def unpack(self, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and term scores of blocks i up to j."""
        k, a = self.shard.kinds, self.a
        data = []
        for stream, ends in ((self.shard.docs, k["doc_ends"]), (self.shard.tfs, k["tf_ends"])):
            lo = int(ends[a + i - 1]) if a + i else 0
            data.append(unvarint(stream[lo:int(ends[a + j - 1])]))
        docs = np.cumsum(data[0]) + (int(self.last[i - 1]) if i else -1)
        return docs, impact(data[1], self.shard.m8[docs])


class Heap:
    """The k best (score, doc_id) of an item so far; a rejected document has a
    score strictly below ``floor``."""

    def __init__(self, k: int):
        self.k, self.score, self.id = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def floor(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        best = np.lexsort((ids, -score))[:self.k]
        self.score, self.id = score[best], ids[best]


def search_shard(shard: Shard, query: list[tuple[bytes, int]], heap: Heap) -> None:
    """``query``: terms and their weights (w times repeats)."""
    lists = sorted(((weight * p.max, weight, p) for term, weight in query if (p := shard.find(term)) is not None), key=lambda x: x[0])
    upto = np.cumsum([b for b, _, _ in lists]).tolist()           # bounds of the lists up to each
    if not lists or upto[-1] < heap.floor:
        return
    for low in range(0, len(shard.ids), WINDOW):
        high = min(low + WINDOW, len(shard.ids))
        cut_at = next((i for i, b in enumerate(upto) if b >= heap.floor), len(lists))
        if cut_at == len(lists):
            return
        scores = np.zeros(high - low, np.int64)
        for _, weight, p in lists[cut_at:]:                       # essential lists
            i, j = np.searchsorted(p.last, (low, high - 1))
            if i == len(p.last):
                continue
            docs, s = p.unpack(int(i), min(int(j) + 1, len(p.last)))
            inside = slice(*np.searchsorted(docs, (low, high)))
            scores[docs[inside] - low] += weight * s[inside]
        c = np.flatnonzero(scores)
        for at in range(cut_at - 1, -1, -1):
            _, weight, p = lists[at]
            floor = heap.floor
            c = c[scores[c] + upto[at] >= floor]
            block = np.searchsorted(p.last, c + low)
            there = block < len(p.last)
            most = np.where(there, weight * p.block_max[np.minimum(block, len(p.last) - 1)], 0)
            fine = scores[c] + most + (upto[at - 1] if at else 0) >= floor
            c, block, there = c[fine], block[fine], there[fine]
            need = np.unique(block[there])
            # Runs of neighbouring blocks are unpacked together.
            for run in np.split(need, np.flatnonzero(np.diff(need) > 1) + 1) if len(need) else ():
                docs, s = p.unpack(int(run[0]), int(run[-1]) + 1)
                asked = c[there & (block >= run[0]) & (block <= run[-1])]
                where = np.minimum(np.searchsorted(docs, asked + low), len(docs) - 1)
                hit = docs[where] == asked + low
                scores[asked[hit]] += weight * s[where[hit]]
        c = c[scores[c] >= heap.floor]
        heap.add(scores[c], shard.ids[c + low])


FOUND = "item int, doc_id long, score long"


def _search(queries: list[list[tuple[bytes, int]]], n: int, total: int, k: int):
    def run(batches):
        heaps = [Heap(k) for _ in queries]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard({f: batch.column(f)[i].as_py() for f in FIELDS}, n, total)
                for query, heap in zip(queries, heaps, strict=True):
                    search_shard(shard, query, heap)
        for i, heap in enumerate(heaps):
            if len(heap.id):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(heap.id), i, np.int32)), pa.array(heap.id), pa.array(heap.score)], names=["item", "doc_id", "score"])
    return run


def _frequencies(wanted: frozenset):
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                names, df = _terms(batch.column(0)[i].as_py()), spread(batch.column(1)[i].as_py(), np.int32)
                at = [j for j, t in enumerate(names) if t in wanted]
                yield pa.RecordBatch.from_arrays([pa.array([names[j] for j in at], pa.binary()), pa.array(df[at].astype(np.int64))], names=["term", "df"])
    return run


def rank(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each item."""
    spark = docs.sparkSession
    index = build(docs)
    n, total = (int(x or 0) for x in index.agg(F.sum("n_docs"), F.sum("n_terms")).first())
    # One text per item_id; the digest deals items over the slices.
    asked = cut(items.groupBy(F.col("item_id")).agg(F.min(F.col("text").cast("string")).alias("text"))
                .where("text IS NOT NULL").select("item_id", "text", F.xxhash64("item_id").alias("h")), "items")
    slices = max(1, -(-2 * int(asked.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0) // SLICE_BYTES))
    out = f"item_id {dict(items.dtypes)['item_id']}, item int"
    found = None
    for part in range(slices if total else 0):
        rows = sorted(asked.where(F.pmod("h", F.lit(slices)) == part).collect(), key=lambda r: (r.item_id is None, r.item_id))
        counts = [term_counts(r.text) for r in rows]
        df = {bytes(r.term): r.df for r in index.select("terms", "df").mapInArrow(
            _frequencies(frozenset().union(*counts)), "term binary, df long").groupBy("term").agg(F.sum("df").alias("df")).collect()}
        weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for t, f in df.items()}
        queries = [[(t, weight[t] * x) for t, x in sorted(c.items()) if weight.get(t, 0) > 0] for c in counts]
        best = index.mapInArrow(_search(queries, n, total, k), FOUND)
        named = spark.createDataFrame([(r.item_id, i) for i, r in enumerate(rows)], out)
        # At most k rows of each task and item meet here.
        one = cut(best.join(F.broadcast(named), "item").select("item_id", "doc_id", "score"), "ranked-found")
        found = one if found is None else found.union(one)
    if found is None:
        return spark.createDataFrame([], f"item_id {dict(items.dtypes)['item_id']}, rank int, doc_id long, score long")
    by = Window.partitionBy("item_id").orderBy(F.desc("score"), "doc_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k) \
        .select("item_id", "rank", F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "score")
