"""Hard negatives by length buckets and coordinate pruning.

Vectors become integer vectors, floor(256 * x), and a row's score for an anchor
is the integer inner product.  An anchor's positives are its best rows of the
same label; its negatives for a positive are the best rows of another label
whose score lies between 50 and 95 per cent of the positive's.

Buckets.  Rows are range partitioned by dimension and vector length and packed
into buckets of at most ``BUCKET`` rows of similar length.  A bucket keeps, for
every coordinate, its rows in order of that coordinate of the vector scaled to
length one.

Search.  An anchor needs rows that score at least some bound t.  In a bucket
whose longest row has length l that is a cosine of at least t / (|a| * l); a
bucket where this exceeds one is passed over.  Otherwise a row of that cosine c
can differ only so much from the anchor in any coordinate: with the anchor's
scaled value q, it lies between q*c - r and q*c + r with
r = sqrt((1 - q*q) * (1 - c*c)).  These feasible ranges are looked up in the
sorted lists of the anchor's ``FOCUS`` largest coordinates, the candidate sets
are intersected, and what is left is verified by integer inner products.  The
bounds rise with the best rows found so far, within a task from bucket to
bucket.  Where cosines are low, the ranges are wide and most rows are verified:
the work grows with anchors times rows then, in blocks.

The positives are found by a first pass over the buckets; the second takes
their scores as ranges.  Anchors are worked off in blocks of about ``ANCHORS``
rows, which bounds what is sent to the tasks.

Defined cases: rows with a null vec_id, label or vector, or a null or
non-finite component take no part; vectors (also empty ones) are compared
within their dimension only; a zero vector scores zero with everything; of
rows that share a vec_id, an anchor is the one with the smallest (label,
vector), never meets its own vec_id, and meets another vec_id once, with its
best score; ties go to the smaller vec_id; a positive score of zero admits
scores of zero, one below zero admits none; fewer rows
than asked for give fewer rows; scores are 64-bit integers; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut

BUCKET = 2048
ANCHORS = 8192               # anchors sent to the tasks at a time
FOCUS = 4                    # coordinates looked up for an anchor
SLACK = 1e-9                 # widens feasible ranges beyond rounding errors

BUCKETS = "dim int, ids binary, labels binary, rows binary, order binary"
NONE = -(2**62)


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id, label (noisy where vec_id is divisible by 7), v (long array)."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite) \
        .select(F.col("vec_id").cast("long").alias("vec_id"), label.alias("label"),
                F.transform(v, lambda x: F.floor(256 * x).cast("long")).alias("v"))


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of length one (zero rows stay) and lengths."""
    y = x.astype(np.float64)
    most = np.abs(y).max(axis=1, initial=0.0)
    y /= np.where(most > 0, most, 1)[:, None]
    length = np.sqrt((y * y).sum(axis=1))
    return y / np.where(length > 0, length, 1)[:, None], length * most


def _buckets(batches):
    schema = pa.schema([("dim", pa.int32()), *((k, pa.binary()) for k in ("ids", "labels", "rows", "order"))])
    for batch in batches:
        ids, labels = (batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1))
        base = batch.column(2).offsets.to_numpy()
        flat = batch.column(2).values.to_numpy(zero_copy_only=False)
        dims = np.diff(base)
        for d in np.unique(dims):
            at = np.flatnonzero(dims == d)
            for i in range(0, len(at), BUCKET):
                part = at[i:i + BUCKET]
                x = flat[base[part][:, None] + np.arange(d)].astype(np.int64).reshape(len(part), d)
                order = np.argsort(scaled(x)[0], axis=0).T.astype(np.uint16)
                yield pa.RecordBatch.from_pylist([{"dim": int(d), "ids": ids[part].tobytes(), "labels": labels[part].tobytes(),
                                                   "rows": x.tobytes(), "order": order.tobytes()}], schema=schema)


def build(rows: DataFrame) -> DataFrame:
    """Rows by dimension and length, packed into buckets; rows of one length
    are spread over the range by a hash of the vec_id."""
    size = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return cut(cut(rows, "vectors").repartitionByRange(F.size("v"), size, F.xxhash64("vec_id"))
               .sortWithinPartitions(F.size("v"), size).mapInArrow(_buckets, BUCKETS), "buckets", BUCKET)


class Bucket:
    def __init__(self, ids, labels, rows, order, d: int):
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.rows = np.frombuffer(rows, np.int64).reshape(len(self.ids), d)
        self.order = np.frombuffer(order, np.uint16).reshape(d, len(self.ids))
        unit, length = scaled(self.rows)
        self.length = float(length.max(initial=0.0))
        self.lists = np.take_along_axis(unit.T, self.order.astype(np.int64), axis=1)

    def candidates(self, unit: np.ndarray, focus: np.ndarray, length: float, least: int) -> np.ndarray | None:
        """Rows that may score at least ``least``; None for all."""
        if least <= 0 or not length * self.length:
            return None if least <= 0 else np.zeros(0, np.int64)
        cosine = least / (length * self.length)
        if cosine > 1 + SLACK:
            return np.zeros(0, np.int64)
        cosine = min(cosine, 1.0)
        q = unit[focus]
        reach = np.sqrt(np.maximum(1 - q * q, 0) * (1 - cosine * cosine)) + SLACK
        # A row may be closer than the bound: up to the anchor's own direction the range stays open.
        low = np.where(q <= -cosine, -np.inf, q * cosine - reach)
        high = np.where(q >= cosine, np.inf, q * cosine + reach)
        spans = [(int(np.searchsorted(self.lists[f], a)), int(np.searchsorted(self.lists[f], b, side="right")), f)
                 for f, a, b in zip(focus, low, high, strict=True)]
        spans = sorted((s for s in spans if s[1] - s[0] < len(self.ids)), key=lambda s: s[1] - s[0])
        if not spans:
            return None
        i, j, f = spans[0]
        found = self.order[f, i:j]
        for i, j, f in spans[1:]:
            if not len(found):
                break
            inside = np.zeros(len(self.ids), bool)
            inside[self.order[f, i:j]] = True
            found = found[inside[found]]
        return found.astype(np.int64)


def best(ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best distinct ids, best first, ties by the smaller id."""
    order = np.lexsort((ids, -score))
    ids, score = ids[order], score[order]
    if len(ids) > 1:
        _, first = np.unique(ids, return_index=True)
        if len(first) < len(ids):
            first.sort()
            ids, score = ids[first], score[first]
    return ids[:k], score[:k]


class Wanted:
    """What one anchor looks for: k rows of a label test within [low, high]."""

    def __init__(self, low: int, high: int | None, k: int):
        self.low, self.high, self.k = low, high, k
        self.ids, self.score = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        return max(self.low, int(self.score[-1])) if len(self.score) == self.k else self.low

    def add(self, ids: np.ndarray, score: np.ndarray) -> None:
        keep = score >= self.least
        if self.high is not None:
            keep &= score <= self.high
        if keep.any():
            self.ids, self.score = best(np.concatenate([self.ids, ids[keep]]), np.concatenate([self.score, score[keep]]), self.k)


class Anchors:
    """Anchors of one dimension and what each looks for."""

    def __init__(self, ids, labels, vectors, wanted, same: bool):
        self.ids, self.labels, self.same = ids, labels, same
        self.x = np.array(vectors, np.int64).reshape(len(ids), -1)
        self.unit, self.length = scaled(self.x)
        self.focus = np.argsort(-np.abs(self.unit), axis=1)[:, :FOCUS]
        self.wanted = wanted                                     # per anchor: (low, high, k) triples

    def scan(self, bucket: Bucket, state: list[list[Wanted]]) -> None:
        # Inner products of whole numbers are exact in doubles below 2**53.
        top = np.abs(bucket.rows).max(initial=0) * np.abs(self.x).max(initial=0)
        exact = float(top) * self.x.shape[1] < 2**53
        rows = bucket.rows.astype(np.float64) if exact else bucket.rows
        asked = self.x.astype(np.float64) if exact else self.x
        for i, wanted in enumerate(state):
            if not wanted:
                continue
            at = bucket.candidates(self.unit[i], self.focus[i], float(self.length[i]), min(w.least for w in wanted))
            score = (rows if at is None else rows[at]) @ asked[i]
            at = np.arange(len(rows)) if at is None else at
            fit = (bucket.labels[at] == self.labels[i]) == self.same
            fit &= bucket.ids[at] != self.ids[i]
            fit &= score >= min(w.least for w in wanted)
            at, score = at[fit], score[fit].astype(np.int64)
            if len(at):
                for w in wanted:
                    w.add(bucket.ids[at], score)


FOUND = "anchor_id long, slot int, vec_id long, score long"


def _search(groups: dict[int, Anchors]):
    def run(batches):
        state = {d: [[Wanted(*w) for w in ws] for ws in g.wanted] for d, g in groups.items()}
        for batch in batches:
            for n in range(batch.num_rows):
                d = batch.column(0)[n].as_py()
                if d in groups:
                    groups[d].scan(Bucket(*(batch.column(k)[n].as_py() for k in range(1, 5)), d), state[d])
        for d, g in groups.items():
            for anchor, wanted in zip(g.ids, state[d], strict=True):
                for slot, w in enumerate(wanted):
                    if len(w.ids):
                        n = len(w.ids)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, anchor)), pa.array(np.full(n, slot, np.int32)), pa.array(w.ids), pa.array(w.score)],
                            names=["anchor_id", "slot", "vec_id", "score"])
    return run


def _groups(rows, ranges: dict[int, list] | None, k: int, same: bool) -> dict[int, Anchors]:
    out = {}
    for d in sorted({len(r.v) for r in rows}):
        part = [r for r in rows if len(r.v) == d]
        wanted = [[(NONE, None, k)] if ranges is None else [(*span, k) for span in ranges.get(r.vec_id, ())] for r in part]
        out[d] = Anchors(np.array([r.vec_id for r in part], np.int64), np.array([r.label for r in part], np.int64),
                         [r.v for r in part], wanted, same)
    return out


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of each anchor and slot over all tasks."""
    one = found.groupBy("anchor_id", "slot", "vec_id").agg(F.max("score").alias("score"))
    by = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return one.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3,
                   low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score for the rows of ``anchors`` against those of ``vectors``."""
    spark = vectors.sparkSession
    buckets = build(integers(vectors))
    asked = cut(integers(anchors).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.*"), "anchors")
    blocks = max(1, -(-2 * asked.count() // ANCHORS))
    found = None
    for part in range(blocks):
        rows = sorted(asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == part).collect(), key=lambda r: r.vec_id)
        first = cut(_merged(buckets.mapInArrow(_search(_groups(rows, None, positives, True)), FOUND), positives), "positives")
        # low * positive score <= 100 * score <= high * positive score, in whole numbers.
        spans: dict[int, dict[tuple[int, int], int]] = {}
        for r in first.select("anchor_id", "score").collect():       # at most ``positives`` rows of each anchor of the block
            a, b = -(-low * r.score // 100), high * r.score // 100
            if a <= b:
                spans.setdefault(r.anchor_id, {}).setdefault((a, b), 0)
        ranges = {q: sorted(s) for q, s in spans.items()}
        slots = spark.createDataFrame([(q, i, a, b) for q, s in ranges.items() for i, (a, b) in enumerate(s)],
                                      "anchor_id long, slot int, lo long, hi long")
        second = _merged(buckets.mapInArrow(_search(_groups(rows, ranges, negatives, False)), FOUND), negatives)
        best_of = second.join(F.broadcast(slots), ["anchor_id", "slot"]).select(
            "anchor_id", "lo", "hi", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
        score = F.col("score")
        # A negative score admits nothing; for the others div rounds down.
        pairs = first.where("score >= 0").select(
            "anchor_id", F.col("vec_id").alias("positive_id"), score.alias("positive_score"),
            F.expr(f"({low} * score + 99) div 100").alias("lo"), F.expr(f"({high} * score) div 100").alias("hi"))
        one = cut(pairs.join(best_of, ["anchor_id", "lo", "hi"]).select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"), "negatives")
        found = one if found is None else found.union(one)
    return found
