"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its words (runs of letters and digits, A-Z lowered), their
beginnings of 6 and 8 bytes, and both again where they come twice or three
times, hashed to 2**18 slots.  The machine scores

    w0 + sum_j w_j x_j + sum_{j<k} <v_j, v_k> x_j x_k

with x_j = 1 for a present term: the factors learn that two terms together
mean what neither means alone, for instance an insult next to the mention of a
group, or a rare word next to further rare words of the same stem.

Training reads at most ``max_rows`` labelled rows (the smallest hashes of
their doc_id; the bound keeps the broadcast of their ids, and the fit, of
fixed size).  Of all slots the ``n_terms`` with the largest likelihood-ratio
statistic enter the machine, which is fitted by Adam on mini-batches; the seed
and the order of rows are fixed, so reruns agree.  Scoring reads every whole
text in one pass without a shuffle.

Defined cases: a null or empty text has no terms and scores the bias; rows
with a null doc_id are scored, never learned from; a doc_id with several
labels has their majority (a tie: toxic); of the rows that share a doc_id the
smallest text is learned from, all are scored; texts of any length are read
whole, one at a time; without labelled rows, or with only
one class among them, every text scores the smoothed share of toxic rows;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, below_hash, cut, mix, powers, prefix_hash, sorted_unique

SLOTS = 1 << 18
PREFIXES = (6, 8)
MAX_ROWS = 20_000
N_TERMS = 2048
FACTORS = 8

# Bytes of words: letters, digits and all of multi-byte characters.
WORD = np.zeros(256, bool)
WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def terms(text: str | None) -> np.ndarray:
    """Sorted distinct slots of a text's terms."""
    if not text:
        return np.zeros(0, np.int64)
    buf = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(LOWER), np.uint8)
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = WORD[buf]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    p = prefix_hash(buf)
    up, _ = powers(len(buf) + 1)
    found = []
    for kind, stop in enumerate((ends, *(starts + n for n in PREFIXES))):
        long = stop <= ends
        a, b = starts[long], stop[long]
        h, n = np.unique(mix((p[b] - p[a]) * up[a] + np.uint64(kind)), return_counts=True)
        found += [h, *(mix(h[n >= times] + np.uint64(times)) for times in (2, 3))]
    return sorted_unique(np.concatenate(found) >> np.uint64(64 - 18)).astype(np.int64)


class Machine:
    """Fitted parameters: position of a slot among the terms, weights, factors."""

    def __init__(self, slots, w0, w, v):
        self.place = np.full(SLOTS, -1, np.int32)
        self.place[slots] = np.arange(len(slots))
        self.w0, self.w, self.v = float(w0), w, v

    def score(self, text: str | None) -> float:
        j = self.place[terms(text)]
        j = j[j >= 0]
        v = self.v[j]
        s = v.sum(axis=0)
        z = self.w0 + float(self.w[j].sum()) + 0.5 * float((s * s - (v * v).sum(axis=0)).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def select_slots(a: np.ndarray, total: np.ndarray, n1: int, n0: int, n_terms: int) -> np.ndarray:
    """The slots that tell the classes apart most (likelihood ratio), from the
    toxic rows and all rows that hold each slot."""
    b, n = total - a, n0 + n1
    with np.errstate(divide="ignore", invalid="ignore"):
        def part(seen, expected):
            return np.where(seen > 0, seen * np.log(seen / expected), 0.0)
        g = part(a, total * n1 / n) + part(b, total * n0 / n) \
            + part(n1 - a, (n - total) * n1 / n) + part(n0 - b, (n - total) * n0 / n)
    g[total < 3] = 0
    best = np.argsort(-g, kind="stable")[:n_terms]
    return np.sort(best[g[best] > 0])


def fit(places: list[np.ndarray], y: np.ndarray, chosen: np.ndarray, factors: int = FACTORS, steps: int = 4000,
        seed: int = 5) -> Machine:
    """From each row's terms, as positions among the chosen slots."""
    y = np.asarray(y, np.float64)
    share = (y.sum() + 0.5) / (len(y) + 1)
    if not 0 < y.sum() < len(y):
        return Machine(np.zeros(0, np.int64), np.log(share / (1 - share)), np.zeros(0), np.zeros((0, factors)))
    x = np.zeros((len(y), len(chosen)), np.uint8)
    for i, p in enumerate(places):
        x[i, p] = 1
    rng = np.random.default_rng(seed)
    params = [np.array([np.log(share / (1 - share))], np.float32), np.zeros(len(chosen), np.float32),
              rng.normal(0, 0.02, (len(chosen), factors)).astype(np.float32)]
    m, s, t = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(max(10, -(-steps * 256 // len(y)))):
        order = rng.permutation(len(y))
        for i in range(0, len(order), 256):
            pick = order[i:i + 256]
            xb = x[pick].astype(np.float32)
            w0, w, v = params
            sv = xb @ v
            z = w0 + xb @ w + 0.5 * (sv * sv - xb @ (v * v)).sum(axis=1)
            e = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y[pick].astype(np.float32)) / np.float32(len(pick))
            ex = xb.T * e
            grad = [e.sum(keepdims=True), ex.sum(axis=1) + 1e-5 * w, ex @ sv - v * ex.sum(axis=1)[:, None] + 1e-4 * v]
            t += 1
            for k, g in enumerate(grad):
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                params[k] = params[k] - 0.01 * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
    return Machine(chosen, params[0][0], params[1].astype(np.float64), params[2].astype(np.float64))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Rows kept from learning: crc32 of the id's text in one residue class."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def labelled_ids(labels: DataFrame, label: str, folds: int, fold: int, max_rows: int, only: int | None = None) -> DataFrame:
    """At most ``max_rows`` (doc_id, y) to learn from, by smallest hash."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id"), folds, fold)) \
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg(F.col(label).cast("int")) >= 0.5).cast("int").alias("y"))
    if only is not None:
        rows = rows.where(F.col("y") == only)
    h = F.xxhash64("doc_id")
    return below_hash(rows, h, max_rows, rows.count()).orderBy(h, "doc_id").limit(max_rows)


def _terms(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array([terms(t).astype(np.int32).tobytes() for t in batch.column(2).to_pylist()], pa.binary())],
            names=["doc_id", "y", "terms"])


def _slot_counts(batches):
    """Rows, and toxic rows, of a task that hold each slot."""
    total, toxic = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
    for batch in batches:
        for y, t in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
            slots = np.frombuffer(t.as_py(), np.int32)
            total[slots] += 1
            toxic[slots] += y
    on = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(on), pa.array(total[on]), pa.array(toxic[on])], names=["slot", "total", "toxic"])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 3, fold: int = 1,
          max_rows: int = MAX_ROWS, n_terms: int = N_TERMS) -> Machine:
    # The ids are broadcast: at most max_rows rows of two numbers.
    ids = F.broadcast(labelled_ids(labels, label, folds, fold, max_rows))
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .join(ids, "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).mapInArrow(_terms, "doc_id long, y int, terms binary")
    rows = cut(sample, "toxic-terms")
    # The driver gets SLOTS rows of counts at most, and of each sample row
    # only the chosen terms.
    counts = rows.mapInArrow(_slot_counts, "slot long, total long, toxic long") \
        .groupBy("slot").agg(F.sum("total").alias("total"), F.sum("toxic").alias("toxic")).toArrow()
    total, toxic = np.zeros(SLOTS), np.zeros(SLOTS)
    slots = counts["slot"].to_numpy()
    total[slots], toxic[slots] = counts["total"].to_numpy(), counts["toxic"].to_numpy()
    of = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    chosen = select_slots(toxic, total, of.get(1, 0), of.get(0, 0), n_terms) if of.get(0) and of.get(1) else np.zeros(0, np.int64)
    place = np.full(SLOTS, -1, np.int32)
    place[chosen] = np.arange(len(chosen))

    def narrow(batches):
        for batch in batches:
            found = [place[np.frombuffer(t.as_py(), np.int32)] for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([p[p >= 0].astype(np.int32).tobytes() for p in found], pa.binary())],
                names=["doc_id", "y", "places"])

    table = rows.mapInArrow(narrow, "doc_id long, y int, places binary").toArrow()
    sample = sorted(zip(table["doc_id"].to_pylist(), table["places"].to_pylist(), table["y"].to_pylist(), strict=True))
    return fit([np.frombuffer(p, np.int32) for _, p, _ in sample], np.array([y for *_, y in sample]), chosen)


def score(docs: DataFrame, machine: Machine, folds: int = 3, fold: int = 1, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([machine.score(t) for t in batch.column(1).to_pylist()], pa.float64())],
                names=["doc_id", "score"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, machine: Machine, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, all columns."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            keep = [machine.score(t) < threshold for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(docs, labels))
