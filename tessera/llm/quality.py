"""Quality by positive-unlabelled learning.

Trusted good documents are the positives; the rest of the corpus is unlabelled
and known to hold good and bad ones.  With class prior pi and logistic loss l,
the fitted function g minimises the non-negative unbiased risk

    pi E_p[l(g)] + max(0, E_u[l(-g)] - pi E_p[l(-g)])

(where the second term goes below zero, a step is taken to raise it again).
The prior is estimated from the same samples: a first function tells positives
from unlabelled texts; above a threshold where few bad documents are left, the
unlabelled share is pi times the positive share.  The smallest such ratio over
the thresholds that keep nine in ten positives, less two standard errors,
estimates pi: too large a prior makes bad documents look good, too small a one
costs little.

Texts are described by shares that need no language: letters, case, digits,
marks, repetition of words, lines and word pairs, lengths.  g is a network
with one small hidden layer; the score is its logistic value.

The fit reads at most ``max_rows`` positives and ``max_rows`` unlabelled rows
(smallest hashes of their doc_id, one row of each doc_id).  Features and scores
cover every whole text, one at a time; neither step shuffles.

Defined cases: a null or empty text has all features 0 and gets a score like
any other; rows with a null doc_id are scored; a doc_id with several labels
has their majority (a tie: good); without positives, or without documents to
compare them with, every text scores 0.5; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import below_hash, cut, grams, sorted_unique, span_hash, word_spans
from tessera.llm.toxicity import held_out, labelled_ids

MAX_ROWS = 20_000
HIDDEN = 16
BATCH = 1024         # of each sample per step: keeps the sign of the risk steady

_CLASS = np.zeros(256, np.int8)          # 0 other marks
_CLASS[0x61:0x7B] = 1                    # a-z
_CLASS[0x41:0x5B] = 2                    # A-Z
_CLASS[0x30:0x3A] = 3                    # digits
_CLASS[0x80:] = 4                        # multi-byte
_CLASS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 5
_CLASS[[0x2C, 0x2E]] = 6                 # comma, full stop

FEATURES = 20


def features(text: str | None) -> np.ndarray:
    """FEATURES numbers of moderate size that describe a text."""
    out = np.zeros(FEATURES)
    if not text:
        return out
    buf = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    kind = _CLASS[buf]
    share = np.bincount(kind, minlength=7) / len(buf)
    starts, ends = word_spans(buf)
    out[:7] = share
    out[7] = np.log1p(len(buf)) / 10
    n = len(starts)
    if not n:
        return out
    length = ends - starts
    total = np.concatenate([np.zeros((1, 7), np.int64), np.cumsum(kind[:, None] == np.arange(7), axis=0)])
    by_word = total[ends] - total[starts]
    h = span_hash(buf, starts, ends)
    pairs = grams(h, 2)
    _, times = np.unique(h, return_counts=True)
    new_pairs = len(sorted_unique(pairs)) / len(pairs) if len(pairs) else 1.0
    breaks = np.flatnonzero(buf == 0x0A)
    lines = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(buf)]])
    lh = span_hash(buf, *lines)
    out[8] = np.log1p(n) / 10
    out[9] = length.mean() / 10
    out[10] = length.std() / 10
    out[11] = (length == 1).mean()
    out[12] = (by_word[:, 0] >= 2).mean()                                   # words with several marks
    out[13] = ((by_word[:, 0] == length) & (length == 1)).mean()            # single marks
    out[14] = ((by_word[:, 2] >= 2) & (by_word[:, 1] == 0)).mean()          # words in capitals
    out[15] = (h[1:] == h[:-1]).mean() if n > 1 else 0.0                    # the word before again
    out[16] = len(times) / n ** 0.9
    out[17] = times.max() / n
    out[18] = 1 - new_pairs
    out[19] = 1 - len(sorted_unique(lh)) / len(lh)
    return out


class Model:
    """Standardised features -> one hidden layer -> one number."""

    def __init__(self, mean, scale, params):
        self.mean, self.scale, self.params = mean, scale, params

    def value(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.params
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        return np.tanh(z @ a + b) @ c + d[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.value(x), -40, 40)))


def _sigma(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _fit(p: np.ndarray, u: np.ndarray, prior: float | None, steps: int, seed: int) -> Model:
    """prior None: tell positives from unlabelled; else the non-negative risk."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([p, u])
    model = Model(both.mean(axis=0), both.std(axis=0) + 1e-6,
                  [rng.normal(0, 0.3, (FEATURES, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.3, HIDDEN), np.zeros(1)])
    p, u = (np.clip((x - model.mean) / model.scale, -6, 6) for x in (p, u))
    m, s = [np.zeros_like(x) for x in model.params], [np.zeros_like(x) for x in model.params]
    for t in range(1, steps + 1):
        xp, xu = p[rng.integers(0, len(p), BATCH)], u[rng.integers(0, len(u), BATCH)]
        x = np.concatenate([xp, xu])
        a, b, c, d = model.params
        hidden = np.tanh(x @ a + b)
        g = hidden @ c + d[0]
        gp, gu = g[:BATCH], g[BATCH:]
        # d l(g) = sigma(g) - 1, d l(-g) = sigma(g); per sample and weight.
        if prior is None:
            e = np.concatenate([(_sigma(gp) - 1) / (2 * BATCH), _sigma(gu) / (2 * BATCH)])
        else:
            low = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
            if low >= 0:
                e = np.concatenate([prior * (_sigma(gp) - 1) - prior * _sigma(gp), _sigma(gu)]) / BATCH
            else:
                e = -np.concatenate([-prior * _sigma(gp), _sigma(gu)]) / BATCH
        back = (e[:, None] * c) * (1 - hidden * hidden)
        grad = [x.T @ back + 1e-4 * a, back.sum(axis=0), hidden.T @ e + 1e-4 * c, np.array([e.sum()])]
        rate = 5e-3 * (1 - 0.9 * t / steps)
        for k, gr in enumerate(grad):
            m[k] = 0.9 * m[k] + 0.1 * gr
            s[k] = 0.999 * s[k] + 0.001 * gr * gr
            model.params[k] = model.params[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
    return model


def estimate_prior(p: np.ndarray, u: np.ndarray, seed: int = 3, steps: int = 1000) -> float:
    """Share of positives among unlabelled rows.  Half of each sample fits the
    function that orders them, the other half measures the shares."""
    model = _fit(p[::2], u[::2], None, steps, seed)
    vp, vu = np.sort(model.value(p[1::2])), np.sort(model.value(u[1::2]))
    if not len(vp) or not len(vu):
        return 0.5
    at = np.quantile(vp, np.linspace(0.002, 0.1, 50))
    keep_p = 1 - np.searchsorted(vp, at) / len(vp)
    keep_u = 1 - np.searchsorted(vu, at) / len(vu)
    ratio = (keep_u / keep_p).min()
    error = np.sqrt(max(ratio * (1 - ratio), 0) / len(vu))
    return float(np.clip(ratio - 2 * error, 0.05, 0.98))


def fit(p: np.ndarray, u: np.ndarray, prior: float | None = None, steps: int = 2000, seed: int = 11) -> Model:
    if len(p) < 2 or len(u) < 2:
        return Model(np.zeros(FEATURES), np.ones(FEATURES),
                     [np.zeros((FEATURES, 1)), np.zeros(1), np.zeros(1), np.zeros(1)])
    return _fit(p, u, estimate_prior(p, u) if prior is None else prior, steps, seed)


def _features(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array([features(t).tolist() for t in batch.column(1).to_pylist()], pa.list_(pa.float64()))],
            names=["doc_id", "x"])


def describe(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_features, "doc_id long, x array<double>")


def train(described: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, fold: int = 0,
          max_rows: int = MAX_ROWS) -> Model:
    """From described rows: at most ``max_rows`` positives and as many of all."""
    # At most max_rows ids are broadcast, and one row of each is learned from.
    ids = F.broadcast(labelled_ids(labels, label, folds, fold, max_rows, only=1).select("doc_id"))
    positive = described.join(ids, "doc_id").groupBy("doc_id").agg(F.min("x").alias("x")).collect()
    h = F.xxhash64(F.lit(1), "doc_id")
    some = below_hash(described.where("doc_id IS NOT NULL"), h, max_rows, described.count())
    unlabelled = some.groupBy("doc_id").agg(F.min("x").alias("x")).orderBy(h, "doc_id").limit(max_rows).collect()
    p, u = (np.array([r.x for r in sorted(rows, key=lambda r: (r.doc_id, r.x))]).reshape(-1, FEATURES) for rows in (positive, unlabelled))
    return fit(p, u)


def score(described: DataFrame, model: Model, folds: int = 5, fold: int = 0, threshold: float = 0.3) -> DataFrame:
    def run(batches):
        for batch in batches:
            x = np.asarray(batch.column(1).values, np.float64).reshape(batch.num_rows, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=["doc_id", "score"])

    out = described.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    described = cut(describe(docs), "features")
    return score(described, train(described, labels))
