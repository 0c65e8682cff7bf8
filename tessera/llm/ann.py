"""Nearest neighbours by randomly rotated one-bit codes.

Vectors are scaled to length one and rotated by a fixed random orthogonal
matrix; a code keeps the signs of the rotated coordinates, packed, and one
correction scalar, the inner product c of the vector with its sign vector.
For a rotated query r, <signs, r> / c estimates the cosine, and with high
probability it is off by no more than

    sqrt((1 - c*c) / (c*c)) * EPSILON / sqrt(d - 1).

A scan holds, for each query, the k best exact scores so far.  Of a code block
the k best estimates are reranked with their original components first, which
raises the least of them; then only vectors whose upper bound reaches it are.

Queries are worked off in blocks of at most ``QUERIES`` rows, which bounds what
is sent to the tasks; every block scans the codes once, each task sends its k
best per query, and those are merged.  The rotation depends on the dimension
alone; there is nothing to fit.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part; vectors are compared within their dimension; a vec_id
with several vectors queries with the smallest one and is found by its nearest
one; rows with a null vec_id take no part; fewer candidates than k give fewer
rows; ties go to the smaller vec_id; extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import cut

EPSILON = 2.5
QUERIES = 4096          # queries sent to the tasks at a time
ROWS = 4096             # vectors of a code block
STEP = 64               # queries compared with a code block at a time
PAIRS = 1 << 14         # pairs reranked at a time


def rotation(d: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors scaled by powers of two, so that nothing overflows and no digit
    changes, and their lengths."""
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return x, np.sqrt((x * x).sum(axis=1))


def units(x: np.ndarray) -> np.ndarray:
    x, length = scaled(x)
    return x / length[:, None]


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated unit vectors, and their correction scalars."""
    d = x.shape[1]
    r = units(x) @ rotation(d)
    return np.packbits(r > 0, axis=1), np.abs(r).sum(axis=1) / np.sqrt(d)


def estimates(bits: np.ndarray, c: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines (codes x rotated unit queries) and their error bound."""
    d = queries.shape[1]
    signs = np.unpackbits(bits, axis=1, count=d).astype(np.float32) * 2 - 1
    est = (signs @ queries.T.astype(np.float32)) / (c * np.sqrt(d)).astype(np.float32)[:, None]
    error = np.sqrt(np.maximum(1 - c * c, 0)) / c * EPSILON / np.sqrt(max(d - 1, 1)) + 1e-5
    return est, error.astype(np.float32)[:, None]


CODES = "dim int, ids binary, bits binary, c binary, raw binary"


def _codes(batches):
    """(vec_id, vector) rows -> blocks of codes, by dimension."""
    schema = pa.schema([("dim", pa.int32()), *((k, pa.binary()) for k in ("ids", "bits", "c", "raw"))])
    for whole in batches:
        ids, vectors = whole.column(0).to_numpy(zero_copy_only=False), whole.column(1)
        dims = np.diff(vectors.offsets.to_numpy())
        flat = vectors.values.to_numpy(zero_copy_only=False)
        base = vectors.offsets.to_numpy()
        for d in np.unique(dims):
            rows = np.flatnonzero(dims == d)
            for i in range(0, len(rows), ROWS):
                part = rows[i:i + ROWS]
                x = flat[base[part][:, None] + np.arange(d)].astype(np.float64)
                bits, c = encode(x)
                yield pa.RecordBatch.from_pylist(
                    [{"dim": int(d), "ids": ids[part].astype(np.int64).tobytes(), "bits": bits.tobytes(),
                      "c": c.tobytes(), "raw": x.tobytes()}], schema=schema)


FOUND = "query_id long, vec_id long, score double"


class Best:
    """The k best distinct vec_ids of each query, and their exact scores."""

    def __init__(self, n: int, k: int):
        self.k, self.score, self.id = k, np.full((n, k), -np.inf), np.zeros((n, k), np.int64)

    def add(self, query: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        at = np.unique(query)
        old = np.isfinite(self.score[at])
        rows = np.repeat(at, old.sum(axis=1))
        q, i, s = (np.concatenate(x) for x in ((rows, query), (self.id[at][old], ids), (self.score[at][old], score)))
        # The best score of each (query, id), then the k best ids of a query.
        order = np.lexsort((-s, i, q))
        q, i, s = q[order], i[order], s[order]
        first = np.append(True, (q[1:] != q[:-1]) | (i[1:] != i[:-1]))[:len(q)]
        q, i, s = q[first], i[first], s[first]
        order = np.lexsort((i, -s, q))
        q, i, s = q[order], i[order], s[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < self.k
        self.score[at] = -np.inf
        self.score[q[keep], place[keep]], self.id[q[keep], place[keep]] = s[keep], i[keep]


def _search(query_ids: np.ndarray, vectors: list[np.ndarray], k: int):
    by_dim = {}
    for d in {len(v) for v in vectors}:
        at = [i for i, v in enumerate(vectors) if len(v) == d]
        x = np.array([vectors[i] for i in at])
        by_dim[d] = (query_ids[at], *scaled(x), units(x))

    def run(batches):
        state = {d: (Best(len(q), k), u @ rotation(d)) for d, (q, _, _, u) in by_dim.items()}
        for batch in batches:
            for n in range(batch.num_rows):
                d, ids, bits, c, raw = (column[n].as_py() for column in batch.columns)
                if d not in by_dim:
                    continue
                qid, qx, qlength, _ = by_dim[d]
                best, rotated = state[d]
                ids, c = np.frombuffer(ids, np.int64), np.frombuffer(c, np.float64)
                x, length = scaled(np.frombuffer(raw, np.float64).reshape(len(ids), d))
                bits = np.frombuffer(bits, np.uint8).reshape(len(ids), -1)

                def rerank(a, q, x=x, length=length, ids=ids, qx=qx, qlength=qlength, best=best):
                    for i in range(0, len(a), PAIRS):
                        r, j = a[i:i + PAIRS], q[i:i + PAIRS]
                        best.add(j, ids[r], np.einsum("ij,ij->i", x[r], qx[j]) / (length[r] * qlength[j]))

                for i in range(0, len(qid), STEP):
                    est, error = estimates(bits, c, rotated[i:i + STEP])
                    est[ids[:, None] == qid[None, i:i + STEP]] = -np.inf
                    top = np.argpartition(-est, min(k, len(ids)) - 1, axis=0)[:k]
                    q = np.broadcast_to(np.arange(est.shape[1]), top.shape).ravel()
                    top = top.ravel()
                    some = np.isfinite(est[top, q])
                    rerank(top[some], i + q[some])
                    est[top, q] = -np.inf
                    a, q = np.nonzero(est + error >= best.score[i:i + STEP, k - 1][None, :])
                    some = np.isfinite(est[a, q])
                    rerank(a[some], i + q[some])
        for d, (best, _) in state.items():
            at, r = np.nonzero(np.isfinite(best.score))
            yield pa.RecordBatch.from_arrays(
                [pa.array(by_dim[d][0][at]), pa.array(best.id[at, r]), pa.array(best.score[at, r])], names=["query_id", "vec_id", "score"])
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of ``vectors`` for
    each vec_id of ``queries``, other than itself."""
    def valid(df):
        v = F.col("embedding")
        finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return df.where(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0)) \
            .select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("embedding"))

    codes = cut(valid(vectors).mapInArrow(_codes, CODES), "codes")
    asked = cut(valid(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "queries")
    blocks = max(1, -(-asked.count() // (QUERIES // 2)))
    found = None
    for part in range(blocks):
        # About QUERIES / 2 rows: the hash deals them evenly.
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == part).collect()
        rows.sort(key=lambda r: r.vec_id)
        search = _search(np.array([r.vec_id for r in rows], np.int64), [np.array(r.embedding) for r in rows], k)
        one = cut(codes.mapInArrow(search, FOUND), "found")
        found = one if found is None else found.union(one)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    # At most k rows of each task and query meet here.
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
