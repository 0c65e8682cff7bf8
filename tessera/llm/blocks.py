"""Documents packed into blocks, and first occurrences of names across them.

A block holds some documents one after another in one compressed buffer.  An
operator names pieces of its documents (suffixes, chunks) by 96-bit hashes; to
learn which names occur earlier elsewhere, every block sends each of its names
once, with the smallest doc_id that has it, sorted and compressed, to the
bucket of the name; the bucket answers with one bit per name.  However often a
name occurs, it is one entry per block, and no task holds more than a bucket
of bounded average size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import BYTE_HASH, cut, powers

BLOCK_BYTES = 1 << 20
LAST = 2**63 - 1             # order of a null doc_id
BATCH = 16                   # blocks in an Arrow batch


def pack(values: np.ndarray) -> bytes:
    """Sorted uint64 values: differences by byte plane, compressed."""
    d = np.diff(values, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8)
    return len(values).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(d.T).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    if not n:
        return np.zeros(0, np.uint64)
    raw = pa.decompress(data[8:], decompressed_size=8 * n, codec="zstd", asbytes=True)
    d = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, n).T).view(np.uint64).reshape(-1)
    return np.cumsum(d, dtype=np.uint64)


def rows(batch: pa.RecordBatch, names: list[str]):
    """The rows of a batch one by one, so that one block at a time is unpacked."""
    columns = [batch.column(n) for n in names]
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in columns)
    pa.default_memory_pool().release_unused()


def sorted_order(h: np.ndarray) -> np.ndarray:
    """Stable order of 64-bit hashes: hash bits and position share one word,
    which sorts much faster than an argsort; the few hashes that agree in the
    bits kept but not in the others are put right afterwards."""
    bits = max(len(h) - 1, 1).bit_length()
    mask = np.uint64((1 << bits) - 1)
    order = (np.sort((h & ~mask) | np.arange(len(h), dtype=np.uint64)) & mask).astype(np.int64)
    a = h[order]
    wrong = np.flatnonzero(a[1:] < a[:-1])
    if len(wrong):
        kept = a & ~mask
        for i in np.unique(np.searchsorted(kept, kept[wrong])):
            j = np.searchsorted(kept, kept[i], side="right")
            part = np.sort(order[i:j])
            order[i:j] = part[np.argsort(h[part], kind="stable")]
    return order


def squeeze(a: np.ndarray) -> bytes:
    return len(a).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(a).tobytes(), codec="zstd", asbytes=True)


def spread(data: bytes, kind) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    size = n * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(data[8:], decompressed_size=size, codec="zstd", asbytes=True) if n else b"", kind)


# ------------------------------------------------------------------ blocks
BLOCKS = "block long, ids binary, nulls binary, keys binary, lens binary, blob binary"
COLUMNS = ["block", "ids", "nulls", "keys", "lens", "blob"]


class Block:
    """Documents one after another in one buffer."""

    def __init__(self, ids, nulls, keys, lens, buf):
        self.ids, self.nulls, self.keys, self.lens, self.buf = ids, nulls, keys, lens, buf
        self.starts = np.concatenate([[0], np.cumsum(lens)[:-1]]).astype(np.int64) if len(lens) else np.zeros(0, np.int64)

    @classmethod
    def load(cls, ids, nulls, keys, lens, blob):
        lens = np.frombuffer(lens, np.int64)
        n = int(lens.sum())
        raw = pa.decompress(blob, decompressed_size=n, codec="zstd", asbytes=True) if n else b""
        return cls(np.frombuffer(ids, np.int64), np.frombuffer(nulls, np.bool_), np.frombuffer(keys, np.int64), lens,
                   np.frombuffer(raw, np.uint8))

    def columns(self):
        blob = pa.compress(self.buf.tobytes(), codec="zstd", asbytes=True) if len(self.buf) else b""
        return [self.ids.tobytes(), self.nulls.tobytes(), self.keys.tobytes(), self.lens.astype(np.int64).tobytes(), blob]

    def doc_of(self, pos: np.ndarray) -> np.ndarray:
        full = np.flatnonzero(self.lens > 0)
        return full[np.searchsorted(self.starts[full], pos, side="right") - 1]

    def prefix(self, second: bool = False) -> np.ndarray:
        _, down = powers(len(self.buf))
        p = np.zeros(len(self.buf) + 1, np.uint64)
        table = np.roll(BYTE_HASH, 101) ^ np.uint64(0x5851F42D4C957F2D) if second else BYTE_HASH
        np.cumsum(table[self.buf] * down, out=p[1:])
        return p


def _pack_docs(batches):
    from pyspark import TaskContext
    base, n = TaskContext.get().partitionId() << 32, 0
    schema = pa.schema([("block", pa.int64()), *((k, pa.binary()) for k in COLUMNS[1:])])
    ids, keys, texts, size = [], [], [], 0

    def row():
        block = Block(np.array([LAST if i is None else i for i in ids], np.int64), np.array([i is None for i in ids], np.bool_),
                      np.array(keys, np.int64), np.array([len(t) for t in texts], np.int64), np.frombuffer(b"".join(texts), np.uint8))
        return pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip([base + n, *block.columns()], schema, strict=True)], schema=schema)

    for batch in batches:
        for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
            if texts and size + len(raw) > BLOCK_BYTES:
                yield row()
                n += 1
                ids, keys, texts, size = [], [], [], 0
            ids.append(doc)
            keys.append(key)
            texts.append(raw)
            size += len(raw)
    if texts:
        yield row()


def to_blocks(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> blocks; a document's key is the hash of its text,
    which tells rows that share a doc_id apart."""
    text = F.col("text").cast("string")
    return cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))
               .mapInArrow(_pack_docs, BLOCKS), "blocks")


# ------------------------------------------------------------------- names
def in_part(h1: np.ndarray, part: int, parts: int) -> np.ndarray:
    """Which names fall into one of ``parts`` equal ranges."""
    low, high = (2**64 * k // parts for k in (part, part + 1))
    return (h1 >= np.uint64(low)) & (h1 <= np.uint64(high - 1))


class Named:
    """Pieces of a block, in document and position order: document index and
    96-bit name."""

    def __init__(self, block: Block, doc, h1, h2):
        self.block, self.doc, self.h1, self.h2 = block, doc, h1, h2

    def ordered(self, part: int, parts: int, buckets: int):
        """The pieces of one range of names, in order of (name, doc_id,
        position): their indexes; where a name begins; the bucket of each
        distinct name."""
        at = np.flatnonzero(in_part(self.h1, part, parts)) if parts > 1 else np.arange(len(self.h1))
        if np.any(np.diff(self.block.ids) <= 0):
            rank = np.argsort(np.argsort(self.block.ids, kind="stable"), kind="stable")
            at = at[np.argsort(rank[self.doc[at]], kind="stable")]    # positions stay in order within a document
        h1, h2 = self.h1[at], self.h2[at]
        order = sorted_order(h1)
        a, b = h1[order], h2[order]
        if np.any((a[1:] == a[:-1]) & (b[1:] != b[:-1])):             # two names that agree in 64 bits
            order = np.lexsort((h2, h1))
            a, b = h1[order], h2[order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        first = a[new]
        bucket = first >> np.uint64(64 - (buckets.bit_length() - 1)) if buckets > 1 else np.zeros(len(first), np.uint64)
        return at[order], new, bucket

    def keys(self, name: int, part: int, parts: int, buckets: int) -> pa.RecordBatch:
        """What the block sends: per bucket its names and their first documents."""
        idx, new, bucket = self.ordered(part, parts, buckets)
        head = idx[new]
        names, cuts = np.unique(bucket, return_index=True)
        out = [[], [], []]
        for i, j in zip(cuts, np.append(cuts[1:], len(head))[:len(cuts)], strict=True):
            out[0].append(pack(self.h1[head[i:j]]))
            out[1].append(squeeze(self.h2[head[i:j]]))
            out[2].append(squeeze(self.block.ids[self.doc[head[i:j]]]))
        return pa.RecordBatch.from_arrays(
            [pa.array(names.astype(np.int64)), pa.array(np.full(len(names), name, np.int64)),
             *(pa.array(x, pa.binary()) for x in out)], names=["bucket", "block", "h1", "h2", "first"])

    def repeated(self, late, parts: int, buckets: int) -> np.ndarray:
        """Indexes of pieces whose name occurs earlier: in a document with a
        smaller doc_id, or before in the same document."""
        told = {(x["part"], x["bucket"]): x["late"] for x in late or ()}
        ids, gone = self.block.ids, []
        for part in range(parts):
            idx, new, bucket = self.ordered(part, parts, buckets)
            if not len(idx):
                continue
            group = np.cumsum(new) - 1
            flag = np.zeros(len(bucket), bool)
            names, cuts = np.unique(bucket, return_index=True)
            for b, i, j in zip(names, cuts, np.append(cuts[1:], len(bucket)), strict=True):
                if (bits := told.get((part, int(b)))) is not None:
                    flag[i:j] = np.unpackbits(np.frombuffer(bits, np.uint8), count=j - i).astype(bool)
            doc = self.doc[idx]
            tie = ids[doc] > ids[doc[new]][group]
            again = np.zeros(len(idx), bool)
            again[1:] = ~new[1:] & (doc[1:] == doc[:-1])
            gone.append(idx[flag[group] | tie | again])
        return np.sort(np.concatenate(gone)) if gone else np.zeros(0, np.int64)


KEYS = "bucket long, block long, h1 binary, h2 binary, first binary"
LATE = "block long, part int, bucket long, late binary"


def _late(part: int):
    def run(table: pa.Table) -> pa.Table:
        """One bucket: for each block a bit per name, set if the name's first
        document elsewhere comes earlier."""
        h1 = [unpack(x) for x in table.column("h1").to_pylist()]
        sizes = [len(x) for x in h1]
        h1 = np.concatenate(h1)
        h2 = np.concatenate([spread(x, np.uint32) for x in table.column("h2").to_pylist()])
        first = np.concatenate([spread(x, np.int64) for x in table.column("first").to_pylist()])
        order = sorted_order(h1)
        a, b = h1[order], h2[order]
        if np.any((a[1:] == a[:-1]) & (b[1:] != b[:-1])):
            order = np.lexsort((h2, h1))
            a, b = h1[order], h2[order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        low = np.minimum.reduceat(first[order], np.flatnonzero(new))
        late = np.zeros(len(order), bool)
        late[order] = first[order] > low[np.cumsum(new) - 1]
        bits = [np.packbits(x).tobytes() if x.any() else None for x in np.split(late, np.cumsum(sizes)[:-1])]
        return pa.table({"block": table.column("block"), "part": pa.array(np.full(table.num_rows, part, np.int32)),
                         "bucket": table.column("bucket"), "late": pa.array(bits, pa.binary())})
    return run


def late_names(send, parts: int) -> DataFrame:
    """(block, late) of the blocks that have names occurring earlier elsewhere.
    ``send(part)`` gives the blocks' keys of one range of names; the ranges
    are worked off one after another, so their shuffles do not add up."""
    found = None
    for part in range(parts):
        one = cut(send(part).groupBy("bucket").applyInArrow(_late(part), LATE).where("late IS NOT NULL"), "late", BATCH)
        found = one if found is None else found.union(one)
    return found.groupBy("block").agg(F.collect_list(F.struct("part", "bucket", "late")).alias("late"))
