"""Repeated passages by content-defined chunking.

Texts are cut where a gear rolling hash of the last 32 bytes says so: after a
white-space byte whose hash has two leading zero bits, or at a character whose
hash has nine.  Where the last 32 bytes hold no white space (Chinese, Japanese,
Thai, encoded runs), three are enough after a character of several bytes and
four after one of one byte, so that chunks there are about as long as elsewhere
and hardly ever reach the largest size.  Cuts depend on the bytes just before
them, so an insertion moves them but does not change them, and equal passages
get equal chunks but for their ends.  Chunks have 12 to 512 bytes.

A chunk is named by a 96-bit digest.  It is repeated if its name occurs in a
document with a smaller doc_id, or before in the same document.  Repeated
chunks in a row are removed if together they have ``min_run`` bytes or more:
shorter runs are common phrases.  First occurrences stay.

Digests travel as in ``blocks``: one entry per block and name, however often
the block holds it.

Defined cases: a null text is empty; a null doc_id comes after all others;
rows that share a doc_id are separate documents, none earlier than the other;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import COLUMNS, KEYS, Block, Named, late_names, rows, to_blocks
from tessera.llm.common import SPACE, mix, powers, text_bytes

SPACE_ZEROS, ANY_ZEROS = 2, 9      # leading zero bits that cut
WIDE_ZEROS, NARROW_ZEROS = 3, 4    # far from white space, after characters of several bytes and of one
FAR = 32                           # bytes without white space
MIN_CHUNK, MAX_CHUNK = 12, 512
MIN_RUN = 100
BUCKET_KEYS = 1 << 19

GEAR = np.random.default_rng(32).integers(0, 2**32, 256, dtype=np.uint32)


def gear_hash(buf: np.ndarray) -> np.ndarray:
    """h[i] = (h[i-1] << 1) + GEAR[buf[i]] in 32 bits: a sum over the last 32
    bytes, built by doubling its length five times."""
    h = GEAR[buf]
    for k in (1, 2, 4, 8, 16):
        longer = h.copy()
        longer[k:] += h[:-k] << np.uint32(k)
        h = longer
    return h


def cuts(buf: np.ndarray) -> np.ndarray:
    """Ends of the chunks of one text, in order; the last one is its length."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64)
    h = gear_hash(buf)
    whole = np.ones(n, bool)                       # the next byte begins a character
    whole[:-1] = (buf[1:] & 0xC0) != 0x80
    at = (SPACE[buf] & (h >> np.uint32(32 - SPACE_ZEROS) == 0)) | (whole & (h >> np.uint32(32 - ANY_ZEROS) == 0))
    some = np.flatnonzero(whole & (h >> np.uint32(32 - WIDE_ZEROS) == 0))
    some = some[(buf[some] >= 0x80) | (h[some] >> np.uint32(32 - NARROW_ZEROS) == 0)]
    space = np.concatenate([[-1], np.flatnonzero(SPACE[buf])])
    at[some[some - space[np.searchsorted(space, some, side="right") - 1] > FAR]] = True
    out, last = [], 0
    for end in [*(np.flatnonzero(at) + 1).tolist(), n]:
        while end - last > MAX_CHUNK:
            # No cut in reach: the last white space there, or a whole character.
            reach = slice(last + MIN_CHUNK, last + MAX_CHUNK)
            spot = np.flatnonzero(SPACE[buf[reach]])
            if not len(spot):
                spot = np.flatnonzero(whole[reach])
            last += MIN_CHUNK + (int(spot[-1]) + 1 if len(spot) else MAX_CHUNK - MIN_CHUNK)
            out.append(last)
        if end - last >= MIN_CHUNK:
            out.append(end)
            last = end
    if not out or out[-1] != n:
        out.append(n)                              # a short rest
    return np.array(out, np.int64)


def _chunks(block: Block):
    """Starts, ends and names of the chunks of a block."""
    starts, ends, docs = [], [], []
    for i, (s, n) in enumerate(zip(block.starts.tolist(), block.lens.tolist(), strict=True)):
        e = cuts(block.buf[s:s + n])
        ends.append(e + s)
        starts.append(np.concatenate([[0], e[:-1]])[:len(e)] + s)
        docs.append(np.full(len(e), i))
    starts, ends, docs = (np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (starts, ends, docs))
    up, _ = powers(len(block.buf) + 1)
    h = []
    for second in (False, True):
        p = block.prefix(second)
        h.append(mix((p[ends] - p[starts]) * up[starts] + (ends - starts).astype(np.uint64)))
    return starts, ends, Named(block, docs, h[0], (h[1] >> np.uint64(32)).astype(np.uint32))


def _keys(part: int, parts: int, buckets: int):
    def run(batches):
        for batch in batches:
            for name, *row in rows(batch, COLUMNS):
                yield _chunks(Block.load(*row))[2].keys(name, part, parts, buckets)
    return run


RESULT = "doc_id long, key long, n_bytes long, n_chunks long, n_repeated long, n_removed long, n_spans long, kept string"


def _result(min_run: int, parts: int, buckets: int):
    def run(batches):
        for batch in batches:
            for _, *row, late in rows(batch, [*COLUMNS, "late"]):
                block = Block.load(*row)
                starts, ends, named = _chunks(block)
                again = np.zeros(len(starts), bool)
                again[named.repeated(late, parts, buckets)] = True
                out = {k: [] for k in ("doc", "key", "bytes", "chunks", "again", "removed", "spans", "kept")}
                lo = np.searchsorted(named.doc, np.arange(len(block.lens)), side="left")
                hi = np.searchsorted(named.doc, np.arange(len(block.lens)), side="right")
                for i, (s, n) in enumerate(zip(block.starts, block.lens, strict=True)):
                    r = again[lo[i]:hi[i]]
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], r.astype(np.int8), [0]])))
                    kept, removed, spans, at = [], 0, 0, s
                    for a, b in zip(edge[0::2], edge[1::2], strict=True):
                        x, y = starts[lo[i] + a], ends[lo[i] + b - 1]
                        if y - x >= min_run:
                            kept.append(block.buf[at:x].tobytes())
                            at, removed, spans = y, removed + int(y - x), spans + 1
                    kept.append(block.buf[at:s + n].tobytes())
                    for k, x in zip(out, (None if block.nulls[i] else int(block.ids[i]), int(block.keys[i]), int(n), len(r),
                                           int(r.sum()), removed, spans, b"".join(kept).decode("utf-8", "surrogatepass")), strict=True):
                        out[k].append(x)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x, pa.int64()) for x in list(out.values())[:-1]), pa.array(out["kept"], pa.string())],
                    names=[x.split()[0] for x in RESULT.split(", ")])
    return run


def repeated_passages(docs: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """doc_id, key (hash of the text), n_bytes, n_chunks, n_repeated,
    n_removed (bytes), n_spans (removed runs), kept (the remaining text) for
    every row of ``docs``."""
    total = max(text_bytes(docs), 1)
    # About 35 bytes a chunk and 14 bytes a name: one range of names moves
    # less than half of the text.
    buckets = 1 << max(0, math.ceil(math.log2(max(total // 35, 1) / BUCKET_KEYS)))
    blocks = to_blocks(docs)
    late = late_names(lambda part: blocks.mapInArrow(_keys(part, 1, buckets), KEYS), 1)
    return blocks.join(late, "block", "left").select(*COLUMNS, "late").mapInArrow(_result(min_run, 1, buckets), RESULT)
