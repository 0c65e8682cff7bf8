"""Token counts without token ids.

A byte-level BPE splits a text into pre-tokens and encodes each by itself, so
a document's token count is the sum over its distinct pre-tokens of frequency
times number of pieces.  Pre-tokens repeat enormously; pieces are counted once
per distinct pre-token of the whole corpus:

1. Documents are taken in blocks; a block holds the list of its distinct
   pre-tokens, divided into buckets by their checksum, and, per document,
   their codes and frequencies, all compressed.
2. A bucket gathers the lists of all blocks and counts the pieces of every
   distinct pre-token once.
3. The counts are joined back to the blocks, there to the documents'
   frequencies, and summed.

A pre-token that occurs in every document is one entry per block, so no key is
hot; the number of buckets grows with the text.  Special strings inside texts count as the library's default has it: one
token each, dividing the text.

Texts whose characters are all below U+0530 are split by the published
pattern; others by the library's own pre-tokenizer, because Unicode versions
differ on newly assigned characters.

Defined cases: a null or empty text has no tokens; rows with a null doc_id and
repeated rows are counted like any other; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, text_bytes

BLOCK_CHARS = 16 << 20       # characters of one block
BLOCK_TERMS = 400_000        # distinct pre-tokens after which a block ends
BUCKET_BYTES = 8 << 20       # text bytes for each bucket of pre-tokens

# Fixed value: the vocabulary's published splitting pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Splitter:
    """Pre-tokens of a text, as the tokenizer file defines them."""

    def __init__(self, path: str):
        import re

        import regex
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        specials = [t["content"] for t in spec.get("added_tokens", [])]
        pre = spec.get("pre_tokenizer") or {}
        if spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
            raise ValueError("a byte-level vocabulary without normaliser or added prefix is expected")
        if any(t.get(k) for t in spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("special strings are expected to stand for themselves")
        # The library takes the first match, the longest one at a place.
        specials = sorted(specials, key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, specials))) if specials else None
        self.split = regex.compile(PATTERN).findall
        self.plain = re.compile("[\\x00-\\u052f]*").fullmatch

    def words(self, text: str) -> list[str]:
        if self.plain(text):
            return self.split(text)
        return [text[i:j] for _, (i, j) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def count(self, text: str) -> tuple[Counter, int]:
        """Frequencies of pre-tokens and the number of special strings."""
        if self.special is None or not self.special.search(text):
            return Counter(self.words(text)), 0
        parts = self.special.split(text)
        found: Counter = Counter()
        for p in parts:
            found.update(self.words(p))
        return found, len(parts) - 1


BLOCKS = "block long, doc_ids binary, nulls binary, n_bytes binary, specials binary, lens binary, codes binary, freqs binary, terms array<binary>"
NAMES = [x.split()[0] for x in BLOCKS.split(", ")]


def _squeeze(a: np.ndarray, kind) -> bytes:
    """Numbers by byte plane, compressed."""
    a = np.ascontiguousarray(a, kind)
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.itemsize).T)
    return len(a).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _spread(data: bytes, kind) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    if not n:
        return np.zeros(0, kind)
    raw = pa.decompress(data[8:], decompressed_size=n * width, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).view(kind).reshape(-1)


def _pack_terms(terms: list[bytes]) -> bytes:
    text = b"".join(terms)
    lens = np.array([len(t) for t in terms], np.uint32).tobytes()
    return len(terms).to_bytes(8, "little") + len(text).to_bytes(8, "little") + pa.compress(lens + text, codec="zstd", asbytes=True)


def _unpack_terms(data: bytes) -> list[bytes]:
    n, size = int.from_bytes(data[:8], "little"), int.from_bytes(data[8:16], "little")
    raw = pa.decompress(data[16:], decompressed_size=4 * n + size, codec="zstd", asbytes=True)
    ends = np.cumsum(np.frombuffer(raw[:4 * n], np.uint32)).tolist()
    text = raw[4 * n:]
    return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _blocks(path: str, buckets: int):
    schema = pa.schema([("block", pa.int64()), *((n, pa.binary()) for n in NAMES[1:-1]), ("terms", pa.list_(pa.binary()))])

    def row(name, b):
        # Terms by bucket, then the documents' codes in that numbering.
        terms = [t.encode("utf-8", "surrogatepass") for t in b["code"]]
        bucket = np.array([crc32(t) % buckets for t in terms], np.int64)
        order = np.argsort(bucket, kind="stable")
        number = np.empty(len(terms), np.int64)
        number[order] = np.arange(len(terms))
        edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
        packed = [_pack_terms([terms[i] for i in order[x:y]]) if y > x else None for x, y in zip(edge, edge[1:], strict=False)]
        lens = np.array(b["lens"], np.int64)
        codes = number[np.concatenate(b["codes"])] if terms else np.zeros(0, np.int64)
        key = np.repeat(np.arange(len(lens)), lens) << 32 | codes
        order = np.argsort(key)
        codes = codes[order]
        step = np.diff(codes, prepend=0)
        begin = (np.cumsum(lens) - lens)[lens > 0]
        step[begin] = codes[begin]                    # differences restart at each document
        freqs = (np.concatenate(b["freqs"]) if terms else np.zeros(0, np.uint32))[order]
        ids = np.array([0 if i is None else i for i in b["ids"]], np.int64)
        cells = [name, ids.tobytes(), np.array([i is None for i in b["ids"]]).tobytes(), _squeeze(b["bytes"], np.int64),
                 _squeeze(b["special"], np.uint32), _squeeze(lens, np.uint32), _squeeze(step, np.uint32), _squeeze(freqs, np.uint32), packed]
        return pa.RecordBatch.from_arrays([pa.array([c], t.type) for c, t in zip(cells, schema, strict=True)], schema=schema)

    def run(batches):
        from pyspark import TaskContext
        splitter = Splitter(path)
        base, n = TaskContext.get().partitionId() << 32, 0

        def fresh():
            return {"ids": [], "bytes": [], "special": [], "lens": [], "codes": [], "freqs": [], "code": {}, "chars": 0}

        b = fresh()
        for batch in batches:
            for doc, cell in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = cell.as_py() or ""
                found, special = splitter.count(text)
                code = b["code"]
                b["codes"].append(np.array([code.setdefault(t, len(code)) for t in found], np.int64))
                b["freqs"].append(np.fromiter(found.values(), np.uint32, len(found)))
                b["lens"].append(len(found))
                b["ids"].append(doc)
                b["bytes"].append(len(text.encode("utf-8", "surrogatepass")))
                b["special"].append(special)
                b["chars"] += len(text)
                if b["chars"] >= BLOCK_CHARS or len(code) >= BLOCK_TERMS:
                    yield row(base + n, b)
                    b, n = fresh(), n + 1
        if b["ids"]:
            yield row(base + n, b)
    return run


def _pieces(path: str):
    def run(table: pa.Table) -> pa.Table:
        """One bucket: every distinct pre-token is encoded once (alone, it is
        not split again); each block gets the counts of its list."""
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        lists = [_unpack_terms(t.as_py()) for t in table.column("terms")]
        distinct = list(dict.fromkeys(t for x in lists for t in x))
        encode, counts = Tokenizer.from_file(path).encode_batch_fast, []
        for i in range(0, len(distinct), 4096):
            texts = [t.decode("utf-8", "surrogatepass") for t in distinct[i:i + 4096]]
            counts.extend(len(e.ids) for e in encode(texts, add_special_tokens=False))
        of = dict(zip(distinct, counts, strict=True))
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                         "counts": pa.array([_squeeze([of[t] for t in x], np.uint32) for x in lists], pa.binary())})
    return run


RESULT = "doc_id long, n_bytes long, n_tokens long"


def _sum(batches):
    for batch in batches:
        columns = [batch.column(n) for n in (*NAMES[1:-1], "counts")]
        for i in range(batch.num_rows):
            ids, nulls, n_bytes, specials, lens, codes, freqs, counts = (c[i].as_py() for c in columns)
            lens = _spread(lens, np.uint32).astype(np.int64)
            parts = sorted((c["bucket"], c["counts"]) for c in counts or ())
            pieces = np.concatenate([np.zeros(0, np.int64), *(_spread(x, np.uint32) for _, x in parts)]).astype(np.int64)
            run = np.cumsum(_spread(codes, np.uint32).astype(np.int64))
            ends = np.cumsum(lens)
            begin = ends - lens
            # Differences restart at each document: take off what ran up before.
            code = run - np.repeat(np.concatenate([[0], run])[begin], lens)
            total = np.concatenate([[0], np.cumsum(pieces[code] * _spread(freqs, np.uint32))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(ids, np.int64), mask=np.frombuffer(nulls, np.bool_)), pa.array(_spread(n_bytes, np.int64)),
                 pa.array(total[ends] - total[begin] + _spread(specials, np.uint32).astype(np.int64))],
                names=["doc_id", "n_bytes", "n_tokens"])


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row; ``tokenizer`` is
    the path of a byte-level vocabulary file that every worker can read."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    buckets = 1 << max(0, math.ceil(math.log2(max(text_bytes(docs), 1) / BUCKET_BYTES)))
    blocks = cut(docs.mapInArrow(_blocks(tokenizer, buckets), BLOCKS), "tokens")
    terms = blocks.select("block", F.posexplode("terms").alias("bucket", "terms")).where("terms IS NOT NULL")
    counts = terms.groupBy("bucket").applyInArrow(_pieces(tokenizer), "block long, bucket int, counts binary") \
        .groupBy("block").agg(F.collect_list(F.struct("bucket", "counts")).alias("counts"))
    out = blocks.drop("terms").join(counts, "block", "left").mapInArrow(_sum, RESULT)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
