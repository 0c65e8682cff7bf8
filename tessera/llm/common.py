"""Helpers shared by the llm operators: table access, lineage cuts in the
shared checkpoint folder, and vectorised byte/word hashing for Arrow tasks."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from tessera.session import ensure_checkpoint_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def cut(df: DataFrame, name: str, batch: int | None = None) -> DataFrame:
    """Write ``df`` once into the shared checkpoint folder and read it back:
    later steps neither repeat its work nor depend on executor-local files.
    Shuffle files of the write are released as soon as it ends.  ``batch``
    bounds the rows of an Arrow batch on the way to Python, for rows that hold
    whole blocks."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    rows = batch or spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    with _setting(spark, CLEANUP, "true"), _setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows)):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, col: str = "text") -> int:
    """UTF-8 bytes of all texts: sizes blocks and buckets to the input."""
    from pyspark.sql import functions as F
    return int(df.agg(F.sum(F.octet_length(col))).first()[0] or 0)


def below_hash(df: DataFrame, h, n: int, total: int) -> DataFrame:
    """The rows whose 64-bit hash ``h`` lies under a threshold that leaves
    about twice ``n`` of ``total``: what is ordered and collected afterwards is
    bounded, however many partitions there are."""
    low = -2**63 + min(1.0, 2 * n / max(total, 1)) * 2**64
    return df.where(h <= min(int(low), 2**63 - 1))


# ---------------------------------------------------------------- hashing
_rng = np.random.default_rng(20240607)
BYTE_HASH = _rng.integers(0, 2**64, 256, dtype=np.uint64)
BASE = np.uint64(0xD1342543DE82EF95)
BASE_INV = np.uint64(pow(int(BASE), -1, 2**64))
WORD_BASE = [np.uint64(pow(0x9E3779B97F4A7C15, j, 2**64)) for j in range(64)]
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = bytes(range(256)).lower()      # ASCII letters only

_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i (mod 2**64) for i < n, grown on demand."""
    if len(_powers["up"]) < n:
        size = (n + n // 8) | 0xFFFF
        for key, base in (("up", BASE), ("down", BASE_INV)):
            a = np.full(size, base, np.uint64)
            a[0] = 1
            _powers[key] = np.cumprod(a, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


def sorted_unique(a: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by sorting (faster here than by hashing)."""
    a = np.sort(a)
    return a[np.append(True, a[1:] != a[:-1])[:len(a)]]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    return h ^ (h >> np.uint64(32))


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """P with P[j]-P[i] = sum of hashed bytes i..j-1 times BASE**-position:
    the polynomial hash of any window follows by one multiplication."""
    _, down = powers(len(buf))
    p = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(BYTE_HASH[buf] * down, out=p[1:])
    return p


def window_hash(p: np.ndarray, length: int) -> np.ndarray:
    """Hash of every window of ``length`` bytes, by start position."""
    n = len(p) - length
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, _ = powers(len(p))
    return mix((p[length:] - p[:-length]) * up[:n])


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of runs of bytes other than ASCII white space."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = ~SPACE[buf]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def span_hash(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    p = prefix_hash(buf)
    up, _ = powers(len(buf) + 1)
    return mix((p[ends] - p[starts]) * up[starts])


def word_hashes(text: str | None) -> np.ndarray:
    """One 64-bit hash per word of the text (A-Z lowered)."""
    if not text:
        return np.zeros(0, np.uint64)
    buf = np.frombuffer(text.encode("utf-8", "surrogatepass").translate(LOWER), np.uint8)
    return span_hash(buf, *word_spans(buf))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Order-sensitive hash of every run of ``n`` consecutive words."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(m, np.uint64)
    for j in range(n):
        h += words[j:j + m] * WORD_BASE[j]
    return mix(h + np.uint64(n))


def shingles(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct n-word shingles; a shorter text is one shingle."""
    words = word_hashes(text)
    if not len(words):
        return words
    return sorted_unique(grams(words, min(n, len(words))))
