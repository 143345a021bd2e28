"""Shared helpers: scratch tables, bounded slices of Arrow batches, word hashes."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsengine.session import checkpoint_dir

SLICE_BYTES = 1 << 20


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder (URI) below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of at most 8 MB, so that a task's memory does not follow
    the length of the rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def give_back() -> None:
    """Return freed memory to the system: Spark keeps idle Python workers."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def save_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts the lineage;
    a lost executor rereads the files)."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed_text(df: DataFrame, key: str, text: str, **more) -> DataFrame:
    """``(key, text, ...)`` under internal names, whatever other columns there are.
    A null text counts as empty."""
    cols = [df[key].cast("long").alias("key"),
            F.coalesce(df[text].cast("string"), F.lit("")).alias("text")]
    return df.select(*cols, *[c.alias(n) for n, c in more.items()])


def text_slices(batches, column: str = "text",
                max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds about ``max_bytes`` of text
    (one row at least), which bounds the arrays made from it."""
    try:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            size = pc.binary_length(batch.column(column)).fill_null(0)
            ends = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))
            i = 0
            while i < n:
                base = ends[i - 1] if i else 0
                j = max(i + 1, int(np.searchsorted(ends, base + max_bytes, "right")))
                yield batch.slice(i, j - i)
                i = j
    finally:
        give_back()


# ---------------------------------------------------------------- word hashes

_SEP = np.zeros(256, bool)
_SEP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_rng = np.random.Generator(np.random.PCG64(20240611))
_BYTE = _rng.integers(0, 2**64, 256, np.uint64, endpoint=False) | np.uint64(1)
_BASE = int(_rng.integers(0, 2**63)) * 2 + 1
_MIXERS = _rng.integers(0, 2**64, 64, np.uint64, endpoint=False) | np.uint64(1)
_powers: list[np.ndarray] = [np.empty(0, np.uint64), np.empty(0, np.uint64)]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser (splitmix64) on uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 4096)
        for i, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[i] = np.cumprod(p, dtype=np.uint64)
    return _powers[0], _powers[1]


def forget_hashes() -> None:
    """Free the tables that ``word_hashes`` keeps between slices."""
    _powers[:] = [np.empty(0, np.uint64), np.empty(0, np.uint64)]
    give_back()


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of each text, with
    ASCII letters lower-cased, and the offsets of each text's words in them."""
    raw = texts.cast(pa.large_binary()).fill_null(b"").to_pylist()
    buf = _LOWER[np.frombuffer(b"\n".join([*raw, b""]), np.uint8)] if raw else np.empty(0, np.uint8)
    at = np.zeros(len(raw) + 1, np.int64)
    np.cumsum([len(x) + 1 for x in raw], out=at[1:])
    inside = ~_SEP[buf]
    edge = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    power, inverse = _power_tables(len(buf) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[buf] * power[:len(buf)], dtype=np.uint64, out=total[1:])
    h = mix64((total[ends] - total[starts]) * inverse[starts])
    return h, np.searchsorted(starts, at)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ``k``-word shingles of one sequence; a sequence of fewer
    words is one shingle as a whole, an empty one has none."""
    n = len(words)
    if not n:
        return words
    k = min(k, n)
    out = words[:n - k + 1] * _MIXERS[0]
    for j in range(1, k):
        out = out + words[j:n - k + 1 + j] * _MIXERS[j]
    return mix64(out + np.uint64(k))


def as_long(x: np.ndarray) -> np.ndarray:
    """uint64 bits as int64 (Spark has no unsigned long)."""
    return np.ascontiguousarray(x).view(np.int64)
