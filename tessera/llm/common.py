"""Helpers shared by the operators: Arrow text buffers, word spans, 64-bit hashes.

All hashing is content-only (fixed constants, no process seed), so a retried
task on another executor gives the same values.
"""

from __future__ import annotations

import ctypes
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_ROWS = 2000       # rows handed to Python at a time
SLICE_BYTES = 1 << 20           # text handled by one numpy step; a longer document is a step of its own
GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D      # odd, so invertible modulo 2**64
_tables: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit value over all its bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * GOLD)
SPACE = np.zeros(256, bool)     # space, \t \n \v \f \r
SPACE[[32, 9, 10, 11, 12, 13]] = True


#: What other operators keep in a worker between tasks; dropped when a task of another kind begins.
KEPT: list = []


def release() -> None:
    """Hands memory that Arrow and the allocator keep for later back to the system, so a worker
    that is reused by other stages does not carry the peak of this one."""
    _tables.clear()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim:
        trim(0)


def map_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """``mapInArrow`` in batches of at most ``BATCH_ROWS`` rows (texts may be long), releasing memory at a task's end."""
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not getattr(run, "keeps", False):
            from tessera.llm import common      # the worker's own list
            for drop in common.KEPT:
                drop()
        try:
            yield from run(batches)
        finally:
            release()

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(df.sparkSession.conf.get(key)) > BATCH_ROWS:
        df.sparkSession.conf.set(key, str(BATCH_ROWS))
    return df.mapInArrow(tidy, schema)


def read(spark: SparkSession, sf_dir: str, table: str, cols: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*cols) if cols else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(col: str = "text"):
    """128-bit content key of a text (null reads as empty)."""
    return F.unhex(F.md5(F.coalesce(F.col(col), F.lit("")).cast("binary")))


def doc_key(doc_id: str = "doc_id", text: str = "text"):
    """128-bit key of a document: rows equal in doc_id and text share it (a null id is an id of its own)."""
    number = F.coalesce(F.col(doc_id).cast("long").cast("string"), F.lit("null")).cast("binary")
    return F.unhex(F.md5(F.concat(number, F.lit(b"\n"), text_key(text))))


def text_buffer(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end and their offsets; null reads as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    kind = pa.large_binary() if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else pa.large_string()
    col = col.cast(kind).fill_null(b"" if kind == pa.large_binary() else "")
    off = np.frombuffer(col.buffers()[1], np.int64, count=len(col) + 1, offset=8 * col.offset)
    data = col.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0]:off[-1]], off - off[0]


def slices(off: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of documents with at most ``limit`` bytes, or a single longer one."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j
        i = j


def text_slices(col) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last, bytes, offsets) for each slice of a text column."""
    buf, off = text_buffer(col)
    for i, j in slices(off):
        yield i, j, buf[off[i]:off[j]], off[i:j + 1] - off[i]


def word_spans(buf: np.ndarray, off: np.ndarray, sep: np.ndarray = SPACE):
    """Starts and ends of maximal runs of non-separators, and each document's first word."""
    out = sep[buf]
    word = ~out
    first, last = word.copy(), word.copy()
    first[1:] &= out[:-1]
    last[:-1] &= out[1:]
    full = off[:-1] < off[1:]
    heads, tails = off[:-1][full], off[1:][full] - 1
    first[heads], last[tails] = word[heads], word[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("pow", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        inverse = pow(_BASE, -1, 1 << 64)
        for name, base in (("pow", _BASE), ("inv", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _tables[name] = np.cumprod(steps)
    return _tables["pow"], _tables["inv"]


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``span_hash`` reads any span's hash from them."""
    power, _ = _powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[buf] * power[:len(buf)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, the same wherever a span lies."""
    _, inv = _powers(len(sums))
    return mix((sums[ends] - sums[starts]) * inv[starts])


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    """A-Z to a-z, all other bytes as they are."""
    return np.where((buf >= 65) & (buf <= 90), buf + np.uint8(32), buf)


def ngram_hash(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive word hashes."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    step = GOLD
    with np.errstate(over="ignore"):
        for k in range(n):
            total += words[k:len(words) - n + 1 + k] * step
            step = step * GOLD + np.uint64(2 * k)
    return mix(total)


def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def groups(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with equal first ``keys`` columns, from a partition sorted by them."""
    for key, run in itertools.groupby(rows(batches), key=lambda r: r[:keys]):
        yield key, list(run)


def batch(schema: pa.Schema, cols: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(cols, schema, strict=True)], schema=schema)


class Emit:
    """Collects output rows and hands them on as batches of bounded length."""

    def __init__(self, schema: pa.Schema, size: int = 4096):
        self.schema, self.size, self.rows = schema, size, []

    def add(self, *row) -> bool:
        self.rows.append(row)
        return len(self.rows) >= self.size

    def take(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield batch(self.schema, list(map(list, zip(*self.rows, strict=True))))
            self.rows = []


def binary_rows(a: np.ndarray) -> pa.Array:
    """Each row of a 2-d array as one binary value."""
    a = np.ascontiguousarray(a)
    n, width = len(a), a.shape[1] * a.itemsize
    return pa.Array.from_buffers(pa.binary(), n, [
        None, pa.py_buffer((np.arange(n + 1, dtype=np.int32) * width).tobytes()), pa.py_buffer(a.tobytes())])
