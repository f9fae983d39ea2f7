"""Vectorised text access shared by the operators: byte slices, words, hashed features.

Python operators receive Arrow batches. A batch is cut into slices of bounded text volume,
so the memory a task needs depends on one slice (or its one longest text), not on the batch.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step works on.
SLICE_BYTES = 1 << 20

#: Bytes that separate words: space and tab to carriage return.
BLANK = np.zeros(256, dtype=bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

#: Bytes that separate alphanumeric words; bytes of multi-byte characters belong to words.
NOT_ALNUM = np.ones(256, dtype=bool)
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

#: A-Z to a-z, every other byte itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def trimmed(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The operator on batches, giving unused memory back at a partition's end: idle workers of earlier stages stay beside those at work."""

    @functools.wraps(rows)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
            if trim:
                trim(0)

    return run


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of the batch whose texts total about ``limit`` bytes; a longer text stands alone."""
    n = batch.num_rows
    if not n:
        return
    _, off = raw(batch.column(column))
    low = 0
    while low < n:
        high = int(np.searchsorted(off, off[low] + limit, "right")) - 1
        high = min(n, max(low + 1, high))
        yield low, high
        low = high


def raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts end to end, and n + 1 offsets; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return flat, off - off[0]


def spans(data: np.ndarray, off: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text: (first byte of each word, bytes kept, offsets of words in these, words of each text)."""
    keep = ~blank[data]
    start = keep.copy()
    start[1:] &= ~keep[:-1]
    heads = off[:-1][off[:-1] < off[1:]]
    start[heads] = keep[heads]
    at = np.flatnonzero(start)
    before = np.cumsum(keep, dtype=np.int64)
    lengths = np.append(before[at] - 1, before[-1] if len(before) else 0)
    return at, data[keep], lengths, np.diff(np.searchsorted(at, off))


def coded(kept: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A code for each word, equal for equal words, and the distinct words by code."""
    n = len(lengths) - 1
    if n <= 0:
        return np.zeros(0, np.int64), pa.array([], pa.binary())
    words = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(lengths.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(kept))])
    made = words.dictionary_encode()
    return made.indices.to_numpy(zero_copy_only=False).astype(np.int64), made.dictionary


def words(data: np.ndarray, off: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(code of each word, distinct words, words of each text)."""
    _, kept, lengths, counts = spans(data, off, blank)
    codes, distinct = coded(kept, lengths)
    return codes, distinct, counts


def per_text(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of the values of each text; values has one entry a byte, word, or whatever off counts."""
    total = np.concatenate(([0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)))
    return total[off[1:]] - total[off[:-1]]


def share_of(column: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id's text leaves this remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def bounded(rows: DataFrame, by: str | None, most: int, key: str = "doc_id") -> DataFrame:
    """About ``most`` rows for each value of ``by``, or of all rows without it, chosen by a hash of the key; never more than twice as many.

    Only the counts by value reach the driver. The share is by key, so the same rows are chosen however
    the table is partitioned. Of a key that many rows repeat, rows beyond the bound are left out, those
    with the largest hash of all columns.
    """
    u = F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    first = [u, F.xxhash64(*rows.columns)]
    if by is None:
        many = rows.count()
        return rows.filter(u < most / many).orderBy(*first).limit(2 * most) if many > most else rows
    counts = rows.groupBy(by).count().collect()
    chosen = F.lit(False)
    for r in counts:
        if r["count"] > most:
            chosen = chosen | (F.col(by).eqNullSafe(F.lit(r[by])) & (u < most / r["count"]))
        else:
            chosen = chosen | F.col(by).eqNullSafe(F.lit(r[by]))
    return rows.filter(chosen).orderBy(*first).limit(2 * most * max(1, len(counts)))
