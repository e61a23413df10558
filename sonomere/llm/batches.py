"""Texts in Arrow batches: small slices, words and word hashes without a Python object per word."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Numpy work on a slice takes some fifty times its bytes.
SLICE_BYTES = 1 << 20
_WORDS_AT_ONCE = 1 << 18


def id_and_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text)`` of any table of documents."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))


def slices(batch: pa.RecordBatch, text: int = 1, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``size`` bytes of text; a longer row stands alone."""
    length = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(length, dtype=np.int64)
    at, before = 0, 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(total, before + size, "right")))
        yield batch.slice(at, end - at)
        at, before = end, int(total[end - 1])


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


# The bytes that separate words.
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def spans(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _SEPARATOR):
    """Maximal runs without a separator inside each row: ``(start, end, row)``."""
    inside = ~separator[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    before[edges] = False
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    h = h.astype(np.uint64)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_LOWER = np.arange(256)
_LOWER[ord("A") : ord("Z") + 1] += 32
_LOWERED = _BYTE[_LOWER]

class _PowerTables:
    """Powers of the step and of its inverse, as many as were needed so far. They grow where they
    are used and do not travel: a closure that is sent to a worker takes an empty one.
    """

    def __init__(self):
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def __reduce__(self):
        return _PowerTables, ()

    def __call__(self, size: int) -> list[np.ndarray]:
        if len(self.tables[0]) < size:
            for i, base in enumerate((_STEP, _BACK)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                self.tables[i] = np.multiply.accumulate(steps)
        return self.tables


_power_tables = _PowerTables()


def hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """64-bit hash of every span; A-Z count as a-z if ``lower``.

    A polynomial over random byte values: prefix sums give every span's value with a fixed number
    of array operations, whatever the spans.
    """
    values = _LOWERED if lower else _BYTE
    out = np.empty(len(start), np.uint64)
    for lo in range(0, len(start), _WORDS_AT_ONCE):
        hi = min(lo + _WORDS_AT_ONCE, len(start))
        first, last = int(start[lo]), int(end[hi - 1])
        up, down = _power_tables(last - first + 1)
        sums = np.zeros(last - first + 1, np.uint64)
        np.cumsum(values[data[first:last]] * up[: last - first], out=sums[1:])
        a, b = start[lo:hi] - first, end[lo:hi] - first
        out[lo:hi] = (sums[b] - sums[a]) * down[a] + (b - a).astype(np.uint64)
    return mix(out)


def sequence_hashes(word: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every stretch of word hashes, in order."""
    up, down = _power_tables(len(word) + 1)
    sums = np.zeros(len(word) + 1, np.uint64)
    np.cumsum(word * up[: len(word)], out=sums[1:])
    return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def shingles(word: np.ndarray, row: np.ndarray, n_rows: int, k: int):
    """Hashes of all runs of ``k`` words, ``(hash, row, first word)``; a row with 1 to k - 1 words
    gives one shingle of all of them.
    """
    count = np.bincount(row, minlength=n_rows)
    stop = np.cumsum(count)
    left = stop[row] - np.arange(len(row))  # words from here to the row's end
    first = np.flatnonzero((left >= k) | ((left == count[row]) & (left < k)))
    used = np.minimum(left[first], k)
    total = used.astype(np.uint64)
    for j in range(k):
        there = first + j
        inside = j < used
        there[~inside] = 0
        total *= _STEP
        total += np.where(inside, word[there], np.uint64(0))
    return mix(total), row[first], first
