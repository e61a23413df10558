"""Run a numpy kernel over every vector of an Arrow list column.

A kernel maps a ``(rows, n)`` matrix to ``(rows, m)`` or ``(rows, windows, m)``. Vectors of one
length are stacked into one matrix, so a batch of equally long records costs one numpy call.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _offsets(lengths: np.ndarray) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(lengths)])
    if ends[-1] > np.iinfo(np.int32).max:
        raise ValueError("Arrow batch too large, lower spark.sql.execution.arrow.maxBytesPerBatch")
    return pa.array(ends.astype(np.int32))


def lists(lengths: np.ndarray, values: pa.Array, valid: np.ndarray) -> pa.ListArray:
    """A list column of consecutive ``values``; a list that is not ``valid`` is NULL."""
    mask = None if valid.all() else pa.array(~valid)
    return pa.ListArray.from_arrays(_offsets(lengths), values, mask=mask)


def map_vectors(vectors: pa.Array, kernel) -> pa.Array:
    """``kernel`` over LIST<DOUBLE>; NULL vectors stay NULL."""
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    valid = lengths >= 0
    flat = vectors.flatten()
    if flat.null_count:
        raise ValueError("NULL sample in a signal")
    samples = flat.to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])[:-1]

    results = []
    for n in np.unique(lengths[valid]):
        rows = np.flatnonzero(lengths == n)
        if len(rows) == len(lengths):
            block = samples.reshape(len(rows), n)
        else:
            block = samples[starts[rows][:, None] + np.arange(n)]
        results.append((rows, kernel(block)))

    depth = results[0][1].ndim if results else 2
    width = results[0][1].shape[-1] if results else 0
    out_lengths = np.zeros(len(lengths), dtype=np.int64)
    for rows, out in results:
        out_lengths[rows] = out[0].size
    if len(results) == 1:
        values = np.ascontiguousarray(results[0][1]).ravel()
    else:
        values = np.empty(out_lengths.sum())
        out_starts = np.concatenate([[0], np.cumsum(out_lengths)])[:-1]
        for rows, out in results:
            values[out_starts[rows][:, None] + np.arange(out[0].size)] = out.reshape(len(rows), -1)

    if depth == 2:
        return lists(out_lengths, pa.array(values), valid)
    n_inner = len(values) // width if width else 0
    inner = lists(np.full(n_inner, width), pa.array(values), np.ones(n_inner, dtype=bool))
    return lists(out_lengths // width, inner, valid)


def map_nested(vectors: pa.Array, kernel) -> pa.Array:
    """``kernel`` over LIST<LIST<DOUBLE>> (one inner vector per channel)."""
    lengths = pc.fill_null(pc.list_value_length(vectors), -1).to_numpy(zero_copy_only=False)
    inner = map_vectors(vectors.flatten(), kernel)
    return lists(np.maximum(lengths, 0), inner, lengths >= 0)
