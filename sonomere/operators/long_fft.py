"""Spectra of channels that are longer than a task can hold.

A transform of ``rows * columns`` points is one of the columns, a rotation, and one of the rows:
with ``n = columns n1 + n2`` and ``k = k1 + rows k2``,

    X[k] = sum over n2 of e(n2 k2 / columns) e(n2 k1 / nfft) (sum over n1 of x[n] e(n1 k1 / rows))

where ``e(a) = exp(-2 pi i a)``. Samples are shuffled to blocks of columns, and what comes out of
them to blocks of rows.
"""

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonomere.functions.literals import check

# Points of a block of columns or rows: all that a task holds of a channel.
BLOCK_POINTS = 1 << 18


def split_size(nfft: int) -> tuple[int, int]:
    """``(rows, columns)`` of a transform, as near to each other as its divisors are."""
    columns = next(d for d in range(math.isqrt(nfft), 0, -1) if nfft % d == 0)
    return nfft // columns, columns


def _keys_of(table: pa.Table, keys: Sequence[str], n: int) -> list[pa.Array]:
    """The keys of a group, ``n`` times."""
    first = pa.array(np.zeros(n, np.int64))
    return [table.column(k).combine_chunks().take(first) for k in keys]


def fft_long(
    frames: DataFrame,
    keys: Sequence[str],
    nfft: int,
    value: str = "x",
    frame: str = "frame",
    block_points: int = BLOCK_POINTS,
) -> DataFrame:
    """``(*keys, k, re, im)``: the one-sided spectrum of every channel of numbered frames.

    Frames that are missing, up to ``nfft``, are zeros; of a frame that occurs twice the values add
    up; null values are zeros. A frame that ``nfft`` has no place for is an error. A task holds
    ``block_points`` points, or one column or row of about the square root of ``nfft`` if that is
    more, and a channel spreads over ``nfft / block_points`` tasks. A prime ``nfft`` has one row and
    needs one task.
    """
    if nfft < 2:
        raise ValueError(f"Incorrect nfft ({nfft}), it should be at least 2")
    keys = list(keys)
    rows, columns = split_size(nfft)
    wide = max(1, min(columns, block_points // rows))  # columns of a block
    tall = max(1, min(rows, block_points // columns))  # rows of a block
    types = {f.name: f.dataType.simpleString() for f in frames.schema.fields}
    named = "".join(f"`{k}` {types[k]}, " for k in keys)

    def columns_of(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        width = min(wide, columns - block * wide)
        place = table.column("frame").to_numpy()
        x = np.zeros((rows, width))
        values = table.column("value").fill_null(0.0).to_numpy()
        np.add.at(x, (place // columns, place % columns - block * wide), values)
        n2 = block * wide + np.arange(width)
        turn = np.exp(-2j * np.pi * np.outer(np.arange(rows), n2) / nfft)
        z = np.fft.fft(x, axis=0) * turn
        starts = range(0, rows, tall)
        out = {
            "block": pa.array(range(len(starts)), pa.int64()),
            "first": pa.array([block * wide] * len(starts), pa.int64()),
            "points": pa.array([z[s : s + tall].tobytes() for s in starts], pa.binary()),
        }
        return pa.Table.from_arrays([*_keys_of(table, keys, len(starts)), *out.values()], [*keys, *out])

    def rows_of(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        height = min(tall, rows - block * tall)
        z = np.zeros((height, columns), np.complex128)
        for first, points in zip(table.column("first").to_pylist(), table.column("points")):
            part = np.frombuffer(points.as_buffer(), np.complex128).reshape(height, -1)
            z[:, first : first + part.shape[1]] = part
        z = np.fft.fft(z, axis=1)
        k = (block * tall + np.arange(height))[:, None] + rows * np.arange(columns)
        half = k <= nfft // 2
        z, k = z[half], k[half]
        out = {"k": pa.array(k), "re": pa.array(z.real.copy()), "im": pa.array(z.imag.copy())}
        return pa.Table.from_arrays([*_keys_of(table, keys, len(k)), *out.values()], [*keys, *out])

    message = F.concat(
        F.lit("Incorrect signal length ("), (F.col(frame) + 1).cast("string"), F.lit(f") for FFT ({nfft})")
    )
    held = check(F.col(frame) < nfft, message, F.col(frame)).cast("bigint")
    placed = frames.select(*keys, held.alias("frame"), F.col(value).cast("double").alias("value"))
    placed = placed.withColumn("block", F.floor(F.col("frame") % columns / F.lit(wide)).cast("bigint"))
    turned = placed.groupBy(*keys, "block").applyInArrow(
        columns_of, f"{named}block bigint, first bigint, points binary"
    )
    return turned.groupBy(*keys, "block").applyInArrow(rows_of, f"{named}k bigint, re double, im double")
