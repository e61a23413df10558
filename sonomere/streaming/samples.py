"""Records cut from a stream of samples that arrive in any order.

State is kept for groups of records, not per channel: the records of one busy channel spread over
all tasks, those of many short ones share a group, and a micro-batch calls Python once per group. A
record's samples leave the state as soon as it is whole or its time is over.
"""

from collections.abc import Iterator, Sequence
from datetime import datetime

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from sonomere.operators.frames import LastRecord
from sonomere.sources.wav import epoch_ms

PARTIAL = "A record ended without all of its samples and PartialLastRecordAction is set to FAIL."
LAST_MS = 9_223_372_036_000
# Groups that all records are dealt into.
GROUPS = 1 << 12
# Samples that a task gathers by record before they are shuffled.
GATHERED = 1 << 20
# The count of a record that is out already.
OUT = -1
# The records of a group: their keys, their indexes, when they are closed, how many samples they
# hold; then the places of those samples, ascending in a record, and their values.
STATE = "keys binary, idx binary, due binary, counts binary, places binary, samples binary"
# Keys are held as JSON: pandas has no null integers. Its lines part the keys of a group.
KEY_FORMAT = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timeZone": "UTC", "mode": "FAILFAST",
}


def record_end_ms(record_idx: Column, record_size: int, fs: float, origin_ms: int) -> Column:
    """First whole millisecond at which a record is over, or the last one pandas can hold."""
    end = F.lit(origin_ms) + F.ceil((record_idx + 1) * F.lit(record_size * 1000.0 / fs))
    return F.least(end.cast("bigint"), F.lit(LAST_MS))


def cut_record_stream(
    samples: DataFrame,
    keys: Sequence[str],
    record_size: int,
    fs: float,
    delay: str,
    value: str = "x",
    frame: str = "frame",
    last_record: LastRecord = "skip",
    origin: datetime | str = "1970-01-01",
) -> DataFrame:
    """``(*keys, record_idx, timestamp, samples)`` from a stream of ``(*keys, frame, value)``.

    The counterpart of ``frames.cut_records``: workflows run on its result as on any records.
    ``frame`` is a sample's position in its channel and, with ``fs`` and ``origin``, its time. Samples may come in any
    order and more than once. A record is put out as soon as it is whole. When the watermark, the
    latest end of a record seen anywhere less ``delay``, passes the end of a record, it is closed:
    what is missing is treated by ``last_record`` (``skip``, ``fill`` with zeros, ``keep`` up to
    its last sample with zeros in its gaps, or ``fail``), and samples that come later are dropped.
    The state therefore holds the samples of the records that end within ``delay``, and a mark for
    each of them that is out.

    A row with a null value is a heartbeat: it is no sample, but time has come as far as its frame.
    Without one, the records within ``delay`` of the end of a stream stay open. Spark's watermark
    begins at 1970, so records that end before are late. Rows with a null or
    negative frame are dropped; null keys are keys of their own. Of several values for one frame
    the least in the micro-batch that brings the first of them counts.
    """
    if record_size < 1:
        raise ValueError(f"Incorrect record size ({record_size})")
    if last_record not in ("skip", "fail", "fill", "keep"):
        raise ValueError(f"Unknown last record action {last_record!r}")
    keys = list(keys)
    origin_ms = epoch_ms(origin)
    index = F.floor(F.col(frame) / F.lit(record_size)).cast("bigint")
    placed = samples.filter(F.col(frame) >= 0).select(
        *keys, index.alias("record_idx"), (F.col(frame) % record_size).cast("int").alias("__place"),
        F.col(value).cast("double").alias("__value"),
    )
    fields = [*(StructField(k, samples.schema[k].dataType) for k in keys), StructField("record_idx", LongType())]
    packed = placed.mapInArrow(_packer(len(fields), place_type(record_size)), StructType([
        *fields, StructField("__places", BinaryType()), StructField("__samples", BinaryType())
    ]))
    end = record_end_ms(F.col("record_idx"), record_size, fs, origin_ms)
    name = F.to_json(F.struct(*keys), KEY_FORMAT) if keys else F.lit("{}")
    timed = packed.select(
        F.pmod(F.xxhash64(*keys, "record_idx"), F.lit(GROUPS)).cast("int").alias("__group"),
        name.alias("__key"), "record_idx", F.timestamp_millis(end).alias("__end"), end.alias("__due"),
        "__places", "__samples",
    ).withWatermark("__end", delay)
    records = timed.groupBy("__group").applyInPandasWithState(
        _collector(record_size, last_record), "__key string, record_idx bigint, samples array<double>",
        STATE, "append", GroupStateTimeout.EventTimeTimeout,
    )
    start = F.lit(origin_ms * 1000) + (F.col("record_idx") * F.lit(record_size * 1e6 / fs)).cast("bigint")
    # A kernel needs the rows of a projection before it, and Spark merges one that could as well
    # come after; it leaves alone what depends on the task.
    timestamp = F.when(F.spark_partition_id() >= 0, F.timestamp_micros(start))
    named = F.from_json("__key", StructType(fields[:-1]), KEY_FORMAT)
    return records.select(
        *[named.getField(k).alias(k) for k in keys], "record_idx", timestamp.alias("timestamp"), "samples"
    )


def place_type(record_size: int) -> np.dtype:
    """The smallest type that holds the places of a record's samples."""
    return np.min_scalar_type(record_size - 1)


def _packer(n_names: int, dtype: np.dtype):
    """Rows of ``(*names, place, value)`` to one row per record and ``GATHERED`` samples: the places
    and the values of its samples as bytes. A record of heartbeats alone has none.
    """

    def numbered(columns: list[pa.Array]) -> np.ndarray:
        """A number per row, equal where all columns are."""
        numbers, bound = np.zeros(len(columns[0]), np.int64), 1
        for column in columns:
            if pa.types.is_nested(column.type):
                column = pa.array([repr(v) for v in column.to_pylist()], pa.string())
            encoded = column.dictionary_encode()
            codes = encoded.indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            more = len(encoded.dictionary) + 1
            if bound * more > 1 << 62:
                numbers, bound = np.unique(numbers, return_inverse=True)[1], len(numbers)
            numbers, bound = numbers * more + codes, bound * more
        return numbers

    def binary(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
        ends = pa.py_buffer((offsets * data.itemsize).astype(np.int32))
        return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, ends, pa.py_buffer(data)])

    def packed(rows: pa.Table) -> pa.RecordBatch:
        *names, place, value = [c.combine_chunks() for c in rows.columns]
        numbers = numbered(names)
        order = np.argsort(numbers, kind="stable")
        starts = np.flatnonzero(np.diff(numbers[order], prepend=-1))
        values = value.fill_null(np.nan).to_numpy(zero_copy_only=False)[order]
        heard = ~np.isnan(values)
        offsets = np.append(0, np.cumsum(np.add.reduceat(heard, starts, dtype=np.int64)))
        places = place.to_numpy(zero_copy_only=False)[order][heard].astype(dtype)
        first = pa.array(order[starts])
        return pa.RecordBatch.from_arrays(
            [*(c.take(first) for c in names), binary(offsets, places), binary(offsets, values[heard])],
            [*rows.schema.names[:n_names], "__places", "__samples"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                n += batch.num_rows
            if n >= GATHERED:
                yield packed(pa.Table.from_batches(waiting))
                waiting, n = [], 0
        if waiting:
            yield packed(pa.Table.from_batches(waiting))

    return run


def _collector(size: int, last_record: LastRecord):
    dtype = place_type(size)

    def loaded(state: GroupState) -> tuple:
        """The records of a group as arrays; ``names`` are (key, index)."""
        if not state.exists:
            return [], *(np.empty(0, t) for t in (np.int64, np.int64, dtype, np.float64))
        keys, idx, due, counts, places, values = state.get
        names = list(zip(bytes(keys).decode().split("\n"), np.frombuffer(idx, np.int64).tolist()))
        return (
            names, np.frombuffer(due, np.int64), np.frombuffer(counts, np.int64),
            np.frombuffer(places, dtype), np.frombuffer(values),
        )

    def keep(state: GroupState, now: int, names, due, counts, places, values) -> None:
        if names:
            keys, idx = zip(*names)
            arrays = np.array(idx, np.int64), due, counts, places, values
            state.update(("\n".join(keys).encode(), *(a.tobytes() for a in arrays)))
            state.setTimeoutTimestamp(max(int(due.min()), now + 1))
        elif state.exists:
            state.remove()

    def merged(names, due, counts, places, values, batches: Iterator[pd.DataFrame], now: int) -> tuple:
        """The records with what has come, and which of them nothing has come for."""
        names, slots, ends = [*names], {name: slot for slot, name in enumerate(names)}, {}
        into, new_places, new_values = [], [], []
        for batch in batches:
            columns = ("__key", "record_idx", "__due", "__places", "__samples")
            for key, idx, end, some_places, some_values in zip(*(batch[c] for c in columns)):
                slot = slots.get((key, idx))
                if slot is None:
                    if not some_places:
                        continue  # heartbeats alone open nothing
                    slot = slots[key, idx] = len(names)
                    names.append((key, idx))
                ends[slot] = end
                into.append(slot)
                new_places.append(some_places)
                new_values.append(some_values)
        n, opened = len(names), np.zeros(len(names) - len(due), np.int64)
        due, counts, idle = np.append(due, opened), np.append(counts, opened), np.ones(n, bool)
        touched = np.fromiter(ends, np.int64, len(ends))
        idle[touched] = False
        due[touched] = np.maximum(np.fromiter(ends.values(), np.int64, len(ends)), now + 1)
        # A number per record and place.
        kept = np.repeat(np.arange(n), np.maximum(counts, 0)) * size + places
        lengths = np.array([len(p) // dtype.itemsize for p in new_places], np.int64)
        new = np.repeat(np.array(into, np.int64), lengths) * size
        new += np.frombuffer(b"".join(new_places), dtype)
        mine = np.frombuffer(b"".join(new_values))
        order = np.lexsort((mine, new))
        order = order[counts[new[order] // size] != OUT]
        # Kept ones first, so that the first value of a place is the one that stays.
        found, first = np.unique(np.concatenate([kept, new[order]]), return_index=True)
        values = np.concatenate([values, mine[order]])[first]
        counts = np.where(counts == OUT, OUT, np.bincount(found // size, minlength=n))
        return names, due, counts, (found % size).astype(dtype), values, idle

    def rows(names: list[tuple], samples) -> pd.DataFrame:
        keys, idx = zip(*names)
        return pd.DataFrame({"__key": keys, "record_idx": idx, "samples": list(samples)})

    def closed(places: np.ndarray, values: np.ndarray) -> np.ndarray:
        """What a record gives that is over and not whole."""
        whole = np.zeros(size if last_record == "fill" else int(places[-1]) + 1)
        whole[places] = values
        return whole

    def collect(
        group: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs()
        names, due, counts, places, values = loaded(state)
        idle = np.ones(len(names), bool)
        if not state.hasTimedOut:
            names, due, counts, places, values, idle = merged(
                names, due, counts, places, values, batches, now
            )
        over, whole, held = idle & (due < now), counts == size, np.maximum(counts, 0)
        ends = np.cumsum(held)
        ready = np.flatnonzero(whole)
        if len(ready):
            yield rows([names[i] for i in ready], values[(ends[ready] - size)[:, None] + np.arange(size)])
        lost = np.flatnonzero(over & (counts != OUT))
        if len(lost) and last_record == "fail":
            raise ValueError(PARTIAL)
        if len(lost) and last_record != "skip":
            parts = [slice(ends[i] - counts[i], ends[i]) for i in lost]
            yield rows([names[i] for i in lost], [closed(places[p], values[p]) for p in parts])
        left, stays = np.flatnonzero(~over), np.repeat(~over & ~whole, held)
        counts = np.where(whole, OUT, counts)
        keep(state, now, [names[i] for i in left], due[left], counts[left], places[stays], values[stays])

    return collect
