"""From ordered rows to numbered frames, records and blocks of samples.

A long-form signal has one sample per row. A channel may hold a large share of all rows: frames
are numbered in buckets of time or in ranges of rows, and records and blocks are collected one by
one, so no task sorts or collects a whole channel.
"""

from collections.abc import Iterator, Sequence
from typing import Literal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonomere.functions.literals import check
from sonomere.functions.spectral import check_window
from sonomere.storage import written

NULL_KEY = "NULL channel or bucket in a signal"

LastRecord = Literal["skip", "fail", "fill", "keep"]

# Samples of one block of windows.
BLOCK_SAMPLES = 1 << 16


def _prefix_sums(runs: DataFrame, channel: Sequence[str], run: str) -> DataFrame:
    before = Window.partitionBy(*channel).orderBy(run).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return runs.withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))


def _numbered(placed: DataFrame, starts: DataFrame, on: list[str], frame: str) -> DataFrame:
    # A left join keeps rows whose key is NULL; they fail instead of vanishing.
    missing = F.raise_error(F.lit(NULL_KEY)).cast("bigint")
    joined = placed.join(starts, on, "left")
    return joined.withColumn(frame, F.col("__pos") + F.coalesce("__start", missing))


def number_frames(
    df: DataFrame,
    channel: Sequence[str],
    order_by: Sequence[str],
    bucket: Column | None = None,
    frame: str = "frame",
) -> DataFrame:
    """Add ``frame``, the 0-based position of a row in its channel.

    ``order_by`` must order the rows of a channel totally. The way is the caller's choice, not
    the data's:

    * ``bucket`` is a coarse column that never decreases along that order, such as the day of a
      timestamp, fine enough that a task can sort one (channel, bucket). Rows are numbered inside
      it and shifted by the rows in the channel's earlier buckets, counted in the same plan; no
      job runs before the result is asked for.
    * Without a bucket, rows are range-partitioned by their full order, which splits any channel
      at any point, at the price of one written table.
    """
    channel, order_by = list(channel), list(order_by)
    if bucket is None:
        return _number_by_range(df, channel, order_by, frame)
    bucketed = df.withColumn("__bucket", bucket)
    counts = bucketed.groupBy(*channel, "__bucket").agg(F.count("*").alias("__n"))
    return _number_by_bucket(bucketed, counts, channel, order_by, frame)


def _number_by_bucket(
    bucketed: DataFrame, counts: DataFrame, channel: list[str], order_by: list[str], frame: str
) -> DataFrame:
    on = [*channel, "__bucket"]
    inside = Window.partitionBy(*on).orderBy(*order_by)
    placed = bucketed.withColumn("__pos", F.row_number().over(inside).cast("bigint") - 1)
    starts = _prefix_sums(counts, channel, "__bucket").drop("__n")
    return _numbered(placed, starts, on, frame).drop("__bucket", "__pos", "__start")


def _number_by_range(
    df: DataFrame, channel: list[str], order_by: list[str], frame: str
) -> DataFrame:
    keys = [*channel, *order_by]
    placed = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__pos", F.monotonically_increasing_id())
    )
    # Positions depend on sampled range bounds, so they are written before anything is derived.
    placed = written(placed, "frames")
    runs = placed.groupBy(*channel, "__part").agg(
        F.min("__pos").alias("__first"), F.count("*").alias("__n")
    )
    starts = _prefix_sums(runs, channel, "__part").select(
        *channel, "__part", (F.col("__start") - F.col("__first")).alias("__start")
    )
    on = [*channel, "__part"]
    return _numbered(placed, starts, on, frame).drop("__part", "__pos", "__start")


def _collect_samples(
    df: DataFrame, keys: Sequence[str], values: dict[str, Column | str], frame: str
) -> DataFrame:
    """``(*keys, <one ARRAY<DOUBLE> per value>)`` in the order of ``frame``.

    Rows are sorted by Spark, which spills, and gathered from Arrow batches as they stream by, so
    a task holds one record and one batch, and no object per sample.
    """
    fields = [
        (F.col(v) if isinstance(v, str) else v).cast("double").alias(name)
        for name, v in values.items()
    ]
    rows = df.select(*keys, F.col(frame).alias("__frame"), *fields)
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    schema = [f"`{k}` {types[k]}" for k in keys] + [f"`{v}` array<double>" for v in values]
    ordered = rows.repartition(*keys).sortWithinPartitions(*keys, "__frame").drop("__frame")
    return ordered.mapInArrow(_gathered(len(keys)), ", ".join(schema))


def _gathered(n_keys: int):
    def vectors(batch: pa.RecordBatch, starts: np.ndarray) -> pa.RecordBatch:
        offsets = pa.array(np.append(starts, batch.num_rows).astype(np.int32))
        keys = [c.take(pa.array(starts)) for c in batch.columns[:n_keys]]
        lists = [pa.ListArray.from_arrays(offsets, c) for c in batch.columns[n_keys:]]
        return pa.RecordBatch.from_arrays([*keys, *lists], batch.schema.names)

    def closed(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        columns = [pa.concat_arrays([p.column(i) for p in parts]) for i in range(parts[0].num_columns)]
        whole = pa.RecordBatch.from_arrays(columns, parts[0].schema.names)
        return vectors(whole, np.zeros(1, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_record: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            new[0] = True
            for column in batch.columns[:n_keys]:
                code = column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
                new[1:] |= code[1:] != code[:-1]
            starts = np.flatnonzero(new)
            head = starts[1] if len(starts) > 1 else batch.num_rows
            if open_record:
                first, last = batch.slice(0, 1), open_record[0].slice(0, 1)
                if all(first.column(i).equals(last.column(i)) for i in range(n_keys)):
                    open_record.append(batch.slice(0, head))
                    if head == batch.num_rows:
                        continue
                    batch, starts = batch.slice(head), starts[1:] - head
                yield closed(open_record)
            tail = int(starts[-1])
            if tail:
                yield vectors(batch.slice(0, tail), starts[:-1])
            open_record = [batch.slice(tail)]
        if open_record:
            yield closed(open_record)

    return run


def cut_records(
    df: DataFrame,
    keys: Sequence[str],
    record_size: int,
    values: dict[str, Column | str],
    last_record: LastRecord = "skip",
    frame: str = "frame",
) -> DataFrame:
    """Cut numbered frames into consecutive records of ``record_size`` samples.

    One row ``(*keys, record_idx, <one ARRAY<DOUBLE> per value>)`` per record; shuffles on
    (keys, record), so a long channel spreads over all tasks.
    """
    if record_size < 1:
        raise ValueError(f"Incorrect record size ({record_size})")
    size = F.lit(record_size)
    cut = df.withColumn("record_idx", F.floor(F.col(frame) / size))
    records = _collect_samples(cut, [*keys, "record_idx"], values, frame)
    for name in values:
        records = complete_records(records, record_size, last_record, name)
    return records


def complete_records(
    records: DataFrame, record_size: int, last_record: LastRecord = "skip", col: str = "samples"
) -> DataFrame:
    """Apply the policy for a partial last record to records cut before."""
    length = F.size(col)
    if last_record == "skip":
        return records.filter(length == record_size)
    if last_record == "fill":
        padding = F.array_repeat(F.lit(0.0), F.lit(record_size) - length)
        return records.withColumn(col, F.concat(F.col(col), padding))
    if last_record == "fail":
        message = F.lit(
            "Signal contains a partial last record and PartialLastRecordAction is set to FAIL."
        )
        return records.withColumn(col, check(length == record_size, message, F.col(col)))
    if last_record == "keep":
        return records
    raise ValueError(f"Unknown last record action {last_record!r}")


def cut_blocks(
    df: DataFrame,
    keys: Sequence[str],
    value: Column | str,
    window_size: int,
    window_overlap: int = 0,
    windows_per_block: int | None = None,
    on_short: Literal["fail", "skip"] = "fail",
    frame: str = "frame",
) -> DataFrame:
    """Cut numbered frames into blocks that hold ``windows_per_block`` whole windows each.

    Segments a channel of any length: the frames shared by the last window of a block and the
    first of the next go to both. One row ``(*keys, block_idx, first_window, samples)`` per
    block; window ``w`` of a block is window ``first_window + w`` of the channel.
    """
    check_window(window_size, window_overlap)
    hop = window_size - window_overlap
    least = -(-window_overlap // hop) or 1  # a frame is then in two blocks at most
    per_block = max(windows_per_block or -(-BLOCK_SAMPLES // hop), least)
    step = per_block * hop
    length = step + window_overlap

    first = F.greatest(F.ceil((F.col(frame) - length + 1) / F.lit(step)), F.lit(0))
    last = F.floor(F.col(frame) / F.lit(step))
    spread = df.withColumn("block_idx", F.explode(F.sequence(first, last)))
    blocks = _collect_samples(
        spread, [*keys, "block_idx"], {"samples": value}, frame
    ).withColumn("first_window", F.col("block_idx") * per_block)

    complete = F.size("samples") >= window_size
    if on_short == "fail":
        message = F.concat(
            F.lit("Incorrect segmentation signal length ("), F.size("samples").cast("string"),
            F.lit(f"), it should be larger than winSize ({window_size})"),
        )
        whole = complete | (F.col("block_idx") > 0)
        blocks = blocks.withColumn("samples", check(whole, message, F.col("samples")))
    return blocks.filter(complete)
