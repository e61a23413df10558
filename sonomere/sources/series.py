"""Generated time series."""

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Ticks one task makes.
TASK_TICKS = 4_000_000


def make_timeserie(
    spark: SparkSession,
    start: datetime,
    end: datetime,
    tick: timedelta,
    value: Callable[[Column], Column] = lambda index: index.cast("double"),
    num_blocks: int = 1,
    ts_name: str = "ts",
    value_name: str = "val",
) -> DataFrame:
    """One row per tick in ``[start, end[``, with ``value`` of the index of the tick in its block.

    The ticks are divided into ``num_blocks`` consecutive blocks of equal size, the last one also
    taking what is left over; the index starts at 0 in every block. A large block is made by
    several tasks. Dates without a zone are read in the session time zone.
    """
    if end - start < tick:
        raise ValueError("Tick should be smaller or equal than [from, to[ interval")
    step = tick // timedelta(seconds=1)
    if step < 1 or tick != timedelta(seconds=step):
        raise ValueError(f"Tick ({tick}) should be a whole number of seconds, at least one")
    if num_blocks < 1:
        raise ValueError(f"Incorrect number of blocks ({num_blocks})")
    span = end - start
    ticks = (span.days * 86_400 + span.seconds) // step
    per_block = ticks // num_blocks

    if per_block:
        block = F.least(F.floor(F.col("id") / per_block), F.lit(num_blocks - 1))
    else:
        block = F.lit(num_blocks - 1)
    index = F.col("id") - block * per_block
    origin = F.unix_micros(F.lit(start.isoformat(sep=" ")).cast("timestamp"))
    n_tasks = max(num_blocks, -(-ticks // TASK_TICKS))
    return spark.range(0, ticks, 1, n_tasks).select(
        F.timestamp_micros(origin + F.col("id") * (step * 1_000_000)).alias(ts_name),
        value(index).alias(value_name),
    )
