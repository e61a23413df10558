"""Joins on time: the last value known before a row, and spans that overlap."""

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from sonomere.storage import written


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    time: str,
    values: dict[str, str],
    right_time: str | None = None,
    direction: Literal["backward", "forward"] = "backward",
    tolerance: Column | None = None,
) -> DataFrame:
    """Every row of ``left`` with ``values`` (new name to column of ``right``) of the last row of
    ``right`` with the same keys that is not later, or of the first one that is not earlier.

    Both tables are united and dealt over the tasks by ranges of (keys, time), which splits a key
    with most of the rows anywhere; a row finds the last value before it in its own range, or else
    the last one of the ranges before, of which there is one row per range and key. No row meets
    more than one other row, whatever the keys are like.

    Of rows of ``right`` with equal keys and time the one with the greatest values counts, compared
    in the order given. ``tolerance`` is the longest time between a row and its value. Null keys
    and times on either side match nothing; a row of ``left`` without a match has null values.
    """
    if direction not in ("backward", "forward"):
        raise ValueError(f"Unknown direction {direction!r}")
    keys, right_time = list(keys), right_time or time
    taken = set(values) & set(left.columns)
    if taken:
        raise ValueError(f"Columns {sorted(taken)} are in the left table already")
    mark = F.struct(F.col(right_time).alias("__at"), *[F.col(c).alias(n) for n, c in values.items()])
    known = F.col(right_time).isNotNull()
    for key in keys:
        known &= F.col(key).isNotNull()
    marks = right.filter(known).select(
        *keys, F.col(right_time).alias("__time"), F.lit(0).alias("__side"), mark.alias("__mark"),
    )
    rows = left.select(
        *keys, F.col(time).alias("__time"), F.lit(1).alias("__side"), F.struct(*left.columns).alias("__row")
    )
    both = marks.unionByName(rows, allowMissingColumns=True)
    when = F.col("__time") if direction == "backward" else F.col("__time").desc()
    order = [*keys, when, "__side"]
    placed = (
        both.repartitionByRange(*order)
        .sortWithinPartitions(*order, "__mark")
        .withColumn("__part", F.spark_partition_id())
        .withColumn("__pos", F.monotonically_increasing_id())
    )
    # Ranges are sampled, so they are written before anything is derived from them.
    placed = written(placed, "as-of")
    on = ["__part", *keys]
    at_mark = F.when(F.col("__mark").isNotNull(), F.col("__pos"))
    ends = placed.groupBy(*on).agg(F.max_by("__mark", at_mark).alias("__end"))
    earlier = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = ends.select(*on, F.last("__end", ignorenulls=True).over(earlier).alias("__before"))
    so_far = Window.partitionBy(*on).orderBy("__pos").rowsBetween(Window.unboundedPreceding, 0)
    found = placed.withColumn("__mark", F.last("__mark", ignorenulls=True).over(so_far))
    found = found.filter("__side = 1").join(before.filter("__before IS NOT NULL"), on, "left")
    mark = F.coalesce("__mark", "__before")
    valid = F.col("__time").isNotNull()
    if tolerance is not None:
        early, late = (mark["__at"], F.col("__time"))[:: 1 if direction == "backward" else -1]
        valid &= early + tolerance >= late
    return found.select("__row.*", *[F.when(valid, mark[n]).alias(n) for n in values])


def calibrate_as_of(
    samples: DataFrame,
    calibrations: DataFrame,
    keys: Sequence[str],
    time: str,
    calibration: str,
    value: str = "x",
    right_time: str | None = None,
) -> DataFrame:
    """Samples divided by ``10^(calibration/20)``, with the sensitivity in decibels that was valid
    at their time; null before the first one of their channel.
    """
    found = as_of_join(samples, calibrations, keys, time, {"__db": calibration}, right_time)
    divisor = F.pow(F.lit(10.0), F.col("__db") / 20.0)
    return found.withColumn(value, F.col(value) / divisor).drop("__db")


def _axis(df: DataFrame, column: str) -> tuple[Column, int]:
    """A column as a number, and its units to one of a bin: microseconds, or the number itself."""
    kind = df.schema[column].dataType
    if isinstance(kind, TimestampNTZType):
        return F.unix_micros(F.col(column).cast("timestamp")), 1_000_000
    if isinstance(kind, TimestampType):
        return F.unix_micros(column), 1_000_000
    return F.col(column), 1


def _binned(df: DataFrame, span: tuple[str, str], width: float, name: str) -> DataFrame:
    """Rows once per bin that their span touches; a span without extent touches none."""
    (start, units), (end, _) = _axis(df, span[0]), _axis(df, span[1])
    size = F.lit(width * units)
    first = F.floor(start / size).cast("bigint")
    # A span ends before its end: one that ends where a bin begins does not touch that bin.
    last = (F.ceil(end / size) - 1).cast("bigint")
    some = df.filter(start < end).withColumn(f"__first_{name}", first)
    return some.withColumn("__bin", F.explode(F.sequence(first, F.greatest(first, last))))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    width: float,
) -> DataFrame:
    """Pairs of rows with the same keys whose spans ``[start, end)`` overlap.

    ``(*keys, <other columns of left>, <other columns of right>, overlap_start, overlap_end)``.
    Spans are timestamps, or numbers. A row goes to every bin of ``width`` (seconds, or the unit of
    the numbers) that its span touches, rows meet by an equi-join on (keys, bin), and the first bin
    they share is the one that puts them out, so no pair comes twice and none is looked for across
    all rows. A bin splits a key with most of the rows by time. Rows are as many as bins their spans
    touch: choose a width near the length of most spans.

    Null keys and bounds, and spans that end before they go on, match nothing.
    """
    keys = list(keys)
    others = [c for c in right.columns if c not in keys]
    clash = set(others) & set(left.columns)
    if clash:
        raise ValueError(f"Columns {sorted(clash)} are in both tables")
    pairs = _binned(left, left_span, width, "l").join(
        _binned(right, right_span, width, "r"), [*keys, "__bin"]
    )
    begin, end = F.greatest(left_span[0], right_span[0]), F.least(left_span[1], right_span[1])
    first = F.col("__bin") == F.greatest("__first_l", "__first_r")
    pairs = pairs.filter(first & (begin < end))
    mine = [c for c in left.columns if c not in keys]
    return pairs.select(
        *keys, *mine, *others, begin.alias("overlap_start"), end.alias("overlap_end")
    )
