"""Levels over windows of event time, on a table or on a stream."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonomere.functions.levels import to_db


def power(level: Column) -> Column:
    """The power that a level in decibels stands for; silence is 0."""
    return F.pow(F.lit(10.0), level / 10.0)


def level_states(level: Column, seconds: float) -> list[Column]:
    """Aggregates that make levels over any span: ``n``, ``mean_level`` of the mean power,
    ``exposure`` of the power summed over time, ``least_level`` and ``greatest_level``.
    """
    return [
        F.count(level).alias("n"),
        to_db(F.avg(power(level))).alias("mean_level"),
        to_db(F.sum(power(level)) * F.lit(seconds)).alias("exposure"),
        F.min(level).alias("least_level"),
        F.max(level).alias("greatest_level"),
    ]


def levels_by_window(
    features: DataFrame,
    keys: Sequence[str],
    record_keys: Sequence[str],
    seconds: float,
    window: str,
    slide: str | None = None,
    delay: str | None = None,
    time: str = "timestamp",
    level: str = "spl",
) -> DataFrame:
    """``(*keys, window_start, n, mean_level, exposure, least_level, greatest_level)`` of every
    window of event time, from levels of records that last ``seconds``.

    ``record_keys`` tell records apart: a record that comes again counts once. On a stream that
    holds within ``delay``, the time for which a window stays open and a record is remembered; both
    are dropped when the watermark has passed, so the state is bounded by ``delay`` and not by the
    stream. A record later than that is dropped. Windows come out once, when they are closed. A
    record with a null level is a heartbeat: it moves time on and counts in no window. Spark's
    watermark begins at 1970, so that records up to then are late on a stream. On a table
    ``delay`` means nothing, and the result is that of a stream in which nothing came too late.
    """
    record_keys = list(dict.fromkeys([*record_keys, time]))
    if features.isStreaming:
        if delay is None:
            raise ValueError("A stream needs a delay, after which nothing is waited for")
        timed = features.withWatermark(time, delay)
        once = timed.dropDuplicatesWithinWatermark(record_keys)
    else:
        once = features.dropDuplicates(record_keys)
    span = F.window(time, window, slide) if slide else F.window(time, window)
    found = once.filter(F.col(level).isNotNull()).groupBy(span.alias("window"), *keys)
    names = ["n", "mean_level", "exposure", "least_level", "greatest_level"]
    levels = found.agg(*level_states(F.col(level), seconds))
    return levels.select(*keys, F.col("window.start").alias("window_start"), *names)
