"""Summaries of levels that can be merged: classes, percentiles, long-term averages, loudest windows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sonomere.streaming.levels import level_states

SILENCE = -(2**31)


def level_classes(df: DataFrame, keys: Sequence[str], level: str, width: float = 0.1) -> DataFrame:
    """``(*keys, class, n)``: how many levels lie in ``[class * width, (class + 1) * width)``.

    Counts are aggregated before they are shuffled, so a key has as many rows as there are classes
    in its range of levels, however many levels it has. -Infinity is a class of its own, null and
    NaN levels are left out.
    """
    silent = F.col(level) == F.lit(float("-inf"))
    number = F.when(silent, F.lit(SILENCE)).otherwise(F.floor(F.col(level) / F.lit(width)).cast("int"))
    known = F.col(level).isNotNull() & ~F.isnan(level)
    return df.filter(known).groupBy(*keys, number.alias("class")).agg(F.count("*").alias("n"))


def merge_classes(classes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Classes of a coarser key, or of several tables in one."""
    return classes.groupBy(*keys, "class").agg(F.sum("n").alias("n"))


def exceeded_levels(
    classes: DataFrame, keys: Sequence[str], percents: Sequence[int], width: float = 0.1
) -> DataFrame:
    """``(*keys, percent, level)``: the level that is reached or exceeded ``percent`` of the time.

    The middle of the class that holds it, so it is off by half a ``width`` at most. Works on
    classes alone; the classes of a key are few and are ordered in one task.
    """
    down = Window.partitionBy(*keys).orderBy(F.desc("class"))
    counted = classes.withColumn("__above", F.sum("n").over(down)).withColumn(
        "__all", F.sum("n").over(Window.partitionBy(*keys))
    )
    wanted = F.explode(F.array(*[F.lit(p) for p in percents])).alias("percent")
    rows = counted.select(*keys, "class", "__above", "__all", wanted)
    found = rows.filter(F.col("__above") * 100 >= F.col("percent") * F.col("__all"))
    top = found.groupBy(*keys, "percent").agg(F.max("class").alias("class"))
    middle = (F.col("class") + 0.5) * F.lit(width)
    level = F.when(F.col("class") == SILENCE, F.lit(float("-inf"))).otherwise(middle)
    return top.select(*keys, "percent", level.alias("level"))


def level_rollup(
    df: DataFrame, dimensions: dict[str, Column | str], level: str, seconds: float
) -> DataFrame:
    """``(*dimensions, depth, n, mean_level, exposure, least_level, greatest_level)`` of every
    prefix of the dimensions; those beyond ``depth`` are null.

    Powers are summed, never levels, and partially before the only shuffle.
    """
    names = list(dimensions)
    named = df.select(
        *[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in dimensions.items()],
        F.col(level).alias("__level"),
    )
    depth = F.lit(len(names)) - F.bit_count(F.grouping_id())
    return named.rollup(*names).agg(
        depth.cast("int").alias("depth"), *level_states(F.col("__level"), seconds)
    )


def top_windows(
    df: DataFrame, keys: Sequence[str], level: str, ties: Sequence[str], k: int
) -> DataFrame:
    """The ``k`` loudest rows of every key with their ``rank`` from 1 on; of equal levels the rows
    that come first by ``ties``. Null levels are the least.

    A task keeps ``k`` rows of each key before anything is shuffled.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(level), *ties)
    return df.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
