"""Gridded variables, one slice of the first dimension per row."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def grid_to_rows(
    df: DataFrame, keys: Sequence[str], grid: str, value: str = "value"
) -> DataFrame:
    """``(*keys, i, j, value)`` from ARRAY<ARRAY<numeric>> slices; slices are flattened where they
    are read, without a shuffle.
    """
    rows = df.select(*keys, F.posexplode(grid).alias("i", "__row"))
    return rows.select(*keys, "i", F.posexplode("__row").alias("j", value))


def with_coordinates(
    rows: DataFrame, coordinates: DataFrame, index: str, name: str
) -> DataFrame:
    """Replace a grid index by its coordinate from a table ``(index, value)``.

    Coordinate tables have one row per position of a dimension; Spark broadcasts them when their
    measured size allows. A cell whose position has no coordinate is an error.
    """
    position, coordinate = coordinates.columns[:2]
    table = coordinates.select(F.col(position).alias(index), F.col(coordinate).alias(name))
    missing = F.concat(F.lit(f"No {name} for position "), F.col(index).cast("string"))
    found = F.when(F.col("__known"), F.col(name)).otherwise(F.raise_error(missing))
    joined = rows.join(table.withColumn("__known", F.lit(True)), index, "left")
    return joined.withColumn(name, found).drop(index, "__known")
