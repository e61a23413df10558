"""Between one row per channel and one row per record."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonomere.functions.literals import elements


def explode_channels(df: DataFrame, col: str = "channels", out: str = "samples") -> DataFrame:
    """One row per channel of a multi-channel record; no shuffle."""
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.posexplode(elements(col)).alias("channel", out))


def nest_channels(
    df: DataFrame, keys: Sequence[str], cols: Sequence[str], channel: str = "channel"
) -> DataFrame:
    """One row per record, every feature as an array over its channels in channel order."""
    rows = F.sort_array(F.collect_list(F.struct(channel, *cols)))
    grouped = df.groupBy(*keys).agg(rows.alias("__rows"))
    return grouped.select(*keys, *[F.col("__rows")[c].alias(c) for c in cols])
