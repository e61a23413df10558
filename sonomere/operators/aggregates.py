"""Aggregations of window spectra and levels over records or channels."""

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonomere.functions.bands import Bands
from sonomere.functions.levels import to_db
from sonomere.functions.literals import check
from sonomere.functions.spectral import n_bins


def welch_long(
    df: DataFrame,
    keys: Sequence[str],
    nfft: int,
    psd: str = "psd",
    weight: Column | None = None,
) -> DataFrame:
    """Welch estimate per key from any number of rows: ``(*keys, k, p)``.

    ``psd`` may hold single periodograms or means of ``weight`` of them. Partial aggregation
    runs before the shuffle, so a key with many rows sends one row per task and bin.
    """
    size = n_bins(nfft)
    message = F.lit(f"Inconsistent periodogram lengths for Welch aggregation ({size})")
    vector = check(F.size(psd) == size, message, F.col(psd))
    if weight is None:
        rows = df.select(*keys, F.posexplode(vector).alias("k", "p"))
        return rows.groupBy(*keys, "k").agg(F.avg("p").alias("p"))
    rows = df.select(*keys, weight.alias("__n"), F.posexplode(vector).alias("k", "p"))
    mean = F.sum(F.col("p") * F.col("__n")) / F.sum("__n")
    return rows.groupBy(*keys, "k").agg(mean.alias("p"))


def tol_long(
    df: DataFrame, keys: Sequence[str], bands: Bands, k: str = "k", p: str = "p"
) -> DataFrame:
    """Third-octave levels from bins in rows: ``(*keys, band, tol)``.

    Every key has every band; one without a bin is at -Infinity. The bands of a key (at most 61)
    are summed side by side in one aggregate, which also checks that the key has all bins once.
    """
    size = n_bins(bands.nfft)
    inside = [(F.col(k) >= lo) & (F.col(k) < hi) for lo, hi in bands.bins]
    powers = F.array(*[F.sum(F.when(i, F.col(p)).otherwise(0.0)) for i in inside])
    found = df.groupBy(*keys).agg(
        powers.cast("array<double>").alias("__powers"),
        F.count("*").alias("__n"), F.min(k).alias("__low"), F.max(k).alias("__high"),
    )
    message = F.concat(
        F.lit("Incorrect PSD size ("), F.col("__n").cast("string"), F.lit(f") for TOL ({size})")
    )
    whole = (F.col("__n") == size) & (F.col("__low") == 0) & (F.col("__high") == size - 1)
    powers = check(whole, message, F.col("__powers"))
    rows = found.select(*keys, F.posexplode(powers).alias("band", "__power"))
    return rows.select(*keys, "band", to_db(F.col("__power")).alias("tol"))


def record_tol(
    df: DataFrame,
    keys: Sequence[str],
    agg: Literal["avg", "sum"] = "avg",
    col: str = "tol",
) -> DataFrame:
    """Third-octave levels of a record from those of its windows, ``(*keys, band, tol)``.

    ``avg`` is the arithmetic mean of the decibel values; ``sum`` adds them.
    """
    combine = {"avg": F.avg, "sum": F.sum}[agg]
    return df.groupBy(*keys, "band").agg(combine(col).alias(col))
