"""Windows of records and their spectra, one row per window."""

from collections.abc import Sequence
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sonomere.functions import spectral
from sonomere.functions.literals import check, elements
from sonomere.functions.spectral import Windowing, check_window
from sonomere.functions.tapers import Taper


def segment(
    df: DataFrame,
    size: int,
    overlap: int = 0,
    col: str = "samples",
    out: str = "x",
    on_short: Literal["fail", "skip"] = "fail",
) -> DataFrame:
    """One row per window: ``window_idx`` and the window's samples replace the record's.

    Windows are sliced inside the row before it is exploded, so a record is never copied once
    per window. An incomplete last window is dropped.
    """
    check_window(size, overlap)
    hop = size - overlap
    length = F.size(col)
    if on_short == "skip":
        df = df.filter(length >= size)
    count = F.floor((length - size) / F.lit(hop)).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), count), lambda w: F.slice(F.col(col), w * hop + 1, size)
    )
    message = F.concat(
        F.lit("Incorrect segmentation signal length ("), length.cast("string"),
        F.lit(f"), it should be larger than winSize ({size})"),
    )
    windows = check(length >= size, message, cut)
    others = [c for c in df.columns if c != col]
    return df.select(*others, F.posexplode(windows).alias("window_idx", out))


def segment_tol(df: DataFrame, fs: float, **options) -> DataFrame:
    """The one-second windows third-octave levels are computed on."""
    return segment(df, int(fs), 0, **options)


def apply_taper(df: DataFrame, taper: Taper, col: str = "x") -> DataFrame:
    return df.withColumn(col, taper.apply(F.col(col)))


def apply_taper_long(
    df: DataFrame, taper: Taper, index: str = "i", value: str = "value"
) -> DataFrame:
    """Taper windows held as one sample per row."""
    coefficients = taper.table(df.sparkSession).withColumnRenamed("i", index)
    return df.join(coefficients, index).withColumn(value, F.col(value) * F.col("w")).drop("w")


def _windows_out(df: DataFrame, vectors, col: str, out: str) -> DataFrame:
    others = [c for c in df.columns if c != col]
    return (
        df.withColumn("__vectors", vectors)
        .select(*others, F.posexplode(elements("__vectors")).alias("window_idx", out))
    )


def stft(
    df: DataFrame, windowing: Windowing, col: str = "samples", out: str = "fft"
) -> DataFrame:
    """FFT of every window of every record, one row per window.

    Records cross to Python once; windows are views of them there, so overlap costs nothing.
    """
    return _windows_out(df, spectral.stft(F.col(col), windowing), col, out)


def spectrogram(
    df: DataFrame, windowing: Windowing, col: str = "samples", out: str = "psd"
) -> DataFrame:
    """Periodogram of every window of every record, one row per window."""
    return _windows_out(df, spectral.spectrogram(F.col(col), windowing), col, out)


def bins(
    df: DataFrame, keys: Sequence[str], col: str = "psd", out: str = "p", index: str = "k"
) -> DataFrame:
    """Long form of a power spectrum or of any feature: one row ``(*keys, k, p)`` per value."""
    return df.select(*keys, F.posexplode(elements(col)).alias(index, out))


def complex_bins(df: DataFrame, keys: Sequence[str], col: str = "fft") -> DataFrame:
    """Long form of an interleaved spectrum: one row ``(*keys, k, re, im)`` per bin."""
    pairs = F.transform(
        F.sequence(F.lit(0), F.floor(F.size(col) / 2).cast("int") - 1),
        lambda k: F.struct(
            F.get(F.col(col), 2 * k).alias("re"), F.get(F.col(col), 2 * k + 1).alias("im")
        ),
    )
    rows = df.select(*keys, F.posexplode(pairs).alias("k", "z"))
    return rows.select(*keys, "k", "z.re", "z.im")
