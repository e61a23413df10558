"""Third-octave bands."""

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonomere.functions.frequency import Spectrum
from sonomere.functions.levels import to_db
from sonomere.functions.literals import check, vector_literal
from sonomere.functions.spectral import Windowing

# Base-ten third octaves number 0 (1 Hz) to 60 (1 MHz).
LAST_BAND = 60
LOWEST_FREQUENCY = 1.0


@dataclass(frozen=True)
class Bands:
    """Third-octave bands of a study range.

    A band reaching over the lower end of the range is kept; one reaching over ``fs/2`` is not.
    There are at most 61, so every table made from them can be broadcast whatever the data.
    """

    nfft: int
    fs: float
    low: float | None = None
    high: float | None = None
    bounds: tuple[tuple[float, float], ...] = field(init=False)

    def __post_init__(self):
        fs, low, high = float(self.fs), self.low, self.high
        if self.nfft < fs:
            raise ValueError(f"Incorrect window size ({self.nfft}) for TOL ({fs})")
        ceiling = min(fs / 2.0, 10.0 ** (0.1 * LAST_BAND))
        bottom = LOWEST_FREQUENCY if low is None else low
        top = ceiling if high is None else high
        if low is not None and not LOWEST_FREQUENCY <= low <= top:
            raise ValueError(
                f"Incorrect low frequency ({low}) for TOL "
                f"(smaller than {LOWEST_FREQUENCY} or bigger than {top})"
            )
        if high is not None and not bottom <= high <= ceiling:
            raise ValueError(
                f"Incorrect high frequency ({high}) for TOL "
                f"(higher than {ceiling} or smaller than {bottom})"
            )
        half_band = 10.0**0.05
        centres = [10.0 ** (0.1 * i) for i in range(LAST_BAND + 1)]
        bounds = [(c / half_band, c * half_band) for c in centres]
        kept = tuple(
            (lo, hi) for lo, hi in bounds if hi >= bottom and lo <= top and hi < ceiling
        )
        object.__setattr__(self, "bounds", kept)

    @property
    def study_range(self) -> tuple[float, float]:
        ceiling = min(float(self.fs) / 2.0, 10.0 ** (0.1 * LAST_BAND))
        return (
            LOWEST_FREQUENCY if self.low is None else self.low,
            ceiling if self.high is None else self.high,
        )

    @property
    def bins(self) -> list[tuple[int, int]]:
        """Half-open bin range of every band."""
        spectrum = Spectrum(self.nfft, float(self.fs))
        return [(spectrum.index_of(lo), spectrum.index_of(hi)) for lo, hi in self.bounds]

    def frequency_vector(self) -> list[float]:
        """Lower bounds, then the last upper bound."""
        if not self.bounds:
            return []
        return [lo for lo, _ in self.bounds] + [self.bounds[-1][1]]

    def table(self, spark: SparkSession) -> DataFrame:
        """``(band, lo, hi, lo_bin, hi_bin)``, one row per band."""
        columns = {
            "lo": vector_literal([lo for lo, _ in self.bounds]),
            "hi": vector_literal([hi for _, hi in self.bounds]),
            "lo_bin": vector_literal([lo for lo, _ in self.bins]).cast("array<int>"),
            "hi_bin": vector_literal([hi for _, hi in self.bins]).cast("array<int>"),
        }
        zipped = F.arrays_zip(*[values.alias(name) for name, values in columns.items()])
        rows = spark.range(0, 1, 1, 1).select(F.posexplode(zipped).alias("band", "b"))
        return rows.select("band", "b.lo", "b.hi", "b.lo_bin", "b.hi_bin")

    def bin_table(self, spark: SparkSession) -> DataFrame:
        """``(band, k)``, one row per bin of every band; NULL for a band without one."""
        bins = F.when(F.col("hi_bin") > F.col("lo_bin"), F.sequence("lo_bin", F.col("hi_bin") - 1))
        return self.table(spark).select("band", F.explode_outer(bins).alias("k"))

    def levels(self, psd: Column) -> Column:
        """Third-octave levels (dB) of one PSD vector."""
        size = Spectrum(self.nfft, float(self.fs)).size
        message = F.concat(
            F.lit("Incorrect PSD size ("), F.size(psd).cast("string"),
            F.lit(f") for TOL ({size})"),
        )
        ranges = F.array(*[
            F.struct(F.lit(lo + 1).alias("at"), F.lit(hi - lo).alias("n")) for lo, hi in self.bins
        ])
        levels = F.transform(
            ranges,
            lambda b: to_db(
                F.aggregate(F.slice(psd, b["at"], b["n"]), F.lit(0.0), lambda a, p: a + p)
            ),
        )
        return check(F.size(psd) == size, message, levels)

    def frequency_to_index(self, freq: Column) -> Column:
        """First band holding the frequency (both ends included), -1 between two bands."""
        bottom, top = self.study_range
        found = F.coalesce(
            *[F.when(freq.between(lo, hi), F.lit(i)) for i, (lo, hi) in enumerate(self.bounds)],
            F.lit(-1),
        )
        message = F.concat(
            F.lit("Incorrect frequency ("), freq.cast("string"),
            F.lit(f") for conversion ({bottom},{top})"),
        )
        return check(freq.between(bottom, top), message, found)

    def index_to_frequency(self, index: Column) -> Column:
        """Lower bound of a band."""
        n = len(self.bounds)
        lows = F.array(*[F.lit(lo) for lo, _ in self.bounds])
        message = F.concat(
            F.lit("Incorrect index ("), index.cast("string"), F.lit(f") for conversion ({n})")
        )
        return check((index >= 0) & (index < n), message, F.get(lows, index))


def range_error(nfft: Column, fs: Column, low: Column, high: Column) -> Column:
    """What is wrong with the parameters of third-octave bands, as ``Bands`` says it; NULL if
    nothing is. A NULL limit is the default one.
    """
    ceiling = F.least(fs / 2.0, F.lit(10.0 ** (0.1 * LAST_BAND)))
    bottom, top = F.coalesce(low, F.lit(LOWEST_FREQUENCY)), F.coalesce(high, ceiling)

    def text(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    size = text("Incorrect window size (", nfft, ") for TOL (", fs, ")")
    below = text(
        "Incorrect low frequency (", low, f") for TOL (smaller than {LOWEST_FREQUENCY} or bigger than ",
        top, ")",
    )
    above = text(
        "Incorrect high frequency (", high, ") for TOL (higher than ", ceiling, " or smaller than ",
        bottom, ")",
    )
    return (
        F.when(nfft < fs, size)
        .when(low.isNotNull() & ~low.between(LOWEST_FREQUENCY, top), below)
        .when(high.isNotNull() & ~high.between(bottom, ceiling), above)
    )


def mean_levels_kernel(bands: Bands, windowing: Windowing, agg: str):
    """Kernel: levels of every window of a record, then their mean (or sum) per band."""
    bins = bands.bins

    def kernel(block: np.ndarray) -> np.ndarray:
        out = np.zeros((len(block), len(bins)))
        with np.errstate(divide="ignore"):
            for at, windows in windowing.pieces(block):
                power = windowing.power(windows)
                for b, (lo, hi) in enumerate(bins):
                    level = 10.0 * np.log10(power[..., lo:hi].sum(axis=-1))
                    out[at[0], b] += level.sum(axis=1)
        return out / windowing.n_windows(block.shape[1]) if agg == "avg" else out

    return kernel
