"""Spectra of sample vectors: the FFT kernel and everything computed from its output.

A complex spectrum is an interleaved ARRAY<DOUBLE> ``[Re0, Im0, Re1, Im1, ...]``. The only work
done outside Catalyst is the FFT itself, in Arrow batches.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from sonomere.functions.arrow_vectors import map_nested, map_vectors
from sonomere.functions.literals import check
from sonomere.functions.tapers import Taper, hamming

# Doubles held by one numpy intermediate: 1 MiB stays in a core's cache, whatever the Arrow
# batch holds.
WORK_DOUBLES = 1 << 17

VECTOR = "array<double>"
VECTORS = "array<array<double>>"
NESTED_VECTORS = "array<array<array<double>>>"


def n_bins(nfft: int) -> int:
    """Points of a one-sided spectrum."""
    if nfft < 2:
        raise ValueError(f"Incorrect nfft ({nfft}), it should be at least 2")
    return nfft // 2 + 1


def calibration_divisor(calibration: float) -> float:
    """What raw samples are divided by, given a sensitivity in dB."""
    if calibration > 0.0:
        raise ValueError(f"Incorrect calibration factor ({calibration}) for SoundCalibration")
    return 10.0 ** (calibration / 20)


def check_window(size: int, overlap: int) -> None:
    if size < 0:
        raise ValueError(f"Incorrect winSize for segmentation ({size})")
    if overlap < 0 or overlap >= size:
        raise ValueError(
            f"Incorrect overlap for segmentation "
            f"({overlap} shouldn't be negative or higher (or equal) than {size})"
        )


def bin_weights(nfft: int) -> np.ndarray:
    """How often a bin of the one-sided spectrum occurs in the two-sided one."""
    weights = np.full(n_bins(nfft), 2.0)
    weights[0] = 1.0
    if nfft % 2 == 0:
        weights[-1] = 1.0
    return weights


@dataclass(frozen=True, eq=False)
class Windowing:
    """How one signal is cut, tapered and transformed.

    ``norm`` defaults to the power-density normalisation ``1 / (fs * sum(w^2))``. A calibration
    divides the samples, which costs nothing here: it goes into the taper's coefficients.
    """

    size: int
    overlap: int
    nfft: int
    fs: float
    taper: Taper | None = None
    norm: float | None = None
    calibration: float = 0.0
    hop: int = field(init=False)
    weights: np.ndarray = field(init=False)

    def __post_init__(self):
        check_window(self.size, self.overlap)
        n_bins(self.nfft)
        if self.size > self.nfft:
            raise ValueError(f"Incorrect signal length ({self.size}) for FFT ({self.nfft})")
        taper = self.taper or hamming(self.size)
        if taper.size != self.size:
            raise ValueError(
                f"Incorrect signal length ({self.size}) for SpectrogramWindow ({taper.size})"
            )
        object.__setattr__(self, "taper", taper)
        object.__setattr__(self, "hop", self.size - self.overlap)
        divisor = calibration_divisor(self.calibration)
        object.__setattr__(self, "weights", taper.coefficients / divisor)
        if self.norm is None:
            object.__setattr__(self, "norm", taper.density_norm(self.fs))

    def pieces(self, block: np.ndarray):
        """Tapered windows of ``block`` as ``(rows, windows, size)``, a bounded piece at a time."""
        if block.shape[1] < self.size:
            raise ValueError(
                f"Incorrect segmentation signal length ({block.shape[1]}), "
                f"it should be larger than winSize ({self.size})"
            )
        views = np.lib.stride_tricks.sliding_window_view(block, self.size, axis=1)
        views = views[:, :: self.hop]
        rows, count = views.shape[:2]
        w_step = max(1, min(count, WORK_DOUBLES // self.nfft))
        r_step = max(1, WORK_DOUBLES // (self.nfft * w_step))
        for r in range(0, rows, r_step):
            for w in range(0, count, w_step):
                at = (slice(r, r + r_step), slice(w, w + w_step))
                yield at, views[at] * self.weights

    def n_windows(self, length: int) -> int:
        return 1 + (length - self.size) // self.hop

    def spectra(self, block: np.ndarray) -> np.ndarray:
        """Interleaved spectrum of every window."""
        out = np.empty((len(block), self.n_windows(block.shape[1]), 2 * n_bins(self.nfft)))
        for at, windows in self.pieces(block):
            out[at] = np.fft.rfft(windows, n=self.nfft, axis=-1).view(np.float64)
        return out

    def power(self, windows: np.ndarray) -> np.ndarray:
        z = np.fft.rfft(windows, n=self.nfft, axis=-1)
        return (z.real**2 + z.imag**2) * (self.norm * bin_weights(self.nfft))

    def periodograms(self, block: np.ndarray) -> np.ndarray:
        out = np.empty((len(block), self.n_windows(block.shape[1]), n_bins(self.nfft)))
        for at, windows in self.pieces(block):
            out[at] = self.power(windows)
        return out

    def mean_periodogram(self, block: np.ndarray) -> np.ndarray:
        squares = np.zeros((len(block), 2 * n_bins(self.nfft)))
        for at, windows in self.pieces(block):
            z = np.fft.rfft(windows, n=self.nfft, axis=-1).view(np.float64)
            squares[at[0]] += np.square(z, out=z).sum(axis=1)
        scale = self.norm * bin_weights(self.nfft) / self.n_windows(block.shape[1])
        return (squares[:, ::2] + squares[:, 1::2]) * scale


def per_vector(kernel, nested: bool, vectors_out: bool):
    """An Arrow UDF running ``kernel`` on every vector (or every channel of a nested column)."""
    if nested:
        returns = NESTED_VECTORS if vectors_out else VECTORS

        @F.arrow_udf(returns)
        def run_nested(x: pa.Array) -> pa.Array:
            return map_nested(x, kernel)

        return run_nested

    returns = VECTORS if vectors_out else VECTOR

    @F.arrow_udf(returns)
    def run(x: pa.Array) -> pa.Array:
        return map_vectors(x, kernel)

    return run


def fft(signal: Column, nfft: int, nested: bool = False) -> Column:
    """One-sided FFT of a real vector, zero-padded to ``nfft``, interleaved."""
    n_bins(nfft)

    def kernel(block):
        if block.shape[1] > nfft:
            raise ValueError(f"Incorrect signal length ({block.shape[1]}) for FFT ({nfft})")
        return np.fft.rfft(block, n=nfft, axis=1).view(np.float64)

    return per_vector(kernel, nested, False)(signal)


def stft(signal: Column, windowing: Windowing, nested: bool = False) -> Column:
    """FFT of every window of a record: ARRAY<ARRAY<DOUBLE>>, one spectrum per window."""
    return per_vector(windowing.spectra, nested, True)(signal)


def spectrogram(signal: Column, windowing: Windowing, nested: bool = False) -> Column:
    """Periodogram of every window of a record."""
    return per_vector(windowing.periodograms, nested, True)(signal)


def welch(signal: Column, windowing: Windowing, nested: bool = False) -> Column:
    """Mean periodogram over the windows of a record."""
    return per_vector(windowing.mean_periodogram, nested, False)(signal)


def _bin_power(spectrum: Column, k: Column) -> Column:
    re, im = F.get(spectrum, 2 * k), F.get(spectrum, 2 * k + 1)
    return re * re + im * im


def _weight(k: Column, nfft: int) -> Column:
    single = k == 0
    if nfft % 2 == 0:
        single = single | (k == nfft // 2)
    return F.when(single, F.lit(1.0)).otherwise(F.lit(2.0))


def _bins(nfft: int) -> Column:
    return F.sequence(F.lit(0), F.lit(n_bins(nfft) - 1))


def periodogram(spectrum: Column, nfft: int, norm: float) -> Column:
    """One-sided periodogram of an interleaved spectrum; all bins but DC and Nyquist doubled."""
    size = 2 * n_bins(nfft)
    message = F.concat(
        F.lit("Incorrect fft length ("),
        F.size(spectrum).cast("string"),
        F.lit(f") for Periodogram it should be a one-sided ({size}) FFT"),
    )
    power = F.transform(
        _bins(nfft), lambda k: F.lit(float(norm)) * _weight(k, nfft) * _bin_power(spectrum, k)
    )
    return check(F.size(spectrum) == size, message, power)


def normalized_fft(spectrum: Column, taper: Taper) -> Column:
    """Spectrum divided by the square root of the spectrum factor, as scipy's ``stft`` does."""
    scale = float(np.sqrt(taper.spectrum_factor()))
    return F.transform(spectrum, lambda v: v / F.lit(scale))


def two_sided(spectrum: Column, nfft: int) -> Column:
    """The two-sided spectrum (``2 * nfft`` values) that a one-sided one of a real signal implies."""

    def value(j):
        k = F.floor(j / 2).cast("int")
        mirrored = k > nfft // 2
        at = 2 * F.when(mirrored, nfft - k).otherwise(k) + j % 2
        sign = F.when(mirrored & (j % 2 == 1), F.lit(-1.0)).otherwise(F.lit(1.0))
        return sign * F.get(spectrum, at)

    return F.transform(F.sequence(F.lit(0), F.lit(2 * nfft - 1)), value)


def vector_mean(vectors: Column, nfft: int) -> Column:
    """Welch aggregation of the periodograms held by one row (ARRAY<ARRAY<DOUBLE>>)."""
    size = n_bins(nfft)
    consistent = F.forall(vectors, lambda v: F.size(v) == size)
    message = F.lit(f"Inconsistent periodogram lengths for Welch aggregation ({size})")
    zero = F.array_repeat(F.lit(0.0), size)
    total = F.aggregate(vectors, zero, lambda acc, v: F.zip_with(acc, v, lambda a, b: a + b))
    return check(consistent, message, F.transform(total, lambda v: v / F.size(vectors)))
