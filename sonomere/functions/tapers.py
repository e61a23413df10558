"""Taper (window) functions and their normalisation factors."""

from dataclasses import dataclass
from typing import Literal

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonomere.functions.literals import check, vector_literal

TaperKind = Literal["symmetric", "periodic"]

# Cosine-sum coefficients of the classical tapers.
HAMMING = (0.54, 0.46)
HANN = (0.5, 0.5)
BLACKMAN = (0.42, 0.5, 0.08)


@dataclass(frozen=True, eq=False)
class Taper:
    """A vector of window coefficients; any vector will do (``Taper.of([...])``)."""

    coefficients: np.ndarray

    @staticmethod
    def of(coefficients) -> "Taper":
        return Taper(np.asarray(coefficients, dtype=np.float64))

    @property
    def size(self) -> int:
        return len(self.coefficients)

    def density_factor(self, alpha: float = 1.0) -> float:
        """Energy of the window, sum(w^2) / alpha^2: normalises to a power density."""
        return float(np.sum(self.coefficients**2)) / alpha**2

    def spectrum_factor(self, alpha: float = 1.0) -> float:
        """Squared sum of the window, sum(w)^2 / alpha^2: normalises to a power spectrum."""
        return float(np.sum(self.coefficients)) ** 2 / alpha**2

    def density_norm(self, fs: float) -> float:
        return 1.0 / (float(fs) * self.density_factor())

    def spectrum_norm(self) -> float:
        return 1.0 / self.spectrum_factor()

    def apply(self, signal: Column) -> Column:
        """``signal`` (ARRAY<DOUBLE>) multiplied by the window, sample by sample."""
        tapered = F.zip_with(signal, vector_literal(self.coefficients), lambda x, w: x * w)
        message = F.concat(
            F.lit("Incorrect signal length ("),
            F.size(signal).cast("string"),
            F.lit(f") for SpectrogramWindow ({self.size})"),
        )
        return check(F.size(signal) == self.size, message, tapered)

    def table(self, spark: SparkSession) -> DataFrame:
        """The coefficients as rows ``(i INT, w DOUBLE)``; ``size`` rows, so always broadcastable."""
        one = spark.range(0, 1, 1, 1).select(vector_literal(self.coefficients).alias("w"))
        return one.select(F.posexplode("w").alias("i", "w"))


def cosine_sum(size: int, coefficients: tuple[float, ...], kind: TaperKind = "periodic") -> Taper:
    """``w(n) = sum_k a_k cos(k x_n)`` with ``x_n`` running from -pi over one period."""
    if kind not in ("symmetric", "periodic"):
        raise ValueError(f"Unknown window type {kind!r}")
    if size < 1 or (kind == "symmetric" and size < 2):
        raise ValueError(f"Incorrect window size ({size}) for a {kind} window")
    period = size - 1 if kind == "symmetric" else size
    x = -np.pi + 2.0 * np.pi * np.arange(size) / period
    return Taper.of(sum(a * np.cos(k * x) for k, a in enumerate(coefficients)))


def hamming(size: int, kind: TaperKind = "periodic") -> Taper:
    return cosine_sum(size, HAMMING, kind)


def hann(size: int, kind: TaperKind = "periodic") -> Taper:
    return cosine_sum(size, HANN, kind)


def blackman(size: int, kind: TaperKind = "periodic") -> Taper:
    return cosine_sum(size, BLACKMAN, kind)
