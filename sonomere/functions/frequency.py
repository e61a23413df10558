"""Bin indices and frequencies.

Every conversion exists for power spectra (``Spectrum``) and for interleaved FFTs, which hold two
values per bin (``Interleaved``). ``frequency_to_index`` and ``index_to_frequency`` take columns;
values outside the valid range fail the query.
"""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sonomere.functions.literals import check
from sonomere.functions.spectral import n_bins


@dataclass(frozen=True)
class Spectrum:
    """Frequencies of the bins of a periodogram, PSD or Welch estimate."""

    nfft: int
    fs: float

    @property
    def size(self) -> int:
        return n_bins(self.nfft)

    def index_of(self, freq: float) -> int:
        """``frequency_to_index`` of a parameter, on the driver."""
        if not 0.0 <= freq <= self.fs / 2.0:
            raise ValueError(f"Incorrect frequency ({freq}) for conversion ({self.fs / 2.0})")
        return int(freq * self.nfft / self.fs)

    def frequency_to_index(self, freq: Column) -> Column:
        index = (freq * F.lit(self.nfft) / F.lit(float(self.fs))).cast("int")
        message = F.concat(
            F.lit("Incorrect frequency ("), freq.cast("string"),
            F.lit(f") for conversion ({self.fs / 2.0})"),
        )
        return check((freq >= 0.0) & (freq <= self.fs / 2.0), message, index)

    def index_to_frequency(self, index: Column) -> Column:
        freq = index.cast("double") * F.lit(float(self.fs)) / F.lit(self.nfft)
        message = F.concat(
            F.lit("Incorrect index ("), index.cast("string"),
            F.lit(f") for conversion ({self.size})"),
        )
        return check((index >= 0) & (index < self.size), message, freq)

    def frequency_vector(self) -> Column:
        """All bin frequencies as one ARRAY<DOUBLE> expression."""
        return F.transform(
            F.sequence(F.lit(0), F.lit(self.size - 1)),
            lambda k: k.cast("double") * F.lit(float(self.fs)) / F.lit(self.nfft),
        )


@dataclass(frozen=True)
class Interleaved(Spectrum):
    """Frequencies of the values of an interleaved complex spectrum."""

    def index_of(self, freq: float) -> int:
        return 2 * super().index_of(freq)

    def frequency_to_index(self, freq: Column) -> Column:
        return 2 * super().frequency_to_index(freq)

    def index_to_frequency(self, index: Column) -> Column:
        # Integer division towards zero, so the index -1 stands for bin 0.
        return super().index_to_frequency((index / 2).cast("int"))

    def frequency_vector(self) -> Column:
        return F.flatten(F.transform(super().frequency_vector(), lambda f: F.array(f, f)))
