"""Calibration, decibels, energies and sound pressure levels as Catalyst expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from sonomere.functions.literals import check
from sonomere.functions.spectral import _bin_power, _bins, _weight, calibration_divisor, n_bins


def calibrate(signal: Column, calibration: float) -> Column:
    """Samples divided by ``10^(calibration/20)``; ``calibration`` is a sensitivity in dB, <= 0."""
    divisor = F.lit(calibration_divisor(calibration))
    return F.transform(signal, lambda x: x / divisor)


def calibrate_value(value: Column, calibration: float) -> Column:
    """``calibrate`` for one sample per row."""
    return value / F.lit(calibration_divisor(calibration))


def to_db(value: Column) -> Column:
    """``10 log10(v)``, -Infinity at 0 and NaN below."""
    return (
        F.when(value > 0, 10.0 * F.log10(value))
        .when(value == 0, F.lit(float("-inf")))
        .when(value < 0, F.lit(float("nan")))
    )


def _sum(values: Column, term) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + term(v))


def _sized(vector: Column, valid: Column, what: str, size: int, energy: Column) -> Column:
    message = F.concat(
        F.lit(f"Incorrect {what} size ("), F.size(vector).cast("string"),
        F.lit(f") for Energy ({size})"),
    )
    return check(valid, message, energy)


def energy_raw(signal: Column, nfft: int) -> Column:
    """Energy of a raw signal of at most ``nfft`` samples."""
    return _sized(
        signal, F.size(signal) <= nfft, "signal", nfft, _sum(signal, lambda x: x * x)
    )


def energy_fft(spectrum: Column, nfft: int) -> Column:
    """Energy of a one-sided FFT (Parseval)."""
    size = 2 * n_bins(nfft)
    energy = _sum(_bins(nfft), lambda k: _weight(k, nfft) * _bin_power(spectrum, k))
    return _sized(
        spectrum, F.size(spectrum) == size, "fft", size, energy / F.lit(float(nfft))
    )


def energy_psd(psd: Column, nfft: int) -> Column:
    """Energy of a one-sided power spectral density."""
    size = n_bins(nfft)
    return _sized(psd, F.size(psd) == size, "PSD", size, _sum(psd, lambda p: p))


def spl_raw(signal: Column, nfft: int) -> Column:
    return to_db(energy_raw(signal, nfft))


def spl_fft(spectrum: Column, nfft: int) -> Column:
    return to_db(energy_fft(spectrum, nfft))


def spl_psd(psd: Column, nfft: int) -> Column:
    return to_db(energy_psd(psd, nfft))
