"""Feature workflows over recordings and tables of records.

A workflow runs on a table of records or straight on WAV files. A records table has a
``timestamp`` and either ``channels`` ARRAY<ARRAY<DOUBLE>> (all channels of a record in one row)
or ``samples`` ARRAY<DOUBLE> (one channel per row); features keep that form. On a table, every
feature is a column of its own, so a caller who selects one computes one. On files, features are
computed where samples are decoded, and samples never reach the JVM. Either way a workflow is
one narrow stage without a shuffle.
"""

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonomere.functions.bands import Bands, mean_levels_kernel
from sonomere.functions.levels import calibrate, spl_psd
from sonomere.functions.spectral import NESTED_VECTORS, VECTORS, Windowing, per_vector
from sonomere.operators.frames import LastRecord, cut_records
from sonomere.sources.wav import read_wav_features, record_size_in_frames
from sonomere.storage import written
from sonomere.streaming.samples import cut_record_stream

Kernels = dict[str, Callable[[np.ndarray], np.ndarray]]

SIGNALS = ("channels", "samples")


def _signal(df: DataFrame) -> tuple[str, bool]:
    for name in SIGNALS:
        if name in df.columns:
            return name, name == "channels"
    raise ValueError("A records table needs a 'channels' or a 'samples' column")


def _sorted(features: DataFrame, names: Iterable[str]) -> DataFrame:
    """Features by time.

    A global sort samples its input before it shuffles it, which would compute every feature
    twice; so they are written first. Ties are broken by the other keys of the record, or the
    records of many recorders starting together could not be told apart and split.
    """
    keys = [c for c in features.columns if c not in ("timestamp", *names)]
    return written(features, "features").orderBy("timestamp", *keys)


def calibrate_records(df: DataFrame, calibration: float) -> DataFrame:
    """Records with calibrated samples."""
    signal, nested = _signal(df)
    if nested:
        calibrated = F.transform(signal, lambda channel: calibrate(channel, calibration))
    else:
        calibrated = calibrate(F.col(signal), calibration)
    return df.withColumn(signal, calibrated)


class Workflow:
    """Features given by numpy kernels, and by expressions of other features."""

    segment_duration: float
    results: tuple[str, ...]

    def kernels(self, fs: float, calibration: float) -> Kernels:
        raise NotImplementedError

    def derived(self, features: DataFrame, nested: bool) -> DataFrame:
        return features

    def __call__(
        self, records: DataFrame, fs: float, sort: bool = False, calibration: float = 0.0
    ) -> DataFrame:
        """``records`` with features in place of samples.

        ``calibration`` is for records not calibrated yet.
        """
        signal, nested = _signal(records)
        found = {
            name: per_vector(kernel, nested, False)(F.col(signal))
            for name, kernel in self.kernels(fs, calibration).items()
        }
        keys = [c for c in records.columns if c != signal]
        features = self.derived(records.withColumns(found), nested).select(*keys, *self.results)
        return _sorted(features, self.results) if sort else features

    def of_samples(
        self,
        samples: DataFrame,
        keys: Sequence[str],
        fs: float,
        value: str = "x",
        last_record: LastRecord = "skip",
        calibration: float = 0.0,
        delay: str | None = None,
    ) -> DataFrame:
        """Features of the records of numbered samples ``(*keys, frame, value)``, of a table or of a
        stream. On a stream samples may come in any order within ``delay`` (``cut_record_stream``),
        and the features are those of the table that it will have been.
        """
        size = record_size_in_frames(fs, self.segment_duration)
        if samples.isStreaming:
            if delay is None:
                raise ValueError("A stream needs a delay, after which no sample is waited for")
            records = cut_record_stream(samples, keys, size, fs, delay, value, last_record=last_record)
        else:
            records = cut_records(samples, keys, size, {"samples": value}, last_record)
            micros = (F.col("record_idx") * F.lit(size * 1e6 / fs)).cast("bigint")
            records = records.withColumn("timestamp", F.timestamp_micros(micros))
        return self(records, fs, calibration=calibration)

    def of_recordings(
        self,
        spark: SparkSession,
        uri: str,
        starts: DataFrame | Iterable[tuple[str, datetime | str]],
        fs: float,
        channels: int,
        bits: int,
        last_record: LastRecord = "skip",
        sort: bool = False,
        calibration: float = 0.0,
        only_listed: bool = False,
    ) -> DataFrame:
        """Features of the records of all WAV files under ``uri``."""
        kernels = {n: (k, VECTORS) for n, k in self.kernels(fs, calibration).items()}
        read = read_wav_features(
            spark, uri, starts, fs, channels, bits, self.segment_duration, kernels, last_record,
            only_listed,
        )
        keys = [c for c in read.columns if c not in kernels]
        features = self.derived(read, True).select(*keys, *self.results)
        return _sorted(features, self.results) if sort else features


@dataclass(frozen=True)
class WelchSpl(Workflow):
    """Welch power spectral density and sound pressure level of every record."""

    segment_duration: float
    window_size: int
    window_overlap: int
    nfft: int
    results = ("welch", "spl")

    def windowing(self, fs: float, calibration: float = 0.0) -> Windowing:
        return Windowing(
            self.window_size, self.window_overlap, self.nfft, fs, calibration=calibration
        )

    def kernels(self, fs: float, calibration: float) -> Kernels:
        return {"welch": self.windowing(fs, calibration).mean_periodogram}

    def derived(self, features: DataFrame, nested: bool) -> DataFrame:
        if nested:
            spl = F.transform("welch", lambda psd: F.array(spl_psd(psd, self.nfft)))
        else:
            welch = F.col("welch")
            spl = F.when(welch.isNotNull(), F.array(spl_psd(welch, self.nfft)))
        return features.withColumn("spl", spl)


@dataclass(frozen=True)
class Tol(Workflow):
    """Third-octave levels of every record: levels of its one-second windows, combined per band.

    ``agg="avg"`` is the mean of the decibel values, ``agg="sum"`` their sum; they agree on
    records of one second.
    """

    segment_duration: float
    low: float | None = None
    high: float | None = None
    agg: str = "avg"
    results = ("tol",)

    def __post_init__(self):
        if self.segment_duration < 1.0:
            raise ValueError(
                f"Incorrect segmentDuration ({self.segment_duration}) for TOL computation"
            )
        if self.agg not in ("avg", "sum"):
            raise ValueError(f"Unknown aggregation {self.agg!r}")

    def kernels(self, fs: float, calibration: float) -> Kernels:
        second = int(fs)
        bands = Bands(second, fs, self.low, self.high)
        windowing = Windowing(second, 0, second, fs, calibration=calibration)
        return {"tol": mean_levels_kernel(bands, windowing, self.agg)}


@dataclass(frozen=True)
class WelchSplTol(Workflow):
    """Welch, sound pressure level and third-octave levels from one reading of the records."""

    segment_duration: float
    window_size: int
    window_overlap: int
    nfft: int
    low: float | None = None
    high: float | None = None
    results = ("welch", "spl", "tol")

    def __post_init__(self):
        self.tol()

    def welch_spl(self) -> WelchSpl:
        return WelchSpl(self.segment_duration, self.window_size, self.window_overlap, self.nfft)

    def tol(self) -> Tol:
        return Tol(self.segment_duration, self.low, self.high)

    def kernels(self, fs: float, calibration: float) -> Kernels:
        return self.welch_spl().kernels(fs, calibration) | self.tol().kernels(fs, calibration)

    def derived(self, features: DataFrame, nested: bool) -> DataFrame:
        return self.welch_spl().derived(features, nested)


@dataclass(frozen=True)
class AllFeatures:
    """Every feature of a recording as its own DataFrame.

    ``fft`` and ``periodogram`` hold one spectrum per window; ``tol`` (the summed variant) is
    there for records of a second or more. ``together`` has them all in one row per record.
    """

    segment_duration: float
    window_size: int
    window_overlap: int
    nfft: int
    low: float | None = None
    high: float | None = None

    def parts(self) -> dict[str, Workflow]:
        welch_spl = WelchSpl(
            self.segment_duration, self.window_size, self.window_overlap, self.nfft
        )
        parts = {"welch": welch_spl, "spl": welch_spl}
        if self.segment_duration >= 1.0:
            parts["tol"] = Tol(self.segment_duration, self.low, self.high, "sum")
        return parts

    def kernels(self, fs: float, calibration: float) -> dict[str, tuple[Callable, str]]:
        """Every kernel with the type of its result for one vector."""
        windowing = self.parts()["welch"].windowing(fs, calibration)
        kernels = {"fft": (windowing.spectra, True), "periodogram": (windowing.periodograms, True)}
        for workflow in self.parts().values():
            kernels |= {n: (k, False) for n, k in workflow.kernels(fs, calibration).items()}
        return kernels

    def together(self, records: DataFrame, fs: float, calibration: float = 0.0) -> DataFrame:
        """Records with all features as columns in place of samples: one Arrow crossing."""
        signal, nested = _signal(records)
        found = {
            name: per_vector(kernel, nested, windows)(F.col(signal))
            for name, (kernel, windows) in self.kernels(fs, calibration).items()
        }
        features = self.parts()["spl"].derived(records.withColumns(found), nested)
        return features.drop(signal)

    def together_of_recordings(
        self,
        spark: SparkSession,
        uri: str,
        starts: DataFrame | Iterable[tuple[str, datetime | str]],
        fs: float,
        channels: int,
        bits: int,
        last_record: LastRecord = "skip",
        calibration: float = 0.0,
    ) -> DataFrame:
        """All features of the records of WAV files, computed while they are read once."""
        kernels = {
            name: (kernel, NESTED_VECTORS if windows else VECTORS)
            for name, (kernel, windows) in self.kernels(fs, calibration).items()
        }
        read = read_wav_features(
            spark, uri, starts, fs, channels, bits, self.segment_duration, kernels, last_record
        )
        return self.parts()["spl"].derived(read, True)

    def _each(self, together: DataFrame) -> dict[str, DataFrame]:
        """One DataFrame per feature; whoever selects one computes one."""
        names = [n for n in ("fft", "periodogram", *self.parts()) if n in together.columns]
        return {n: together.drop(*[other for other in names if other != n]) for n in names}

    def __call__(
        self,
        spark: SparkSession,
        uri: str,
        fs: float,
        channels: int,
        bits: int,
        start: datetime | str = "1970-01-01T00:00:00.000Z",
        calibration: float = 0.0,
        last_record: LastRecord = "skip",
    ) -> dict[str, DataFrame]:
        """Features of one WAV file, which starts at ``start``."""
        starts = [(uri.rstrip("/").split("/")[-1], start)]
        return self._each(self.together_of_recordings(
            spark, uri, starts, fs, channels, bits, last_record, calibration
        ))

    def of_records(
        self, records: DataFrame, fs: float, calibration: float = 0.0
    ) -> dict[str, DataFrame]:
        """The same of a table of records."""
        return self._each(self.together(records, fs, calibration))
