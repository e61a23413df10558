"""Functions and table functions for SQL text.

``register(spark)`` makes them known to a session. Scalar functions are SQL themselves, so Catalyst
sees through them; the table functions are polymorphic: their columns follow from the table and the
arguments of a call.
"""

import numpy as np
from pyspark.sql import Row, SparkSession
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn

from sonomere.functions.spectral import Windowing, check_window, n_bins

# Windows transformed at once.
WINDOWS = 64

SCALARS = {
    "to_db": (
        "v DOUBLE", "DOUBLE",
        "CASE WHEN v > 0 THEN 10 * log10(v) WHEN v = 0 THEN double('-Infinity') WHEN v < 0 THEN double('NaN') END",
    ),
    "from_db": ("level DOUBLE", "DOUBLE", "pow(10D, level / 10)"),
    "calibrated": ("x DOUBLE, sensitivity DOUBLE", "DOUBLE", "x / pow(10D, sensitivity / 20)"),
    "bin_frequency": ("k BIGINT, nfft BIGINT, fs DOUBLE", "DOUBLE", "k * fs / nfft"),
    "third_octave": (
        "frequency DOUBLE", "INT", "CASE WHEN frequency > 0 THEN CAST(round(10 * log10(frequency)) AS INT) END"
    ),
}


def _text(arguments: dict[str, AnalyzeArgument], name: str, default: str | None = None) -> str:
    if name not in arguments:
        if default is None:
            raise ValueError(f"The argument {name} is missing")
        return default
    value = arguments[name].value
    if not isinstance(value, str):
        raise ValueError(f"The argument {name} must be a constant text")
    return value


def _whole(arguments: dict[str, AnalyzeArgument], name: str) -> int:
    value = arguments[name].value if name in arguments else None
    if isinstance(value, bool) or not isinstance(value, int):
        raise ValueError(f"The argument {name} must be a constant whole number")
    return value


class _Channels:
    """A table function on channels: rows are grouped by ``keys``, names separated by commas, and come
    in the order of the column ``ordered``; ``value`` has the samples.
    """

    results: T.StructType

    @classmethod
    def checked(cls, arguments: dict[str, AnalyzeArgument]) -> None:
        check_window(_whole(arguments, "size"), _whole(arguments, "overlap"))

    @classmethod
    def analysed(cls, samples: AnalyzeArgument, arguments: dict[str, AnalyzeArgument]) -> AnalyzeResult:
        if not samples.isTable:
            raise ValueError("The first argument must be a table")
        keys = [k.strip() for k in _text(arguments, "keys").split(",")]
        order, value = _text(arguments, "ordered", "frame"), _text(arguments, "value", "x")
        for name in (*keys, order, value):
            if name not in samples.dataType.names:
                raise ValueError(f"The table has no column {name}")
        cls.checked(arguments)
        schema = T.StructType([samples.dataType[k] for k in keys] + list(cls.results))
        return AnalyzeResult(
            schema=schema,
            partitionBy=[PartitioningColumn(k) for k in keys],
            orderBy=[OrderingColumn(order)],
        )

    def begin(self, keys: str, size: int, overlap: int, value: str) -> None:
        self.keys, self.value = [k.strip() for k in keys.split(",")], value
        self.size, self.hop, self.samples, self.window = size, size - overlap, [], 0

    def rows(self, windows: np.ndarray):
        raise NotImplementedError

    def cut(self, least: int):
        """The rows of the windows that are whole, if there are ``least``."""
        n = (len(self.samples) - self.size) // self.hop + 1 if len(self.samples) >= self.size else 0
        if n < least or not n:
            return
        views = np.lib.stride_tricks.sliding_window_view(np.array(self.samples), self.size)
        for row in self.rows(views[: n * self.hop : self.hop]):
            yield (*self.key, *row)
        self.samples, self.window = self.samples[n * self.hop :], self.window + n

    def take(self, row: Row):
        self.key = [row[k] for k in self.keys]
        self.samples.append(float(row[self.value]))
        yield from self.cut(WINDOWS)

    def terminate(self):
        if hasattr(self, "samples"):
            yield from self.cut(1)


class SegmentFunction(_Channels):
    """``segment(TABLE t, keys, size, overlap)``: ``(*keys, window_idx, samples)`` of every window."""

    results = T.StructType().add("window_idx", T.LongType()).add("samples", T.ArrayType(T.DoubleType()))

    @staticmethod
    def analyze(
        samples: AnalyzeArgument, keys: AnalyzeArgument, size: AnalyzeArgument, overlap: AnalyzeArgument,
        ordered: AnalyzeArgument | None = None, value: AnalyzeArgument | None = None,
    ) -> AnalyzeResult:
        given = {"keys": keys, "size": size, "overlap": overlap, "ordered": ordered, "value": value}
        return SegmentFunction.analysed(samples, {k: v for k, v in given.items() if v is not None})

    def eval(self, samples: Row, keys: str, size: int, overlap: int, ordered: str = "frame", value: str = "x"):
        if not hasattr(self, "samples"):
            self.begin(keys, size, overlap, value)
        yield from self.take(samples)

    def rows(self, windows: np.ndarray):
        for i, window in enumerate(windows.tolist()):
            yield self.window + i, window


class SpectrogramFunction(_Channels):
    """``spectrogram(TABLE t, keys, size, overlap, nfft, fs)``: ``(*keys, window_idx, k, p)``, the
    one-sided power spectral density of every Hamming window.
    """

    results = T.StructType().add("window_idx", T.LongType()).add("k", T.IntegerType()).add("p", T.DoubleType())

    @classmethod
    def checked(cls, arguments: dict[str, AnalyzeArgument]) -> None:
        super().checked(arguments)
        size, nfft = _whole(arguments, "size"), _whole(arguments, "nfft")
        if size > nfft:
            raise ValueError(f"Incorrect signal length ({size}) for FFT ({nfft})")
        n_bins(nfft)

    @staticmethod
    def analyze(
        samples: AnalyzeArgument, keys: AnalyzeArgument, size: AnalyzeArgument, overlap: AnalyzeArgument,
        nfft: AnalyzeArgument, fs: AnalyzeArgument, ordered: AnalyzeArgument | None = None,
        value: AnalyzeArgument | None = None,
    ) -> AnalyzeResult:
        given = {
            "keys": keys, "size": size, "overlap": overlap, "nfft": nfft, "ordered": ordered, "value": value,
        }
        return SpectrogramFunction.analysed(samples, {k: v for k, v in given.items() if v is not None})

    def eval(
        self, samples: Row, keys: str, size: int, overlap: int, nfft: int, fs: float, ordered: str = "frame",
        value: str = "x",
    ):
        if not hasattr(self, "samples"):
            self.begin(keys, size, overlap, value)
            self.windowing = Windowing(size, overlap, nfft, float(fs))
        yield from self.take(samples)

    def rows(self, windows: np.ndarray):
        for i, spectrum in enumerate(self.windowing.power(windows * self.windowing.weights).tolist()):
            for k, p in enumerate(spectrum):
                yield self.window + i, k, p


TABLE_FUNCTIONS = {"segment": SegmentFunction, "spectrogram": SpectrogramFunction}


def register(spark: SparkSession) -> None:
    """Make all functions known to the session: ``to_db``, ``from_db``, ``calibrated``,
    ``bin_frequency``, ``third_octave``, and the table functions ``segment`` and ``spectrogram``.

    Table functions hold some windows of a channel at a time, whatever its length; one channel is
    read by one task, in the order of its rows, which Spark sorts. Samples must not be null.
    """
    from pyspark.sql.functions import udtf

    for name, (arguments, result, body) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")
    for name, function in TABLE_FUNCTIONS.items():
        spark.udtf.register(name, udtf(function))
