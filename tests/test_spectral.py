import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonomere.functions import levels, spectral
from sonomere.functions.spectral import Windowing
from sonomere.functions.tapers import Taper, hann
from sonomere.operators.aggregates import welch_long
from sonomere.operators.windows import bins, complex_bins, spectrogram, stft

# Start of the FFT of cos(0, 0.1, ..., 10) and of the periodogram of
# 2 cos + 3 sin at 1000 Hz.
FFT_101 = [
    -5.3552126084096887, 0.0, -9.3015054823533401, 18.079330752013401, 12.301449694913190,
    -40.406477468073383, 3.4128549118994069, -13.355268892224943,
]
PERIODOGRAM_101 = [
    0.018821131046057503, 0.155794411914756625, 0.403962223018968447, 0.036691691896538800,
    0.013860845848032056, 0.007496823811848302, 0.004775020226013218, 0.003339960066646203,
]
PERIODOGRAM_101_LAST = 0.000135526233395330


def vectors(spark, rows):
    schema = T.StructType([
        T.StructField("id", T.IntegerType()), T.StructField("x", T.ArrayType(T.DoubleType()))
    ])
    rows = [(i, None if x is None else [float(v) for v in x]) for i, x in enumerate(rows)]
    return spark.createDataFrame(rows, schema).repartition(1)


def values(df, expression):
    rows = df.select("id", expression.alias("v")).collect()
    return [np.array(r.v) for r in sorted(rows, key=lambda r: r.id)]


def interleaved(signal, nfft):
    return np.fft.rfft(signal, nfft).view(float)


def test_fft_goldens(spark):
    signal = np.cos(np.arange(101) * 0.1)
    found = values(vectors(spark, [signal]), spectral.fft(F.col("x"), 101))[0]
    assert len(found) == 102
    assert np.allclose(found[:8], FFT_101, rtol=0, atol=1e-13)


def test_periodogram_goldens(spark):
    t = np.arange(101) * 0.1
    df = vectors(spark, [2 * np.cos(t) + 3 * np.sin(t)]).withColumn(
        "fft", spectral.fft(F.col("x"), 101)
    )
    found = values(df, spectral.periodogram(F.col("fft"), 101, 1 / (101 * 1000.0)))[0]
    assert len(found) == 51
    assert np.allclose(found[:8], PERIODOGRAM_101, rtol=0, atol=1.1e-15)
    assert np.isclose(found[-1], PERIODOGRAM_101_LAST, rtol=0, atol=1.1e-15)


@pytest.mark.parametrize("nfft", [2, 3, 16, 17, 40])
def test_lengths_and_nulls_mix_in_a_batch(spark, nfft):
    rng = np.random.default_rng(0)
    signals = [rng.normal(size=n) for n in (nfft, 1, nfft, 2, 1)] + [None]
    found = values(vectors(spark, signals), spectral.fft(F.col("x"), nfft))
    for signal, spectrum in zip(signals, found):
        if signal is None:
            assert spectrum.item() is None
        else:
            assert np.allclose(spectrum, interleaved(signal, nfft), atol=1e-12)


def test_errors(spark):
    df = vectors(spark, [np.zeros(100)])
    with pytest.raises(Exception, match=r"Incorrect signal length \(100\) for FFT \(10\)"):
        df.select(spectral.fft(F.col("x"), 10)).collect()
    with pytest.raises(ValueError, match="Incorrect nfft"):
        spectral.fft(F.col("x"), 1)
    with pytest.raises(Exception, match=r"Incorrect fft length \(100\) for Periodogram"):
        df.select(spectral.periodogram(F.col("x"), 10, 1.0)).collect()
    with pytest.raises(ValueError, match="Incorrect signal length"):
        Windowing(32, 0, 16, 1.0)
    with pytest.raises(ValueError, match="SpectrogramWindow"):
        Windowing(32, 0, 32, 1.0, hann(16))
    with pytest.raises(Exception, match="it should be larger than winSize"):
        df.select(spectral.welch(F.col("x"), Windowing(128, 0, 128, 1.0))).collect()
    with pytest.raises(Exception, match=r"Inconsistent periodogram lengths .* \(51\)"):
        df.select(spectral.vector_mean(F.array("x"), 100)).collect()
    with pytest.raises(Exception, match="Inconsistent periodogram lengths"):
        welch_long(df.withColumnRenamed("x", "psd"), ["id"], 100).collect()


@pytest.mark.parametrize("nfft", [8, 9, 64, 65])
def test_two_sided(spark, nfft):
    signal = np.random.default_rng(1).normal(size=8)
    df = vectors(spark, [signal]).withColumn("fft", spectral.fft(F.col("x"), nfft))
    found = values(df, spectral.two_sided(F.col("fft"), nfft))[0]
    assert np.allclose(found, np.fft.fft(signal, nfft).view(float), atol=1e-12)


@pytest.mark.parametrize("n", [10, 11, 64])
def test_parseval(spark, n):
    signal = np.random.default_rng(2).normal(size=n)
    df = vectors(spark, [signal]).withColumn("fft", spectral.fft(F.col("x"), n))
    df = df.withColumn("psd", spectral.periodogram(F.col("fft"), n, 1.0 / n))
    row = df.select(
        levels.energy_raw(F.col("x"), n).alias("raw"),
        levels.energy_fft(F.col("fft"), n).alias("fft"),
        levels.energy_psd(F.col("psd"), n).alias("psd"),
    ).first()
    assert np.allclose([row.fft, row.psd], row.raw, rtol=1e-12)


def local_periodograms(signal, windowing):
    n = 1 + (len(signal) - windowing.size) // windowing.hop
    cut = [signal[w * windowing.hop:][: windowing.size] for w in range(n)]
    spectra = [np.fft.rfft(x * windowing.taper.coefficients, windowing.nfft) for x in cut]
    weights = np.full(windowing.nfft // 2 + 1, 2.0)
    weights[0] = 1
    if windowing.nfft % 2 == 0:
        weights[-1] = 1
    return np.array([abs(z) ** 2 * windowing.norm * weights for z in spectra])


@pytest.mark.parametrize("size, overlap, nfft", [(32, 16, 32), (24, 12, 31), (60, 50, 70), (100, 0, 100)])
def test_kernels_against_numpy(spark, size, overlap, nfft):
    rng = np.random.default_rng(3)
    signals = [rng.normal(size=n) for n in (200, 200, 131, 100, 200)]
    df = vectors(spark, signals)
    windowing = Windowing(size, overlap, nfft, 500.0)
    expected = [local_periodograms(s, windowing) for s in signals]
    for found, wanted in zip(values(df, spectral.spectrogram(F.col("x"), windowing)), expected):
        assert np.allclose(np.stack(found), wanted, rtol=1e-12)
    for found, wanted in zip(values(df, spectral.welch(F.col("x"), windowing)), expected):
        assert np.allclose(found, wanted.mean(axis=0), rtol=1e-12)
    in_row = df.withColumn("psds", spectral.spectrogram(F.col("x"), windowing))
    for found, wanted in zip(values(in_row, spectral.vector_mean(F.col("psds"), nfft)), expected):
        assert np.allclose(found, wanted.mean(axis=0), rtol=1e-12)
    long = welch_long(spectrogram(df, windowing, "x"), ["id"], nfft).collect()
    for r in long:
        assert np.isclose(r.p, expected[r.id].mean(axis=0)[r.k], rtol=1e-12)
    assert bins(spectrogram(df, windowing, "x"), ["id"]).count() == sum(e.size for e in expected)


def test_work_is_cut_into_bounded_pieces(spark, monkeypatch):
    signals = [np.random.default_rng(4).normal(size=400) for _ in range(5)]
    windowing = Windowing(16, 8, 16, 1.0)
    whole = windowing.periodograms(np.stack(signals))
    monkeypatch.setattr(spectral, "WORK_DOUBLES", 16 * 7)
    pieces = [w.shape for _, w in windowing.pieces(np.stack(signals))]
    assert max(a * b * c for a, b, c in pieces) <= 16 * 7
    assert np.array_equal(windowing.periodograms(np.stack(signals)), whole)
    assert np.allclose(windowing.mean_periodogram(np.stack(signals)), whole.mean(axis=1))


def test_nested_channels_equal_flat_ones(spark):
    df = vectors(spark, [np.arange(64), np.arange(64)[::-1]])
    windowing = Windowing(16, 0, 16, 1.0)
    flat = values(df, spectral.welch(F.col("x"), windowing))
    nested = df.groupBy().agg(F.sort_array(F.collect_list(F.struct("id", "x")))["x"].alias("c"))
    found = nested.select(spectral.welch(F.col("c"), windowing, nested=True).alias("w")).first().w
    assert np.allclose(found, flat)
    empty = spark.range(1).select(F.array().cast("array<array<double>>").alias("c"))
    assert empty.select(spectral.welch(F.col("c"), windowing, True).alias("w")).first().w == []


def test_stft_is_linear(spark):
    rng = np.random.default_rng(5)
    a, b = rng.normal(size=64), rng.normal(size=64)
    windowing = Windowing(16, 8, 20, 1.0, Taper.of(np.ones(16)))
    found = values(vectors(spark, [a, b, a + b]), spectral.stft(F.col("x"), windowing))
    za, zb, zab = (np.stack(v) for v in found)
    assert np.allclose(za + zb, zab)
    rows = complex_bins(stft(vectors(spark, [a]), windowing, "x"), ["window_idx"]).collect()
    assert len(rows) == za.shape[0] * 11
    assert all(np.isclose(r.re, za[r.window_idx][2 * r.k]) for r in rows)


def test_unused_spectra_are_not_computed(spark):
    df = vectors(spark, [np.arange(64)])
    windowing = Windowing(16, 8, 16, 1.0)
    both = df.select(
        "id", spectral.welch(F.col("x"), windowing).alias("a"), spectral.fft(F.col("x"), 64).alias("b")
    )

    def plan(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    assert plan(both).count("ArrowEvalPython") == 1
    assert plan(both.select("a")).count("pythonUDF1") == 0
    assert "ArrowEvalPython" not in plan(both.select("id"))
