"""The transform over shuffled columns and rows against the one in memory."""

import numpy as np
import pytest

from sonomere.operators.long_fft import fft_long, split_size


def frames(spark, signals):
    rows = [(c, i, float(v)) for c, x in signals.items() for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "c string, frame bigint, x double")


def spectra(found):
    out = {}
    for r in found.collect():
        out.setdefault(r.c, {})[r.k] = complex(r.re, r.im)
    return {c: np.array([z[k] for k in sorted(z)]) for c, z in out.items()}


@pytest.mark.parametrize("nfft", [2, 3, 7, 12, 64, 100, 101, 120, 1000])
@pytest.mark.parametrize("points", [1, 16, 1 << 18])
def test_every_size(spark, nfft, points):
    rng = np.random.default_rng(nfft)
    signals = {"a": rng.normal(size=nfft), "b": rng.normal(size=max(1, nfft - 3))}
    found = spectra(fft_long(frames(spark, signals), ["c"], nfft, block_points=points))
    for c, x in signals.items():
        assert np.allclose(found[c], np.fft.rfft(x, nfft), atol=1e-9)


def test_a_million_points(spark):
    """No row and no task has the channel: blocks hold a sixteenth of it."""
    n = 1 << 20
    df = spark.range(n, numPartitions=8).selectExpr("'a' AS c", "id AS frame", "sin(id * 0.37) + cos(id * id * 1e-7) AS x")
    i = np.arange(n)
    wanted = np.fft.rfft(np.sin(i * 0.37) + np.cos(i * i * 1e-7))
    found = fft_long(df, ["c"], n, block_points=1 << 16).toPandas().sort_values("k")
    assert found.k.tolist() == list(range(n // 2 + 1))
    assert np.allclose(found.re + 1j * found.im, wanted, atol=1e-6)


def test_gaps_repeats_nulls_and_ends(spark):
    rows = [("a", 0, 1.0), ("a", 3, 2.0), ("a", 3, 1.0), ("a", 4, None), (None, 1, 5.0)]
    df = spark.createDataFrame(rows, "c string, frame bigint, x double")
    found = spectra(fft_long(df, ["c"], 6))
    assert np.allclose(found["a"], np.fft.rfft([1, 0, 0, 3, 0, 0]))
    assert np.allclose(found[None], np.fft.rfft([0, 5, 0, 0, 0, 0]))
    assert fft_long(df.limit(0), ["c"], 6).count() == 0
    with pytest.raises(Exception, match=r"Incorrect signal length \(5\) for FFT \(4\)"):
        fft_long(df, ["c"], 4).collect()
    with pytest.raises(ValueError, match="nfft"):
        fft_long(df, ["c"], 1)


def test_split():
    assert split_size(1 << 20) == (1024, 1024) and split_size(12) == (4, 3) and split_size(13) == (13, 1)
