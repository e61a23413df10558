import numpy as np
import pytest
from pyspark.sql import functions as F

from sonomere.functions.tapers import Taper, blackman, hamming, hann
from sonomere.operators.windows import apply_taper, apply_taper_long

# The periodic Hamming window of 32 points.
HAMMING_32 = [
    0.08, 0.088838771014514, 0.1150154150448081, 0.1575239783408292, 0.2147308806541882,
    0.2844376928109831, 0.3639656211120588, 0.4502584518725811, 0.54, 0.6297415481274191,
    0.7160343788879413, 0.795562307189017, 0.865269119345812, 0.922476021659171,
    0.9649845849551919, 0.9911612289854861, 1.0,
]


def test_hamming_periodic():
    expected = HAMMING_32 + HAMMING_32[1:16][::-1]
    assert np.allclose(hamming(32).coefficients, expected, rtol=0, atol=4e-14)


def test_symmetric_windows_mirror():
    for make in (hamming, hann, blackman):
        w = make(33, "symmetric").coefficients
        assert np.allclose(w, w[::-1], atol=1e-15)
        assert np.isclose(w[16], 1.0)
    assert np.isclose(hann(32, "symmetric").coefficients[0], 0.0)
    assert np.allclose(hann(32).coefficients, 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(32) / 32))


@pytest.mark.parametrize(
    "taper, density, spectrum",
    [
        (hamming(32, "symmetric"), 4.024751020408163, 92.37955918367348),
        (hamming(32, "periodic"), 4.152424489795918, 97.50151836734696),
        (blackman(32, "symmetric"), 3.0832979591836738, 55.35359999999999),
        (blackman(32, "periodic"), 3.182759183673469, 58.9824),
    ],
)
def test_factors(taper, density, spectrum):
    assert np.isclose(taper.density_factor(1.75), density, rtol=1e-14)
    assert np.isclose(taper.spectrum_factor(1.75), spectrum, rtol=1e-14)


def test_user_defined_window(spark):
    n = 1024
    ramp = Taper.of(np.arange(1, n + 1))
    df = spark.range(1).select(
        F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: 1.0 / i).alias("x")
    )
    tapered = apply_taper(df, ramp).first().x
    assert np.isclose(sum(tapered), 1024, rtol=1e-14)
    rows = df.select(F.posexplode("x").alias("i", "value"))
    assert np.isclose(apply_taper_long(rows, ramp).agg(F.sum("value")).first()[0], 1024)


def test_long_tapers_stay_one_literal(spark):
    df = spark.range(1).select(F.array_repeat(F.lit(1.0), 48000).alias("x"))
    tapered = apply_taper(df, hamming(48000))
    assert tapered.select(F.size("x")).first()[0] == 48000
    assert tapered.agg(F.sum(F.col("x")[0])).first()[0] == pytest.approx(0.08)


def test_errors(spark):
    with pytest.raises(ValueError):
        hamming(1, "symmetric")
    with pytest.raises(ValueError):
        hamming(8, "other")
    df = spark.range(1).select(F.array(F.lit(1.0)).alias("x"))
    with pytest.raises(Exception, match=r"Incorrect signal length \(1\) for SpectrogramWindow \(8\)"):
        apply_taper(df, hamming(8)).collect()
