import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonomere.functions import levels, spectral
from sonomere.functions.bands import Bands
from sonomere.operators.aggregates import tol_long
from sonomere.functions.frequency import Interleaved, Spectrum
from sonomere.plans.workflows import Tol

# Energy and level of 1..10 and 1..11; third-octave levels of the PSD of 1..128.
ENERGY = {10: (385.0, 25.854607295085007), 11: (506.0, 27.041505168397993)}
CUSTOM_BOUNDS = [
    (28.183829312644537, 35.48133892335754), (35.481338923357555, 44.66835921509632),
    (44.66835921509631, 56.2341325190349),
]
CUSTOM_LEVELS = [8.714892243362911, 8.325191414850961, 8.388036763027877]
DEFAULT_LEVELS = [
    25.67692669684795, 23.184259402046305, 23.548126209403705, 18.352313812634517,
    21.075016847040825, 18.58391927707086, 16.695020229990888, 17.0109786752842,
    15.796288449641548, 14.735492156642533, 14.345791328130584, 14.408636676307502,
]


def column(spark, expression):
    return spark.range(1).select(expression.alias("v")).first().v


def literal(values):
    return F.array(*[F.lit(float(v)) for v in values])


def fails(spark, expression, message):
    with pytest.raises(Exception, match=message):
        column(spark, expression)


@pytest.mark.parametrize("n", [10, 11])
def test_energy_goldens(spark, n):
    energy, spl = ENERGY[n]
    signal = np.arange(1, n + 1)
    fft = literal(np.fft.rfft(signal).view(float))
    psd = literal(abs(np.fft.rfft(signal)) ** 2 / n * spectral.bin_weights(n))
    raw = literal(signal)
    found = column(spark, F.array(
        levels.energy_raw(raw, n), levels.energy_fft(fft, n), levels.energy_psd(psd, n)
    ))
    assert np.allclose(found, energy, rtol=1e-13)
    found = column(spark, F.array(
        levels.spl_raw(raw, n), levels.spl_fft(fft, n), levels.spl_psd(psd, n)
    ))
    assert np.allclose(found, spl, rtol=1e-13)


def test_energy_of_a_short_signal_and_wrong_sizes(spark):
    assert column(spark, levels.energy_raw(literal([1, 2]), 10)) == 5.0
    fails(spark, levels.energy_raw(literal(range(10)), 5), r"Incorrect signal size \(10\) for Energy \(5\)")
    fails(spark, levels.energy_fft(literal([1]), 101), r"Incorrect fft size \(1\) for Energy \(102\)")
    fails(spark, levels.energy_psd(literal([1]), 1000), r"Incorrect PSD size \(1\) for Energy \(501\)")


def test_decibels(spark):
    values = F.array(F.lit(10.0), F.lit(0.0), F.lit(-1.0), F.lit(None).cast("double"))
    found = column(spark, F.transform(values, levels.to_db))
    assert found[0] == 10.0 and found[1] == -math.inf and math.isnan(found[2]) and found[3] is None


def test_calibration(spark):
    found = column(spark, levels.calibrate(literal([-1.1, 1.2, 1.3]), -2.0))
    expected = [-1.384817952973584, 1.5107104941530005, 1.6366030353324175]
    assert np.allclose(found, expected, rtol=0, atol=1e-15)
    assert column(spark, levels.calibrate_value(F.lit(1.2), -2.0)) == pytest.approx(expected[1])
    with pytest.raises(ValueError, match=r"Incorrect calibration factor \(1.0\)"):
        levels.calibrate(literal([1]), 1.0)


def ramp_psd():
    """Periodogram of 1..128 with normalisation 1/128^2."""
    return abs(np.fft.rfft(np.arange(1, 129))) ** 2 / 128**2 * spectral.bin_weights(128)


def test_band_bounds():
    assert len(Bands(128, 128.0).bounds) == 18
    assert np.allclose(Bands(128, 128.0, 35.2, 50.5).bounds, CUSTOM_BOUNDS, rtol=0, atol=3e-14)
    assert np.allclose(
        Bands(128, 128.0, 35.2, 50.5).frequency_vector(),
        [28.183829312644537, 35.481338923357555, 44.66835921509631, 56.2341325190349],
        rtol=0, atol=3e-14,
    )


def test_levels_goldens(spark):
    found = column(spark, Bands(128, 128.0, 35.2, 50.5).levels(literal(ramp_psd())))
    assert np.allclose(found, CUSTOM_LEVELS, rtol=0, atol=3e-14)
    found = column(spark, Bands(128, 32.0).levels(literal(ramp_psd() * 4)))
    assert np.allclose(found, DEFAULT_LEVELS, rtol=0, atol=3e-14)


def test_empty_bands_are_at_minus_infinity(spark):
    bands = Bands(64, 64.0)
    found = column(spark, bands.levels(literal(np.ones(33))))
    empty = [i for i, (lo, hi) in enumerate(bands.bins) if lo == hi]
    assert empty == [1, 2, 4]
    assert [i for i, v in enumerate(found) if v == -math.inf] == empty


def test_band_of_a_frequency(spark):
    custom, default = Bands(128, 128.0, 35.2, 50.5), Bands(128, 128.0)
    for bands, freq, band in (
        (custom, 35.2, 0), (custom, 36.0, 1), (custom, 44.668359215097, 2),
        (default, 1.0, 0), (default, 1.123, 1), (default, 35.2, 15), (default, 50.0, 17),
    ):
        assert column(spark, bands.frequency_to_index(F.lit(freq))) == band
    gap = next(
        (hi + lo) / 2 for (_, hi), (lo, _) in zip(default.bounds, default.bounds[1:])
        if hi < (hi + lo) / 2 < lo
    )
    assert column(spark, default.frequency_to_index(F.lit(gap))) == -1
    fails(spark, custom.frequency_to_index(F.lit(1.0)), r"Incorrect frequency \(1.0\) for conversion \(35.2,50.5\)")
    fails(spark, default.frequency_to_index(F.lit(0.99)), r"Incorrect frequency \(0.99\) for conversion \(1.0,64.0\)")
    assert column(spark, default.index_to_frequency(F.lit(3))) == default.bounds[3][0]
    fails(spark, Bands(100, 100.0).index_to_frequency(F.lit(1000)), r"Incorrect index \(1000\) for conversion \(17\)")
    fails(spark, Bands(100, 100.0).index_to_frequency(F.lit(-1)), r"Incorrect index \(-1\) for conversion \(17\)")
    fails(spark, Bands(100, 100.0).levels(literal([1])), r"Incorrect PSD size \(1\) for TOL \(51\)")


@pytest.mark.parametrize("args, message", [
    ((100, 1000.0), r"Incorrect window size \(100\) for TOL \(1000.0\)"),
    ((100, 100.0, 200.0), r"low frequency \(200.0\) for TOL \(smaller than 1.0 or bigger than 50.0\)"),
    ((100, 100.0, 0.0), r"low frequency \(0.0\) for TOL \(smaller than 1.0 or bigger than 50.0\)"),
    ((100, 100.0, 40.0, 30.0), r"low frequency \(40.0\) for TOL \(smaller than 1.0 or bigger than 30.0\)"),
    ((100, 100.0, 10.0, 100.0), r"high frequency \(100.0\) for TOL \(higher than 50.0 or smaller than 10.0\)"),
    ((100, 100.0, None, 0.0), r"high frequency \(0.0\) for TOL \(higher than 50.0 or smaller than 1.0\)"),
])
def test_band_parameters(args, message):
    with pytest.raises(ValueError, match=message):
        Bands(*args)


def test_band_tables(spark):
    bands = Bands(128, 128.0)
    rows = bands.table(spark).orderBy("band").collect()
    assert [(r.lo_bin, r.hi_bin) for r in rows] == bands.bins
    counted = bands.bin_table(spark).groupBy("band").agg(F.count("k").alias("n"))
    assert {r.band: r.n for r in counted.collect()} == {i: hi - lo for i, (lo, hi) in enumerate(bands.bins)}


def test_short_records_have_no_tol():
    with pytest.raises(ValueError, match=r"Incorrect segmentDuration \(0.1\) for TOL computation"):
        Tol(0.1)


def test_frequencies(spark):
    a, b, c = Spectrum(100, 1.0), Spectrum(1024, 44800.0), Spectrum(2049, 96000.0)
    for s, index, freq in (
        (a, 0, 0.0), (a, 10, 0.1), (a, 25, 0.25), (a, 50, 0.5), (b, 1, 43.75), (b, 100, 4375.0),
        (c, 1, 46.85212298682284), (c, 1024, 47976.57393850659),
    ):
        assert column(spark, s.index_to_frequency(F.lit(index))) == freq
        assert column(spark, s.frequency_to_index(F.lit(freq))) == index
        assert s.index_of(freq) == index
    assert np.allclose(column(spark, a.frequency_vector()), np.arange(51) / 100)
    odd = Interleaved(11, 1.0)
    assert column(spark, odd.frequency_to_index(F.lit(0.183))) == 4
    assert column(spark, odd.frequency_to_index(F.lit(0.5))) == 10
    assert column(spark, odd.index_to_frequency(F.lit(5))) == pytest.approx(2 / 11)
    assert np.allclose(column(spark, odd.frequency_vector()), np.repeat(np.arange(6) / 11, 2))
    fails(spark, b.frequency_to_index(F.lit(22500.0)), r"Incorrect frequency \(22500.0\)")
    fails(spark, b.frequency_to_index(F.lit(-1.0)), "Incorrect frequency")
    fails(spark, b.index_to_frequency(F.lit(-1)), r"Incorrect index \(-1\) for conversion \(513\)")
    fails(spark, b.index_to_frequency(F.lit(1030)), "Incorrect index")
    with pytest.raises(ValueError, match="Incorrect frequency"):
        b.index_of(-1.0)


def test_long_levels_have_every_band(spark):
    """Fixed order of bins 0, 1, 2, ...; empty bands are at -Infinity, as in the array form."""
    bands = Bands(64, 64.0)
    psd = [float(i + 1) for i in range(33)]
    rows = spark.createDataFrame([("a", k, p) for k, p in enumerate(psd)], "key string, k int, p double")
    found = {r.band: r.tol for r in tol_long(rows, ["key"], bands).collect()}
    array = spark.createDataFrame([(psd,)], "psd array<double>").select(bands.levels(F.col("psd"))).first()[0]
    assert [found[i] for i in range(len(bands.bounds))] == array and float("-inf") in array
    for wrong in (rows.filter("k < 10"), rows.union(rows), rows.withColumn("k", F.col("k") + 1)):
        with pytest.raises(Exception, match="Incorrect PSD size"):
            tol_long(wrong, ["key"], bands).collect()
