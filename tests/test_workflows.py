import numpy as np
import pytest
from pyspark.sql import functions as F

import wavs
from sonomere.functions import spectral
from sonomere.functions.bands import Bands
from sonomere.functions.spectral import Windowing
from sonomere.plans.workflows import AllFeatures, Tol, WelchSpl, WelchSplTol, calibrate_records
from sonomere.operators.shape import explode_channels, nest_channels
from sonomere.operators import windows
from sonomere.operators.compare import assert_rmse
from sonomere.sources import vectors, wav
from sonomere.streaming.records import stream_records, write_features

START = "1978-04-11T13:14:20.200Z"
FS = 16000.0


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("wav")
    wavs.write_sine(path / "sine.wav")
    noise = np.random.default_rng(0).integers(-30000, 30000, size=(40000, 2))
    wavs.write(path / "noise.wav", noise, 16000)
    return path


def records(spark, folder, name="sine", channels=1, seconds=1.0):
    return wav.read_wav_file(spark, f"{folder}/{name}.wav", START, FS, channels, 16, seconds)


def local_psd(x, windowing):
    cut = [x[a: a + windowing.size] for a in range(0, len(x) - windowing.size + 1, windowing.hop)]
    weights = np.full(windowing.nfft // 2 + 1, 2.0)
    weights[0] = 1
    if windowing.nfft % 2 == 0:
        weights[-1] = 1
    taper = 0.54 - 0.46 * np.cos(2 * np.pi * np.arange(windowing.size) / windowing.size)
    norm = 1 / (FS * np.sum(taper**2))
    return np.array([
        norm * weights * abs(np.fft.rfft(c * taper, windowing.nfft)) ** 2 for c in cut
    ])


def local_tol(x, low, high):
    second = Windowing(int(FS), 0, int(FS), FS)
    bins = Bands(int(FS), FS, low, high).bins
    return np.array([[10 * np.log10(p[lo:hi].sum()) for lo, hi in bins] for p in local_psd(x, second)])


@pytest.mark.parametrize("size, overlap, nfft, seconds", [
    (16000, 0, 16000, 1.0), (6000, 3000, 7000, 1.0), (6000, 3000, 7001, 0.5),
])
@pytest.mark.parametrize("name, channels", [("sine", 1), ("noise", 2)])
def test_welch_spl(spark, folder, size, overlap, nfft, seconds, name, channels):
    table = records(spark, folder, name, channels, seconds)
    samples = {r.record_idx: np.array(r.channels) for r in table.collect()}
    found = WelchSpl(seconds, size, overlap, nfft)(table, FS).collect()
    assert len(found) == len(samples) == int(2.5 / seconds)
    for row in found:
        assert len(row.welch) == len(row.spl) == channels
        for c in range(channels):
            welch = local_psd(samples[row.record_idx][c], Windowing(size, overlap, nfft, FS)).mean(axis=0)
            assert np.allclose(row.welch[c], welch, rtol=1e-10, atol=1e-18)
            assert np.isclose(row.spl[c][0], 10 * np.log10(welch.sum()), rtol=1e-12)


def test_tol_and_combined(spark, folder):
    table = records(spark, folder, "noise", 2, 2.0)
    samples = np.array(table.first().channels)
    mean = np.array([local_tol(x, 3000.0, 7000.0).mean(axis=0) for x in samples])
    assert mean.shape == (2, 4)
    assert np.allclose(Tol(2.0, 3000.0, 7000.0)(table, FS).first().tol, mean, rtol=1e-12)
    summed = Tol(2.0, 3000.0, 7000.0, "sum")(table, FS).first().tol
    assert np.allclose(summed, mean * 2, rtol=1e-12)
    row = WelchSplTol(2.0, 6000, 3000, 7000, 3000.0, 7000.0)(table, FS).first()
    alone = WelchSpl(2.0, 6000, 3000, 7000)(table, FS).first()
    assert np.allclose(row.tol, mean, rtol=1e-12)
    assert row.welch == alone.welch and row.spl == alone.spl


def test_result_shape_and_times(spark, folder):
    found = WelchSplTol(1.0, 16000, 0, 16000, 3000.0, 7000.0)(records(spark, folder), FS, sort=True)
    assert dict(found.dtypes)["welch"] == dict(found.dtypes)["tol"] == "array<array<double>>"
    assert dict(found.dtypes)["timestamp"] == "timestamp"
    rows = found.select("*", F.date_format("timestamp", "HH:mm:ss.SSS").alias("at")).collect()
    assert [r.at for r in rows] == ["13:14:20.200", "13:14:21.200"]
    assert [len(r.welch[0]) for r in rows] == [8001, 8001]
    assert [len(r.tol[0]) for r in rows] == [4, 4]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_workflows_are_one_narrow_stage(spark, folder, tmp_path):
    records(spark, folder).write.parquet(str(tmp_path / "r"))
    table = spark.read.parquet(str(tmp_path / "r"))
    features = WelchSplTol(1.0, 6000, 3000, 7000, 3000.0, 7000.0)(table, FS)
    text = plan(features)
    assert "Exchange" not in text and text.count("ArrowEvalPython [") == 1
    assert "pythonUDF1" in text
    only_spl = plan(features.select("timestamp", "spl"))
    assert "pythonUDF1" not in only_spl and "path" not in only_spl.split("ReadSchema")[1]
    assert "ArrowEvalPython" not in plan(features.select("timestamp"))


def test_exploding_features_computes_them_once(spark, folder, tmp_path):
    explode_channels(records(spark, folder, "noise", 2)).write.parquet(str(tmp_path / "r"))
    table = spark.read.parquet(str(tmp_path / "r"))
    features = WelchSpl(1.0, 6000, 3000, 7000)(table, FS)
    spectra = windows.stft(table, Windowing(6000, 3000, 7000, FS))
    for df in (
        windows.bins(features, ["record_idx"], "welch"),
        windows.bins(features, ["record_idx"], "spl"),
        windows.complex_bins(spectra, ["record_idx", "window_idx"]),
    ):
        assert plan(df).count("ArrowEvalPython [") == 1


def test_calibration_and_channel_forms(spark, folder):
    table = records(spark, folder, "noise", 2)
    calibrated = calibrate_records(table, -20.0)
    assert np.allclose(calibrated.first().channels, np.array(table.first().channels) * 10)
    workflow = WelchSplTol(1.0, 6000, 3000, 7000, 3000.0, 7000.0)
    nested = workflow(calibrated, FS).select("record_idx", "welch", "spl", "tol")
    per_channel = workflow(calibrate_records(explode_channels(table), -20.0), FS)
    assert dict(per_channel.dtypes)["welch"] == "array<double>"
    again = nest_channels(per_channel, ["record_idx"], ["welch", "spl", "tol"])
    assert nested.orderBy("record_idx").collect() == again.orderBy("record_idx").collect()
    with pytest.raises(ValueError, match="samples"):
        workflow(table.drop("channels"), FS)


@pytest.mark.parametrize("workflow", [
    WelchSpl(1.0, 6000, 3000, 7000), Tol(1.0, 3000.0, 7000.0),
    WelchSplTol(1.0, 6000, 3000, 7000, 3000.0, 7000.0),
])
def test_features_computed_while_reading(spark, folder, workflow):
    table = records(spark, folder, "noise", 2)
    expected = workflow(calibrate_records(table, -20.0), FS, sort=True)
    folded = workflow(table, FS, sort=True, calibration=-20.0)
    scanned = workflow.of_recordings(
        spark, f"{folder}/*.wav", [("noise.wav", START)], FS, 2, 16, sort=True, calibration=-20.0,
        only_listed=True,
    )
    assert scanned.columns == folded.columns == expected.columns
    assert "channels" not in plan(scanned)
    for a, b, c in zip(expected.collect(), folded.collect(), scanned.collect()):
        assert a.timestamp == b.timestamp == c.timestamp and a.sound_id == c.sound_id
        for name in workflow.results:
            assert np.allclose(a[name], b[name], rtol=1e-11, atol=0)
            assert b[name] == c[name]


def test_all_features(spark, folder):
    workflow = AllFeatures(1.0, 6000, 3000, 7000, 3000.0, 7000.0)
    found = workflow(spark, f"{folder}/noise.wav", FS, 2, 16, START, calibration=-20.0)
    assert sorted(found) == ["fft", "periodogram", "spl", "tol", "welch"]
    table = calibrate_records(records(spark, folder, "noise", 2), -20.0)
    x = np.array(table.filter("record_idx = 0").first().channels)
    psd = np.array([local_psd(c, Windowing(6000, 3000, 7000, FS)) for c in x])
    first = {n: np.array(df.filter("record_idx = 0").first()[n]) for n, df in found.items()}
    z = first["fft"][..., ::2] + 1j * first["fft"][..., 1::2]
    assert z.shape == psd.shape == first["periodogram"].shape
    assert np.allclose(first["periodogram"], psd, rtol=1e-9)
    assert np.allclose(first["welch"], psd.mean(axis=1), rtol=1e-10)
    assert np.allclose(first["spl"][:, 0], 10 * np.log10(psd.mean(axis=1).sum(axis=1)))
    assert np.allclose(first["tol"], [local_tol(c, 3000.0, 7000.0)[0] for c in x])
    assert "tol" not in AllFeatures(0.5, 600, 0, 600)(spark, f"{folder}/sine.wav", FS, 1, 16)


def test_vectors_of_a_named_sound(spark, tmp_path):
    """A sound by its naming convention: its vectors written as text, read back and compared."""
    fs, nfft, size, offset = 3906, 4100, 4000, 3906
    name = f"Sound1_64_24_9811_{float(fs)}_1"
    x = np.random.default_rng(7).integers(-(2**23), 2**23, size=9811)
    (tmp_path / "wav").mkdir()
    wavs.write(tmp_path / "wav" / f"{name}.wav", x, fs, 24)
    sound = wav.inspect_wavs(spark, str(tmp_path / "wav")).select(
        vectors.parse_sound_name(F.element_at(F.split("path", "/"), -1)).alias("p"), "fs", "bits", "frames"
    ).first()
    assert (sound.p.sampling_rate, sound.p.wav_bits, sound.p.sample_number) == (
        sound.fs, sound.bits, sound.frames
    )
    chunk = wav.read_wav_chunks(spark, str(tmp_path / "wav"), 9811)
    windowing = Windowing(size, size - offset, nfft, float(fs))
    bands = Bands(nfft, float(fs), 0.2 * fs, 0.4 * fs)
    welch = chunk.withColumn("welch", spectral.welch(F.col("channels"), windowing, True)[0])
    found = welch.select("welch", bands.levels(F.col("welch")).alias("tol")).first()

    taper = 0.54 - 0.46 * np.cos(2 * np.pi * np.arange(size) / size)
    z = np.array([np.fft.rfft(taper * x[a: a + size] / 2**23, nfft) for a in (0, offset)])
    weights = np.r_[1, np.full(nfft // 2 - 1, 2), 1]
    expected = (abs(z) ** 2 * weights / (fs * np.sum(taper**2))).mean(axis=0)
    assert np.allclose(found.welch, expected, rtol=1e-10)
    assert len(found.tol) == len(bands.bins) == 4
    assert np.allclose(found.tol, [10 * np.log10(expected[lo:hi].sum()) for lo, hi in bands.bins])

    text = " ".join(repr(float(v)) for v in expected)
    (tmp_path / f"{name}_vWelch_{nfft}_{size}_{offset}_64.csv").write_text(text + "\n")
    golden = vectors.read_vectors(spark, str(tmp_path / "*.csv")).select(
        F.lit(0).alias("sound"), F.col("values").alias("welch")
    )
    assert_rmse(golden, welch.select(F.lit(0).alias("sound"), "welch"), ["sound"], "welch", 1e-13)


def test_streamed_records(spark, folder, tmp_path):
    table = records(spark, folder, "noise", 2)
    table.write.parquet(str(tmp_path / "in"))
    workflow = WelchSplTol(1.0, 6000, 3000, 7000, 3000.0, 7000.0)
    arriving = stream_records(spark, str(tmp_path / "in"), table.schema)

    def run():
        query = write_features(arriving, workflow, FS, str(tmp_path / "out"), str(tmp_path / "state"))
        query.awaitTermination()
        return spark.read.parquet(str(tmp_path / "out")).orderBy("timestamp").collect()

    expected = workflow(table, FS).orderBy("timestamp").collect()
    assert run() == expected
    later = table.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 HOUR"))
    later.write.mode("append").parquet(str(tmp_path / "in"))
    found = run()
    assert len(found) == 4 and [r.welch for r in found[2:]] == [r.welch for r in expected]
