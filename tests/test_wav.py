from datetime import datetime, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

import wavs
from sonomere.operators.shape import explode_channels
from sonomere.sources import wav
from sonomere.sources.pcm import decode_pcm

START = "1978-04-11T13:14:20.200Z"


@pytest.fixture(scope="module")
def sine(tmp_path_factory):
    path = tmp_path_factory.mktemp("wav") / "sin_16kHz_2.5s.wav"
    wavs.write_sine(path)
    return str(path)


def read(spark, sine, starts=None, seconds=1.0, policy="skip", fs=16000.0, channels=1, bits=16, **kw):
    starts = [("sin_16kHz_2.5s.wav", START)] if starts is None else starts
    return wav.read_wav_records(spark, sine, starts, fs, channels, bits, seconds, policy, **kw)


@pytest.mark.parametrize("policy, seconds, n", [
    ("skip", 1.0, 2), ("fill", 1.0, 3), ("keep", 1.0, 3), ("skip", 0.5, 5), ("skip", 0.1, 25),
])
def test_records(spark, sine, policy, seconds, n):
    rows = read(spark, sine, policy=policy, seconds=seconds).orderBy("record_idx").collect()
    assert len(rows) == n
    assert all(len(r.channels) == 1 for r in rows)
    assert np.allclose(rows[0].channels[0][:16], wavs.FIRST_WAVE, rtol=0, atol=0)
    size = int(16000 * seconds)
    lengths = [len(r.channels[0]) for r in rows]
    assert lengths == [size] * n if policy != "keep" else [size, size, size // 2]
    if policy == "fill":
        assert not any(rows[2].channels[0][8000:]) and any(rows[2].channels[0][:8000])


def test_timestamps(spark, sine):
    rows = read(spark, sine, policy="fill").select(
        "record_idx", "frame_offset", F.unix_millis("timestamp").alias("ms")
    ).orderBy("record_idx").collect()
    start = int(datetime(1978, 4, 11, 13, 14, 20, 200_000, timezone.utc).timestamp() * 1000)
    assert [r.ms - start for r in rows] == [0, 1000, 2000]
    assert [r.frame_offset for r in rows] == [0, 16000, 32000]


def test_start_by_path_and_single_file(spark, sine):
    by_path = read(spark, sine, [(sine, START)]).collect()
    single = wav.read_wav_file(spark, "file://" + sine, START, 16000.0, 1, 16, 1.0).collect()
    date = datetime.fromisoformat(START)
    by_table = read(spark, sine, spark.createDataFrame([(sine, date)], "name string, start timestamp"))
    key = lambda r: r.record_idx
    assert sorted(by_path, key=key) == sorted(single, key=key) == sorted(by_table.collect(), key=key)


def test_fail_policy(spark, sine):
    message = "contains a partial last record and PartialLastRecordAction is set to FAIL."
    with pytest.raises(Exception, match=message):
        read(spark, sine, policy="fail").take(1)
    assert read(spark, sine, policy="fail", seconds=0.5).count() == 5


@pytest.mark.parametrize("options, message", [
    ({"fs": 1.0, "starts": [("other.wav", START)]}, r"sample rate \(16000.0\) doesn't match configured one \(1.0\)"),
    ({"channels": 2}, r"number of channels \(1\) doesn't match configured one \(2\)"),
    ({"bits": 24}, r"sample size in bits \(16\) doesn't match configured one \(24\)"),
    ({"starts": [("other.wav", START)]}, "Read file sin_16kHz_2.5s.wav has no startDate in given list"),
])
def test_contradictions(spark, sine, options, message):
    with pytest.raises(Exception, match=message):
        read(spark, sine, **options).take(1)


def test_parameters(spark, sine):
    with pytest.raises(ValueError, match=r"Computed record size \(0.1\) should not have a decimal part."):
        read(spark, sine, fs=1.0, seconds=0.1)
    duplicates = [("a.wav", START), ("a.wav", START)]
    with pytest.raises(ValueError, match="Sounds list contains duplicate filename entries"):
        read(spark, sine, duplicates)
    table = spark.createDataFrame(duplicates, "name string, start string")
    with pytest.raises(ValueError, match="duplicate filename entries"):
        read(spark, sine, table.withColumn("start", F.to_timestamp("start")))
    with pytest.raises(ValueError, match="last record action"):
        read(spark, sine, policy="other")


def test_directory_glob_and_unlisted_files(spark, tmp_path):
    for i, n in enumerate((40, 25, 10)):
        wavs.write(tmp_path / f"s{i}.wav", np.arange(n) + 100 * i, 10)
    starts = [("s0.wav", "2020-01-01"), ("s1.wav", "2020-01-02")]

    def ids(uri, **kw):
        rows = wav.read_wav_records(spark, uri, starts, 10, 1, 16, 1.0, **kw)
        return sorted((r.sound_id, r.record_idx) for r in rows.collect())

    listed = [("s0.wav", i) for i in range(4)] + [("s1.wav", i) for i in range(2)]
    assert ids(str(tmp_path), only_listed=True) == listed
    assert ids(str(tmp_path) + "/s{0,1}.wav") == listed
    with pytest.raises(Exception, match="Read file s2.wav has no startDate"):
        ids(str(tmp_path))


@pytest.mark.parametrize("bits", [8, 16, 24, 32])
@pytest.mark.parametrize("channels", [1, 2, 3])
def test_decoding(spark, tmp_path, bits, channels):
    rng = np.random.default_rng(bits)
    low, high = (0, 256) if bits == 8 else (-(2 ** (bits - 1)), 2 ** (bits - 1))
    samples = rng.integers(low, high, size=(1000, channels))
    samples[0], samples[1] = low, high - 1
    wavs.write(tmp_path / "a.wav", samples, 100, bits)
    expected = -1 + samples / 127.5 if bits == 8 else samples / 2.0 ** (bits - 1)
    starts = [("a.wav", "2020-01-01")]
    rows = wav.read_wav_records(
        spark, str(tmp_path), starts, 100, channels, bits, 1.0, split_bytes=97
    )
    found = {r.record_idx: np.array(r.channels).T for r in rows.collect()}
    assert sorted(found) == list(range(10))
    assert np.array_equal(np.concatenate([found[i] for i in range(10)]), expected)

    blob = spark.createDataFrame([(bytearray(wavs.pcm(samples, bits)),), (None,)], "raw binary")
    decoded = blob.select(decode_pcm(F.col("raw"), bits, channels).alias("c")).collect()
    assert np.array_equal(np.array(decoded[0].c).T, expected) and decoded[1].c is None
    assert explode_channels(rows).filter("channel = 0").count() == 10


@pytest.mark.parametrize("split_bytes", [16, 45, 100, 4096, 1 << 20])
@pytest.mark.parametrize("policy", ["skip", "fill", "keep"])
def test_every_record_is_read_once_whatever_the_splits(spark, tmp_path, split_bytes, policy):
    wavs.write(tmp_path / "a.wav", np.arange(333), 10)
    rows = wav.read_wav_records(
        spark, str(tmp_path), [("a.wav", "2020-01-01")], 10, 1, 16, 1.0, policy,
        split_bytes=split_bytes,
    ).orderBy("record_idx").collect()
    found = np.concatenate([r.channels[0] for r in rows]) * 32768
    expected = {"skip": np.arange(330), "keep": np.arange(333)}.get(
        policy, np.concatenate([np.arange(333), np.zeros(7)])
    )
    assert [r.record_idx for r in rows] == list(range(len(rows)))
    assert np.array_equal(found, expected)


def test_one_file_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(wav, "TASK_BYTES", 64)
    wavs.write(tmp_path / "a.wav", np.arange(2000), 10)
    rows = wav.read_wav_records(
        spark, str(tmp_path), [("a.wav", "2020-01-01")], 10, 1, 16, 1.0, split_bytes=64
    )
    assert rows.select(F.spark_partition_id().alias("p")).distinct().count() > 20
    assert rows.count() == 200


def test_chunks(spark, sine):
    chunks = wav.read_wav_chunks(spark, sine, 16).orderBy("record_idx").collect()
    assert len(chunks) == 2500
    assert all(r.channels[0] == wavs.FIRST_WAVE for r in chunks)
    assert wav.read_wav_chunks(spark, sine, 16, max_chunks=10).count() == 10
    some = wav.read_wav_chunks(spark, sine, 16, 1024, 10, split_bytes=500).collect()
    assert sorted(r.frame_offset for r in some) == list(range(1024, 1184, 16))
    assert all(r.channels[0] == wavs.FIRST_WAVE for r in some)
    last = wav.read_wav_chunks(spark, sine, 39990).orderBy("record_idx").collect()
    assert [len(r.channels[0]) for r in last] == [39990, 10]
    with pytest.raises(Exception, match="offsetFrame larger than file's number of frames"):
        wav.read_wav_chunks(spark, sine, 16, 10_000_000).collect()
    with pytest.raises(ValueError, match="chunkSize larger than authorized"):
        wav.read_wav_chunks(spark, sine, 2**31 - 1)


BAD_FILES = {
    "aiff.wav": (b"FORM" + b"\0" * 60, "Input file is not wav"),
    "tiny.wav": (b"RI", "Input file is not wav"),
    "rifx.wav": (wavs.raw(magic=b"RIFX"), "Input file is big-endian"),
    "float.wav": (wavs.raw(tag=3, bits=32), "Input file is not integer-PCM formatted"),
    "longer.wav": (wavs.raw(extra=6), "Input file length doesn't match computed one"),
    "shorter.wav": (wavs.raw()[:-2], "Input file length doesn't match computed one"),
    "headless.wav": (wavs.raw()[:40], "Input file length doesn't match computed one"),
}


def test_audit(spark, tmp_path):
    (tmp_path / "good.wav").write_bytes(wavs.raw(before=b"LIST" + b"\3\0\0\0abc\0"))
    for name, (content, _) in BAD_FILES.items():
        (tmp_path / name).write_bytes(content)
    rows = {r.path.split("/")[-1]: r for r in wav.inspect_wavs(spark, str(tmp_path)).collect()}
    good = rows.pop("good.wav")
    assert (good.ok, good.error, good.fs, good.channels, good.bits, good.frames) == (True, None, 8, 1, 16, 4)
    assert sorted(rows) == sorted(BAD_FILES)
    for name, row in rows.items():
        assert not row.ok and row.error.startswith(BAD_FILES[name][1]), name


@pytest.mark.parametrize("name", ["aiff.wav", "rifx.wav", "float.wav", "longer.wav"])
def test_bad_files_fail_a_read(spark, tmp_path, name):
    content, message = BAD_FILES[name]
    (tmp_path / name).write_bytes(content)
    with pytest.raises(Exception, match=message):
        wav.read_wav_records(spark, str(tmp_path), [(name, START)], 8, 1, 16, 0.5).collect()


def test_samples_after_another_chunk(spark, tmp_path):
    data = wavs.pcm(np.arange(8), 16)
    (tmp_path / "a.wav").write_bytes(wavs.raw(data=data, before=b"LIST" + b"\3\0\0\0abc\0"))
    rows = wav.read_wav_records(spark, str(tmp_path), [("a.wav", START)], 8, 1, 16, 1.0).collect()
    assert np.array_equal(np.array(rows[0].channels[0]) * 32768, np.arange(8))
