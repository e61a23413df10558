"""The WAV data source against the reader functions."""

import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from sonomere.sources import wav_format
from sonomere.sources.wav import read_wav_records
from tests.wavs import write

FS = 100
OPTIONS = {"recordSeconds": "0.5", "fs": str(FS), "channels": "2", "bits": "16", "lastRecord": "fill"}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    wav_format.register(spark)
    folder = tmp_path_factory.mktemp("wavs")
    rng = np.random.default_rng(1)
    for hour, n in ((10, 1234), (11, 500), (12, 49), (13, 3000)):
        samples = rng.integers(-20000, 20000, size=(n, 2))
        write(folder / f"20200301_{hour}0000.wav", samples, FS, 16)
    (folder / ".hidden").write_bytes(b"x")
    return folder


def starts(folder):
    return [(p.name, f"2020-03-01T{p.name[9:11]}:00:00") for p in folder.glob("2*.wav")]


def read(spark, folder, schema=None, **options):
    reader = spark.read.format("wav").options(**{**OPTIONS, "startFormat": "%Y%m%d_%H%M%S.wav", **options})
    return (reader.schema(schema) if schema else reader).load(str(folder))


def rows(df):
    return sorted(map(tuple, df.select("sound_id", "record_idx", "frame_offset", "timestamp", "channels").collect()))


def plain(spark, folder, last_record="fill"):
    return read_wav_records(spark, str(folder / "*.wav"), starts(folder), FS, 2, 16, 0.5, last_record)


@pytest.mark.parametrize("last_record", ["fill", "skip", "keep"])
@pytest.mark.parametrize("split", [1, 3000, 1 << 25])
def test_same_records_as_the_reader(spark, folder, last_record, split):
    found = read(spark, folder, lastRecord=last_record, splitBytes=str(split))
    assert rows(found) == rows(plain(spark, folder, last_record))


FILTERS = [
    "record_idx = 3", "record_idx > 20 AND record_idx <= 25", "record_idx < 2", "record_idx >= 59",
    "record_idx IN (1, 4)", "sound_id = '20200301_110000.wav'", "sound_id LIKE '20200301_1%'",
    "sound_id IN ('20200301_110000.wav', 'x')", "path LIKE '%_130000.wav'", "sound_id LIKE '%10%' AND record_idx = 0",
    "timestamp >= timestamp'2020-03-01 13:00:10' AND timestamp < timestamp'2020-03-01 13:00:11.5'",
    "timestamp = timestamp'2020-03-01 10:00:01.500'", "timestamp < timestamp'2000-01-01'",
    "record_idx = 1 OR sound_id = 'x'", "NOT record_idx = 1", "record_idx IS NULL",
]


@pytest.mark.parametrize("condition", FILTERS)
def test_filters_change_no_result(spark, folder, condition):
    found = read(spark, folder, splitBytes="2000").filter(condition)
    assert rows(found) == rows(plain(spark, folder).filter(condition))


def partitions(df):
    return df.rdd.getNumPartitions()


def test_filters_take_ranges_out_of_the_plan(spark, folder):
    every = read(spark, folder, splitBytes="400")
    assert partitions(every) > 40
    assert partitions(every.filter("record_idx = 3")) <= 4
    assert partitions(every.filter("sound_id = '20200301_110000.wav' AND record_idx < 5")) <= 3
    assert partitions(every.filter("timestamp < timestamp'2020-03-01 10:00:02'")) <= 3
    assert partitions(every.filter("sound_id = 'none'")) == 1


def test_excluded_files_are_not_opened(spark, folder, tmp_path):
    for path in folder.glob("2*.wav"):
        shutil.copy(path, tmp_path)
    (tmp_path / "20200302_000000.wav").write_bytes(b"not a wav file at all")
    every = read(spark, tmp_path)
    with pytest.raises(Exception, match="Input file is not wav"):
        every.collect()
    assert rows(every.filter("sound_id LIKE '20200301%'")) == rows(plain(spark, folder))


def test_a_schema_without_samples(spark, folder):
    found = read(spark, folder, "timestamp timestamp, record_idx bigint")
    assert found.columns == ["timestamp", "record_idx"]
    assert sorted(map(tuple, found.collect())) == sorted(
        map(tuple, plain(spark, folder).select("timestamp", "record_idx").collect())
    )


def test_one_file_globs_and_dates(spark, folder):
    plainly = spark.read.format("wav").options(**OPTIONS)
    epoch = plainly.load(str(folder / "*_12*.wav"))
    one = plainly.option("start", "2001-01-01").load(str(folder / "20200301_120000.wav"))
    assert [str(r.timestamp) for r in one.collect()] == ["2001-01-01 00:00:00"]
    assert epoch.select(F.unix_millis("timestamp")).first()[0] == 0 and epoch.count() == 1


@pytest.mark.parametrize("options, error", [
    ({"fs": "44.1"}, "decimal part"), ({"channels": "1"}, "number of channels"), ({"lastRecord": "drop"}, "Unknown last record"),
    ({"lastRecord": "fail"}, "set to FAIL"), ({"startFormat": "%H.wav"}, "no startDate"),
])
def test_errors(spark, folder, options, error):
    with pytest.raises(Exception, match=error):
        read(spark, folder, **options).collect()
    with pytest.raises(Exception, match="Options .*bits.* missing"):
        spark.read.format("wav").option("fs", "1").load(str(folder)).collect()
    with pytest.raises(Exception, match="no column loudness"):
        read(spark, folder, "loudness double").collect()


def test_arriving_files(spark, folder, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    files = sorted(folder.glob("2*.wav"))

    def run():
        stream = spark.readStream.format("wav").options(**OPTIONS, startFormat="%Y%m%d_%H%M%S.wav").load(str(source))
        query = (
            stream.writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / "out")))

    shutil.copy(files[3], source)
    shutil.copy(files[1], source)
    first = run()
    assert {r[0] for r in first} == {files[3].name, files[1].name}
    assert run() == first
    for path in (files[0], files[2]):
        shutil.copy(path, source)
    assert run() == rows(plain(spark, folder))
