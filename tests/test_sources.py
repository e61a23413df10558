import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sonomere.sources import grid, series, vectors
from sonomere.sources.series import make_timeserie

START = datetime(2018, 3, 1)
HOUR = START + timedelta(hours=1)
SECOND = timedelta(seconds=1)


@pytest.mark.parametrize("blocks, per_block", [(1, 3600), (2, 1800), (7, 514)])
def test_timeserie(spark, blocks, per_block):
    df = make_timeserie(spark, START, HOUR, SECOND, num_blocks=blocks)
    assert df.dtypes == [("ts", "timestamp"), ("val", "double")]
    assert df.rdd.getNumPartitions() == blocks
    rows = df.select(F.unix_seconds("ts").alias("s"), "val").orderBy("s").collect()
    first = rows[0].s
    for i, r in enumerate(rows):
        block = min(i // per_block, blocks - 1)
        assert r.s - first == i and r.val == i - block * per_block
    assert len(rows) == 3600


def test_timeserie_values_names_and_ticks(spark):
    df = make_timeserie(
        spark, START, HOUR, timedelta(seconds=25), lambda i: F.cos(i), 1, "test_ts", "test_val"
    )
    assert df.columns == ["test_ts", "test_val"]
    rows = df.select(F.date_format("test_ts", "HH:mm:ss").alias("at"), "test_val").collect()
    assert len(rows) == 144
    assert rows[3].at == "00:01:15" and rows[3].test_val == pytest.approx(math.cos(3))
    with_rest = make_timeserie(spark, START, START + timedelta(seconds=10), timedelta(seconds=3))
    assert with_rest.count() == 3
    few = make_timeserie(spark, START, START + timedelta(seconds=3), SECOND, num_blocks=5)
    assert sorted(r.val for r in few.collect()) == [0.0, 1.0, 2.0]


def test_a_large_block_is_made_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(series, "TASK_TICKS", 100)
    df = make_timeserie(spark, START, HOUR, SECOND)
    assert df.rdd.getNumPartitions() == 36
    assert sorted(r.val for r in df.collect()) == [float(i) for i in range(3600)]


def test_timeserie_errors(spark):
    with pytest.raises(ValueError, match="Tick should be smaller or equal"):
        make_timeserie(spark, START, HOUR, timedelta(hours=2))
    for tick in (timedelta(milliseconds=500), timedelta(milliseconds=1500), timedelta(0)):
        with pytest.raises(ValueError, match="whole number of seconds"):
            make_timeserie(spark, START, HOUR, tick)
    with pytest.raises(ValueError, match="number of blocks"):
        make_timeserie(spark, START, HOUR, SECOND, num_blocks=0)


def test_vector_files_and_names(spark, tmp_path):
    name = "Sound2_64_24_3120_2000.0_1_vPSD_128_128_128_64.csv"
    (tmp_path / name).write_text(" 1.5e-3 2 -3.25\n0.1  0.2 0.3 \n\n")
    rows = vectors.read_vectors(spark, str(tmp_path)).collect()
    assert sorted(r["values"] for r in rows) == [[0.0015, 2.0, -3.25], [0.1, 0.2, 0.3]]
    parsed = vectors.read_vectors(spark, str(tmp_path)).select(
        vectors.parse_result_name(F.col("file_name")).alias("p")
    ).first().p
    assert (parsed.sound_name, parsed.sampling_rate, parsed.algo, parsed.window_offset) == (
        "Sound2", 2000.0, "vPSD", 128
    )
    sound = vectors.sound_name(*[F.lit(v) for v in ("Sound2", 64, 24, 3120, 2000.0, 1)])
    composed = vectors.result_name(sound, *[F.lit(v) for v in ("vPSD", 128, 128, 128, 64)])
    row = spark.range(1).select(
        composed.alias("n"), vectors.parse_sound_name(F.concat(sound, F.lit(".wav"))).alias("p")
    ).first()
    assert row.n == name and row.p.sample_number == 3120


def test_grid(spark):
    """A wind field, cos(t) sin(lon lat), by time slice."""
    lat, lon = [float(i) for i in range(1, 11)], [float(i) for i in range(-10, 0)]
    slices = spark.createDataFrame(
        [(t, [[math.cos(t) * math.sin(y * x) for x in lon] for y in lat]) for t in range(20)],
        "t int, wind array<array<float>>",
    )
    cells = grid.grid_to_rows(slices, ["t"], "wind")
    cells = grid.with_coordinates(
        cells, spark.createDataFrame(list(enumerate(lat)), "p int, v double"), "i", "lat"
    )
    cells = grid.with_coordinates(
        cells, spark.createDataFrame(list(enumerate(lon)), "p int, v double"), "j", "lon"
    )
    rows = cells.collect()
    assert len(rows) == 2000
    assert all(abs(r.value - math.cos(r.t) * math.sin(r.lon * r.lat)) < 1e-7 for r in rows)
