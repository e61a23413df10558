"""Streams of samples and of levels: out of order, repeated, late."""

import random

import pytest
from pyspark.sql import functions as F

from sonomere.operators.frames import cut_records
from sonomere.plans import timelines
from sonomere.plans.workflows import WelchSpl
from sonomere.streaming import samples
from sonomere.streaming.levels import levels_by_window
from sonomere.streaming.records import stream_records, write_stream
from sonomere.streaming.samples import cut_record_stream

SAMPLES = "channel string, frame bigint, x double"
LEVELS = "site string, record int, timestamp timestamp, spl double"
FS, SIZE = 4.0, 8


class Feed:
    """A stream of files, one micro-batch per file, that can be run on when more have arrived."""

    def __init__(self, spark, folder, schema, build):
        self.spark, self.folder, self.schema, self.build, self.n = spark, folder, schema, build, 0

    def add(self, rows):
        target = str(self.folder / "in")
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(target)
        return self

    def run(self):
        stream = stream_records(self.spark, str(self.folder / "in"), self.schema, max_files=1)
        query = write_stream(self.build(stream), str(self.folder / "out"), str(self.folder / "state"))
        query.awaitTermination()
        progress = [p for p in query.recentProgress if p["stateOperators"]]
        self.state_rows = progress[-1]["stateOperators"][-1]["numRowsTotal"] if progress else 0
        return self.spark.read.parquet(str(self.folder / "out")).collect()


def records(feed):
    return sorted((r.channel, r.record_idx, list(r.samples)) for r in feed.run())


def cutter(last_record="skip", delay="4 seconds"):
    return lambda stream: cut_record_stream(stream, ["channel"], SIZE, FS, delay, last_record=last_record)


def signal(channel, n):
    rng = random.Random(channel)
    return [(channel, i, rng.random()) for i in range(n)]


@pytest.mark.parametrize("last_record", ["skip", "fill", "keep"])
def test_shuffled_and_repeated_samples_make_the_records_of_a_table(spark, tmp_path, last_record):
    rows = signal("a", 53) + signal("b", 40) + signal("c", 3)
    table = spark.createDataFrame(rows, SAMPLES)
    wanted = cut_records(table, ["channel"], SIZE, {"samples": "x"}, last_record).collect()
    feed = Feed(spark, tmp_path, SAMPLES, cutter(last_record, "1 hour"))
    mixed = rows + random.Random(1).sample(rows, 30)
    random.Random(2).shuffle(mixed)
    for lo in range(0, len(mixed), 43):
        feed.add(mixed[lo : lo + 43])
    feed.add([("a", 10**6, None)])
    assert records(feed) == sorted((r.channel, r.record_idx, list(r.samples)) for r in wanted)
    feed.add([("a", 2 * 10**6, None)]).run()
    assert feed.state_rows == 0


def test_timestamps_and_features(spark, tmp_path):
    rows = signal("a", 64)
    workflow = WelchSpl(2.0, 4, 2, 4)
    whole = workflow.of_samples(spark.createDataFrame(rows, SAMPLES), ["channel"], FS).collect()
    (tmp_path / "plain").mkdir()
    plain = Feed(spark, tmp_path / "plain", SAMPLES, lambda s: workflow.of_samples(s, ["channel"], FS, delay="1 hour"))
    assert sorted(plain.add(rows[32:]).add(rows[:32]).run()) == sorted(whole)
    build = lambda s: workflow(
        cut_record_stream(s, ["channel"], SIZE, FS, "1 hour", origin="2020-05-01 10:00:00"), FS
    )
    found = Feed(spark, tmp_path, SAMPLES, build).add(rows[::-1]).run()
    table = cut_records(spark.createDataFrame(rows, SAMPLES), ["channel"], SIZE, {"samples": "x"})
    table = table.withColumn("timestamp", F.expr("timestamp'2020-05-01 10:00:00' + make_dt_interval(0, 0, 0, record_idx * 2)"))
    wanted = WelchSpl(2.0, 4, 2, 4)(table, FS).select(found[0].__fields__).collect()
    assert sorted(found, key=lambda r: r.record_idx) == sorted(wanted, key=lambda r: r.record_idx)


def test_late_samples_are_dropped_and_open_records_wait(spark, tmp_path):
    """A record is closed once time has come past its end and the delay, not before."""
    rows = signal("a", 200)
    feed = Feed(spark, tmp_path, SAMPLES, cutter("fill"))
    feed.add([r for r in rows[:24] if r[1] not in (3, 11)])
    assert [r[1] for r in records(feed)] == [2]
    feed.add(rows[24:40])  # ends at 10 s: closes what ends before 6 s
    feed.run()
    found = {r[1]: r[2] for r in records(feed)}
    assert sorted(found) == [0, 1, 2, 3, 4]
    assert found[0][3] == 0.0 and found[1][3] == 0.0
    feed.add([rows[3], rows[11]]).run()
    assert {r[1]: r[2] for r in records(feed)} == found
    assert len(records(feed)) == 5


def test_a_gap_is_filled_while_there_is_time(spark, tmp_path):
    rows = signal("a", 32)
    feed = Feed(spark, tmp_path, SAMPLES, cutter("fill", "5 seconds"))
    feed.add([r for r in rows[:20] if r[1] != 3]).run()
    feed.add([rows[3]])
    found = {r[1]: r[2] for r in records(feed)}
    assert found[0] == [x for _, _, x in rows[:8]]


def test_state_does_not_grow_with_the_stream(spark, tmp_path):
    feed = Feed(spark, tmp_path, SAMPLES, cutter())
    rows = signal("a", 4000)
    seen = []
    for lo in range(0, 4000, 1000):
        feed.add(rows[lo : lo + 1000]).run()
        seen.append(feed.state_rows)
    assert max(seen) <= 3  # the records of the last four seconds
    assert len(records(feed)) == 500


def test_repeats_and_odd_rows(spark, tmp_path):
    rows = [("a", i, float(i)) for i in range(8)]
    odd = [("a", 2, 7.0), ("a", None, 1.0), ("a", -3, 1.0), (None, 0, 5.0), ("a", 3, None)]
    feed = Feed(spark, tmp_path, SAMPLES, cutter("keep")).add(rows + odd).add(rows).add([("z", 10**5, None)])
    found = {(r.channel, r.record_idx): list(r.samples) for r in feed.run()}
    assert found == {("a", 0): [float(i) for i in range(8)], (None, 0): [5.0]}


def test_a_partial_record_can_fail(spark, tmp_path):
    feed = Feed(spark, tmp_path, SAMPLES, cutter("fail")).add(signal("a", 3)).add([("a", 10**5, None)])
    with pytest.raises(Exception, match="PartialLastRecordAction is set to FAIL"):
        feed.run()


def level_rows(n):
    rng = random.Random(n)
    return [(rng.choice("ab"), i, f"2024-03-01 00:{i // 60:02}:{i % 60:02}", rng.uniform(50, 90)) for i in range(n)]


def windows(stream, delay="10 seconds"):
    return levels_by_window(stream, ["site"], ["site", "record"], 1.0, "10 seconds", "5 seconds", delay)


def as_rows(df_rows):
    return sorted((r.site, r.window_start, r.n, round(r.mean_level, 9), round(r.exposure, 9)) for r in df_rows)


def cast(spark, rows):
    return spark.createDataFrame(rows, "site string, record int, t string, spl double").selectExpr(
        "site", "record", "CAST(t AS TIMESTAMP) AS timestamp", "spl"
    )


class LevelFeed(Feed):
    def add(self, rows):
        cast(self.spark, rows).coalesce(1).write.mode("append").parquet(str(self.folder / "in"))
        return self


def test_level_windows_of_shuffled_repeated_files(spark, tmp_path):
    rows = level_rows(200)
    mixed = rows + rows[::3]
    random.Random(5).shuffle(mixed)
    feed = LevelFeed(spark, tmp_path, LEVELS, lambda s: windows(s, "1 hour"))
    for lo in range(0, len(mixed), 70):
        feed.add(mixed[lo : lo + 70])
    feed.add([("b", 0, "2024-03-02 00:00:00", None)])
    assert as_rows(feed.run()) == as_rows(windows(cast(spark, rows + rows[:9])).collect())


def test_late_levels_change_nothing(spark, tmp_path):
    rows = [("a", i, t, s) for _, i, t, s in level_rows(100)]
    feed = LevelFeed(spark, tmp_path, LEVELS, windows).add(rows[:50])
    before = as_rows(feed.run())
    assert before and max(r[1] for r in before).second <= 30
    feed.add([("a", 999, "2024-03-01 00:00:05", 200.0)]).add(rows[50:]).add([("a", 0, "2024-03-02", None)])
    found = as_rows(feed.run())
    assert found == as_rows(windows(cast(spark, rows)).collect())
    assert before == found[: len(before)]


def test_a_stream_needs_a_delay(spark, tmp_path):
    feed = LevelFeed(spark, tmp_path, LEVELS, lambda s: windows(s, None)).add(level_rows(3))
    with pytest.raises(ValueError, match="delay"):
        feed.run()


def test_many_short_channels_share_their_state(spark, tmp_path, monkeypatch):
    """A micro-batch calls Python once for a group of records, not once for each."""
    monkeypatch.setattr(samples, "GROUPS", 16, raising=False)
    n = 400
    rows = [(f"c{c}", i, c + i / 8) for i in range(12) for c in range(n)]
    feed = Feed(spark, tmp_path, SAMPLES, cutter("fill", "1 hour")).add(rows[:n * 5])
    assert records(feed) == [] and feed.state_rows <= 16
    found = records(feed.add(rows[n * 3:]))
    assert feed.state_rows <= 16
    assert found == sorted((f"c{c}", 0, [c + i / 8 for i in range(8)]) for c in range(n))
    found = records(feed.add([("a", 10**6, None)]))
    assert len(found) == 2 * n and feed.state_rows == 0
    assert [r for r in found if r[1]] == sorted(
        (f"c{c}", 1, [c + i / 8 for i in range(8, 12)] + [0.0] * 4) for c in range(n)
    )


@pytest.fixture
def one_group(monkeypatch):
    monkeypatch.setattr(samples, "GROUPS", 1)


@pytest.mark.parametrize("last_record", ["skip", "fill", "keep"])
def test_records_of_one_group_stay_apart(spark, tmp_path, one_group, last_record):
    test_shuffled_and_repeated_samples_make_the_records_of_a_table(spark, tmp_path, last_record)


def test_each_record_of_a_group_has_its_own_end(spark, tmp_path, one_group):
    test_late_samples_are_dropped_and_open_records_wait(spark, tmp_path)


def test_a_gap_is_filled_beside_records_that_are_out(spark, tmp_path, one_group):
    test_a_gap_is_filled_while_there_is_time(spark, tmp_path)


def test_keys_of_any_type_come_out_as_they_went_in(spark, tmp_path):
    keys = "id bigint, at timestamp, name string, price decimal(20,4), f double, day date, raw binary"
    values = [
        "9007199254740993L, timestamp'2024-03-31 01:30:00.123456', 'a\\n\"b\\u00e9', 0.1000BD, 0.1D, date'2024-02-29', X'00FF'",
        "CAST(NULL AS BIGINT), NULL, NULL, NULL, NULL, NULL, NULL",
        "1L, timestamp'1969-12-31 23:59:59.999999', '', -5.0000BD, double('NaN'), date'1582-10-15', X''",
    ]
    schema = f"{keys}, frame bigint, x double"
    source = " UNION ALL ".join(f"SELECT {v} , id, id + 0.5D FROM range(8)" for v in values)
    table = spark.createDataFrame(spark.sql(source).collect(), schema)
    table.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = stream_records(spark, str(tmp_path / "in"), schema)
    names = [f.split()[0] for f in keys.split(", ")]
    cut = cut_record_stream(stream, names, SIZE, FS, "1 hour")
    assert cut.select(names).dtypes == table.select(names).dtypes
    write_stream(cut, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out"))
    shown = lambda df: sorted(map(str, df.select(names).distinct().collect()))
    assert shown(found) == shown(table)
    assert {tuple(r.samples) for r in found.collect()} == {tuple(i + 0.5 for i in range(8))}


def test_an_append_is_a_few_large_files(spark, monkeypatch):
    """So that micro-batches do not grow in number with the tasks that read and write the table."""
    paths = []

    def noted(spark, path, schema, **options):
        paths.append(path)
        return stream_records(spark, path, schema, **options)

    monkeypatch.setattr(timelines, "stream_records", noted)
    small = {"spark.sql.files.maxPartitionBytes": "2k", "spark.sql.files.openCostInBytes": "1k"}
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        table = spark.range(4000, numPartitions=40).select((F.col("id") % 40).alias("c"), "id")
        when, copies = F.col("id") % timelines.ARRIVALS, F.col("id") % 7 == 0
        stream = timelines.arriving(table, when, {"id": 10**9}, copies)
    finally:
        for name in small:
            spark.conf.unset(name)
    found = spark.read.parquet(*paths)
    assert sorted(r.id for r in found.collect()) == sorted([*range(4000), *range(0, 4000, 7), 10**9])
    assert len(found.inputFiles()) <= 8 * (timelines.ARRIVALS + 1) + 1
    assert timelines.to_end(stream).count() == found.count()


@pytest.mark.parametrize("size", [1, 256, 257, 70_000])
def test_records_of_any_size(spark, tmp_path, size):
    rows = [("a", i, float(i)) for i in range(2 * size + min(size - 1, 3))]
    build = lambda s: cut_record_stream(s, ["channel"], size, float(size), "1 hour", last_record="keep")
    feed = Feed(spark, tmp_path, SAMPLES, build).add(rows[::-2]).add(rows[1::2] + rows[::2])
    found = records(feed.add([("a", 10**4 * size, None)]))
    wanted = [rows[lo : lo + size] for lo in range(0, len(rows), size)]
    assert found == [("a", n, [x for _, _, x in part]) for n, part in enumerate(wanted)]
