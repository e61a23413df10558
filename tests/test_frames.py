import re

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sonomere.operators import frames
from sonomere.operators.frames import cut_blocks, cut_records, number_frames
from sonomere.operators.windows import segment


def skewed(spark, n=6000):
    """A third of all rows in channel 0, and a third of those at one time."""
    i = F.col("id")
    return spark.range(n).select(
        F.when(i % 3 == 0, 0).otherwise(1 + i % 40).alias("channel"),
        F.when(i % 9 == 0, 500).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000))).alias("t"),
        i.alias("tie"),
    )


def naive(df):
    w = Window.partitionBy("channel").orderBy("t", "tie")
    return {(r.channel, r.tie): r.f for r in df.withColumn("f", F.row_number().over(w) - 1).collect()}


@pytest.mark.parametrize("bucket", ["coarse", "one", None])
def test_numbering_of_a_hot_channel(spark, bucket):
    df = skewed(spark)
    column = {"coarse": F.floor(F.col("t") / 100), "one": F.lit(0), None: None}[bucket]
    numbered = number_frames(df, ["channel"], ["t", "tie"], column)
    assert {(r.channel, r.tie): r.frame for r in numbered.collect()} == naive(df)


def test_the_plan_does_not_depend_on_the_data(spark):
    def plan(n):
        numbered = number_frames(skewed(spark, n), ["channel"], ["t", "tie"], F.floor(F.col("t") / 100))
        records = cut_records(numbered, ["channel"], 64, {"x": F.col("t").cast("double")}, "fill")
        text = records._jdf.queryExecution().analyzed().toString()
        return re.sub(r"#\d+L?|\(0, \d+, ", "", text)

    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    assert plan(10) == plan(10**6)
    assert len(tracker.getJobIdsForGroup(None)) == before


def test_records_of_a_hot_channel_spread(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        numbered = number_frames(skewed(spark), ["channel"], ["t", "tie"], F.floor(F.col("t") / 100))
        records = cut_records(numbered, ["channel"], 64, {"x": F.col("t").cast("double")}, "keep")
        parts = records.filter("channel = 0").select(F.spark_partition_id().alias("p")).distinct()
        assert parts.count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_range_numbering_splits_the_hot_channel(spark):
    parts = []
    original = frames.written

    def spy(df, what):
        out = original(df, what)
        if what == "frames":
            parts.append(out)
        return out

    frames.written = spy
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        number_frames(skewed(spark), ["channel"], ["t", "tie"]).count()
    finally:
        frames.written = original
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    per_part = parts[0].groupBy("__part").count().agg(F.max("count")).first()[0]
    hot = parts[0].filter("channel = 0").select("__part").distinct().count()
    assert per_part < 6000 / 3 and hot > 1


def test_a_null_channel_is_an_error(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 1), (CAST(NULL AS INT), 2) AS t(channel, t)")
    for bucket in (None, F.lit(0)):
        with pytest.raises(Exception, match="NULL channel"):
            number_frames(df.union(df), ["channel"], ["t"], bucket).collect()


def signal(spark, lengths):
    rows = [(c, f, float(10 * c + f)) for c, n in lengths.items() for f in range(n)]
    return spark.createDataFrame(rows, "channel int, frame bigint, v double").repartition(5)


def test_records(spark):
    df = signal(spark, {1: 10, 2: 8})
    cut = {
        policy: {
            (r.channel, r.record_idx): r.samples
            for r in cut_records(df, ["channel"], 4, {"samples": "v"}, policy).collect()
        }
        for policy in ("skip", "fill", "keep")
    }
    assert len(cut["skip"]) == 4 and len(cut["fill"]) == 5 and len(cut["keep"]) == 5
    assert cut["skip"][1, 1] == [14.0, 15.0, 16.0, 17.0]
    assert cut["keep"][1, 2] == [18.0, 19.0]
    assert cut["fill"][1, 2] == [18.0, 19.0, 0.0, 0.0]
    with pytest.raises(Exception, match="contains a partial last record and PartialLastRecordAction"):
        cut_records(df, ["channel"], 4, {"samples": "v"}, "fail").collect()
    whole = cut_records(df.filter("channel = 2"), ["channel"], 4, {"samples": "v"}, "fail")
    assert whole.count() == 2
    with pytest.raises(ValueError):
        cut_records(df, ["channel"], 0, {"samples": "v"})
    with pytest.raises(ValueError):
        cut_records(df, ["channel"], 4, {"samples": "v"}, "other")


def test_records_span_batches(spark):
    lengths = {1: 10, 2: 1, 3: 23, 4: 7, 5: 60}
    for size in (1, 3, 7, 1000):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(size))
        try:
            df = signal(spark, lengths).union(spark.sql("SELECT CAST(NULL AS INT), 0L, 1.5D"))
            found = cut_records(df, ["channel"], 20, {"samples": "v"}, "keep").collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        wanted = {(None, 0): [1.5]}
        for c, n in lengths.items():
            for i in range(-(-n // 20)):
                wanted[c, i] = [float(10 * c + f) for f in range(i * 20, min(n, i * 20 + 20))]
        assert {(r.channel, r.record_idx): r.samples for r in found} == wanted and len(found) == len(wanted)


def test_records_keep_values_together(spark):
    df = signal(spark, {1: 8}).withColumn("w", -F.col("v"))
    row = cut_records(df, ["channel"], 8, {"a": "v", "b": F.col("w") * 2}).first()
    assert row.b == [-2 * x for x in row.a] and row.a == sorted(row.a)


@pytest.mark.parametrize("size, overlap, per_block", [
    (10, 0, 1), (10, 8, 1), (10, 8, 3), (7, 3, 2), (10, 9, 4), (5, 0, 100), (16, 15, 16),
])
def test_blocks_hold_the_windows_of_the_signal(spark, size, overlap, per_block):
    lengths = {1: size, 2: 37, 3: 64, 4: 17}
    blocks = cut_blocks(signal(spark, lengths), ["channel"], "v", size, overlap, per_block)
    found = {
        (r.channel, r.first_window + r.window_idx): r.x
        for r in segment(blocks, size, overlap).collect()
    }
    hop = size - overlap
    expected = {
        (c, w): [float(10 * c + w * hop + i) for i in range(size)]
        for c, n in lengths.items()
        for w in range(1 + (n - size) // hop)
    }
    assert found == expected


def test_blocks_are_bounded(spark):
    blocks = cut_blocks(signal(spark, {1: 500}), ["channel"], "v", 8, 4, 4)
    sizes = [r[0] for r in blocks.select(F.size("samples")).collect()]
    assert max(sizes) == 4 * 4 + 4 and len(sizes) > 20


def test_short_channels(spark):
    df = signal(spark, {1: 5, 2: 20})
    with pytest.raises(Exception, match=r"Incorrect segmentation signal length \(5\)"):
        cut_blocks(df, ["channel"], "v", 10).collect()
    kept = cut_blocks(df, ["channel"], "v", 10, on_short="skip")
    assert [r.channel for r in kept.collect()] == [2]


def series(spark, n):
    return spark.range(1).select(
        F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: i.cast("double")).alias("samples")
    )


@pytest.mark.parametrize("n, size, overlap, starts", [
    (100, 10, 0, range(1, 100, 10)), (110, 25, 0, (1, 26, 51, 76)), (23, 10, 8, range(1, 14, 2)),
])
def test_segmentation(spark, n, size, overlap, starts):
    rows = segment(series(spark, n), size, overlap).orderBy("window_idx").collect()
    assert [r.x for r in rows] == [list(np.arange(s, s + size, dtype=float)) for s in starts]


def test_segmentation_errors(spark):
    with pytest.raises(ValueError, match=r"Incorrect winSize for segmentation \(-1\)"):
        segment(series(spark, 5), -1)
    with pytest.raises(ValueError, match="shouldn't be negative or higher"):
        segment(series(spark, 5), 10, 10)
    with pytest.raises(ValueError, match="shouldn't be negative or higher"):
        segment(series(spark, 5), 10, -1)
    with pytest.raises(Exception, match="it should be larger than winSize"):
        segment(series(spark, 5), 10).collect()
    assert segment(series(spark, 5), 10, on_short="skip").count() == 0
