"""Joins on time and summaries against plain versions."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from sonomere.operators import compare, summaries, temporal

KEY = lambda r: tuple((x is not None, x) for x in r)


def day(n):
    return None if n is None else dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def plain_as_of(left, right, forward, tolerance):
    out = []
    for key, at, name in left:
        known = [
            (t, v) for k, t, v in right
            if None not in (key, at, k, t) and k == key and (t >= at if forward else t <= at)
            and abs(t - at) <= tolerance
        ]
        nearest = min if forward else max
        best = nearest((t for t, _ in known), default=None)
        values = [v for t, v in known if t == best]
        out.append((key, day(at), name, max(values) if values else None))
    return out


def as_of_tables(spark, left, right):
    return (
        spark.createDataFrame([(k, day(t), n) for k, t, n in left], "k string, t timestamp, name string"),
        spark.createDataFrame([(k, day(t), v) for k, t, v in right], "k string, at timestamp, v int"),
    )


@pytest.mark.parametrize("direction", ["backward", "forward"])
@pytest.mark.parametrize("seed", [1, 2])
def test_as_of(spark, direction, seed):
    rng = random.Random(seed)
    at = lambda: rng.choice([None, *range(60)])
    left = [(rng.choice(["hot", "hot", "hot", "b", None]), at(), f"n{i % 90}") for i in range(200)]
    right = [(rng.choice(["hot", "b", "c", None]), at(), rng.randrange(50)) for i in range(40)]
    for tolerance in (None, 4):
        found = temporal.as_of_join(
            *as_of_tables(spark, left, right), ["k"], "t", {"value": "v"}, "at", direction,
            None if tolerance is None else F.expr(f"INTERVAL {tolerance} DAYS"),
        )
        wanted = plain_as_of(left, right, direction == "forward", tolerance or 999)
        assert sorted(map(tuple, found.collect()), key=KEY) == sorted(wanted, key=KEY)


def test_as_of_splits_a_hot_key(spark, monkeypatch):
    """The rows of one key lie in many ranges, and values cross their borders."""
    kept, written = [], temporal.written
    monkeypatch.setattr(temporal, "written", lambda df, what: kept.append(written(df, what)) or kept[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    left = spark.range(4000).selectExpr("'hot' AS k", "id AS t")
    right = spark.createDataFrame([("hot", 10, 1), ("hot", 3000, 2)], "k string, at bigint, v int")
    found = temporal.as_of_join(left, right, ["k"], "t", {"v": "v"}, "at").collect()
    assert {(r.t, r.v) for r in found} == {
        (t, None if t < 10 else 1 if t < 3000 else 2) for t in range(4000)
    }
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sizes = [r["count"] for r in kept[0].groupBy("__part").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 2000


def test_as_of_empty_tables_and_clashing_names(spark):
    left, right = as_of_tables(spark, [("a", 1, "x")], [])
    assert temporal.as_of_join(left, right, ["k"], "t", {"v": "v"}, "at").first().v is None
    assert temporal.as_of_join(left.limit(0), right, ["k"], "t", {"v": "v"}, "at").count() == 0
    with pytest.raises(ValueError, match="left table already"):
        temporal.as_of_join(left, right, ["k"], "t", {"name": "v"}, "at")
    with pytest.raises(ValueError, match="direction"):
        temporal.as_of_join(left, right, ["k"], "t", {"v": "v"}, "at", direction="nearest")


def test_calibration_changes_over_time(spark):
    left, right = as_of_tables(spark, [("a", 1, "x"), ("a", 5, "y")], [("a", 2, -20)])
    found = temporal.calibrate_as_of(left.withColumn("x", F.lit(2.0)), right, ["k"], "t", "v", right_time="at")
    assert {(r.name, r.x) for r in found.collect()} == {("x", None), ("y", 20.0)}


@pytest.mark.parametrize("width", [0.5, 3.0, 50.0])
def test_intervals(spark, width):
    rng = random.Random(int(width))

    def spans(n, longest):
        out = []
        for i in range(n):
            s = rng.choice([None, *[x / 2 for x in range(-40, 40)]])
            out.append((rng.choice(["a", "a", None]), i, s, None if s is None else s + rng.choice([-1.0, 0.0, 0.25, 0.5, 1.0, longest])))
        return out

    left, right = spans(60, 30.0), spans(60, 7.5)
    wanted = [
        (k, i, s, e, j, u, v, max(s, u), min(e, v))
        for k, i, s, e in left for q, j, u, v in right
        if None not in (k, q, s, e, u, v) and k == q and s < e and u < v and max(s, u) < min(e, v)
    ]
    pairs = temporal.interval_join(
        spark.createDataFrame(left, "k string, i int, s double, e double"),
        spark.createDataFrame(right, "k string, j int, u double, v double"),
        ["k"], ("s", "e"), ("u", "v"), width,
    )
    assert sorted(map(tuple, pairs.collect())) == sorted(wanted) and wanted
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_intervals_of_time(spark):
    left = spark.createDataFrame([("a", day(0), day(2))], "k string, s timestamp, e timestamp")
    right = spark.createDataFrame(
        [("a", day(2), day(3)), ("a", day(1), day(5)), ("b", day(0), day(9))], "k string, u timestamp, v timestamp"
    )
    found = temporal.interval_join(left, right, ["k"], ("s", "e"), ("u", "v"), 86400.0).collect()
    assert [(r.overlap_start, r.overlap_end) for r in found] == [(day(1), day(2))]
    with pytest.raises(ValueError, match="both tables"):
        temporal.interval_join(left, left, ["k"], ("s", "e"), ("s", "e"), 1.0)


def test_exceeded_levels_are_within_half_a_class(spark):
    rng = random.Random(1)
    levels = {k: [rng.gauss(80, 12) for _ in range(n)] for k, n in (("a", 1), ("b", 7), ("c", 1000))}
    levels["d"] = [float("-inf")] * 9 + [50.0]
    rows = [(k, v) for k, values in levels.items() for v in values]
    rows += [("a", None), ("a", float("nan")), (None, 1.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    classes = summaries.level_classes(df, ["k"], "v", 0.1)
    found = summaries.exceeded_levels(classes, ["k"], [1, 5, 50, 95, 100], 0.1)
    found = {(r.k, r.percent): r.level for r in found.collect()}
    for k, values in levels.items():
        for percent in (1, 5, 50, 95, 100):
            exact = sorted(values, reverse=True)[math.ceil(percent * len(values) / 100) - 1]
            if math.isinf(exact):
                assert found[k, percent] == exact
            else:
                assert abs(found[k, percent] - exact) <= 0.05 + 1e-9
    # Classes of parts make those of the whole.
    halves = [df.filter(F.pmod(F.hash("v"), F.lit(2)) == i) for i in (0, 1)]
    parts = halves[0].transform(summaries.level_classes, ["k"], "v", 0.1).union(
        halves[1].transform(summaries.level_classes, ["k"], "v", 0.1)
    )
    merged = summaries.merge_classes(parts, ["k"])
    assert sorted(map(tuple, merged.collect()), key=KEY) == sorted(map(tuple, classes.collect()), key=KEY)


def plan_of(df):
    """The physical plan as it ran, without the one it started from."""
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def shuffles(df):
    return plan_of(df).count("Exchange hashpartitioning")


def test_rollup_adds_powers_in_one_shuffle(spark):
    df = spark.createDataFrame([("a", 1, 10.0), ("a", 1, 20.0), ("a", 2, None), ("b", 1, float("-inf"))], "s string, d int, v double")
    found = summaries.level_rollup(df, {"site": "s", "day": "d"}, "v", 2.0)
    rows = {(r.depth, r.site, r.day): r for r in found.collect()}
    assert len(rows) == 6
    assert rows[0, None, None].n == 3
    assert rows[2, "a", 1].mean_level == pytest.approx(10 * math.log10(55))
    assert rows[1, "a", None].exposure == pytest.approx(10 * math.log10(220))
    assert rows[2, "a", 2].mean_level is None and rows[2, "b", 1].mean_level == float("-inf")
    assert shuffles(found) == 1


def test_top_windows_are_cut_before_the_shuffle(spark):
    rows = [("a", i, float(i % 5)) for i in range(40)] + [("b", 0, None), ("b", 1, float("-inf"))]
    df = spark.createDataFrame(rows, "k string, i int, v double")
    top = summaries.top_windows(df, ["k"], "v", ["i"], 3)
    assert sorted((r.k, r["rank"], r.i) for r in top.collect()) == [
        ("a", 1, 4), ("a", 2, 9), ("a", 3, 14), ("b", 1, 1), ("b", 2, 0),
    ]
    assert plan_of(top).count("WindowGroupLimit") == 2


def test_difference_counts_duplicates_and_nulls(spark):
    schema = "k string, v double, w string"
    e = [("a", 1.0, "x"), ("a", 1.0, "x"), ("a", None, None), ("b", float("nan"), "y"), ("b", 0.0, "z"), ("c", 1.0, "q"), (None, 1.0, "n")]
    f = [("a", 1.0, "x"), ("a", None, None), ("a", 2.0, "x"), ("b", float("nan"), "y"), ("b", -0.0, "z"), ("d", 1.0, "q"), ("d", 1.0, "q")]
    found = compare.keyed_difference(
        spark.createDataFrame(e, schema), spark.createDataFrame(f, schema).select("w", "v", "k"), ["k"]
    )
    assert sorted(map(tuple, found.collect()), key=KEY) == [
        (None, 0, 0, 1, 0), ("a", 2, 1, 0, 0), ("b", 2, 0, 0, 0), ("c", 0, 0, 1, 0), ("d", 0, 0, 0, 2),
    ]
    close = [("a", 1.0000001, "x"), ("a", 1.0, "x"), ("a", None, None)]
    rounded = compare.keyed_difference(spark.createDataFrame(e[:3], schema), spark.createDataFrame(close, schema), ["k"], 3)
    assert [tuple(r) for r in rounded.collect()] == [("a", 3, 0, 0, 0)]
    with pytest.raises(ValueError, match="Columns differ"):
        compare.keyed_difference(found, found.drop("same"), ["k"])
