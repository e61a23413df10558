import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonomere.operators.compare import (
    assert_rmse, paired_run_report, rmse_long, rmse_match, rmse_results, rmse_values, rmse_vectors,
)

# Two vectors and their deviation.
A = [
    0.1221174368357885, 0.8030612655311997, 0.8732426284336273, 0.8000925604778708,
    0.6351656368136573, 0.323284190497698, 0.6192489942098376, 0.9573403084388671,
    0.7101131243855894, 0.0232360227774637,
]
B = [
    0.7363374103655478, 0.352353350406777, 0.7134586729011047, 0.0323479482933672,
    0.9458845231585757, 0.7822982947818798, 0.844976605688674, 0.5908107704086722,
    0.570884102351707, 0.1368780976139283,
]
RMSE = 0.41475327309957516

SIZES = "The given sequences' sizes don't match"


def table(spark, rows, depth):
    dtype = T.DoubleType()
    for _ in range(depth):
        dtype = T.ArrayType(dtype)
    schema = T.StructType([T.StructField("ts", T.LongType()), T.StructField("v", dtype)])
    return spark.createDataFrame(rows, schema)


def test_values_and_vectors(spark):
    row = spark.range(1).select(
        rmse_values(F.lit(0.9458845231585757), F.lit(0.323284190497698)).alias("a"),
        rmse_vectors(F.lit(A), F.lit(B)).alias("b"),
        rmse_match(F.lit(A), F.lit(B), 0.5).alias("c"),
        rmse_match(F.lit(A), F.lit(A), 0.0).alias("d"),
    ).first()
    assert row.a == pytest.approx(0.440244917193507, abs=1e-10)
    assert row.b == pytest.approx(RMSE, abs=1e-10)
    assert (row.c, row.d) == (True, False)
    with pytest.raises(Exception, match=SIZES):
        spark.range(1).select(rmse_vectors(F.lit(A), F.lit(B[:2]))).collect()


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_results(spark, depth):
    def nest(v):
        for _ in range(depth - 1):
            v = [v]
        return v

    a, b = (table(spark, [(100, nest(v)), (200, nest(v))], depth) for v in (A, B))
    assert rmse_results(a, b, ["ts"], "v").first().rmse == pytest.approx(RMSE, abs=1e-10)
    assert assert_rmse(a, a, ["ts"], "v", 1e-16) == 0.0
    with pytest.raises(AssertionError, match="did not rmse-match"):
        assert_rmse(a, b, ["ts"], "v", RMSE / 2)


def test_long_results(spark):
    a, b = (table(spark, list(enumerate(v)), 0) for v in (A, B))
    assert rmse_long(a, b, ["ts"], "v").first().rmse == pytest.approx(RMSE, abs=1e-10)
    assert rmse_results(a, b, ["ts"], "v").first().rmse == pytest.approx(RMSE, abs=1e-10)
    with pytest.raises(Exception, match=SIZES):
        rmse_long(a, b.filter("ts < 9"), ["ts"], "v").collect()
    with pytest.raises(Exception, match="keys don't match"):
        rmse_long(a, b.withColumn("ts", F.col("ts") + 1), ["ts"], "v").collect()


@pytest.mark.parametrize("expected, actual, message", [
    ([(101, [[[1.0]]])], [(100, [[[1.0]]])], "keys don't match"),
    ([(100, [[[1.0]]])], [(100, [[[1.0, 2.0]]])], SIZES),
    ([(100, [[[1.0]]])], [(100, [[[1.0]], [[1.0]]])], "number of channels don't match"),
    ([(100, [[[1.0]]])], [(100, [[[1.0]]]), (100, [[[1.0]]])], SIZES),
    ([(100, [[[1.0]]])], [(100, [[[1.0], [2.0]]])], "number of segment don't match"),
    ([(1, [[[1.0]]]), (2, [[[1.0], [1.0]]])], [(1, [[[1.0]]]), (2, [[[1.0], [1.0]]])], "number of segment"),
])
def test_segmented_mismatches(spark, expected, actual, message):
    with pytest.raises(Exception, match=message):
        rmse_results(table(spark, expected, 3), table(spark, actual, 3), ["ts"], "v").collect()


@pytest.mark.parametrize("expected, actual, message", [
    ([(101, [[1.0]])], [(100, [[1.0]])], "keys don't match"),
    ([(100, [[1.0]])], [(100, [[1.0]]), (100, [[1.0]])], SIZES),
    ([(100, [[1.0]])], [(100, [[1.0], [2.0]])], "number of channels don't match"),
    ([(100, [[1.0]])], [(100, [[1.0, 2.0]])], "records' length don't match"),
    ([(1, [[1.0]]), (2, [[1.0, 2.0]])], [(1, [[1.0]]), (2, [[1.0, 2.0]])], "records' length don't"),
])
def test_aggregated_mismatches(spark, expected, actual, message):
    with pytest.raises(Exception, match=message):
        rmse_results(table(spark, expected, 2), table(spark, actual, 2), ["ts"], "v").collect()


def test_unsupported_types(spark):
    df = spark.createDataFrame([(1, ["a"])], "ts long, v array<string>")
    with pytest.raises(ValueError, match="Unsupported type"):
        rmse_results(df, df, ["ts"], "v")
    with pytest.raises(ValueError, match="differ in type"):
        rmse_results(table(spark, [(1, [1.0])], 1), table(spark, [(1, 1.0)], 0), ["ts"], "v")


def local_report(pairs):
    f1, f2 = ([p[i] for p in pairs] for i in (0, 1))
    mean = lambda v: sum(v) / len(v)
    dev = lambda v: math.sqrt(mean([(x - mean(v)) ** 2 for x in v]))
    faster1, faster2 = [b - a for a, b in pairs if a < b], [a - b for a, b in pairs if a > b]
    out = {
        "runs": len(pairs), "f1_total": sum(f1), "f2_total": sum(f2),
        "f1_share": sum(f1) * 100 // (sum(f1) + sum(f2)),
        "f2_share": sum(f2) * 100 // (sum(f1) + sum(f2)),
        "f1_mean": mean(f1), "f2_mean": mean(f2), "f1_stddev": dev(f1), "f2_stddev": dev(f2),
        "f1_wins": len(faster1), "f2_wins": len(faster2),
        "f1_win_share": len(faster1) * 100 // len(pairs),
        "f2_win_share": len(faster2) * 100 // len(pairs),
        "f1_win_mean": mean(faster1), "f2_win_mean": mean(faster2),
        "f1_win_stddev": dev(faster1), "f2_win_stddev": dev(faster2),
    }
    for name, values in (("f1", sorted(f1)), ("f2", sorted(f2))):
        for p in (0.25, 0.5, 0.75, 0.9, 0.95, 0.99):
            out[f"{name}_p{round(p * 100)}"] = values[math.ceil((len(values) - 1) * p)]
    return out


def test_paired_run_report(spark):
    pairs = [((i * 37) % 101 + 1, (i * 53) % 97 + 1) for i in range(20)]
    df = spark.createDataFrame(
        [("a", *p) for p in pairs] + [(None, b, a) for a, b in pairs], "g string, x long, y long"
    )
    rows = {r.g: r.asDict() for r in paired_run_report(df, "x", "y", ["g"]).collect()}
    for g, wanted in (("a", local_report(pairs)), (None, local_report([(b, a) for a, b in pairs]))):
        assert {k: v for k, v in rows[g].items() if k != "g"} == pytest.approx(wanted)
    whole = paired_run_report(df.filter("g = 'a'"), "x", "y").first().asDict()
    assert whole == pytest.approx(local_report(pairs))
