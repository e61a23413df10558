"""Root-mean-square deviation between two results, and a report on paired runs."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sonomere.functions.literals import check

# Error texts that callers match on.
SIZES = "The given sequences' sizes don't match"
KEYS = "The given records' keys don't match"
CHANNELS = "The given records' number of channels don't match"
SEGMENTS = "The given records' number of segment don't match"
LENGTHS = "The given records' length don't match"


def _squared(a: Column, b: Column) -> Column:
    return (a - b) * (a - b)


def rmse_values(expected: Column, actual: Column) -> Column:
    """Deviation of two numbers, ``sqrt((a-b)^2 / 2)``."""
    return F.sqrt(_squared(expected, actual) / 2)


def _squared_distance(expected: Column, actual: Column) -> Column:
    terms = F.zip_with(expected, actual, _squared)
    return F.aggregate(terms, F.lit(0.0), lambda acc, d: acc + d)


def rmse_vectors(expected: Column, actual: Column) -> Column:
    """Deviation of two vectors of one length."""
    mean = _squared_distance(expected, actual) / F.size(expected)
    return check(F.size(expected) == F.size(actual), F.lit(SIZES), F.sqrt(mean))


def rmse_match(expected: Column, actual: Column, max_rmse: float) -> Column:
    """Whether two vectors deviate by less than ``max_rmse``."""
    return rmse_vectors(expected, actual) < F.lit(float(max_rmse))


def _nesting(df: DataFrame, col: str) -> int:
    dtype, depth = df.schema[col].dataType, 0
    while isinstance(dtype, T.ArrayType):
        dtype, depth = dtype.elementType, depth + 1
    if not isinstance(dtype, T.NumericType) or depth > 3:
        raise ValueError(f"Unsupported type ({df.schema[col].dataType.simpleString()}) for RMSE")
    return depth


def _shape(col: str, depth: int) -> dict[str, Column]:
    """Number of channels, of segments per channel and of values per segment, and the values."""
    if depth == 1:
        return {
            "channels": F.lit(1),
            "segments": F.array(F.lit(1)),
            "lengths": F.array(F.size(col)),
            "values": F.col(col),
        }
    inner = F.transform(col, F.size)
    if depth == 2:
        return {
            "channels": F.size(col),
            "segments": F.array(F.lit(1)),
            "lengths": F.array_distinct(inner),
            "values": F.flatten(col),
        }
    windows = F.flatten(col)
    return {
        "channels": F.size(col),
        "segments": F.array_distinct(inner),
        "lengths": F.array_distinct(F.transform(windows, F.size)),
        "values": F.flatten(windows),
    }


def _sides(expected: DataFrame, actual: DataFrame, keys: Sequence[str], cols) -> DataFrame:
    """Both results in one table, told apart by ``is_expected``."""
    both = [
        df.select(*keys, F.lit(side).alias("is_expected"), *[v.alias(n) for n, v in cols.items()])
        for df, side in ((expected, True), (actual, False))
    ]
    return both[0].unionByName(both[1])


def _paired(sides: DataFrame, keys: Sequence[str], cols, pick) -> DataFrame:
    """One row per key: how often it occurs on each side, and what ``pick`` finds there."""
    expected = F.col("is_expected")
    return sides.groupBy(*keys).agg(
        F.count_if(expected).alias("n_e"),
        F.count_if(~expected).alias("n_a"),
        *[pick(F.when(expected, F.col(c))).alias("e_" + c) for c in cols],
        *[pick(F.when(~expected, F.col(c))).alias("a_" + c) for c in cols],
    )


def _key_checks() -> list[Column]:
    return [
        F.sum("n_e").alias("n_expected"),
        F.sum("n_a").alias("n_actual"),
        F.count_if((F.col("n_e") != F.col("n_a")) | (F.col("n_e") > 1)).alias("bad_keys"),
    ]


def _key_errors() -> Column:
    return F.when(F.col("n_expected") != F.col("n_actual"), F.raise_error(F.lit(SIZES))).when(
        F.col("bad_keys") > 0, F.raise_error(F.lit(KEYS))
    )


def rmse_results(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], col: str
) -> DataFrame:
    """Deviation of two results as a table of one value, ``rmse``.

    ``col`` may be an array nested up to three deep (channels, windows, values), or a number.
    Both results must have the same keys, each once, and the same shape in every record. One
    shuffle brings the two versions of a record together, another one counts the keys.
    """
    depth = _nesting(expected, col)
    if _nesting(actual, col) != depth:
        raise ValueError("The given results differ in type")
    if depth == 0:
        return rmse_long(expected, actual, keys, col)
    cols = _shape(col, depth)
    left = expected.select(*keys, F.lit(True).alias("e"), *[v.alias(f"e_{n}") for n, v in cols.items()])
    right = actual.select(
        *[F.col(k).alias(f"__{k}") for k in keys], F.lit(True).alias("a"),
        *[v.alias(f"a_{n}") for n, v in cols.items()],
    )
    # A hash join: the two versions of a record meet without sorting their values.
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    pairs = left.hint("shuffle_hash").join(right, same, "full")
    counted = _paired(_sides(expected, actual, keys, {}), keys, {}, F.max).agg(*_key_checks())

    def uneven(name: str) -> Column:
        """Records whose two versions differ, or are not of one shape in themselves."""
        differ = F.col(f"e_{name}") != F.col(f"a_{name}")
        return differ if name == "channels" else differ | (F.size(f"e_{name}") > 1)

    shapes = ("channels", "segments", "lengths")
    comparable = F.size("e_values") == F.size("a_values")
    distance = _squared_distance(F.col("e_values"), F.col("a_values"))
    compared = pairs.agg(
        *[F.count_if(uneven(n)).alias(f"bad_{n}") for n in shapes],
        *[F.min(f"e_{n}").alias(f"min_{n}") for n in shapes],
        *[F.max(f"e_{n}").alias(f"max_{n}") for n in shapes],
        F.sum(F.when(comparable, distance)).alias("squares"),
        F.sum(F.when(comparable, F.size("e_values"))).alias("n"),
    )
    # Two tables of one row.
    both = counted.unionByName(compared, allowMissingColumns=True)
    totals = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns])
    result = _key_errors()
    messages = (CHANNELS, SEGMENTS, LENGTHS if depth == 2 else SIZES)
    for name, message in zip(shapes, messages):
        bad = (F.col(f"bad_{name}") > 0) | (F.col(f"min_{name}") != F.col(f"max_{name}"))
        result = result.when(bad, F.raise_error(F.lit(message)))
    return totals.select(result.otherwise(F.sqrt(F.col("squares") / F.col("n"))).alias("rmse"))


def rmse_long(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], value: str
) -> DataFrame:
    """``rmse_results`` for results in long form, one number per row and key."""
    cols = {"value": F.col(value).cast("double")}
    pairs = _paired(_sides(expected, actual, keys, cols), keys, cols, F.max)
    squares = _squared(F.col("e_value"), F.col("a_value"))
    totals = pairs.agg(*_key_checks(), F.avg(squares).alias("mean_square"))
    return totals.select(_key_errors().otherwise(F.sqrt("mean_square")).alias("rmse"))


def assert_rmse(
    expected: DataFrame, actual: DataFrame, keys: Sequence[str], col: str, max_rmse: float
) -> float:
    """Fail unless the deviation is below ``max_rmse`` (strictly)."""
    value = rmse_results(expected, actual, keys, col).first()[0]
    if value is None or not value < max_rmse:
        raise AssertionError(f"The arrays did not rmse-match ({value} > {max_rmse})")
    return value


# Milliseconds whose different durations one task orders.
BUCKET = 1000
PERCENTILES = {25: 0.25, 50: 0.5, 75: 0.75, 90: 0.9, 95: 0.95, 99: 0.99}


def paired_run_report(
    df: DataFrame, first: str, second: str, group: Sequence[str] = ()
) -> DataFrame:
    """Compare two durations (whole milliseconds) measured per run, one row per group.

    Totals and their shares in whole percent, mean and population deviation, percentiles (the
    value at index ``ceil((n-1) p)``), how often each was faster and by how much. Durations are
    counted per value before anything is ordered, and then ordered in buckets of a second, so no
    task orders all durations of a group.
    """
    group = list(group)
    if not group:
        whole = df.withColumn("__all", F.lit(0))
        return paired_run_report(whole, first, second, ["__all"]).drop("__all")
    runs = df.select(
        *group, F.col(first).cast("bigint").alias("f1"), F.col(second).cast("bigint").alias("f2")
    )
    margin = F.col("f1") - F.col("f2")
    by_first, by_second = F.when(margin < 0, -margin), F.when(margin > 0, margin)
    total = F.sum("f1") + F.sum("f2")

    def share(part: Column, whole: Column) -> Column:
        return F.floor(part * 100 / whole).cast("bigint")

    summary = runs.groupBy(*group).agg(
        F.count("*").alias("runs"),
        F.sum("f1").alias("f1_total"),
        F.sum("f2").alias("f2_total"),
        share(F.sum("f1"), total).alias("f1_share"),
        share(F.sum("f2"), total).alias("f2_share"),
        F.avg("f1").alias("f1_mean"),
        F.avg("f2").alias("f2_mean"),
        F.stddev_pop("f1").alias("f1_stddev"),
        F.stddev_pop("f2").alias("f2_stddev"),
        F.count(by_first).alias("f1_wins"),
        F.count(by_second).alias("f2_wins"),
        share(F.count(by_first), F.count("*")).alias("f1_win_share"),
        share(F.count(by_second), F.count("*")).alias("f2_win_share"),
        F.avg(by_first).alias("f1_win_mean"),
        F.avg(by_second).alias("f2_win_mean"),
        F.stddev_pop(by_first).alias("f1_win_stddev"),
        F.stddev_pop(by_second).alias("f2_win_stddev"),
    )

    sides = F.explode(
        F.array(*[
            F.struct(F.lit(s).alias("side"), F.col(s).alias("v")) for s in ("f1", "f2")
        ])
    )
    counted = (
        runs.select(*group, sides.alias("s"))
        .groupBy(*group, "s.side", "s.v")
        .agg(F.count("*").alias("n"))
    )
    # Durations are summed up inside buckets, and the buckets' totals before them.
    counted = counted.withColumn("bucket", F.floor(F.col("v") / BUCKET))
    inside = Window.partitionBy(*group, "side", "bucket").orderBy("v")
    upto = F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    side = Window.partitionBy(*group, "side")
    before = F.sum("m").over(side.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    buckets = counted.groupBy(*group, "side", "bucket").agg(F.sum("n").alias("m")).select(
        *[F.col(g).alias(f"__{g}") for g in group], F.col("side").alias("__side"),
        F.col("bucket").alias("__bucket"),
        F.coalesce(before, F.lit(0)).alias("before"), F.sum("m").over(side).alias("all_runs"),
    )
    there = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in (*group, "side", "bucket")]
    placed = counted.join(buckets, there).drop(*[f"__{g}" for g in group])
    placed = placed.withColumn("upto", F.col("before") + upto)
    at = {p: F.ceil((F.col("all_runs") - 1) * F.lit(f)) for p, f in PERCENTILES.items()}
    reached = [
        F.min(F.when((F.col("side") == s) & (F.col("upto") > at[p]), F.col("v"))).alias(f"{s}_p{p}")
        for s in ("f1", "f2")
        for p in PERCENTILES
    ]
    percentiles = placed.groupBy(*group).agg(*reached)
    # One row per group on both sides; NULL is a group like any other.
    right = percentiles.withColumnsRenamed({g: f"__{g}" for g in group})
    same = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group]
    return summary.join(right, same).drop(*[f"__{g}" for g in group])


def keyed_difference(
    expected: DataFrame, found: DataFrame, keys: Sequence[str], digits: int | None = None
) -> DataFrame:
    """``(*keys, same, changed, missing, extra)``: how the rows of each key differ in two results.

    Rows are compared as they are, with their duplicates, null equal to null, NaN to NaN and -0.0 to
    0.0; ``digits`` rounds doubles first. Of the rows that only one result has, as many as the other
    has too under that key are ``changed``; the rest is ``missing`` or ``extra``. Columns go by name
    and must be the same in both. Keys with only equal rows are given too.

    One signed count per distinct row takes the place of set operations in both directions, so both
    results are read and shuffled once.
    """
    if sorted(expected.columns) != sorted(found.columns):
        raise ValueError(f"Columns differ: {sorted(expected.columns)} and {sorted(found.columns)}")
    doubles = [n for n, t in expected.dtypes if t in ("double", "float")]

    def normal(df: DataFrame, sides: tuple[int, int]) -> DataFrame:
        df = df.withColumns({
            c: (F.col(c) if digits is None else F.round(c, digits)) + F.lit(0.0) for c in doubles
        })
        return df.select(*expected.columns, *[F.lit(n).alias(s) for n, s in zip(sides, ("__e", "__f"))])

    both = normal(expected, (1, 0)).unionByName(normal(found, (0, 1)))
    rows = both.groupBy(*expected.columns).agg(F.sum("__e").alias("__e"), F.sum("__f").alias("__f"))
    per_key = rows.groupBy(*keys).agg(
        F.sum(F.least("__e", "__f")).alias("same"),
        F.sum(F.greatest(F.col("__e") - F.col("__f"), F.lit(0))).alias("__e"),
        F.sum(F.greatest(F.col("__f") - F.col("__e"), F.lit(0))).alias("__f"),
    )
    changed = F.least("__e", "__f")
    return per_key.select(
        *keys, "same", changed.alias("changed"), (F.col("__e") - changed).alias("missing"),
        (F.col("__f") - changed).alias("extra"),
    )
