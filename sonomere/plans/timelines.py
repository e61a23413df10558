"""Queries over time: streams of samples and levels, joins on time, long-term summaries.

As in ``catalogue``, with the same queries in SQL beside them.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sonomere.functions import sql
from sonomere.functions.bands import Bands
from sonomere.functions.levels import to_db
from sonomere.functions.spectral import Windowing
from sonomere.operators import aggregates, compare, long_fft, summaries, temporal, windows
from sonomere.plans import oracles
from sonomere.plans.catalogue import (
    FS, FULL_SCALE, HIGH, LOW, RECORD, RECORDERS, Query, _feature_rows, _flat_spl, _shown, _tol_spectra, evt, lin,
    lin_records, rounded, table,
)
from sonomere.plans.oracles import (
    EVT, LIN, R, REC, cut, db, density, dft, lin_psd, lin_tol, lin_welch, psd, rnd, taper,
)
from sonomere.plans.workflows import WelchSpl
from sonomere.storage import new_path
from sonomere.streaming.levels import levels_by_window
from sonomere.streaming.records import stream_records, write_stream

# Appends that an arriving table is dealt into.
ARRIVALS = 4
# Files of an append, and of a micro-batch, however large; they are read by row groups of so many
# bytes.
TRIGGER_FILES = 8
ROW_GROUP = 16 << 20
LEVEL_KEYS = ["recorder"]


def arriving(rows: DataFrame, when, heartbeat: dict, copies) -> DataFrame:
    """``rows`` as a stream of files that were appended in the order of ``when``, a number below
    ``ARRIVALS``. Rows with ``copies`` come once more in the append after; the last append has a
    heartbeat, the row of the given values.
    """
    spark = rows.sparkSession
    arrival = when.cast("int")
    times = F.when(copies, F.array(arrival, arrival + 1)).otherwise(F.array(arrival))
    dealt = rows.withColumn("__arrival", F.explode(times))
    first = new_path(spark, "arrivals")
    dealt.write.partitionBy("__arrival").parquet(first)
    source = new_path(spark, "stream-in")
    schema = rows.schema
    for arrived in range(ARRIVALS + 1):
        append = spark.read.schema(dealt.schema).parquet(first).filter(F.col("__arrival") == arrived)
        append = append.drop("__arrival").coalesce(TRIGGER_FILES)
        append.write.option("parquet.block.size", ROW_GROUP).mode("append").parquet(source)
    beat = spark.range(0, 1, 1, 1).select(
        *[F.lit(heartbeat.get(f.name)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
    beat.write.mode("append").parquet(source)
    return stream_records(spark, source, schema, max_files=TRIGGER_FILES)


def to_end(stream: DataFrame) -> DataFrame:
    """All that a stream puts out."""
    spark, target = stream.sparkSession, new_path(stream.sparkSession, "stream-out")
    write_stream(stream, target, new_path(spark, "stream-state")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


def welch_spl_samples(spark: SparkSession, sf: str) -> DataFrame:
    """WF-1 over single samples that arrive out of order, some of them twice."""
    samples = lin(spark, sf).select("l_suppkey", "frame", "x")
    jitter = F.pmod(F.xxhash64("l_suppkey", "frame"), F.lit(200))
    when = F.least(F.floor((F.col("frame") + jitter) / 250), F.lit(ARRIVALS - 1))
    stream = arriving(samples, when, {"frame": 10**12}, F.pmod(F.xxhash64("frame"), F.lit(7)) == 0)
    features = WelchSpl(2.0, 32, 16, 32).of_samples(
        stream, ["l_suppkey"], FS, last_record="fill", delay="30 seconds"
    )
    return _feature_rows(_flat_spl(to_end(features)), RECORD)


def _record_levels(spark: SparkSession, sf: str) -> DataFrame:
    features = _flat_spl(WelchSpl(2.0, 32, 16, 32)(lin_records(spark, sf), FS))
    later = (F.col("timestamp") + F.expr("INTERVAL 1 DAY")).alias("timestamp")
    return features.select((F.col("l_suppkey") % RECORDERS).alias("recorder"), *RECORD, later, "spl")


def _window_rows(levels: DataFrame) -> DataFrame:
    rows = levels.withColumn("window_ms", F.unix_millis("window_start")).drop("window_start")
    return rounded(rows, "mean_level", "exposure", "least_level", "greatest_level")


def level_windows(streamed: bool) -> Query:
    """Levels of every recorder over sliding windows, from a table or from shuffled, repeated files."""
    def query(spark, sf):
        levels = _record_levels(spark, sf)
        if streamed:
            order = F.pmod(F.xxhash64(*RECORD), F.lit(ARRIVALS))
            levels = arriving(
                levels, order, {"timestamp": "2200-01-01"}, F.pmod(F.xxhash64(*RECORD), F.lit(3)) == 0
            )
        found = levels_by_window(levels, LEVEL_KEYS, RECORD, 2.0, "4 seconds", "2 seconds", "1000 days")
        return _window_rows(to_end(found) if streamed else found)

    return query


def calibration_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Samples of four recorders under calibrations that change, several of them on one day."""
    samples = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_suppkey") % RECORDERS).alias("recorder"), "l_shipdate",
        (F.col("l_extendedprice") / FULL_SCALE).alias("x"),
    )
    calibrations = table(spark, sf, "orders").select(
        (F.col("o_custkey") % RECORDERS).alias("recorder"), "o_orderdate",
        (-(F.col("o_orderkey") % 40)).alias("sensitivity"),
    )
    found = temporal.calibrate_as_of(
        samples, calibrations, ["recorder"], "l_shipdate", "sensitivity", right_time="o_orderdate"
    )
    return rounded(found, "x")


def next_error(spark: SparkSession, sf: str) -> DataFrame:
    """For every event the user's next error within six hours."""
    events = table(spark, sf, "events").select("event_id", "user_id", "ts")
    errors = table(spark, sf, "events").filter("event_type = 'error'").select("user_id", "ts", "event_id")
    return temporal.as_of_join(
        events, errors, ["user_id"], "ts", {"error_id": "event_id"}, direction="forward",
        tolerance=F.expr("INTERVAL 6 HOURS"),
    )


def annotations_in_records(spark: SparkSession, sf: str) -> DataFrame:
    """Events that last as many minutes as their value, and the hours of their user they overlap."""
    events = table(spark, sf, "events")
    seconds = F.round(F.col("value") * 60, 6).cast("decimal(18,6)")
    annotations = events.filter("event_type <> 'view'").select(
        "user_id", "event_id", "ts", (F.col("ts") + F.make_dt_interval(secs=seconds)).alias("end")
    )
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    hours = events.select("user_id", hour.alias("hour")).distinct()
    hours = hours.withColumn("hour_end", F.col("hour") + F.expr("INTERVAL 1 HOUR"))
    pairs = temporal.interval_join(
        annotations, hours, ["user_id"], ("ts", "end"), ("hour", "hour_end"), 3600.0
    )
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return pairs.select(
        "user_id", "event_id", "hour", (micros("overlap_end") - micros("overlap_start")).alias("overlap_us")
    )


def exceeded_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Levels that the spectrum of every recorder exceeds 5, 50 and 95 % of the time."""
    spectra = windows.spectrogram(
        lin_records(spark, sf).withColumn("recorder", F.col("l_suppkey") % RECORDERS),
        Windowing(32, 16, 32, FS),
    )
    rows = windows.bins(spectra, ["recorder"], "psd", "p", "k")
    rows = rows.withColumn("level", to_db(F.col("p")))
    classes = summaries.level_classes(rows, ["recorder", "k"], "level", 0.5)
    return _shown(summaries.exceeded_levels(classes, ["recorder", "k"], [5, 50, 95], 0.5), "level")


def level_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Levels by recorder, year and month, by recorder and year, by recorder, and over all."""
    rows = table(spark, sf, "lineitem").withColumn("level", to_db(F.col("l_extendedprice")))
    found = summaries.level_rollup(
        rows,
        {
            "recorder": F.col("l_suppkey") % RECORDERS, "year": F.year("l_shipdate"),
            "month": F.month("l_shipdate"),
        },
        "level", 2.0,
    )
    return rounded(found, "mean_level", "exposure", "least_level", "greatest_level")


def top_windows(spark: SparkSession, sf: str) -> DataFrame:
    """The three loudest windows of every supplier and third-octave band."""
    keys = [*RECORD, "window_idx"]
    levels = aggregates.tol_long(
        windows.bins(_tol_spectra(spark, sf), keys), keys, Bands(64, FS, LOW, HIGH)
    )
    top = summaries.top_windows(levels, ["l_suppkey", "band"], "tol", ["record_idx", "window_idx"], 3)
    return _shown(top, "tol")


def keyed_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Line items against a copy with rows lost, doubled and changed, by order."""
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_quantity", F.expr("nullif(l_returnflag, 'A')").alias("flag"), "l_linenumber"
    )
    changed = items.withColumn(
        "l_quantity", F.when(F.col("l_linenumber") == 2, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    ).filter("l_linenumber <> 3")
    copies = changed.union(changed.filter("l_linenumber = 1"))
    return compare.keyed_difference(
        items.drop("l_linenumber"), copies.drop("l_linenumber"), ["l_orderkey"]
    )


def fft_long(spark: SparkSession, sf: str) -> DataFrame:
    """The spectrum of every supplier's whole signal, all of one size that holds the longest."""
    frames = lin(spark, sf).select("l_suppkey", "frame", "x")
    longest = frames.agg(F.max("frame")).first()[0] + 1
    found = long_fft.fft_long(
        frames, ["l_suppkey"], 1 << (longest - 1).bit_length(), block_points=1 << 12
    )
    return rounded(found, "re", "im")


def sql_spectrogram(spark: SparkSession, sf: str) -> DataFrame:
    """A spectrogram and its levels in SQL text, by table functions and functions of a session."""
    sql.register(spark)
    evt(spark, sf).createOrReplaceTempView("user_signals")
    return spark.sql("""
        SELECT user_id, window_idx, k, bin_frequency(k, 16, 64D) AS frequency, round(p, 6) AS p,
          round(to_db(p), 6) AS level
        FROM spectrogram(
          TABLE(SELECT user_id, frame, value AS x FROM user_signals),
          keys => 'user_id', size => 16, overlap => 8, nfft => 16, fs => 64D)
        WHERE k > 0""")


QUERIES: dict[str, Query] = {
    "welch_spl_samples": welch_spl_samples,
    "level_windows": level_windows(False),
    "level_windows_stream": level_windows(True),
    "calibration_as_of": calibration_as_of,
    "next_error": next_error,
    "annotations_in_records": annotations_in_records,
    "exceeded_levels": exceeded_levels,
    "level_rollup": level_rollup,
    "top_windows": top_windows,
    "keyed_difference": keyed_difference,
    "fft_long": fft_long,
    "sql_spectrogram": sql_spectrogram,
}


def states(level: str) -> str:
    """Levels over a group of levels of two seconds each."""
    power = f"power(10::DOUBLE, {level} / 10)"
    return f"""count({level}) AS n, {rnd(db(f'avg({power})'))} AS mean_level,
  {rnd(db(f'(sum({power}) * 2)'))} AS exposure, {rnd(f'min({level})')} AS least_level,
  {rnd(f'max({level})')} AS greatest_level"""


LEVEL_WINDOWS = f"""WITH {REC}, {lin_welch(32, 16, 32)}, spl AS (
  SELECT {R}, 10 * log10(sum(p)) AS spl FROM welch GROUP BY {R})
SELECT l_suppkey % 4 AS recorder, 86400000 + (record_idx * 2 - late) * 1000 AS window_ms, {states('spl')}
FROM (SELECT *, unnest([0, 2]) AS late FROM spl) GROUP BY ALL"""

_UNTYPED = {
    "welch_spl_samples": oracles.ORACLES["welch_spl_workflow"],
    "level_windows": LEVEL_WINDOWS,
    "level_windows_stream": LEVEL_WINDOWS,
    "calibration_as_of": f"""WITH cal AS (
  SELECT o_custkey % 4 AS recorder, o_orderdate AS t, max(-(o_orderkey % 40)) AS sensitivity
  FROM orders GROUP BY ALL),
samples AS (SELECT l_orderkey, l_linenumber, l_suppkey % 4 AS recorder, l_shipdate,
  l_extendedprice / 131072::DOUBLE AS x FROM lineitem)
SELECT l_orderkey, l_linenumber, s.recorder, l_shipdate,
  {rnd('x / power(10::DOUBLE, sensitivity / 20::DOUBLE)')} AS x
FROM samples s ASOF LEFT JOIN cal c ON s.recorder = c.recorder AND s.l_shipdate >= c.t""",
    "next_error": """WITH e AS (
  SELECT user_id, ts, max(event_id) AS error_id FROM events WHERE event_type = 'error' GROUP BY ALL)
SELECT l.event_id, l.user_id, l.ts,
  CASE WHEN e.ts <= l.ts + INTERVAL 6 HOURS THEN e.error_id END AS error_id
FROM events l ASOF LEFT JOIN e ON l.user_id = e.user_id AND l.ts <= e.ts""",
    "annotations_in_records": """WITH a AS (
  SELECT user_id, event_id, ts, ts + to_microseconds(round(value * 60000000)::BIGINT) AS stop
  FROM events WHERE event_type <> 'view'),
h AS (SELECT DISTINCT user_id, date_trunc('hour', ts) AS hour FROM events)
SELECT a.user_id, event_id, hour,
  epoch_us(least(stop, hour + INTERVAL 1 HOUR)) - epoch_us(greatest(ts, hour)) AS overlap_us
FROM a JOIN h ON a.user_id = h.user_id AND ts < hour + INTERVAL 1 HOUR AND hour < stop""",
    "exceeded_levels": f"""WITH {REC}, {lin_psd(32, 16, 32)},
classes AS (
  SELECT l_suppkey % 4 AS recorder, k, count(*) AS n,
    CASE WHEN p > 0 THEN floor(10 * log10(p) / 0.5::DOUBLE)::BIGINT ELSE -2147483648 END AS class
  FROM psd GROUP BY ALL),
counted AS (
  SELECT *, sum(n) OVER (PARTITION BY recorder, k ORDER BY class DESC) AS above,
    sum(n) OVER (PARTITION BY recorder, k) AS total, unnest([5, 50, 95]) AS percent FROM classes)
SELECT recorder, k, percent,
  CASE WHEN max(class) > -2147483648 THEN (max(class) + 0.5::DOUBLE) * 0.5::DOUBLE END AS level
FROM counted WHERE above * 100 >= percent * total GROUP BY recorder, k, percent""",
    "level_rollup": f"""SELECT recorder, year, month, depth::INTEGER AS depth, * EXCLUDE (recorder, year, month, depth)
FROM (SELECT l_suppkey % 4 AS recorder, year(l_shipdate) AS year, month(l_shipdate) AS month,
    3 - bit_count(grouping_id(recorder, year, month)) AS depth, {states('level')}
  FROM (SELECT *, 10 * log10(l_extendedprice) AS level FROM lineitem) GROUP BY ROLLUP (recorder, year, month))""",
    "top_windows": f"""WITH {REC}, {lin_tol()}
SELECT {R}, window_idx, band, {rnd('tol')} AS tol, rank::INTEGER AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY l_suppkey, band
    ORDER BY tol DESC NULLS LAST, record_idx, window_idx) AS rank FROM tol)
WHERE rank <= 3""",
    "keyed_difference": """WITH e AS (
  SELECT l_orderkey, l_quantity, nullif(l_returnflag, 'A') AS flag FROM lineitem),
c AS (SELECT l_orderkey, l_quantity + (l_linenumber = 2)::INTEGER AS l_quantity,
  nullif(l_returnflag, 'A') AS flag, unnest(CASE WHEN l_linenumber = 1 THEN [1, 2] ELSE [1] END) AS copy
  FROM lineitem WHERE l_linenumber <> 3),
f AS (SELECT l_orderkey, l_quantity, flag FROM c),
parts AS (
  SELECT l_orderkey, 1 AS s, 0 AS e, 0 AS f FROM (SELECT * FROM e INTERSECT ALL SELECT * FROM f)
  UNION ALL SELECT l_orderkey, 0, 1, 0 FROM (SELECT * FROM e EXCEPT ALL SELECT * FROM f)
  UNION ALL SELECT l_orderkey, 0, 0, 1 FROM (SELECT * FROM f EXCEPT ALL SELECT * FROM e))
SELECT l_orderkey, sum(s)::BIGINT AS same, least(sum(e), sum(f))::BIGINT AS changed,
  (sum(e) - least(sum(e), sum(f)))::BIGINT AS missing, (sum(f) - least(sum(e), sum(f)))::BIGINT AS extra
FROM parts GROUP BY l_orderkey""",
    "fft_long": f"""WITH {LIN},
size AS (SELECT power(2, ceil(log2(max(frame) + 1)))::BIGINT AS nfft FROM lin),
bins AS (SELECT nfft, unnest(range(nfft // 2 + 1)) AS k FROM size)
SELECT l_suppkey, k, {rnd("sum(x * cos(2 * pi() * ((k * frame) % nfft) / nfft::DOUBLE))")} AS re,
  {rnd("-sum(x * sin(2 * pi() * ((k * frame) % nfft) / nfft::DOUBLE))")} AS im
FROM lin, bins GROUP BY l_suppkey, k""",
    "sql_spectrogram": f"""WITH {EVT}, {cut("evt", "user_id", "frame", "n", 16, 8)},
{dft("win", "user_id, window_idx", 16, taper("hamming", 16))},
{psd("user_id, window_idx", 16, density("hamming", 16, 64))}
SELECT user_id, window_idx, k, k * 64::DOUBLE / 16 AS frequency, {rnd("p")} AS p, {rnd(db("p"))} AS level
FROM psd WHERE k > 0""",
}

# Columns that are INTEGER in Spark and BIGINT in SQL, by query.
INTEGERS = {
    "exceeded_levels": ["k", "percent"],
    "level_rollup": ["year", "month"],
    "top_windows": ["window_idx", "band"],
    "sql_spectrogram": ["k"],
}


def _typed(name: str, sql: str) -> str:
    narrow = ", ".join(f"{c}::INTEGER AS {c}" for c in INTEGERS.get(name, []))
    return f"SELECT * REPLACE ({narrow}) FROM ({sql})" if narrow else sql


ORACLES = {name: _typed(name, sql) for name, sql in _UNTYPED.items()}
