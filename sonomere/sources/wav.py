"""Directories of PCM WAV recordings as tables of records.

Spark lists the files; each is cut into byte ranges, and a task reads the header of the file and
the records that start in its range. A long recording is therefore read by many tasks, and
nothing but file names and sizes is looked at before.
"""

from collections.abc import Callable, Iterable, Iterator
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonomere.functions.arrow_vectors import map_nested
from sonomere.operators.frames import LastRecord
from sonomere.sources.pcm import decode, open_file, read_header

SPLIT_BYTES = 32 << 20
TASK_BYTES = 128 << 20
# Files a task opens to audit them.
AUDIT_FILES = 1000
# Decoded samples of one Arrow batch.
BATCH_SAMPLES = 1 << 20
MAX_INT = 2**31 - 1

KEY_SCHEMA = "sound_id string, path string, record_idx bigint, frame_offset bigint, ts_ms bigint"
AUDIT_SCHEMA = (
    "path string, ok boolean, error string, fs int, channels int, bits int, frames bigint"
)


def list_wavs(spark: SparkSession, uri: str) -> DataFrame:
    """``(path, uri_path, sound_id, length)`` of the files under a URI or glob; reads no contents.

    Like all Spark file sources, leaves out files of zero bytes.
    """
    files = spark.read.format("binaryFile").load(uri).select("path", "length")
    return files.select(
        "path",
        F.regexp_replace("path", "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "").alias("uri_path"),
        F.element_at(F.split("path", "/"), -1).alias("sound_id"),
        "length",
    )


def inspect_wavs(spark: SparkSession, uri: str) -> DataFrame:
    """Audit files: ``(path, ok, error, fs, channels, bits, frames)``, one row per file."""

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {name: [] for name in ("path", "error", "fs", "channels", "bits", "frames")}
            for path, length in zip(batch["path"].to_pylist(), batch["length"].to_pylist()):
                with open_file(path) as source:
                    header = read_header(source, length)
                rows["path"].append(path)
                for name in ("error", "fs", "channels", "bits", "frames"):
                    rows[name].append(getattr(header, name))
            columns = {
                "path": pa.array(rows["path"], pa.string()),
                "ok": pa.array([e is None for e in rows["error"]], pa.bool_()),
                "error": pa.array(rows["error"], pa.string()),
                "fs": pa.array(rows["fs"], pa.int32()),
                "channels": pa.array(rows["channels"], pa.int32()),
                "bits": pa.array(rows["bits"], pa.int32()),
                "frames": pa.array(rows["frames"], pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    files = list_wavs(spark, uri).select("path", "length")
    # Spark packs the listing by bytes; opening a file costs the same whatever its length.
    n_tasks = max(spark.sparkContext.defaultParallelism, -(-files.count() // AUDIT_FILES))
    return files.repartition(n_tasks).mapInArrow(audit, AUDIT_SCHEMA)


def declaration_errors(audit: DataFrame, fs: float, channels: int, bits: int) -> DataFrame:
    """``(path, error)`` of every audited file: why a reader told that format would refuse it, or
    NULL.
    """
    def differs(what: str, found: Column, wanted) -> Column:
        message = F.concat(
            F.lit("File "), F.col("path"), F.lit(f": {what} ("), found.cast("string"),
            F.lit(f") doesn't match configured one ({wanted})"),
        )
        return F.when(found != F.lit(wanted), message)

    broken = F.when(F.col("error").isNotNull(), F.concat("error", F.lit(": "), "path"))
    error = F.coalesce(
        broken,
        differs("sample rate", F.col("fs").cast("double"), float(fs)),
        differs("number of channels", F.col("channels"), channels),
        differs("sample size in bits", F.col("bits"), bits),
    )
    return audit.select("path", error.alias("error"))


def duplicate_names(starts: DataFrame) -> DataFrame:
    """``(name, n)`` of the names that a list of start dates has more than once."""
    return starts.groupBy("name").agg(F.count("*").alias("n")).filter("n > 1")


def record_size_in_frames(fs: float, record_seconds: float) -> int:
    size = float(fs) * float(record_seconds)
    whole = round(size)
    if abs(size - whole) > 1e-9 * max(1.0, size):
        raise ValueError(f"Computed record size ({size:.6g}) should not have a decimal part.")
    if whole < 1:
        raise ValueError(f"Computed record size ({size:.6g}) should be at least one frame.")
    return whole


def start_table(
    spark: SparkSession, starts: DataFrame | Iterable[tuple[str, datetime | str]]
) -> DataFrame:
    """``(name, start_ms)`` from a table ``(name, start TIMESTAMP)`` or from pairs.

    Dates without a zone are UTC. A name may occur once.
    """
    duplicates = "Sounds list contains duplicate filename entries"
    if isinstance(starts, DataFrame):
        name, start = starts.columns[:2]
        table = starts.select(
            F.col(name).alias("name"), F.unix_millis(F.col(start).cast("timestamp")).alias("start_ms")
        )
        if not duplicate_names(table).isEmpty():
            raise ValueError(duplicates)
        return table
    rows = [(name, epoch_ms(start)) for name, start in starts]
    if len({name for name, _ in rows}) != len(rows):
        raise ValueError(duplicates)
    return spark.createDataFrame(rows, "name string, start_ms bigint")


def epoch_ms(date: datetime | str) -> int:
    if isinstance(date, str):
        date = datetime.fromisoformat(date)
    if date.tzinfo is None:
        date = date.replace(tzinfo=timezone.utc)
    since = date - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (since.days * 86_400 + since.seconds) * 1000 + since.microseconds // 1000


def with_start(files: DataFrame, starts: DataFrame, only_listed: bool = False) -> DataFrame:
    """Add ``start_ms`` to files, looked up by path or by name; NULL where neither is listed.

    Two equi-joins rather than one OR, so that neither side has to be small.
    """
    by_path = starts.select(F.col("name").alias("uri_path"), F.col("start_ms").alias("__by_path"))
    by_name = starts.select(F.col("name").alias("sound_id"), F.col("start_ms").alias("__by_name"))
    found = (
        files.join(by_path, "uri_path", "left")
        .join(by_name, "sound_id", "left")
        .withColumn("start_ms", F.coalesce("__by_path", "__by_name"))
        .drop("__by_path", "__by_name")
    )
    return found.filter("start_ms IS NOT NULL") if only_listed else found


def read_wav_records(
    spark: SparkSession,
    uri: str,
    starts: DataFrame | Iterable[tuple[str, datetime | str]],
    fs: float,
    channels: int,
    bits: int,
    record_seconds: float,
    last_record: LastRecord = "skip",
    only_listed: bool = False,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Records of ``record_seconds`` of all files under ``uri``.

    ``starts`` gives the start date of every file by its name or path. Rows are ``(sound_id,
    path, record_idx, frame_offset, timestamp, channels)``, ``channels`` holding one array of
    normalised samples per channel. A file that contradicts the declared format, or whose start
    date is unknown, fails the query; ``only_listed`` leaves unlisted files out instead.
    """
    size = record_size_in_frames(fs, record_seconds)
    files, sizes = _files(spark, uri, starts, only_listed)
    return _read(
        spark, files, sizes, size, fs, channels, bits, last_record, split_bytes=split_bytes
    )


def read_wav_features(
    spark: SparkSession,
    uri: str,
    starts: DataFrame | Iterable[tuple[str, datetime | str]],
    fs: float,
    channels: int,
    bits: int,
    record_seconds: float,
    kernels: dict[str, tuple[Callable[[np.ndarray], np.ndarray], str]],
    last_record: LastRecord = "skip",
    only_listed: bool = False,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """``read_wav_records`` with features in place of samples, computed where samples are decoded.

    ``kernels`` maps a feature to a function of a (signals, samples) matrix and to the type of
    its result for one record. Samples, by far the largest data there is, never leave the Python
    worker that read them.
    """
    size = record_size_in_frames(fs, record_seconds)
    files, sizes = _files(spark, uri, starts, only_listed)
    return _read(
        spark, files, sizes, size, fs, channels, bits, last_record, split_bytes=split_bytes,
        kernels=kernels,
    )


def read_wav_file(
    spark: SparkSession,
    uri: str,
    start: datetime | str,
    fs: float,
    channels: int,
    bits: int,
    record_seconds: float,
    last_record: LastRecord = "skip",
) -> DataFrame:
    """``read_wav_records`` for one file, whose name is the last element of the URI."""
    name = uri.rstrip("/").split("/")[-1]
    return read_wav_records(
        spark, uri, [(name, start)], fs, channels, bits, record_seconds, last_record
    )


def read_wav_chunks(
    spark: SparkSession,
    uri: str,
    chunk_size: int,
    offset_frame: int = 0,
    max_chunks: int | None = None,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """Chunks of ``chunk_size`` frames of every file from ``offset_frame`` on, at most
    ``max_chunks`` each; the last may be short. The format is the one in each header, and
    timestamps count from the epoch.
    """
    if chunk_size < 1 or chunk_size >= MAX_INT:
        raise ValueError("chunkSize larger than authorized")
    if offset_frame < 0 or (max_chunks is not None and max_chunks < 0):
        raise ValueError("offset_frame and max_chunks should not be negative")
    files = list_wavs(spark, uri).withColumn("start_ms", F.lit(0).cast("bigint"))
    return _read(
        spark, files, files, chunk_size, None, None, None, "keep", offset_frame, max_chunks,
        split_bytes,
    )


def _files(spark, uri, starts, only_listed) -> tuple[DataFrame, DataFrame]:
    """Files with their start dates, and the same files as far as their sizes matter."""
    listing = list_wavs(spark, uri)
    files = with_start(listing, start_table(spark, starts), only_listed)
    return files, files if only_listed else listing


def _read(
    spark, files, sizes, size, fs, channels, bits, last_record, offset=0, max_records=None,
    split_bytes=SPLIT_BYTES, kernels=None,
) -> DataFrame:
    if last_record not in ("skip", "fail", "fill", "keep"):
        raise ValueError(f"Unknown last record action {last_record!r}")
    last = F.greatest(F.ceil(F.col("length") / split_bytes) - 1, F.lit(0))
    n_tasks = _read_tasks(spark, sizes.agg(F.sum(last + 1), F.sum("length")).first())
    splits = files.select(
        "sound_id", "path", "length", "start_ms", F.explode(F.sequence(F.lit(0), last)).alias("split")
    )

    def read_splits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for records in _records_of_split(
                    row, size, fs, channels, bits, last_record, offset, max_records, split_bytes
                ):
                    yield records if kernels is None else _with_features(records, kernels)

    results = {"channels": "array<array<double>>"}
    if kernels is not None:
        results = {name: dtype for name, (_, dtype) in kernels.items()}
    schema = ", ".join([KEY_SCHEMA, *[f"{name} {dtype}" for name, dtype in results.items()]])
    records = splits.repartition(n_tasks).mapInArrow(read_splits, schema)
    return records.select(
        "sound_id", "path", "record_idx", "frame_offset",
        F.timestamp_millis("ts_ms").alias("timestamp"), *results,
    )


def _with_features(records: pa.RecordBatch, kernels) -> pa.RecordBatch:
    columns = {name: records[name] for name in records.schema.names if name != "channels"}
    for name, (kernel, _) in kernels.items():
        columns[name] = map_nested(records["channels"], kernel)
    return pa.RecordBatch.from_pydict(columns)


def _read_tasks(spark: SparkSession, listed) -> int:
    """Tasks to read with: ``TASK_BYTES`` each, small files packed together.

    ``listed`` is the number of splits and of bytes, known from the listing alone.
    """
    n_splits, n_bytes = (int(v or 0) for v in listed)
    wanted = max(spark.sparkContext.defaultParallelism, -(-n_bytes // TASK_BYTES))
    return max(1, min(n_splits, wanted))


def check_format(path, header, fs, channels, bits) -> None:
    if header.error:
        raise ValueError(f"{header.error}: {path}")
    declared = (
        ("sample rate", float(header.fs), None if fs is None else float(fs)),
        ("number of channels", header.channels, channels),
        ("sample size in bits", header.bits, bits),
    )
    for what, found, wanted in declared:
        if wanted is not None and found != wanted:
            raise ValueError(
                f"File {path}: {what} ({found}) doesn't match configured one ({wanted})"
            )


def _records_of_split(
    row, size, fs, channels, bits, last_record, offset, max_records, split_bytes
) -> Iterator[pa.RecordBatch]:
    """The records that start in one byte range of one file, a bounded batch at a time."""
    path, sound_id = row["path"], row["sound_id"]
    with open_file(path) as source:
        header = read_header(source, row["length"])
        check_format(path, header, fs, channels, bits)
        if row["start_ms"] is None:
            raise ValueError(f"Read file {sound_id} has no startDate in given list")
        if offset and offset >= header.frames:
            raise ValueError("offsetFrame larger than file's number of frames")
        if size >= MAX_INT // header.channels:
            raise ValueError("chunkSize larger than authorized")
        origin = header.data_offset + offset * header.frame_bytes
        record_bytes = size * header.frame_bytes
        # A record belongs to the split its first byte is in.
        low, high = row["split"] * split_bytes, (row["split"] + 1) * split_bytes
        first, last = max(0, -(-(low - origin) // record_bytes)), -(-(high - origin) // record_bytes)
        if max_records is not None:
            last = min(last, max_records)
        yield from records_between(source, header, row, size, first, last, last_record, offset)


def record_count(header, path: str, size: int, last_record: LastRecord, offset: int = 0) -> int:
    """Records of a file under a policy for the last one."""
    whole, rest = divmod(header.frames - offset, size)
    if rest and last_record == "fail":
        raise ValueError(
            f"File {path} contains a partial last record "
            "and PartialLastRecordAction is set to FAIL."
        )
    return whole + (1 if rest and last_record != "skip" else 0)


def records_between(
    source, header, row, size: int, first: int, last: int, last_record: LastRecord, offset: int = 0
) -> Iterator[pa.RecordBatch]:
    """The records ``first`` to ``last`` of an open file, as far as it has them, a bounded batch at
    a time.
    """
    last = min(last, record_count(header, row["path"], size, last_record, offset))
    frames = header.frames - offset
    origin = header.data_offset + offset * header.frame_bytes
    step = max(1, BATCH_SAMPLES // (size * header.channels))
    for at in range(first, last, step):
        n = min(step, last - at)
        source.seek(origin + at * size * header.frame_bytes)
        raw = source.read(min(n * size, frames - at * size) * header.frame_bytes)
        yield _batch(row, header, raw, at, n, size, offset, last_record)


def _batch(row, header, raw, at, n, size, offset, last_record) -> pa.RecordBatch:
    samples = decode(raw, header.bits)
    missing = n * size * header.channels - len(samples)
    if missing and last_record == "fill":
        samples, missing = np.concatenate([samples, np.zeros(missing)]), 0
    if not missing:
        values = samples.reshape(n, size, header.channels).transpose(0, 2, 1).ravel()
        lengths = np.full(n * header.channels, size)
    else:
        records = np.array_split(
            samples.reshape(-1, header.channels), range(size, len(samples) // header.channels, size)
        )
        values = np.concatenate([r.T.ravel() for r in records])
        lengths = np.repeat([len(r) for r in records], header.channels)
    inner = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(values)
    )
    outer = pa.ListArray.from_arrays(
        pa.array(np.arange(0, n * header.channels + 1, header.channels, dtype=np.int32)), inner
    )
    index = np.arange(at, at + n, dtype=np.int64)
    frame_offset = offset + index * size
    elapsed = frame_offset * 1000 // header.fs
    return pa.RecordBatch.from_pydict({
        "sound_id": pa.array([row["sound_id"]] * n, pa.string()),
        "path": pa.array([row["path"]] * n, pa.string()),
        "record_idx": pa.array(index),
        "frame_offset": pa.array(frame_offset),
        "ts_ms": pa.array(row["start_ms"] + elapsed),
        "channels": outer,
    })
