"""WAV files as a data source of Spark: ``spark.read.format("wav")``, and ``readStream``.

    wav_format.register(spark)
    records = spark.read.format("wav").options(recordSeconds=60, fs=16000, channels=1, bits=16).load(uri)

Files are planned by name and length alone, as ranges of records. Filters on ``sound_id``, ``path``,
``record_idx`` and ``timestamp`` take files and ranges out of the plan, so what they exclude is never
opened. A schema without ``channels`` reads headers only, and no samples.

Options: ``recordSeconds``, ``fs``, ``channels``, ``bits`` (all needed); ``lastRecord`` (``skip``);
``start``, the date of every file, or ``startFormat``, how a file's name tells it, as in
``%Y%m%d_%H%M%S.wav`` (the epoch, if neither is there); ``splitBytes``, about the bytes of one task;
``settleSeconds`` (0), how long a stream leaves a new file alone.
"""

import fnmatch
import time
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import types as T

from sonomere.sources.pcm import open_file, read_header, split_uri
from sonomere.sources.wav import (
    SPLIT_BYTES, check_format, epoch_ms, record_count, record_size_in_frames, records_between,
)

SCHEMA = T.StructType([
    T.StructField("sound_id", T.StringType()),
    T.StructField("path", T.StringType()),
    T.StructField("record_idx", T.LongType()),
    T.StructField("frame_offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("channels", T.ArrayType(T.ArrayType(T.DoubleType()))),
])
_FOREVER = 1 << 62
_TIME = pa.timestamp("us", tz="UTC")


def register(spark: SparkSession) -> None:
    """Make the format known to the session, and let filters reach it."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WavFormat)


@dataclass(frozen=True)
class File:
    path: str
    length: int
    modified: int

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]


@dataclass
class RecordRange(ds.InputPartition):
    """Some records of one file."""

    path: str
    length: int
    start_ms: int
    first: int
    last: int


def list_files(uri: str) -> list[File]:
    """The files at a path, in a folder or under a glob in its last part; hidden and empty ones are
    left out, as Spark does.
    """
    files, root = split_uri(uri)
    root = root.rstrip("/")
    folder, _, pattern = root.rpartition("/")
    if not any(c in pattern for c in "*?["):
        info = files.get_file_info(root)
        if info.type == pafs.FileType.File:
            folder, pattern, found = folder, None, [info]
        elif info.type == pafs.FileType.Directory:
            folder, pattern = root, "*"
        else:
            raise FileNotFoundError(uri)
    if pattern is not None:
        found = files.get_file_info(pafs.FileSelector(folder, recursive=False))
    prefix = uri[: uri.rindex(folder)] if folder in uri else ""
    return sorted(
        (
            File(prefix + f.path, f.size, f.mtime_ns or 0)
            for f in found
            if f.type == pafs.FileType.File and f.size and not f.base_name.startswith((".", "_"))
            and (pattern is None or fnmatch.fnmatchcase(f.base_name, pattern))
        ),
        key=lambda f: f.path,
    )


class _Plan:
    """What the options say, and the ranges of records that filters leave."""

    def __init__(self, options: Mapping[str, str], schema: T.StructType):
        missing = [o for o in ("path", "recordSeconds", "fs", "channels", "bits") if o not in options]
        if missing:
            raise ValueError(f"Options {missing} of the wav format are missing")
        for field in schema.fields:
            if field.name not in SCHEMA.names or field.dataType != SCHEMA[field.name].dataType:
                raise ValueError(f"The wav format has no column {field.name} {field.dataType.simpleString()}")
        self.columns = schema.names
        self.uri = options["path"]
        self.fs, self.channels, self.bits = float(options["fs"]), int(options["channels"]), int(options["bits"])
        self.size = record_size_in_frames(self.fs, float(options["recordSeconds"]))
        self.last_record = options.get("lastRecord", "skip")
        if self.last_record not in ("skip", "fail", "fill", "keep"):
            raise ValueError(f"Unknown last record action {self.last_record!r}")
        self.split_bytes = int(options.get("splitBytes", SPLIT_BYTES))
        self.settle = float(options.get("settleSeconds", 0))
        self.start, self.start_format = options.get("start"), options.get("startFormat")
        self.names: list = []  # conditions on a file, as (column, condition)
        self.first, self.last = 0, _FOREVER
        self.since, self.until = None, None

    def start_ms(self, file: File) -> int:
        if self.start_format is not None:
            try:
                date = datetime.strptime(file.name, self.start_format)
            except ValueError:
                raise ValueError(f"Read file {file.name} has no startDate in its name") from None
            return epoch_ms(date)
        return 0 if self.start is None else epoch_ms(self.start)

    def take(self, condition: ds.Filter) -> bool:
        """Use a filter for the plan; true if nothing of it is left for Spark to check."""
        column = condition.attribute if hasattr(condition, "attribute") else ()
        name, value = (column[0] if len(column) == 1 else None), getattr(condition, "value", None)
        if name in ("sound_id", "path") and isinstance(
            condition, ds.EqualTo | ds.In | ds.StringStartsWith | ds.StringEndsWith | ds.StringContains
        ):
            self.names.append((name, condition))
            return True
        if name == "record_idx" and isinstance(value, int):
            low, high = _bounds(condition, value, 1)
            self.first, self.last = max(self.first, low), min(self.last, high)
            return low > -_FOREVER or high < _FOREVER
        if name == "timestamp" and isinstance(value, datetime):
            # Time to the millisecond, so Spark compares once more.
            low, high = _bounds(condition, _millis(value), 1)
            self.since = low if self.since is None else max(self.since, low)
            self.until = high if self.until is None else min(self.until, high)
        return False

    def wanted(self, file: File) -> bool:
        return all(_holds(c, file.name if n == "sound_id" else file.path) for n, c in self.names)

    def ranges(self, files: Iterable[File]) -> list[RecordRange]:
        """The ranges to read. A file may turn out to have fewer records than its length allows."""
        record_bytes = self.size * self.channels * (self.bits // 8)
        record_ms = self.size * 1000 / self.fs
        step = max(1, self.split_bytes // record_bytes)
        out = []
        for file in files:
            if not self.wanted(file):
                continue
            start = self.start_ms(file)
            first, last = self.first, min(self.last, -(-file.length // record_bytes))
            if self.since is not None:
                first = max(first, int((self.since - start) // record_ms) - 1)
                last = min(last, int((self.until - start) // record_ms) + 2)
            for at in range(max(0, first), last, step):
                out.append(RecordRange(file.path, file.length, start, at, min(at + step, last)))
        return out

    def read(self, part: RecordRange) -> Iterator[pa.RecordBatch]:
        row = {"path": part.path, "sound_id": part.path.rsplit("/", 1)[-1], "start_ms": part.start_ms}
        with open_file(part.path) as source:
            header = read_header(source, part.length)
            check_format(part.path, header, self.fs, self.channels, self.bits)
            if "channels" in self.columns:
                batches = records_between(
                    source, header, row, self.size, part.first, part.last, self.last_record
                )
                for batch in batches:
                    yield self.shaped(batch)
                return
        last = min(part.last, record_count(header, part.path, self.size, self.last_record))
        index = np.arange(part.first, max(part.first, last), dtype=np.int64)
        yield self.shaped(pa.RecordBatch.from_pydict({
            "sound_id": pa.array([row["sound_id"]] * len(index), pa.string()),
            "path": pa.array([row["path"]] * len(index), pa.string()),
            "record_idx": pa.array(index), "frame_offset": pa.array(index * self.size),
            "ts_ms": pa.array(part.start_ms + index * self.size * 1000 // header.fs),
        }))

    def shaped(self, batch: pa.RecordBatch) -> pa.RecordBatch:
        def column(name: str) -> pa.Array:
            if name == "timestamp":
                return pa.array(np.asarray(batch["ts_ms"]) * 1000, pa.int64()).cast(_TIME)
            return batch[name]

        return pa.RecordBatch.from_arrays([column(n) for n in self.columns], self.columns)


def _millis(value: datetime) -> int:
    if value.tzinfo is None:
        value = value.astimezone()  # Spark gives local time, as in rows
    return epoch_ms(value.astimezone(timezone.utc))


def _bounds(condition: ds.Filter, value: int, unit: int) -> tuple[int, int]:
    """``[low, high)`` of the whole numbers that a comparison allows."""
    if isinstance(condition, ds.EqualTo):
        return value, value + unit
    if isinstance(condition, ds.GreaterThan):
        return value + unit, _FOREVER
    if isinstance(condition, ds.GreaterThanOrEqual):
        return value, _FOREVER
    if isinstance(condition, ds.LessThan):
        return -_FOREVER, value
    if isinstance(condition, ds.LessThanOrEqual):
        return -_FOREVER, value + unit
    return -_FOREVER, _FOREVER


def _holds(condition: ds.Filter, text: str) -> bool:
    value = condition.value
    if isinstance(condition, ds.EqualTo):
        return text == value
    if isinstance(condition, ds.In):
        return text in value
    if isinstance(condition, ds.StringStartsWith):
        return text.startswith(value)
    if isinstance(condition, ds.StringEndsWith):
        return text.endswith(value)
    return value in text


class _Reader(ds.DataSourceReader):
    def __init__(self, plan: _Plan):
        self.plan = plan

    def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:
        for condition in filters:
            if not self.plan.take(condition):
                yield condition

    def partitions(self) -> list[ds.InputPartition]:
        # One range at least, even an empty one.
        return self.plan.ranges(list_files(self.plan.uri)) or [RecordRange("", 0, 0, 0, 0)]

    def read(self, partition: RecordRange) -> Iterator[pa.RecordBatch]:
        return self.plan.read(partition) if partition.path else iter(())


class _StreamReader(ds.DataSourceStreamReader):
    """Files in the order in which they were last modified; an offset is the last one taken."""

    def __init__(self, plan: _Plan):
        self.plan = plan

    def initialOffset(self) -> dict:
        return {"modified": -1, "path": ""}

    def _settled(self) -> list[tuple[int, str, File]]:
        latest = time.time_ns() - int(self.plan.settle * 1e9)
        found = [f for f in list_files(self.plan.uri) if f.modified <= latest]
        return sorted((f.modified, f.path, f) for f in found)

    def latestOffset(self) -> dict:
        files = self._settled()
        return {"modified": files[-1][0], "path": files[-1][1]} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> list[ds.InputPartition]:
        after, upto = (start["modified"], start["path"]), (end["modified"], end["path"])
        return self.plan.ranges(f for at, path, f in self._settled() if after < (at, path) <= upto)

    def read(self, partition: RecordRange) -> Iterator[pa.RecordBatch]:
        return self.plan.read(partition)


class WavFormat(ds.DataSource):
    """Records of WAV files: ``(sound_id, path, record_idx, frame_offset, timestamp, channels)``.

    As ``read_wav_records``, from which it differs in where dates come from and in what it skips. A
    stream takes every file once, when it has not changed for ``settleSeconds``; a file that appears
    with an earlier time than one already taken is not seen, so move files in within that time.
    """

    @classmethod
    def name(cls) -> str:
        return "wav"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> ds.DataSourceReader:
        return _Reader(_Plan(self.options, schema))

    def streamReader(self, schema: T.StructType) -> ds.DataSourceStreamReader:
        return _StreamReader(_Plan(self.options, schema))
