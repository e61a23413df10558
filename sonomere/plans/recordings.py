"""WAV recordings made from a table, for queries that read recordings back.

Recorders write files of bounded length, and so does this: one file per (channel, file index),
written by the task that holds its frames into the folder all executors share.
"""

import io
import uuid
import wave
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sonomere.operators.frames import cut_records
from sonomere.sources.pcm import split_uri
from sonomere.storage import new_path


def encode(samples: np.ndarray, bits: int) -> bytes:
    """Interleaved integer samples as little-endian PCM; 8-bit samples are unsigned."""
    if bits == 8:
        return samples.astype(np.uint8).tobytes()
    if bits == 16:
        return samples.astype("<i2").tobytes()
    return samples.astype("<i4").view(np.uint8).reshape(-1, 4)[:, : bits // 8].tobytes()


def write_recordings(
    frames: DataFrame,
    channel: str,
    samples: Sequence[Column],
    fs: int,
    bits: int,
    frames_per_file: int,
) -> tuple[str, DataFrame]:
    """Write numbered frames as files ``<channel>_<file index>.wav`` with one audio channel per
    expression in ``samples``; returns the folder and ``(name, file_idx, frames)`` per file.
    """
    folder = new_path(frames.sparkSession, "recordings")
    names = [f"c{i}" for i in range(len(samples))]
    files = cut_records(
        frames, [channel], frames_per_file, dict(zip(names, samples)), "keep"
    ).withColumnRenamed("record_idx", "file_idx")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root = split_uri(folder)
        filesystem.create_dir(root, recursive=True)
        for batch in batches:
            done = {"name": [], "file_idx": [], "frames": []}
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in (channel, "file_idx")}
                # The samples as views of the batch, not as Python numbers.
                values = [batch.column(n)[i].values.to_numpy(zero_copy_only=False) for n in names]
                data = np.stack(values, axis=1).astype(np.int64)
                buffer = io.BytesIO()
                with wave.open(buffer, "wb") as out:
                    out.setnchannels(len(names))
                    out.setsampwidth(bits // 8)
                    out.setframerate(fs)
                    out.writeframes(encode(data.ravel(), bits))
                name = f"{row[channel]}_{row['file_idx']}.wav"
                # Moved into place whole: a task that is lost or runs twice leaves no half a file.
                partial = f"{root}/.{name}.{uuid.uuid4().hex}"
                with filesystem.open_output_stream(partial) as target:
                    target.write(buffer.getvalue())
                filesystem.move(partial, f"{root}/{name}")
                done["name"].append(name)
                done["file_idx"].append(row["file_idx"])
                done["frames"].append(len(data))
            yield pa.RecordBatch.from_pydict({
                "name": pa.array(done["name"], pa.string()),
                "file_idx": pa.array(done["file_idx"], pa.int64()),
                "frames": pa.array(done["frames"], pa.int64()),
            })

    listing = new_path(frames.sparkSession, "recording-list")
    made = files.mapInArrow(write, "name string, file_idx bigint, frames bigint")
    made.write.parquet(listing)
    return folder, frames.sparkSession.read.parquet(listing).withColumn(
        "start", F.timestamp_seconds(F.col("file_idx") * frames_per_file / F.lit(fs))
    )


# Ways to damage a file, by the name its copy begins with.
DAMAGES = {
    "whole": lambda data: data,
    "rifx": lambda data: b"RIFX" + data[4:],
    "text": lambda data: b"text" + data[4:],
    "float": lambda data: data[:20] + b"\x03\x00" + data[22:],
    "short": lambda data: data[:-4],
}


def damage_recordings(spark: SparkSession, folder: str, made: DataFrame) -> str:
    """A folder with one copy of every recording per kind of damage, named ``<kind>_<name>``."""
    target = new_path(spark, "damaged")

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, source = split_uri(folder)
        _, root = split_uri(target)
        filesystem.create_dir(root, recursive=True)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with filesystem.open_input_file(f"{source}/{name}") as file:
                    data = file.read()
                for kind, damage in DAMAGES.items():
                    partial = f"{root}/.{kind}_{name}.{uuid.uuid4().hex}"
                    with filesystem.open_output_stream(partial) as out:
                        out.write(damage(data))
                    filesystem.move(partial, f"{root}/{kind}_{name}")
            yield batch

    copied = made.select("name").mapInArrow(copy, "name string")
    copied.write.parquet(new_path(spark, "damaged-list"))
    return target
