"""PCM WAV bytes: headers and samples."""

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column
from pyspark.sql import functions as F

from sonomere.functions.arrow_vectors import lists

# Format tags of the "fmt " chunk.
TAG_PCM = 0x0001
TAG_EXTENSIBLE = 0xFFFE

NOT_WAV = "Input file is not wav"
BIG_ENDIAN = "Input file is big-endian (RIFX), which is not supported"
NOT_PCM = "Input file is not integer-PCM formatted"
CORRUPTED = "Input file length doesn't match computed one - probably corrupted"


@dataclass(frozen=True)
class Header:
    """What the chunks before the samples say, and what is wrong with the file (or None)."""

    error: str | None
    fs: int = 0
    channels: int = 0
    bits: int = 0
    data_offset: int = 0
    frames: int = 0

    @property
    def frame_bytes(self) -> int:
        return self.channels * (self.bits // 8)


def read_header(source, length: int) -> Header:
    """Header of a seekable binary ``source`` of ``length`` bytes."""
    head = source.read(12)
    if len(head) == 12 and head[:4] == b"RIFX":
        return Header(BIG_ENDIAN)
    if len(head) < 12 or head[:4] != b"RIFF" or head[8:] != b"WAVE":
        return Header(NOT_WAV)
    declared = struct.unpack("<I", head[4:8])[0] + 8
    tag = fs = channels = bits = None
    position = 12
    while True:
        source.seek(position)
        chunk = source.read(8)
        if len(chunk) < 8:
            return Header(NOT_WAV if tag is None else CORRUPTED)
        name, size = chunk[:4], struct.unpack("<I", chunk[4:])[0]
        position += 8
        if name == b"fmt ":
            body = source.read(min(size, 40))
            if len(body) < 16:
                return Header(CORRUPTED)
            tag, channels, fs, _, _, bits = struct.unpack("<HHIIHH", body[:16])
            if tag == TAG_EXTENSIBLE and len(body) >= 26:
                tag = struct.unpack("<H", body[24:26])[0]
        elif name == b"data":
            break
        position += size + size % 2
    if tag != TAG_PCM or bits not in (8, 16, 24, 32) or not channels:
        return Header(NOT_PCM)
    available = min(size, length - position)
    frames = available // (channels * (bits // 8))
    error = None if declared == length and size == available else CORRUPTED
    return Header(error, fs, channels, bits, position, frames)


def decode(raw: bytes, bits: int) -> np.ndarray:
    """Little-endian PCM samples scaled to [-1, 1]."""
    if bits == 8:
        return -1.0 + np.frombuffer(raw, np.uint8) / (0.5 * (2**8 - 1))
    if bits == 16:
        values = np.frombuffer(raw, "<i2")
    elif bits == 24:
        wide = np.zeros((len(raw) // 3, 4), np.uint8)
        wide[:, 1:] = np.frombuffer(raw, np.uint8).reshape(-1, 3)
        values = wide.view("<i4")[:, 0] >> 8
    elif bits == 32:
        values = np.frombuffer(raw, "<i4")
    else:
        raise ValueError(f"Unsupported sample size ({bits} bits)")
    return values / float(2 ** (bits - 1))


def deinterleave(samples: np.ndarray, channels: int) -> np.ndarray:
    """``(channels, frames)`` of interleaved samples."""
    return np.ascontiguousarray(samples.reshape(-1, channels).T)


def decode_pcm(raw: Column, bits: int, channels: int) -> Column:
    """Interleaved PCM bytes of one row as ARRAY<ARRAY<DOUBLE>>, one inner array per channel."""
    frame = channels * (bits // 8)

    @F.arrow_udf("array<array<double>>")
    def decoded(blobs: pa.Array) -> pa.Array:
        values, frames, valid = [np.empty(0)], [], []
        for blob in blobs:
            data = blob.as_buffer() if blob.is_valid else None
            valid.append(data is not None)
            if data is not None:
                if len(data) % frame:
                    raise ValueError(f"{len(data)} bytes are no whole number of {frame}-byte frames")
                values.append(deinterleave(decode(data, bits), channels).ravel())
                frames.append(len(data) // frame)
        inner_lengths = np.repeat(np.array(frames, dtype=np.int64), channels)
        all_channels = lists(
            inner_lengths, pa.array(np.concatenate(values)), np.ones(len(inner_lengths), dtype=bool)
        )
        valid = np.array(valid, dtype=bool)
        return lists(np.where(valid, channels, 0), all_channels, valid)

    return decoded(raw)


def split_uri(path: str):
    """``(filesystem, path in it)`` of a local path or of any URI pyarrow knows."""
    scheme, _, rest = path.partition(":")
    if path.startswith("/") or not rest:
        return pafs.LocalFileSystem(), path
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    if scheme in ("s3a", "s3n"):
        path = "s3:" + rest
    return pafs.FileSystem.from_uri(path)


def open_file(path: str):
    filesystem, name = split_uri(path)
    return filesystem.open_input_file(name)
