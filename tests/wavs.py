"""WAV files for tests."""

import struct
import wave

import numpy as np

# The first period of the 16 kHz test recording.
FIRST_WAVE = [
    0.0, 0.3826904296875, 0.707122802734375, 0.923858642578125, 0.999969482421875,
    0.92388916015625, 0.707061767578125, 0.382781982421875, -9.1552734375e-5, -0.38262939453125,
    -0.707122802734375, -0.923919677734375, -0.99993896484375, -0.9239501953125, -0.70703125,
    -0.382720947265625,
]


def pcm(samples, bits):
    """``samples`` (frames, channels) of integers as interleaved PCM bytes."""
    flat = np.asarray(samples).ravel()
    if bits == 8:
        return flat.astype(np.uint8).tobytes()
    wide = flat.astype("<i8").view(np.uint8).reshape(-1, 8)
    return wide[:, : bits // 8].tobytes()


def write(path, samples, fs, bits=16):
    samples = np.asarray(samples)
    samples = samples[:, None] if samples.ndim == 1 else samples
    with wave.open(str(path), "wb") as out:
        out.setnchannels(samples.shape[1])
        out.setsampwidth(bits // 8)
        out.setframerate(fs)
        out.writeframes(pcm(samples, bits))


def write_sine(path, seconds=2.5, fs=16000):
    period = np.round(np.array(FIRST_WAVE) * 32768).astype(int)
    n = int(seconds * fs)
    write(path, np.tile(period, -(-n // 16))[:n], fs)


def raw(magic=b"RIFF", kind=b"WAVE", tag=1, bits=16, data=b"\0" * 8, before=b"", extra=0, fs=8):
    """A WAV file by hand: one channel, an optional chunk before the samples, a wrong length."""
    frame = bits // 8
    fmt = b"fmt " + struct.pack("<IHHIIHH", 16, tag, 1, fs, fs * frame, frame, bits)
    body = kind + fmt + before + b"data" + struct.pack("<I", len(data)) + data
    return magic + struct.pack("<I", len(body)) + body + b"\0" * extra
