"""Audio in Arrow batches: WAV contents to samples, samples to WAV and to log-mel features. Compressed formats need a provider.

Samples are 16 kHz, one channel, as 32-bit floats between -1 and 1.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RATE, SHORT_SAMPLES = 16_000, 400_000
#: Formats of samples in a RIFF file.
PCM, FLOAT, EXTENSIBLE = 1, 3, 0xFFFE
#: Zero crossings of the resampling filter on each side, its window's shape, and the part of the narrower band that passes.
CROSSINGS, BETA, PASS = 72, 9.5, 0.95


@lru_cache(maxsize=8)
def _filters(up: int, down: int) -> np.ndarray:
    """(up, taps): for each phase a Kaiser-windowed sinc that passes what both rates can hold; each phase sums to 1."""
    cut = PASS * min(1.0, up / down)
    half = math.ceil(CROSSINGS / cut)
    at = np.arange(-half + 1, half + 1)[None] - np.arange(up)[:, None] / up
    inside = np.clip(1 - np.square(at / half), 0, None)
    taps = cut * np.sinc(cut * at) * np.i0(BETA * np.sqrt(inside)) / np.i0(BETA)
    return taps / taps.sum(axis=1, keepdims=True)


def resampled(x: np.ndarray, rate: int, to: int = RATE) -> np.ndarray:
    """Samples at ``rate`` as samples at ``to``, band-limited by a polyphase filter; beyond the ends there is silence.

    Sinusoids below 0.9 of the lower half rate come out with an error below -80 dB, and those above it below -70 dB.
    """
    if rate == to or not len(x):
        return x.astype(np.float64)
    if rate < 1:
        raise ValueError("no rate")
    shared = math.gcd(rate, to)
    up, down = to // shared, rate // shared
    taps = _filters(up, down)
    n, half = len(x) * up // down, taps.shape[1] // 2
    wide = np.concatenate([np.zeros(half - 1), x, np.zeros(half + 1)])
    windows = np.lib.stride_tricks.sliding_window_view(wide, 2 * half)
    out = np.empty(n)
    # Outputs of one phase lie ``up`` apart and read inputs ``down`` apart: one product for each phase.
    for k in range(min(up, n)):
        start, phase = divmod(k * down, up)
        many = len(out[k::up])
        out[k::up] = windows[start :: down][:many] @ taps[phase]
    return out


def read_wav(content: bytes) -> np.ndarray:
    """Samples of a RIFF file: 8, 16, 24 and 32 bits and floats of 32 and 64; channels are averaged, other rates resampled.

    A last frame that is not whole is left out, and samples end with the file.
    """
    if content[:4] not in (b"RIFF", b"RF64") or content[8:12] != b"WAVE":
        raise ValueError("no WAV")
    at, form = 12, None
    while at + 8 <= len(content):
        name, n = struct.unpack_from("<4sI", content, at)
        if name == b"fmt ":
            form = list(struct.unpack_from("<HHIIHH", content, at + 8))
            if form[0] == EXTENSIBLE:
                form[0] = struct.unpack_from("<H", content, at + 32)[0]
        if name == b"data":
            break
        at += 8 + n + n % 2
    else:
        raise ValueError("no samples")
    if form is None:
        raise ValueError("samples without a format")
    kind, channels, rate, _, frame, bits = form
    body = content[at + 8 : at + 8 + n]
    if not channels or frame * 8 != channels * bits:
        raise ValueError("frames that do not fit their samples")
    body = body[: len(body) // frame * frame]
    if kind == FLOAT and bits in (32, 64):
        x = np.frombuffer(body, f"<f{bits // 8}").astype(np.float64)
    elif kind == PCM and bits == 8:
        x = (np.frombuffer(body, np.uint8) - 128.0) / 128
    elif kind == PCM and bits in (16, 32):
        x = np.frombuffer(body, f"<i{bits // 8}") / float(1 << bits - 1)
    elif kind == PCM and bits == 24:
        wide = np.zeros((len(body) // 3, 4), np.uint8)
        wide[:, 1:] = np.frombuffer(body, np.uint8).reshape(-1, 3)
        x = wide.view("<i4")[:, 0] / float(1 << 31)
    else:
        raise ValueError(f"samples of format {kind} with {bits} bits")
    return resampled(x.reshape(-1, channels).mean(axis=1), rate).astype(np.float32)


def write_wav(samples: np.ndarray) -> bytes:
    """16 bits, 16 kHz, one channel; samples beyond 1 are clamped."""
    body = np.rint(np.clip(samples, -1, 1) * 32767).astype("<i2").tobytes()
    form = struct.pack("<4sIHHIIHH", b"fmt ", 16, PCM, 1, RATE, 2 * RATE, 2, 16)
    return struct.pack("<4sI4s", b"RIFF", 4 + len(form) + 8 + len(body), b"WAVE") + form + struct.pack("<4sI", b"data", len(body)) + body


def from_arrays(spark, arrays: list) -> DataFrame:
    """(path, samples) of arrays in memory, named by their place; an empty list is an error."""
    if not arrays:
        raise ValueError("no audio")
    rows = [(str(k), [float(v) for v in np.asarray(x, np.float32)]) for k, x in enumerate(arrays)]
    return spark.createDataFrame(rows, "path string, samples array<float>")


def encode(audio: DataFrame) -> DataFrame:
    """(path, samples) -> (path, content): WAV contents."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield pd.DataFrame({"path": frame["path"], "content": [write_wav(np.asarray(x, np.float32)) for x in frame["samples"]]})

    return audio.select("path", "samples").mapInPandas(run, "path string, content binary")


def decode(files: DataFrame) -> DataFrame:
    """(path, content) -> (path, samples, duration_sec, reason): what cannot be decoded has its reason, and nulls elsewhere."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for path, content in zip(frame["path"], frame["content"], strict=True):
                try:
                    x = read_wav(content)
                    rows.append((path, x, len(x) / RATE, None))
                except Exception as error:  # noqa: BLE001  a bad file is that file's result
                    rows.append((path, None, None, repr(error)))
            yield pd.DataFrame(rows, columns=["path", "samples", "duration_sec", "reason"])

    return files.select("path", "content").mapInPandas(run, "path string, samples array<float>, duration_sec double, reason string")


def short_enough(samples: Column) -> Column:
    """``samples``, or an error where there are over 25 seconds of them: those need chunks."""
    return F.when(F.size(samples) > SHORT_SAMPLES, F.raise_error(F.lit("too long, use chunks"))).otherwise(samples)


def frames_of(samples: Column, hop: int = 160, window: int = 400, center: bool = True) -> Column:
    """Number of feature frames."""
    n = F.size(samples)
    return F.floor((n if center else n - window) / hop) + 1


def mel_filters(bands: int, fft: int) -> np.ndarray:
    """(fft // 2 + 1, bands): triangles that are evenly spaced in mel (2595 log10(1 + f / 700)) from 0 to half the rate."""
    top = 2595 * np.log10(1 + RATE / 2 / 700)
    edges = 700 * (10 ** (np.linspace(0, top, bands + 2) / 2595) - 1)
    f = np.linspace(0, RATE / 2, fft // 2 + 1)[:, None]
    rise, fall = (f - edges[:-2]) / np.diff(edges)[:-1], (edges[2:] - f) / np.diff(edges)[1:]
    return np.maximum(0, np.minimum(rise, fall))


class LogMel:
    """Log-mel frames of samples that come in pieces: the frames are those of the whole, wherever it is cut.

    A frame's power in mel bands, clamped to 1e-9 to 1e9, as logarithm; periodic Hann windows. With ``center`` frames lie around
    every hop-th sample, and both ends are reflected; else they begin there, as long as they are whole. What later frames
    need of a piece is kept, less than a window and a hop.
    """

    def __init__(self, bands: int = 64, hop: int = 160, window: int = 400, center: bool = True):
        self.hop, self.window, self.center = hop, window, center
        self.hann = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(window) / window)
        self.mel = mel_filters(bands, window)
        self.held, self.begun, self.skip = np.empty(0), not center, 0

    def push(self, samples: np.ndarray) -> np.ndarray:
        """The frames that can be told by now."""
        self.held = np.concatenate([self.held, np.asarray(samples, dtype=np.float64)])
        half = self.window // 2
        if not self.begun:
            if len(self.held) <= half:
                return self._frames(np.empty(0))
            self.held = np.concatenate([self.held[half:0:-1], self.held])
            self.begun = True
        # The end is reflected later on, for which half a window is needed.
        return self._frames(self.held)

    def close(self) -> np.ndarray:
        """The frames that only the end makes; none for fewer samples than half a window and one."""
        half = self.window // 2
        if self.center and self.begun:
            self.held = np.concatenate([self.held, self.tail[-half - 1 : -1][::-1] if len(self.tail) > half else np.empty(0)])
        return self._frames(self.held)

    def _frames(self, x: np.ndarray) -> np.ndarray:
        n = max(0, (len(x) - self.window) // self.hop + 1)
        if len(x):
            keep = self.window // 2 + 1
            self.tail = x[-keep:] if len(x) >= keep else np.concatenate([getattr(self, "tail", np.empty(0)), x])[-keep:]
        if not n:
            return np.empty((0, self.mel.shape[1]))
        parts = np.lib.stride_tricks.sliding_window_view(x, self.window)[:: self.hop][:n]
        self.held = x[n * self.hop :]
        power = np.abs(np.fft.rfft(parts * self.hann, axis=1)) ** 2
        return np.log(np.clip(power @ self.mel, 1e-9, 1e9))


def log_mel(samples: np.ndarray, bands: int = 64, hop: int = 160, window: int = 400, center: bool = True) -> np.ndarray:
    """(frames, bands) of whole samples."""
    own = LogMel(bands, hop, window, center)
    return np.concatenate([own.push(samples), own.close()])


def encoded_frames(frames: Column, steps: int = 2, kernel: int = 5) -> Column:
    """How many frames are left after ``steps`` convolutions of stride two with padding (kernel - 1) // 2."""
    for _ in range(steps):
        frames = F.floor((frames + 2 * ((kernel - 1) // 2) - kernel) / 2) + 1
    return frames


def feature_parts(parts: DataFrame, bands: int = 64, kind: str = "float", **shape) -> DataFrame:
    """(path, part_ix, samples), a file's samples in parts -> (path, first_frame, features): features of the whole, part by part.

    A file's parts are gone through in order and never gathered; part_ix is that of the part with which frames became known, and
    those that the end makes come last. A null part is silence of no length. ``kind`` is float or double.
    """
    path_kind, dtype = parts.schema["path"].dataType.simpleString(), {"float": np.float32, "double": np.float64}[kind]
    rows = parts.select("path", "part_ix", "samples").repartition(F.col("path")).sortWithinPartitions("path", "part_ix")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, own, done, kind_of = None, None, 0, pa.string()

        def batch_of(x: np.ndarray) -> pa.RecordBatch:
            frames = pa.array([list(x.astype(dtype))], pa.list_(pa.list_(pa.from_numpy_dtype(dtype))))
            return pa.RecordBatch.from_arrays([pa.array([here], kind_of), pa.array([done], pa.int64()), frames], ["path", "first_frame", "features"])

        def end() -> Iterator[pa.RecordBatch]:
            if own and len(x := own.close()):
                yield batch_of(x)

        for batch in batches:
            kind_of = batch.schema.field("path").type
            for k, path in enumerate(batch.column("path").to_pylist()):
                if own is None or path != here:
                    yield from end()
                    here, own, done = path, LogMel(bands, **shape), 0
                piece = batch.column("samples")[k].values
                if piece is not None and len(x := own.push(piece.to_numpy(zero_copy_only=False))):
                    yield batch_of(x)
                    done += len(x)
        yield from end()

    return rows.mapInArrow(run, f"path {path_kind}, first_frame long, features array<array<{kind}>>")


def features(audio: DataFrame, bands: int = 64) -> DataFrame:
    """(path, samples) -> (path, features), an array of frames; null for null samples and for those shorter than half a window."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [None if x is None or len(x) <= 200 else list(log_mel(np.asarray(x), bands).astype(np.float32)) for x in frame["samples"]]
            yield pd.DataFrame({"path": frame["path"], "features": made})

    return audio.select("path", "samples").mapInPandas(run, "path string, features array<array<float>>")
