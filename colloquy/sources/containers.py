"""Durations of audio files from their containers, without decoding: RIFF, FLAC, Ogg and MP3.

A probe reads the pieces of a file that it needs: headers, the last pages of an Ogg stream, and all frame headers only where an MP3 says
nothing of its length. What cannot be told has its reason.
"""

from __future__ import annotations

import struct
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.sources.items import system_of

#: ``read(offset, n)`` gives up to n bytes from there.
Read = Callable[[int, int], bytes]

# Fixed values of MPEG audio frames: kilobits by version (1, else 2), layer and index; rates by version bits; samples in a frame.
KILOBITS = {
    (1, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {3: (44100, 48000, 32000), 2: (22050, 24000, 16000), 0: (11025, 12000, 8000)}
SAMPLES = {(1, 1): 384, (1, 2): 1152, (1, 3): 1152, (2, 1): 384, (2, 2): 1152, (2, 3): 576}

TAIL, BLOCK = 1 << 16, 1 << 20


def riff(read: Read, size: int) -> float:
    """Data bytes by block size and rate; a data chunk that claims more than the file holds ends with the file."""
    at, frame, rate, wide = 12, 0, 0, None
    while at + 8 <= size:
        name, n = struct.unpack("<4sI", read(at, 8))
        if name == b"ds64":
            wide = struct.unpack("<QQ", read(at + 8, 16))[1]
        elif name == b"fmt ":
            rate, _, frame = struct.unpack("<IIH", read(at + 12, 10))
        elif name == b"data":
            if not frame or not rate:
                raise ValueError("samples without a format")
            n = wide if n == 0xFFFFFFFF and wide is not None else n
            return min(n, size - at - 8) // frame / rate
        at += 8 + n + n % 2
    raise ValueError("no samples")


def flac(read: Read, size: int) -> float:
    head = read(4, 38)
    if len(head) < 22 or head[0] & 127:
        raise ValueError("no stream information")
    packed = int.from_bytes(head[14:22], "big")
    rate, total = packed >> 44, packed & (1 << 36) - 1
    if not rate or not total:
        raise ValueError("the length is not stated")
    return total / rate


def ogg(read: Read, size: int) -> float:
    """The granule of the stream's last page; its first page tells the rate, and for Opus what is skipped."""
    head = read(0, 4096)
    serial, first = head[14:18], 27 + head[26]
    packet = head[first:]
    if packet.startswith(b"OpusHead"):
        rate, skip = 48_000, struct.unpack("<H", packet[10:12])[0]
    elif packet.startswith(b"\x01vorbis"):
        rate, skip = struct.unpack("<I", packet[12:16])[0], 0
    else:
        raise ValueError("neither Opus nor Vorbis")
    end, after = size, b""
    while end > 0 and rate:
        start = max(0, end - TAIL)
        piece = read(start, end - start) + after
        at = piece.rfind(b"OggS")
        while at >= 0:
            page = piece[at : at + 18]
            if len(page) == 18 and page[14:18] == serial and (granule := struct.unpack("<q", page[6:14])[0]) >= 0:
                return max(0, granule - skip) / rate
            at = piece.rfind(b"OggS", 0, at)
        end, after = start, piece[:17]
    raise ValueError("no page with a position")


def _frame(head: bytes) -> tuple[int, int, int, int, bool] | None:
    """(bytes, samples, rate, version, mono) of the frame that begins with these four bytes."""
    if len(head) < 4 or head[0] != 0xFF or head[1] & 0xE0 != 0xE0:
        return None
    kind, layer, bits, speed = head[1] >> 3 & 3, 4 - (head[1] >> 1 & 3), head[2] >> 4, head[2] >> 2 & 3
    if kind == 1 or layer == 4 or bits in (0, 15) or speed == 3:
        return None
    version, rate = 1 if kind == 3 else 2, RATES[kind][speed]
    samples, per_second, padding = SAMPLES[version, layer], KILOBITS[version, layer][bits] * 1000, head[2] >> 1 & 1
    n = (12 * per_second // rate + padding) * 4 if layer == 1 else samples // 8 * per_second // rate + padding
    return n, samples, rate, version, head[3] >> 6 == 3


def mp3(read: Read, size: int) -> float:
    """The number of frames by a Xing, Info or VBRI header, or else by walking from frame to frame."""
    at = 0
    while (tag := read(at, 10))[:3] == b"ID3" and len(tag) == 10:
        at += 10 + sum((b & 127) << 7 * (3 - k) for k, b in enumerate(tag[6:])) + (10 if tag[5] & 16 else 0)
    # Some bytes may lie between a tag and the first frame; one frame must be followed by another, or by the end.
    piece = read(at, TAIL)
    for k in range(len(piece) - 3):
        if (own := _frame(piece[k : k + 4])) and (at + k + own[0] >= size or _frame(read(at + k + own[0], 4))):
            at += k
            break
    else:
        raise ValueError("no frames")
    n, samples, rate, version, mono = own
    first = read(at, 4 + 32 + 26)
    side = 4 + ((17 if mono else 32) if version == 1 else (9 if mono else 17))
    if first[side : side + 4] in (b"Xing", b"Info") and first[side + 7] & 1:
        return int.from_bytes(first[side + 8 : side + 12], "big") * samples / rate
    if first[36:40] == b"VBRI":
        return int.from_bytes(first[36 + 14 : 36 + 18], "big") * samples / rate
    heard, block, held = Counter(), -1, b""
    while at + 4 <= size:
        if not block <= at <= block + len(held) - 4 or block < 0:
            block, held = at, read(at, BLOCK)
        if not (own := _frame(held[at - block : at - block + 4])):
            break
        heard[own[2]] += own[1]
        at += own[0]
    return sum(n / r for r, n in heard.items())


def duration(read: Read, size: int) -> tuple[float, str]:
    """(seconds, container) of a file; a ValueError says why there are none."""
    head = read(0, 12)
    if head[:4] in (b"RIFF", b"RF64") and head[8:12] == b"WAVE":
        return riff(read, size), "riff"
    if head[:4] == b"fLaC":
        return flac(read, size), "flac"
    if head[:4] == b"OggS":
        return ogg(read, size), "ogg"
    if head[:3] == b"ID3" or _frame(head[:4]):
        return mp3(read, size), "mp3"
    raise ValueError("no container that is known")


def durations(files: DataFrame) -> DataFrame:
    """Adds duration_sec, duration_source (the container) and reason to (path, …[, content]).

    Without the column ``content`` the needed pieces are read from the files themselves, which every executor must reach by
    pyarrow (file, hdfs, s3, gs). A file that has no duration has a null, no source, and the reason; one bad file is no error.
    """
    given = "content" in files.columns
    rest = [c for c in files.columns if c not in ("content", "duration_sec", "duration_source", "reason")]
    names = [*rest, "duration_sec", "duration_source", "reason"]

    def probed(path: str, content: bytes | None) -> tuple[float | None, str | None, str | None]:
        try:
            if given:
                if content is None:
                    raise ValueError("no content")
                return *duration(lambda at, n: content[at : at + n], len(content)), None
            system, place = system_of(path)
            with system.open_input_file(place) as f:
                return *duration(lambda at, n: f.read_at(max(0, min(n, f.size() - at)), min(at, f.size())), f.size()), None
        except Exception as error:  # noqa: BLE001  a bad file is that file's result
            return None, None, str(error) if isinstance(error, ValueError) else repr(error)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents = batch.column("content").to_pylist() if given else [None] * batch.num_rows
            found = [probed(p, c) for p, c in zip(batch.column("path").to_pylist(), contents, strict=True)]
            made = [pa.array([x[k] for x in found], kind) for k, kind in enumerate((pa.float64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), *made], names)

    taken = files.select(*(F.col(f"`{c}`") for c in rest), *(["content"] if given else []))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in taken.schema.fields if f.name != "content")
    return taken.mapInArrow(run, f"{kinds}, duration_sec double, duration_source string, reason string")
