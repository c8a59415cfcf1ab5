"""Containers made by hand, resampling against exact sinusoids, samples of every kind, and features that do not depend on cuts."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.sources import audio, containers, files


def wav(body, kind=1, channels=1, rate=16_000, bits=16, extra=b"", claimed=None, extensible=False):
    frame = channels * bits // 8
    form = struct.pack("<HHIIHH", 0xFFFE if extensible else kind, channels, rate, rate * frame, frame, bits) + (struct.pack("<HHIH", 22, bits, 0, kind) + bytes(14) if extensible else b"")
    return b"RIFF" + bytes(4) + b"WAVE" + extra + b"fmt " + struct.pack("<I", len(form)) + form + b"data" + struct.pack("<I", len(body) if claimed is None else claimed) + body


def flac(total, rate):
    return b"fLaC" + bytes([0x80, 0, 0, 34]) + bytes(10) + (rate << 44 | 1 << 41 | 15 << 36 | total).to_bytes(8, "big") + bytes(16)


def page(granule, serial, packet=b"", more=0):
    return b"OggS\0\0" + struct.pack("<qIII", granule, serial, 0, 0) + bytes([1, len(packet) % 256]) + packet + bytes(more)


OPUS = page(0, 7, b"OpusHead\x01\x02" + struct.pack("<HI", 312, 44_100))
VORBIS = page(0, 7, b"\x01vorbis" + bytes(5) + struct.pack("<I", 22_050) + bytes(10))
# MPEG 1, layer 3, 128 kilobits, 44.1 kHz: frames of 417 bytes and 1,152 samples.
FRAME = b"\xff\xfb\x90\x00" + bytes(413)
ID3 = b"ID3\x04\0\0\0\0\x02\x05" + bytes(2 * 128 + 5)


def _headed(name, frames):
    body = bytearray(FRAME)
    if name == b"VBRI":
        body[36:40], body[50:54] = name, struct.pack(">I", frames)
    else:
        body[36:40], body[40:44], body[44:48] = name, struct.pack(">I", 1), struct.pack(">I", frames)
    return bytes(body)


CASES = {
    "wav": (wav(bytes(32_000)), 1.0, "riff"),
    "wav that claims too much": (wav(bytes(16_001), claimed=10**9), 0.5, "riff"),
    "wav with chunks before": (wav(bytes(6 * 8_000), channels=2, bits=24, rate=8_000, extra=b"LIST" + struct.pack("<I", 3) + b"abc\0"), 1.0, "riff"),
    "wide wav": (b"RF64" + wav(bytes(64_000), extra=b"ds64" + struct.pack("<IQQQI", 28, 0, 64_000, 0, 0), claimed=0xFFFFFFFF)[4:], 2.0, "riff"),
    "flac": (flac(441_000, 44_100), 10.0, "flac"),
    "opus": (OPUS + page(48_312, 7, more=90_000) + page(-1, 7) + page(10**9, 8), 1.0, "ogg"),
    "vorbis": (VORBIS + page(2_205, 7) + page(33_075, 7, more=70_000), 1.5, "ogg"),
    "mp3 walked": (ID3 + FRAME * 100 + b"TAG" + bytes(125), 100 * 1152 / 44_100, "mp3"),
    "mp3 after junk": (ID3 + b"\xff\xfb junk" + FRAME * 3, 3 * 1152 / 44_100, "mp3"),
    "mp3 longer than a block": (FRAME * 3_000, 3_000 * 1152 / 44_100, "mp3"),
    "xing": (_headed(b"Xing", 500) + FRAME * 2, 500 * 1152 / 44_100, "mp3"),
    "vbri": (ID3 + _headed(b"VBRI", 250) + FRAME, 250 * 1152 / 44_100, "mp3"),
    "22 kHz mono": ((b"\xff\xf3\x80\xc0" + bytes(208 - 4)) * 10, 10 * 576 / 22_050, "mp3"),
    "flac without length": (flac(0, 44_100), None, "the length is not stated"),
    "ogg of something": (page(0, 1, b"Speex   "), None, "neither Opus nor Vorbis"),
    "wav without samples": (b"RIFF\0\0\0\0WAVE", None, "no samples"),
    "text": (b"hello, world", None, "no container that is known"),
    "nothing": (b"", None, "no container that is known"),
    "cut": (b"OggS", None, None),
}


def test_durations(spark, tmp_path):
    rows = [(name, bytearray(content)) for name, (content, *_) in CASES.items()]
    got = {r.path: r for r in containers.durations(spark.createDataFrame([*rows, ("null", None)], "path string, content binary")).collect()}
    assert got["null"].reason == "no content" and len(got) == len(CASES) + 1
    for name, (_, seconds, says) in CASES.items():
        r = got[name]
        if seconds is None:
            assert r.duration_sec is None and r.duration_source is None and r.reason and says in (None, r.reason), name
        else:
            assert abs(r.duration_sec - seconds) < 1e-9 and (r.duration_source, r.reason) == (says, None), name
    # From files, by the pieces that are needed; with the manifest that they are made for.
    for k, (content, *_) in enumerate(CASES.values()):
        (tmp_path / f"{k}.x").write_bytes(content)
    listed = files.read_glob(spark, str(tmp_path), "*.x")
    probed = containers.durations(listed)
    names = list(CASES)
    assert {names[int(r.id)]: (r.duration_sec, r.reason) for r in probed.collect()} == {n: (got[n].duration_sec, got[n].reason) for n in CASES if CASES[n][0]}
    manifest = files.duration_manifest(probed, drop_zero=True).collect()
    assert [r.duration_sec for r in manifest] == sorted(s for _, s, _ in CASES.values() if s) and {r.duration_source for r in manifest} == {"riff", "flac", "ogg", "mp3"}
    assert containers.durations(spark.createDataFrame([("/no/such/file",)], "path string")).first().reason


def test_only_needed_pieces_are_read():
    """Headers and the tail are enough for a large file."""
    content, seen = VORBIS + bytes(9_000_000) + page(22_050, 7), []
    read = lambda at, n: seen.append(n) or content[at : at + n]
    assert containers.duration(read, len(content)) == (1.0, "ogg") and sum(seen) < 100_000


def _db(x):
    return 20 * np.log10(np.sqrt(np.mean(np.square(x))) + 1e-30)


@pytest.mark.parametrize("rate", [8_000, 11_025, 22_050, 44_100, 48_000, 96_000, 15_999])
def test_resampling(rate):
    """Tones that both rates hold come out as themselves, those above are gone; the length is that of the time."""
    n = rate // 2
    for tone in (50, 1_000, 0.9 * min(rate, 16_000) / 2):
        got = audio.resampled(np.sin(2 * np.pi * tone * np.arange(n) / rate), rate)
        assert len(got) == n * 16_000 // rate
        want = np.sin(2 * np.pi * tone * np.arange(len(got)) / 16_000)
        middle = slice(len(got) // 4, -len(got) // 4)
        assert _db(got[middle] - want[middle]) < -80
    for tone in (t for t in (8_900, 12_000, 20_000) if t < rate / 2 and rate > 16_000):
        got = audio.resampled(np.sin(2 * np.pi * tone * np.arange(n) / rate), rate)
        assert _db(got[len(got) // 4 : -len(got) // 4]) < -70
    assert len(audio.resampled(np.empty(0), rate)) == 0


def test_samples_of_every_kind(spark):
    x = np.array([0.0, 0.5, -0.5, 0.25, -1.0, 0.0078125])
    ints = lambda bits: np.rint(x * (1 << bits - 1)).astype(np.int64)
    made = {
        "8": wav((ints(8) + 128).astype(np.uint8).tobytes(), bits=8), "16": wav(ints(16).astype("<i2").tobytes()),
        "24": wav(b"".join(int(v).to_bytes(3, "little", signed=True) for v in ints(24)), bits=24), "32": wav(ints(32).astype("<i4").tobytes(), bits=32),
        "f32": wav(x.astype("<f4").tobytes(), kind=3, bits=32), "f64": wav(x.astype("<f8").tobytes(), kind=3, bits=64),
        "extensible": wav(ints(16).astype("<i2").tobytes(), extensible=True),
        "stereo": wav(np.stack([ints(16), ints(16)], axis=1).astype("<i2").tobytes(), channels=2), "cut": wav(ints(16).astype("<i2").tobytes() + b"\1"),
    }
    for name, content in made.items():
        assert np.array_equal(audio.read_wav(content), x.astype(np.float32)), name
    bad = {"a-law": wav(bytes(8), kind=6, bits=8), "no wav": b"junk", "no data": wav(b"")[:36], "odd frames": wav(bytes(8), bits=12)}
    rows = [(k, bytearray(v)) for k, v in {**bad, "ok": made["24"]}.items()]
    got = {r.path: r for r in audio.decode(spark.createDataFrame(rows, "path string, content binary")).collect()}
    assert all(got[k].samples is None and got[k].reason for k in bad) and got["ok"].reason is None and len(got["ok"].samples) == 6


@pytest.mark.parametrize("center", [True, False])
def test_features_do_not_depend_on_cuts(spark, center):
    rng = np.random.default_rng(1)
    for n in (0, 1, 200, 201, 399, 400, 401, 1000, 7777):
        x = rng.standard_normal(n)
        if center and n > 200:
            wide = np.pad(x, 200, mode="reflect")
        else:
            wide = np.empty(0) if center else x
        frames = [wide[a : a + 400] for a in range(0, len(wide) - 399, 160)]
        hann = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(400) / 400)
        want = [np.log(np.clip(np.abs(np.fft.rfft(f * hann)) ** 2 @ audio.mel_filters(64, 400), 1e-9, 1e9)) for f in frames]
        for cuts in ([], [1], [150, 300, 500], list(range(0, n, 37)), [n]):
            own, got, at = audio.LogMel(center=center), [], 0
            for cut in [*(c for c in cuts if c <= n), n]:
                got += list(own.push(x[at:cut]))
                at = cut
            got += list(own.close())
            assert len(got) == len(want) and (not want or np.allclose(got, want)), (n, cuts)
    x = rng.standard_normal(5000).astype(np.float32)
    parts = [("a", k, [float(v) for v in x[a : a + 700]]) for k, a in enumerate(range(0, 5000, 700))] + [("b", 0, [0.0] * 900), ("c", 0, None)]
    df = spark.createDataFrame(parts, "path string, part_ix int, samples array<float>").repartition(3)
    rows = audio.feature_parts(df, center=center).where("path = 'a'").orderBy("first_frame").collect()
    got = np.concatenate([np.array(r.features) for r in rows])
    assert np.allclose(got, audio.log_mel(x, center=center), atol=1e-4) and [r.first_frame for r in rows] == list(np.cumsum([0, *(len(r.features) for r in rows)])[:-1])


def test_lengths_and_arrays(spark):
    df = audio.from_arrays(spark, [np.zeros(16_000), np.zeros(1)])
    got = df.select("path", audio.encoded_frames(audio.frames_of(F.col("samples"))).alias("n")).collect()
    size = lambda n: (n + 4 - 5) // 2 + 1
    assert {r.path: r.n for r in got} == {"0": size(size(101)), "1": size(size(1))}
    with pytest.raises(ValueError):
        audio.from_arrays(spark, [])
