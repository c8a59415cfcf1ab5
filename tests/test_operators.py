"""Operators against plain loops on small random cases, and on cases with a known answer."""

import random
import wave

import numpy as np
import pandas as pd
import pytest

from colloquy import models
from colloquy.config import Config
from colloquy.functions import clock, stem, token_text
from colloquy.operators import intervals, islands, journal, speakers, transducer
from colloquy.plans import align, documents
from colloquy.sources import audio, containers, files
from colloquy.streaming import manifest_stream, run_new
from pyspark.sql import functions as F

WORD = "file_id long, pos long, word string, start_us long, end_us long"
SEG = "file_id long, spk string, start_us long, end_us long"


def cases(n, seed):
    rng = random.Random(seed)
    words, segs = [], []
    for f in range(n):
        t = 0
        for p in range(rng.randint(0, 12)):
            t += rng.randint(-150, 400)
            words.append((f, p + 1, rng.choice("ab"), max(0, t), max(0, t) + rng.randint(0, 300)))
        for _ in range(rng.randint(0, 7)):
            a = rng.randint(0, 2500)
            segs.append((f, rng.choice(("s0", "s1", "s2")), a, a + rng.randint(0, 600)))
    return words, segs


def by_file(rows, f):
    return [r for r in rows if r[0] == f]


def test_assign_words_equals_loop(spark):
    words, segs = cases(300, 1)
    got = {(r.file_id, r.pos): (r.spk, r.snapped) for r in intervals.assign_words(spark.createDataFrame(words, WORD), spark.createDataFrame(segs, SEG), 100, 700).collect()}
    for f in range(300):
        order, j = sorted(by_file(segs, f), key=lambda s: (s[2], s[3], s[1])), 0
        for _, pos, _, a, b in by_file(words, f):
            while j < len(order) and order[j][3] < a:
                j += 1
            score = {}
            for _, spk, c, d in order[j:]:
                if c <= b and min(b, d) > max(a, c):
                    score[spk] = score.get(spk, 0) + min(b, d) - max(a, c)
            if score:
                want = max(score, key=lambda k: (score[k], k)), False
            else:
                near = [(min(2 * abs(a - d), 2 * abs(b - c), abs(a + b - c - d)), k, spk) for k in (j - 1, j) if 0 <= k < len(order) for _, spk, c, d in [order[k]]]
                best = min(near, default=None)
                want = (best[2], True) if best and best[0] <= 200 else (None, False)
            assert got[f, pos] == want


def test_stitch_equals_loop(spark):
    words, _ = cases(300, 2)
    out = islands.stitch_words(spark.createDataFrame(words, WORD), 250, 60)
    got = sorted(tuple(r) for r in out.select("file_id", "pos", "word", "start_us", "end_us").collect())
    want = []
    for f in range(300):
        kept = []
        for w in map(list, by_file(words, f)):
            if kept and kept[-1][2] == w[2] and abs(w[3] - kept[-1][3]) < 250:
                kept[-1][4] = max(kept[-1][4], w[4])
            elif not (kept and kept[-1][2] == w[2] and abs(w[4] - kept[-1][4]) < 60):
                kept.append(w)
        want += map(tuple, kept)
    assert got == sorted(want)


def test_smooth_and_turns_equal_loops(spark):
    rng = random.Random(3)
    words, _ = cases(300, 3)
    rows = [(*w, rng.choice(("A", "B", "A", "B", None))) for w in words]
    frame = spark.createDataFrame(rows, WORD + ", spk string")
    got = {(r.file_id, r.pos): r.spk for r in islands.smooth_islands(frame, 2, 500).collect()}
    turns = islands.build_turns(frame, 90).orderBy("file_id", "turn_ix").collect()
    want_turns = []
    for f in range(300):
        own = by_file(rows, f)
        spk, i = [r[5] for r in own], 0
        while i < len(spk):
            j = i + 1
            while j < len(spk) and spk[j] == spk[i]:
                j += 1
            if 0 < i and j < len(spk) and spk[i] and spk[i - 1] and spk[i - 1] == spk[j] != spk[i] and j - i <= 2 and max(0, own[j - 1][4] - own[i][3]) <= 500:
                spk[i:j] = [spk[j]] * (j - i)
            i = j
        assert [got[f, r[1]] for r in own] == spk
        now = None
        for k, (_, _, word, a, b, who) in enumerate(own):
            if who is None:
                continue
            gap = max(0, a - own[k - 1][4]) if k else 0
            if now is None or who != now[1] or gap > 90:
                now = [f, who, a, b, word]
                want_turns.append(now)
            else:
                now[3], now[4] = b, now[4] + " " + word
    assert [[r.file_id, r.speaker, r.start_us, r.end_us, r.text] for r in turns] == want_turns


def test_reassign_equals_loop(spark):
    _, segs = cases(300, 4)
    dropped = spark.createDataFrame([(f, "s1") for f in range(300)], "file_id long, spk string")
    got = sorted(tuple(r) for r in intervals.reassign_dropped(spark.createDataFrame(segs, SEG), dropped).select("file_id", "spk", "start_us", "end_us").collect())
    want = []
    for f in range(300):
        own = sorted(by_file(segs, f), key=lambda s: (s[2], s[3], s[1]))
        kept = [s for s in own if s[1] != "s1"]
        for s in own if kept else []:
            want.append((f, s[1] if s[1] != "s1" else min(kept, key=lambda k: abs(k[2] + k[3] - s[2] - s[3]))[1], s[2], s[3]))
    assert got == sorted(want)


@pytest.mark.parametrize(("shares", "status", "reason", "dropped"), [
    ([.48, .43, .09], "OK", None, "s2"), ([.34, .33, .30], "BAD_SAMPLE", "three_speakers_equal_shares", ""), ([.5, .3, .2], "BAD_SAMPLE", "three_speakers_no_small_third", ""),
    ([.4, .1, .1], "OK", None, "s2"), ([.1], "BAD_SAMPLE", "single_speaker_low_share", ""), ([.1, .1], "BAD_SAMPLE", "two_speakers_low_dominance", ""), ([.3] * 4, "BAD_SAMPLE", "too_many_speakers:4", ""),
])
def test_verdict(spark, shares, status, reason, dropped):
    rows = [(1, f"s{k}", s, k + 1) for k, s in enumerate(shares)]
    r = speakers.verdict(spark.createDataFrame(rows, "file_id long, spk string, share double, first_seg_ix long"), 0.12, 0.08, 0.2).first()
    assert (r.status, r.reason, r.dropped) == (status, reason, dropped)


def test_chunks_and_packing(spark):
    chunks = intervals.hopping_chunks(spark.createDataFrame([(1, 10), (2, 0), (3, 25)], "file_id long, total_us long"), 10, 3)
    assert [tuple(r) for r in chunks.orderBy("file_id", "chunk_ix").collect()] == [(1, 0, 0, 10), (3, 0, 0, 10), (3, 1, 7, 17), (3, 2, 14, 24), (3, 3, 21, 25)]
    with pytest.raises(ValueError):
        intervals.hopping_chunks(chunks, 5, 5)
    speech = spark.createDataFrame([(1, 2_000_000, 70_000_000), (1, 80_000_000, 81_000_000), (2, 0, 100_000)], "file_id long, start_us long, end_us long")
    packed = [tuple(r) for r in intervals.pack_chunks(speech).orderBy("file_id", "chunk_ix", "part_ix").collect()]
    assert packed == [(1, 0, 0, 0, 23_333_333), (1, 0, 1, 23_333_333, 46_666_666), (1, 0, 2, 46_666_666, 70_000_000), (1, 1, 0, 80_000_000, 81_000_000)]
    assert intervals.union_length(speech).where("file_id = 1").first().union_us == 69_000_000


def test_dialog_rows_of_three(spark):
    turns = [(1, k, s, t) for k, (s, t) in enumerate([("a", "1"), ("a", " 2 "), ("b", "3"), ("c", "4"), ("b", "5"), ("b", ""), (" ", "6"), ("b", "7")])]
    rows = islands.dialog_rows(spark.createDataFrame(turns, "file_id long, pos long, speaker string, text string"))
    assert sorted((r.row_ix, r.speaker, r.text) for r in rows.collect()) == [(0, "a", "1 2"), (0, "b", "3"), (0, "c", "4"), (1, "b", "5 7")]


def test_journal(spark):
    lines = spark.createDataFrame([(0, "x", "SUCCESS"), (1, "y", "BAD_SAMPLE"), (2, "z", "FAILED"), (3, "z", "SKIPPED")], "line_no long, input_path string, status string")
    inputs = spark.createDataFrame([("x",), ("y",), ("z",), ("n",)], "input_path string")
    pending = lambda **k: sorted(r[0] for r in journal.pending_inputs(inputs, lines, **k).collect())
    assert pending(retry_failed=True) == ["n"] and pending(retry_failed=True, literal=False) == ["n", "z"] and pending(literal=False) == ["n"]
    assert journal.status_counts(lines).where("status = 'FAILED'").first().percent == 25.0


def test_files(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text('{"path":"b.mp3","id":"b","x":1}\n\n{"path":"d/a.b.mp3","id":""}\n{"path":"/c.mp3","duration_sec":2.5}\n')
    rows = files.resolved(files.read_manifest(spark, str(tmp_path / "m.jsonl")), "/in").orderBy("source_index").collect()
    assert [(r.path, r.id, r.duration_sec) for r in rows] == [("/in/b.mp3", "b", None), ("/in/d/a.b.mp3", "a.b", None), ("/c.mp3", "c", 2.5)]
    with wave.open(str(tmp_path / "s.wav"), "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(16000), w.writeframes(b"\0\0" * 8000)
    (tmp_path / "t.wav").write_bytes(b"no audio")
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.wav").load(str(tmp_path))
    assert sorted((r.path[-5:], r.duration_sec) for r in containers.durations(found).collect()) == [("s.wav", 0.5), ("t.wav", None)]
    assert sorted(r.id for r in files.read_glob(spark, str(tmp_path), "*.wav").collect()) == ["s", "t"]
    lines = spark.createDataFrame([("0.5 1.25 spk_0",), ("2 1 x",), ("junk",)], "v string").select(files.parse_segment_line(F.col("v")).alias("s"))
    assert [r.s and tuple(r.s) for r in lines.collect()] == [("spk_0", 500_000, 1_250_000), None, None]
    done = spark.createDataFrame(
        [("/a", "a", "SUCCESS", None, ("a", "hi"), ({"s0": 1.0}, ["s0"])), ("/b", "b", "FAILED", "x", None, None), ("/c", "c", "BAD_SAMPLE", "y", ("c", "no"), ({"s1": 0.5}, ["s1"]))],
        "input_path string, id string, status string, reason string, transcript struct<file_id:string,text:string>, meta_diar struct<shares:map<string,double>,speakers:array<string>>")
    out = str(tmp_path / "out")
    files.write_results(done, out)
    assert journal.latest(files.read_journal(spark, f"{out}/journal")).count() == 3
    assert [(r.id, r.file_id, r.text) for r in spark.read.json(f"{out}/transcripts").collect()] == [("a", "a", "hi")]
    assert [r.speakers for r in spark.read.json(f"{out}/meta_diar").collect()] == [["s0"]]
    assert sorted((r.id, r.speakers) for r in spark.read.json(f"{out}/journal").collect()) == [("a", None), ("b", None), ("c", ["s1"])]
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/u.wav").write_bytes(b"x")
    assert [r.relative for r in files.read_glob(spark, str(tmp_path), "*.wav").collect()] == ["s.wav", "sub/u.wav", "t.wav"]


def test_manifest_by_duration(spark, tmp_path):
    rows = [("b", 2.0), ("a", 2.0), ("n", None), ("x", float("nan")), ("m", -1.0), ("z", 0.0)]
    given = spark.createDataFrame([(*r, 1, 1.0, r[0]) for r in rows], "path string, duration_sec double, bytes long, mtime double, id string")
    assert [(r.path, r.duration_sec) for r in files.duration_manifest(given, drop_zero=True).collect()] == [("a", 2.0), ("b", 2.0)]
    assert [(r.path, r.duration_source) for r in files.duration_manifest(given).collect()] == [("m", "none"), ("n", "none"), ("x", "none"), ("z", "header"), ("a", "header"), ("b", "header")]
    assert tuple(files.manifest_counts(given, drop_zero=True).first()) == (2, 4) and tuple(files.manifest_counts(given).first()) == (6, 0)
    files.write_manifest(files.duration_manifest(given), str(tmp_path / "m"))
    assert [r.path for r in files.read_manifest(spark, str(tmp_path / "m")).orderBy("source_index").collect()] == ["m", "n", "x", "z", "a", "b"]


def test_summary(spark):
    lines = spark.createDataFrame([("SUCCESS",), ("FAILED",), ("SUCCESS",)], "status string")
    assert tuple(journal.summary(lines).first()) == ("done_with_errors", 3, {"FAILED": 1, "SUCCESS": 2}, 1)
    assert tuple(journal.summary(lines.where("false")).first()) == ("done", 0, {}, 0)


def test_segment_chunks(spark):
    """Against a loop; a long segment overlaps, a short one does not, an empty one has no chunk."""
    segs = [(0, "s", 0, 10), (0, "s", 5, 70), (1, "t", 3, 3), (1, "t", 4, 26), (2, "u", 0, 22)]
    given = spark.createDataFrame([(f, k, a * 1_000_000, b * 1_000_000) for f, k, a, b in segs], SEG)
    want = []
    for f, _, a, b in segs:
        at, step = 0, 21 if b - a > 22 else 22
        while at == 0 and b > a or at and at + 22 - step < b - a:
            want.append((f, a + at, a + min(b - a, at + 22)))
            at += step
    got = intervals.segment_chunks(given, 22_000_000, 1_000_000, 22_000_000).collect()
    assert sorted((r.file_id, r.start_us // 1_000_000, r.end_us // 1_000_000) for r in got) == sorted(want)
    words = spark.createDataFrame([(0, 2), (0, 2)], "file_id long, seg_ix long")
    items = {(r.file_id, r.seg_ix): (r.num_chunks, r.num_words) for r in intervals.segment_items(given, words, 22_000_000).collect()}
    assert items == {(0, 1): (1, 0), (0, 2): (3, 2), (1, 1): (1, 0), (1, 2): (1, 0), (2, 1): (1, 0)}


def test_documents(spark):
    words = spark.createDataFrame([(0, 1, "hi", 0, 400_000), (0, 2, "you", 500_000, 900_500), (2, 1, "x", 0, 1)], WORD)
    segs = spark.createDataFrame([(0, "a", 0, 1_000_000), (1, "b", 0, 1_000_000), *((2, s, 0, 1_000_000) for s in "abc")], SEG)
    rows = {r.file_id: r for r in documents.documents(words, segs, 2_000_000).collect()}
    one = rows[0]
    assert one.status == "SUCCESS" and one.transcript.mapping.orig_to_norm == {"a": "Spk0"} and one.transcript.mapping.dropped_speakers == []
    assert [tuple(t) for t in one.transcript.turns] == [("Spk0", 0.0, 0.901, "hi you")] and [tuple(w) for w in one.meta_asr.words] == [("hi", 0.0, 0.4), ("you", 0.5, 0.901)]
    assert tuple(one.meta_asr.stats) == (2, 0.801, 0.4003, 0.4005) and tuple(one.transcript.stats) == (1, 2, 0)
    assert rows[1].transcript.turns == [] and tuple(rows[1].meta_asr.stats) == (0, 0.0, 0.0, 0.0)
    assert rows[2].status == "BAD_SAMPLE" and rows[2].reason == "three_speakers_equal_shares" and rows[2].transcript is None and rows[2].meta_diar.shares == {s: 0.5 for s in "abc"}


def test_audio(spark):
    tone = np.sin(2 * np.pi * 1000 * np.arange(16_000) / 16_000) * 0.5
    content = audio.write_wav(tone)
    assert np.abs(audio.read_wav(content) - tone).max() < 1e-4 and np.abs(audio.read_wav(audio.write_wav(np.array([3.0, -3.0])))).max() <= 1
    given = spark.createDataFrame([("a", bytearray(content)), ("b", bytearray(b"junk"))], "path string, content binary")
    rows = {r.path: r for r in audio.decode(given).collect()}
    assert rows["a"].duration_sec == 1.0 and rows["a"].reason is None and rows["b"].samples is None and rows["b"].reason
    mel = {r.path: r.features for r in audio.features(audio.decode(given)).collect()}
    assert mel["b"] is None and np.array(mel["a"]).shape == (101, 64)
    n = audio.decode(given).where("path = 'a'").select(audio.frames_of(F.col("samples")).alias("n"), F.size(audio.short_enough(F.col("samples"))).alias("m")).first()
    assert tuple(n) == (101, 16_000)
    # The loudest band is the one whose triangle is highest at 1 kHz.
    assert np.array(mel["a"])[50].argmax() == audio.mel_filters(64, 400)[25].argmax()
    with pytest.raises(Exception, match="use chunks"):
        spark.range(1).select(audio.short_enough(F.array_repeat(F.lit(0.0), 400_001))).collect()


def plain_transducer(frames, predict, joint, blank, most):
    """One item, step by step."""
    labels = []
    output, state = predict(-1, 0)
    for frame in frames:
        for _ in range(most):
            scores = joint(frame, output)
            if (best := scores.index(max(scores))) == blank:
                break
            labels.append(best)
            output, state = predict(best, state)
    return labels


@pytest.mark.parametrize("most", [1, 3, 10])
def test_transducer_equals_loop(most):
    rng = np.random.default_rng(most)
    table = rng.integers(-9, 9, (5, 7, 4))

    def predict(labels, states):
        """The output depends on the last label and on how many there were."""
        states = states + (labels >= 0)
        return table[labels, states % 7], states

    joint = lambda frames, outputs: frames + outputs
    frames, lengths = rng.integers(-9, 9, (60, 12, 4)).astype(float), rng.integers(0, 13, 60)
    got = transducer.greedy(frames, lengths, predict, joint, np.int64(0), 3, most)
    one = lambda label, state: (table[label, (state + (label >= 0)) % 7], state + (label >= 0))
    want = [plain_transducer(f[:n], one, lambda f, o: list(f + o), 3, most) for f, n in zip(frames, lengths, strict=True)]
    assert [list(x) for x in got] == want and max(map(len, want)) > (12 if most > 1 else 5)
    assert transducer.greedy(frames[:0], lengths[:0], predict, joint, np.int64(0), 3) == []


def test_token_text(spark):
    ids = spark.createDataFrame([([0, 1, 2, 9, 3],), ([],)], "ids array<int>")
    assert [r[0] for r in ids.select(token_text(F.col("ids"), ["▁a", "b", "▁c", "d"])).collect()] == ["ab cd", ""]


def test_config_file(tmp_path):
    (tmp_path / "c.yaml").write_text("input:\n  manifest_path: in/m.jsonl\nresume:\n  enabled: false\nasr:\n  batch_size: 3\n  hf_token: secret\ndiarizer:\n  batch_size: 7\nspeaker_rules:\n  enabled: true\n")
    c = Config.load(str(tmp_path / "c.yaml"))
    assert c.manifest_path == str(tmp_path / "in/m.jsonl") and c.transcripts_dir == str(tmp_path / "transcripts") and "secret" not in repr(c)
    assert c.chunk_batch_size == 3 and not c.resume_enabled and c.rules_enabled and c.overlap_sec == 1.0
    with pytest.raises(ValueError):
        Config.of({"asr": {"overlap_sec": 22.0}})


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    seen = []
    for k in range(2):
        (tmp_path / f"in/{k}.jsonl").write_text(f'{{"path":"p{k}.wav"}}\n')
        run_new(manifest_stream(spark, str(tmp_path / "in")), lambda d: seen.extend(r.id for r in d.collect()), str(tmp_path / "ck")).awaitTermination()
    assert seen == ["p0", "p1"]


def test_functions_and_config(spark):
    r = spark.range(1).select(clock(F.lit(3_725_999_999)).alias("a"), clock(F.lit(65_019_999)).alias("b"), stem(F.lit("/x/.hid")).alias("c")).first()
    assert tuple(r) == ("01:02:05:99", "01:05:01", ".hid")
    assert Config.of({"batch_size": 3}).chunk_batch_size == 3 and "hf_token" not in Config.__dataclass_fields__
    with pytest.raises(ValueError):
        Config.of({"num_instances": 0})


def test_stage_isolates_failures(spark):
    def load():
        """A stand-in for a model, for tests only."""

        def run(batch):
            if (batch["file_id"] == 2).any():
                raise RuntimeError("no")
            return pd.DataFrame({"file_id": batch["file_id"], "text": "t" + batch["file_id"].astype(str)})

        return run

    out = models.apply(spark.range(1, 4).withColumnRenamed("id", "file_id").coalesce(1), models.Stage(load, "file_id long, text string"))
    assert sorted((r.file_id, r.text, r.status) for r in out.collect()) == [(1, "t1", "SUCCESS"), (2, None, "FAILED"), (3, "t3", "SUCCESS")]


def test_empty(spark):
    w, s = spark.createDataFrame([], WORD), spark.createDataFrame([], SEG)
    assert align.full_align(w, s, 1).count() == 0 and islands.stitch_words(w).count() == 0 and intervals.pack_chunks(s.drop("spk")).count() == 0


def _stages():
    """Functions within a function travel to the workers by value."""

    def _diarize():
        import os

        def run(batch):
            if any("broken" in p for p in batch["input_path"]):
                raise RuntimeError("no audio")
            told = {"two": [("b", 0, 3_000_000), ("a", 3_000_000, 9_000_000)], "equal": [("a", 0, 3), ("b", 3, 6), ("c", 6, 9)], "mute": []}
            rows = [[{"spk": s, "start_us": a, "end_us": e} for s, a, e in told["".join(filter(str.isalpha, os.path.basename(p).split(".")[0]))]] for p in batch["input_path"]]
            return pd.DataFrame({"input_path": batch["input_path"].to_numpy(), "duration_us": [10_000_000] * len(rows), "segments": rows})

        return run

    def _recognise():
        def run(batch):
            rows = []
            for p, segments in zip(batch["input_path"], batch["segments"], strict=True):
                if "deaf" in p:
                    raise ValueError("deaf")
                if segments is None:
                    rows.append([{"seg_ix": None, "word": w, "start_us": a, "end_us": a + 500_000} for w, a in (("hi", 100_000), ("there", 700_000), ("you", 4_000_000))])
                else:
                    rows.append([{"seg_ix": int(s["seg_ix"]), "word": f"w{s['seg_ix']}", "start_us": 100_000, "end_us": 400_000} for s in segments])
            return pd.DataFrame({"input_path": batch["input_path"].to_numpy(), "words": rows})

        return run

    return _diarize, _recognise


@pytest.mark.parametrize("mode", ["full_asr_then_align", "diar_cut_then_asr"])
def test_run_end_to_end(spark, tmp_path, mode):
    from colloquy.plans import run as flow

    names = ["two1.wav", "two2.wav", "equal.wav", "mute.wav", "broken.wav"]
    (tmp_path / "in.txt").write_text("\n".join(names) + f"\n{tmp_path}/two3.wav\n")
    c = Config.of({"mode": mode, "audio_dir": "/audio", "out_dir": str(tmp_path / "out"), "manifest_path": str(tmp_path / "in.txt"), "chunk_batch_size": 2})
    loads = _stages()
    stages = models.Stage(loads[0], flow.DIARIZED, "input_path"), models.Stage(loads[1], flow.HEARD, "input_path")
    first = flow.run(spark, c, *stages)
    assert first.status == "done_with_errors" and first.exit_code == 1 and dict(first.counts) == {"SUCCESS": 3, "BAD_SAMPLE": 2, "FAILED": 1}
    lines = {r.input_path: (r.status, r.reason) for r in files.read_journal(spark, f"{tmp_path}/out/journal").collect()}
    assert lines["/audio/mute.wav"] == ("BAD_SAMPLE", "no_speakers") and lines["/audio/equal.wav"][1] == "three_speakers_equal_shares" and "no audio" in lines["/audio/broken.wav"][1]
    doc = {r.id: r for r in spark.read.json(f"{tmp_path}/out/transcripts").collect()}["two1"]
    texts = [(t.speaker, t.text) for t in doc.turns]
    assert texts == ([("Spk1", "hi there"), ("Spk0", "you")] if mode == "full_asr_then_align" else [("Spk1", "w1"), ("Spk0", "w2")]) and doc.file_id == "two1"
    asr = spark.read.json(f"{tmp_path}/out/meta_asr").first()
    assert asr.mode == mode and (mode == "full_asr_then_align" or [(i.segment_id, i.num_words, i.num_chunks_after_split) for i in asr.asr_batch_items] == [(0, 1, 1), (1, 1, 1)])
    # All again: what is final is skipped, the failure only without retry; then outputs alone decide.
    assert dict(flow.run(spark, c, *stages).counts) == {"SKIPPED": 6}
    other = Config.of({**c.__dict__, "resume_enabled": False})
    assert dict(flow.run(spark, other, *stages).counts) == {"SKIPPED": 3, "BAD_SAMPLE": 2, "FAILED": 1}
    with pytest.raises(ValueError):
        (tmp_path / "in.txt").write_text("a/x.wav\nb/x.wav\n")
        flow.run(spark, c, *stages)


def test_provider_is_loaded_once_per_worker(spark, tmp_path):
    def factory(mark):
        def load():
            with open(tmp_path / mark, "a") as f:
                f.write(f"{__import__('os').getpid()}\n")
            return lambda batch: batch[["file_id"]].assign(mark=mark)
        return load

    for mark in ("one", "two"):
        out = models.apply(spark.range(60).repartition(12).withColumnRenamed("id", "file_id"), models.Stage(factory(mark), "file_id long, mark string"))
        assert {r.mark for r in out.collect()} == {mark}
        pids = (tmp_path / mark).read_text().split()
        assert len(pids) == len(set(pids))


def test_journal_order_over_runs(spark, tmp_path):
    path = str(tmp_path / "journal")
    many = spark.range(5000).select(F.concat(F.lit("/o/"), "id").alias("input_path"), F.lit("SUCCESS").alias("status"))
    one = lambda status: spark.createDataFrame([("/a", status)], "input_path string, status string")
    for rows in (one("FAILED"), many.union(one("SUCCESS")), one("FAILED"), many.limit(10).union(one("SUCCESS"))):
        files.append_journal(rows, path)
    lines = files.read_journal(spark, path)
    assert journal.latest(lines).where("input_path = '/a'").first().status == "SUCCESS"
    assert spark.read.json(path).where("started_at IS NULL OR finished_at NOT LIKE '%+00:00'").count() == 0
    plain = tmp_path / "plain.jsonl"
    plain.write_text('{"input_path": "/a", "status": "SUCCESS"}\n\n{"input_path": "/a", "status": "FAILED"}\n')
    assert journal.latest(files.read_journal(spark, str(plain))).first().status == "FAILED"


def test_turn_counts_and_top(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"turns": [{"speaker": "x", "text": "t"}, {"speaker": "", "text": ""}]}')
    (tmp_path / "b.json").write_text('{"status": "SUCCESS"}')
    (tmp_path / "c.json").write_text('{"file_id": "own", "turns": [{"speaker": "x", "text": "t"}, {"speaker": "y", "text": "u"}]}')
    counts = files.turn_counts(spark, str(tmp_path))
    assert [tuple(r) for r in files.most_turns(counts).collect()] == [("a", 2), ("own", 2), ("b", 0)]
    assert files.most_turns(counts, 0).count() == 0 and len(files.most_turns(counts, 1).collect()) == 1
    with pytest.raises(ValueError):
        files.most_turns(counts, -1)
    assert files.read_transcripts(spark, str(tmp_path)).where("file_id = 'own'").count() == 2
