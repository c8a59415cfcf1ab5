"""Batches by length: less padding, no item lost, and the same results for any batch."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from colloquy import models
from colloquy.config import Config
from colloquy.operators.batches import Batches, filled, padded, planned
from colloquy.plans import recognise
from colloquy.plans import run as flow
from colloquy.sources import files


def _items(spark, n=600):
    rng = random.Random(1)
    rows = [(k, [float(k % 7 + i) for i in range(rng.choice((0, 3, 40, rng.randint(1, 400))))]) for k in range(n)]
    return spark.createDataFrame(rows, "file_id long, samples array<float>").withColumn("length", F.size("samples"))


def test_planned_batches(spark):
    items, plan = _items(spark), Batches("length", 1500, 20)
    got = planned(items, "file_id", plan, F.col("file_id") % 5).toPandas()
    assert sorted(got.file_id) == list(range(600))
    for _, x in got.groupby(["part", "batch"]):
        assert len(x) <= 20 and (len(x) * x.padded_to.iloc[0] <= 1500 or len(x) == 1) and x.padded_to.iloc[0] == x.length.max() and sorted(x.nth) == list(range(len(x)))
    # In order of arrival the same limits cost several times the padding.
    padding, arrival, held = (got.padded_to - got.length).sum(), 0, []
    for n in [r.length for r in items.orderBy("file_id").collect()]:
        if held and (len(held) >= 20 or (len(held) + 1) * max([*held, n]) > 1500):
            arrival, held = arrival + sum(max(held) - x for x in held), []
        held.append(n)
    assert padding * 5 < arrival
    assert planned(items.limit(0), "file_id", plan, F.lit(0)).count() == 0
    with pytest.raises(ValueError):
        Batches("length", 0)


def test_filled_keeps_rows():
    frames = [pd.DataFrame({"k": range(a, b), "length": range(a, b)}) for a, b in ((0, 5), (5, 5), (5, 30), (30, 31))]
    got = list(filled(iter(frames), Batches("length", 100, 8)))
    assert pd.concat(got).k.tolist() == list(range(31)) and all(len(x) <= 8 and (len(x) == 1 or len(x) * x.length.max() <= 100) for x in got)


def test_padded():
    x, n = padded([np.array([1.0, 2.0]), np.array([]), np.array([3.0])])
    assert x.tolist() == [[1, 2], [0, 0], [3, 0]] and n.tolist() == [2, 0, 1]
    with pytest.raises(ValueError):
        padded([])


def test_results_do_not_depend_on_batches(spark):
    def load():
        def run(batch):
            x, n = padded(list(batch["samples"]))
            return pd.DataFrame({"file_id": batch["file_id"].to_numpy(), "total": x.sum(axis=1), "n": n, "wide": x.shape[1]})

        return run

    stage, items = models.Stage(load, "file_id long, total double, n long, wide long"), _items(spark)
    plans = [None, Batches("length", 1), Batches("length", 900, 7), Batches("length", 10**6)]
    got = [{r.file_id: (r.total, r.n, r.status) for r in models.apply(items, stage, p).collect()} for p in plans]
    assert len(got[0]) == 600 and got[0] == got[1] == got[2] == got[3]
    small = models.apply(items, stage, Batches("length", 900, 7)).agg(F.sum(F.col("wide") - F.col("n"))).first()[0]
    assert small * 3 < models.apply(items, stage).agg(F.sum(F.col("wide") - F.col("n"))).first()[0]


def _hears():
    """A stand-in for a model: a frame is 1,600 samples, and its label the first of them. Functions within a function travel by value."""

    def load():
        def run(batch):
            if any(len(x) and x[0] == 99 for x in batch["samples"]):
                raise RuntimeError("too loud")
            x, n = padded(list(batch["samples"]))
            return pd.DataFrame({"chunk": batch["chunk"].to_numpy(), "labels": list(x[:, ::1600].astype(int)), "frames": -(-n // 1600)})

        return run

    return models.Stage(load, recognise.LABELS)


SAYS = recognise.Alphabet(("a", "b", "|", "c"), 9)


def test_chunks_share_batches_and_meet_again(spark):
    """Words of an overlap are heard twice and stitched where they are the same; chunks of two files share batches; a failure is its file's."""
    a = np.repeat([0.0, 1, 2, 3, 2, 0, 9, 1, 2, 3], 1600)
    rows = [("a", a.tolist()), ("b", np.repeat([1.0, 9, 9], 1600).tolist()), ("loud", [99.0] * 3200), ("none", [])]
    audio = spark.createDataFrame(rows, "file_id string, samples array<float>")
    lengths = audio.select("file_id", F.expr("size(samples) * 1000000L div 16000").alias("total_us"))
    for plan in (None, Batches("n_samples", 1), Batches("n_samples", 10**6)):
        got = recognise.recognised(audio, recognise.fixed_bounds(lengths, 500_000, 200_000), _hears(), SAYS, plan, max_gap_us=150_000)
        words = {}
        for r in got.words.orderBy("file_id", "start_us").collect():
            words.setdefault(r.file_id, []).append((r.word, r.start_us // 1000, r.end_us // 1000))
        assert words == {"a": [("ab", 0, 200), ("c", 300, 400), ("ab", 500, 800), ("b", 700, 800), ("c", 900, 1000)], "b": [("b", 0, 100)]}
        assert [r.file_id for r in got.failed.collect()] == ["loud"]


@pytest.mark.parametrize("mode", ["full_asr_then_align", "diar_cut_then_asr"])
def test_run_in_chunks(spark, tmp_path, mode):
    """A run whose recogniser hears chunks of the settings' length; in the cut flow words belong to their segments."""

    def told():
        def run(batch):
            rows = [[{"spk": "x", "start_us": 0, "end_us": 700_000}, {"spk": "y", "start_us": 700_000, "end_us": 1_600_000}] for _ in batch["input_path"]]
            return pd.DataFrame({"input_path": batch["input_path"].to_numpy(), "duration_us": 1_600_000, "segments": rows})

        return run

    labels = [0, 1, 2, 3, 3, 2, 1, 2, 0, 2, 2, 3, 2, 2, 1, 2]

    def audio(items):
        x = F.when(F.col("id") != "mute", F.flatten(F.array(*(F.array_repeat(F.lit(float(c)).cast("float"), 1600) for c in labels))))
        return items.select("input_path", x.alias("samples"), F.when(F.col("id") == "mute", "no audio").alias("reason"))

    (tmp_path / "in.txt").write_text("one.wav\nmute.wav\ntwo.wav\n")
    c = Config.of({"mode": mode, "audio_dir": "/audio", "out_dir": f"{tmp_path}/out", "manifest_path": f"{tmp_path}/in.txt", "max_sec": 0.5, "overlap_sec": 0.2, "segment_max_sec": 0.6, "max_snap_sec": 0.1, "rules_enabled": False})
    got = flow.run(spark, c, models.Stage(told, flow.DIARIZED, "input_path"), recognise.Chunked(_hears(), SAYS, audio, Batches("n_samples", 50_000)))
    assert dict(got.counts) == {"FAILED": 1, "SUCCESS": 2}
    assert {r.input_path: r.reason for r in files.read_journal(spark, f"{tmp_path}/out/journal").collect()} == {"/audio/one.wav": None, "/audio/mute.wav": "no audio", "/audio/two.wav": None}
    docs = {r.id: r for r in spark.read.json(f"{tmp_path}/out/transcripts").collect()}
    spoken = [(t.speaker, t.text) for t in docs["one"].turns]
    assert spoken == [("Spk1", "ab c b"), ("Spk0", "a c b")] and spoken == [(t.speaker, t.text) for t in docs["two"].turns]
