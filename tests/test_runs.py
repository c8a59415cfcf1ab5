"""Runs never lose an item; documents appear whole; counts are those of the journal."""

import json
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from colloquy import models
from colloquy.config import Config
from colloquy.plans import run as flow
from colloquy.plans import tables
from colloquy.sources import files, items


def _stages(where):
    """Stand-ins for models: both answer for their items, but for some lose, double or invent rows, in the stage that ``where`` names."""

    def odd(out, stage):
        if stage != where:
            return out
        names = out["input_path"].map(lambda p: p.rpartition("/")[2])
        out = out[~names.str.startswith("lost")]
        out = pd.concat([out, out[out["input_path"].str.contains("/twice")]])
        more = out[out["input_path"].str.contains("/made")].assign(input_path="/audio/nobody.wav")
        return pd.concat([out, more], ignore_index=True)

    def diarize():
        def run(batch):
            rows = [[{"spk": "a", "start_us": 0, "end_us": 3_000_000}, {"spk": "b", "start_us": 3_000_000, "end_us": 9_000_000}] for _ in batch["input_path"]]
            return odd(pd.DataFrame({"input_path": batch["input_path"].to_numpy(), "duration_us": 10_000_000, "segments": rows}), "diarize")

        return run

    def recognise():
        def run(batch):
            rows = [[{"seg_ix": 1, "word": "hi", "start_us": 100_000, "end_us": 400_000}] for _ in batch["input_path"]]
            return odd(pd.DataFrame({"input_path": batch["input_path"].to_numpy(), "words": rows}), "recognise")

        return run

    return models.Stage(diarize, flow.DIARIZED, "input_path"), models.Stage(recognise, flow.HEARD, "input_path")


NAMES = ["a.wav", "lost1.wav", "b.wav", "twice.wav", "c.wav", "made.wav", "lost2.wav", "d.wav"]


@pytest.mark.parametrize("where", ["diarize", "recognise"])
@pytest.mark.parametrize("mode", ["full_asr_then_align", "diar_cut_then_asr"])
def test_no_item_is_lost(spark, tmp_path, mode, where):
    (tmp_path / "in.txt").write_text("\n".join(NAMES))
    c = Config.of({"mode": mode, "audio_dir": "/audio", "out_dir": f"{tmp_path}/out", "manifest_path": f"{tmp_path}/in.txt", "chunk_batch_size": 3})
    heard = []
    got = flow.run(spark, c, *_stages(where), tell=lambda name, counts: heard.append((name, counts)))
    assert got.num_items == len(NAMES) and dict(got.counts) == {"FAILED": 4, "SUCCESS": 4} and got.exit_code == 1
    lines = spark.read.json(f"{tmp_path}/out/journal").orderBy("ordinal").collect()
    assert [r.input_path for r in lines] == [f"/audio/{n}" for n in NAMES]  # once each, in the order of the inputs
    reasons = {r.input_path[7:-4]: r.reason for r in lines}
    assert reasons["lost1"] == reasons["lost2"] == "no result" and reasons["twice"] == "returned twice" and "nobody" in reasons["made"]
    assert all(reasons[k] is None for k in "abcd") and spark.read.json(f"{tmp_path}/out/transcripts").count() == 4
    # Lines have the times of their own work and the settings of the run.
    assert all(r.started_at < r.finished_at and r.started_at.endswith("+00:00") for r in lines) and {r.config.mode for r in lines} == {mode}
    assert [name for name, _ in heard] == ["diarize", "recognise", "written"] and heard[-1][1] == dict(got.counts)
    assert heard[0][1] == ({"SUCCESS": 4, "FAILED": 4} if where == "diarize" else {"SUCCESS": 8, "FAILED": 0})


def test_stage_with_several_rows(spark):
    """A stage that is not single may return an item more than once, but not never."""

    def load():
        return lambda batch: batch[batch["file_id"] != 2][["file_id"]].loc[lambda x: x.index.repeat(2)]

    df = spark.range(4).withColumnRenamed("id", "file_id").coalesce(1)
    rows = [(r.file_id, r.status, r.reason) for r in models.apply(df, models.Stage(load, "file_id long", single=False)).collect()]
    assert sorted(rows, key=str) == sorted([(k, "SUCCESS", None) for k in (0, 0, 1, 1, 3, 3)] + [(2, "FAILED", "no result")], key=str)


def test_a_worker_holds_one_provider_a_place(spark):
    models._loaded.clear()
    for name, place in (("x", "one"), ("y", "one"), ("z", "two")):
        assert models._provider(place, name, lambda name=name: name) == name
    assert models._loaded == {"one": ("y", "y"), "two": ("z", "z")}


def _docs(spark, n=6):
    return spark.range(n).select(F.concat(F.lit("é"), "id").alias("id"), F.struct(F.col("id").alias("n"), F.lit("ü").alias("t")).alias("transcript"), F.struct(F.lit(1).alias("m")).alias("meta_asr"))


PLACES = {"transcript": "transcripts", "meta_asr": "meta_asr"}


def test_item_files(spark, tmp_path):
    items.write_items(_docs(spark), PLACES, str(tmp_path))
    items.write_items(_docs(spark), PLACES, str(tmp_path))
    assert sorted(os.listdir(tmp_path / "transcripts")) == [f"é{k}.json" for k in range(6)] == sorted(os.listdir(tmp_path / "meta_asr"))
    text = (tmp_path / "transcripts/é3.json").read_text()
    assert json.loads(text) == {"n": 3, "t": "ü"} and "ü" in text and '\n  "n"' in text
    assert os.listdir(tmp_path / "_staged") == []
    assert sorted(r.id for r in items.item_ids(spark, f"{tmp_path}/transcripts").collect()) == [f"é{k}" for k in range(6)]
    with pytest.raises(Exception, match="no name"):
        items.write_items(_docs(spark).withColumn("id", F.lit("../x")), PLACES, str(tmp_path))


def test_a_failing_task_leaves_nothing(spark, tmp_path):
    """A task dies after it and others have staged files: no document is seen, and the next write is whole."""
    spark.dataSource.register(items.ItemSource)
    rows = spark.range(0, 40, 1, 4).select(F.concat(F.lit("transcripts/"), "id", F.lit(".json")).alias("name"), F.when(F.col("id") == 17, "no json").otherwise("{}").alias("content"))
    os.makedirs(tmp_path / "_staged/elsewhere")  # so that the folder stays
    with pytest.raises(Exception, match="Expecting value"):
        rows.write.format("colloquy_items").mode("append").option("folder", str(tmp_path)).save()
    assert not (tmp_path / "transcripts").exists() and os.listdir(tmp_path / "_staged") == ["elsewhere"]
    items.recover(str(tmp_path))
    items.write_items(_docs(spark, 40), PLACES, str(tmp_path))
    assert len(os.listdir(tmp_path / "transcripts")) == len(os.listdir(tmp_path / "meta_asr")) == 40


def test_a_commit_that_died_is_ended(tmp_path):
    """After the list of moves is there, any part of the moves may be missing: recover makes the rest, once."""
    writer = items.ItemWriter(str(tmp_path))
    rows = [items.Row(name=f"{p}/{k}.json", content=json.dumps({"k": k})) for k in range(3) for p in ("a", "b")]
    messages = [writer.write(iter(rows[:3])), writer.write(iter(rows[3:])), None]
    whole = items._finish

    def dies(system, top, job):
        with system.open_input_stream(f"{top}/{job}/{items.LIST}") as f:
            first = json.loads(f.read())[0]
        os.makedirs(tmp_path / "a")
        os.rename(tmp_path / first[0], tmp_path / first[1])
        raise RuntimeError("died")

    items._finish = dies
    try:
        with pytest.raises(RuntimeError):
            writer.commit(messages)
    finally:
        items._finish = whole
    assert sum(len(f) for p, _, f in os.walk(tmp_path) if "_staged" not in p) == 1
    assert items.recover(str(tmp_path)) == 1 and items.recover(str(tmp_path)) == 0
    assert sorted(os.listdir(tmp_path / "a")) == sorted(os.listdir(tmp_path / "b")) == ["0.json", "1.json", "2.json"]
    # An attempt that was only staged is dropped.
    items.ItemWriter(str(tmp_path)).write(iter(rows))
    assert items.recover(str(tmp_path)) == 0 and os.listdir(tmp_path / "_staged") == []


def test_run_with_item_files(spark, tmp_path):
    (tmp_path / "in.txt").write_text("\n".join(NAMES))
    c = Config.of({"audio_dir": "/audio", "out_dir": f"{tmp_path}/out", "manifest_path": f"{tmp_path}/in.txt", "item_files": True, "num_instances": 3})
    assert dict(flow.run(spark, c, *_stages("diarize")).counts) == {"FAILED": 4, "SUCCESS": 4}
    assert sorted(os.listdir(tmp_path / "out/transcripts")) == ["a.json", "b.json", "c.json", "d.json"]
    doc = json.loads((tmp_path / "out/transcripts/a.json").read_text())
    assert doc["file_id"] == "a" and doc["turns"][0]["text"] == "hi"
    assert [r.text for r in files.read_transcripts(spark, f"{tmp_path}/out/transcripts").where("file_id = 'b'").collect()] == ["hi"]
    again = Config.of({**c.__dict__, "resume_enabled": False})
    assert dict(flow.run(spark, again, *_stages("diarize")).counts) == {"FAILED": 4, "SKIPPED": 4}


def test_lines_of_a_folder_in_order(spark, tmp_path):
    """Folders are read in the order of names and lines, whatever the sizes of files and the splits that they fall into."""
    folder = tmp_path / "m"
    folder.mkdir()
    want = []
    for name, n in (("part-00000.jsonl", 3), ("part-00001.jsonl", 3000), ("part-00002.jsonl", 0), ("part-00003.jsonl", 40)):
        names = [f"{name[5:10]}/{k}{'x' * (k % 50)}.wav" for k in range(n)]
        (folder / name).write_text("".join(f'{{"path": "{p}"}}\n' + "\n" * (k % 7 == 0) + " \t\n" * (k % 11 == 0) for k, p in enumerate(names)))
        want += names
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for split in ("128m", "10k", "1k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            rows = files.read_manifest(spark, str(folder)).collect()
            assert [r.path for r in sorted(rows, key=lambda r: r.source_index)] == want
            assert sorted(r.source_index for r in rows) == list(range(len(want)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    (tmp_path / "one.txt").write_text("\n b.wav \n\na/c.wav")
    assert [tuple(r) for r in files.read_manifest(spark, f"{tmp_path}/one.txt").orderBy("source_index").collect()] == [(0, "b.wav", "b", None), (1, "a/c.wav", "c", None)]


def test_flow_tables_can_be_cleared(spark):
    df = tables.settled(spark.range(5))
    place = tables.shared_folder(spark).removeprefix("file://")
    assert df.count() == 5 and os.listdir(place)
    tables.clear(spark)
    assert not os.path.exists(place)


MODELS = '''
import pandas as pd
from colloquy import models
from colloquy.plans import run as flow


def stages(settings):
    def diarize():
        return lambda batch: pd.DataFrame({"input_path": batch["input_path"].to_numpy(), "duration_us": 9, "segments": [[{"spk": "a", "start_us": 0, "end_us": 9}]] * len(batch)})

    def recognise():
        def run(batch):
            if batch["input_path"].str.contains("deaf").any():
                raise ValueError("deaf")
            return pd.DataFrame({"input_path": batch["input_path"].to_numpy(), "words": [[{"seg_ix": None, "word": "hi", "start_us": 1, "end_us": 5}]] * len(batch)})

        return run

    return models.Stage(diarize, flow.DIARIZED, "input_path"), models.Stage(recognise, flow.HEARD, "input_path")
'''


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    from colloquy.__main__ import main

    (tmp_path / "own_models.py").write_text(MODELS)
    (tmp_path / "in.txt").write_text("a.wav\nb.wav\n")
    (tmp_path / "settings.json").write_text(json.dumps({"manifest_path": "in.txt", "out_dir": "out", "audio_dir": "/audio"}))
    monkeypatch.syspath_prepend(tmp_path)
    assert main([f"{tmp_path}/settings.json", "own_models:stages"]) == 0
    told = json.loads(capsys.readouterr().out)
    assert told["status"] == "done" and told["num_items"] == 2 and told["counts"] == {"SUCCESS": 2}
    (tmp_path / "in.txt").write_text("a.wav\ndeaf.wav\n")
    assert main([f"{tmp_path}/settings.json", "own_models:stages"]) == 1 and json.loads(capsys.readouterr().out)["counts"] == {"FAILED": 1, "SKIPPED": 1}
    assert main([]) == 2


def test_file_digests(spark, tmp_path):
    import hashlib

    content = os.urandom(3 << 20)
    (tmp_path / "a.gz").write_bytes(content)
    rows = spark.createDataFrame([(f"{tmp_path}/a.gz", 1), (f"{tmp_path}/none", 2)], "path string, x int")
    assert {r.x: r.md5 for r in files.with_digests(rows).collect()} == {1: hashlib.md5(content).hexdigest(), 2: None}
