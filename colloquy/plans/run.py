"""A run from inputs to documents, journal and summary, with the models given as stages."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from colloquy.config import MODES, Config
from colloquy.models import Stage, apply
from colloquy.operators import journal
from colloquy.plans.align import Rules, ruled_segments
from colloquy.plans.documents import documents
from colloquy.plans.recognise import Chunked
from colloquy.plans.tables import settled
from colloquy.sources import files
from colloquy.sources.items import item_ids, recover

#: What the stages return, besides status and reason: an item's length and segments; its words, in the cut flow by segment.
DIARIZED = "input_path string, duration_us long, segments array<struct<spk:string,start_us:long,end_us:long>>"
HEARD = "input_path string, words array<struct<seg_ix:long,word:string,start_us:long,end_us:long>>"


def rules_of(c: Config) -> Rules:
    micros = lambda sec: round(sec * 1_000_000)
    return Rules(micros(c.max_snap_sec), c.island_max_words, micros(c.island_max_sec), micros(c.pause_new_turn_sec), c.third_spk_max_share, c.equal_share_eps, c.max_speakers_allowed, c.rules_enabled)


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def inputs_of(spark: SparkSession, c: Config) -> DataFrame:
    """(input_path, id, source_index): the manifest's items, or else the files of the audio folder, by path; ids must differ, as they name the outputs."""
    if c.manifest_path:
        rows = files.resolved(files.read_manifest(spark, c.manifest_path), c.audio_dir)
    else:
        rows = files.read_glob(spark, c.audio_dir, c.glob).withColumn("source_index", F.monotonically_increasing_id())
    rows = settled(rows.select(F.col("path").alias("input_path"), "id", "source_index"))
    twice = [r.id for r in journal.duplicate_ids(rows).orderBy("id").limit(8).collect()]
    if twice:
        raise ValueError("ids that occur more than once would overwrite outputs: " + ", ".join(twice))
    return rows


#: Called after every step with its name and the number of items by status.
Tell = Callable[[str, dict[str, int]], None]


def _staged(df: DataFrame, stage: Stage, c: Config, tell: Tell | None = None) -> DataFrame:
    """The stage's rows, computed once, in batches of the settings' size and by as many tasks as they ask for; they are counted as they are written."""
    df = df.repartition(c.num_instances) if c.num_instances > 1 else df
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    conf.set(key, str(c.chunk_batch_size))
    try:
        seen = Observation()
        out = settled(apply(df, stage).observe(seen, *(F.count_if(F.col("status") == s).alias(s) for s in ("SUCCESS", "FAILED"))))
        if tell:
            tell(stage.name, seen.get)
        return out
    finally:
        conf.set(key, before)


def _lost(asked: DataFrame, answered: DataFrame) -> DataFrame:
    """(input_path, reason) of items without an answer; stages answer for every item, so there are some only if rows went missing elsewhere."""
    return asked.select("input_path").join(answered.select("input_path"), "input_path", "left_anti").select("input_path", F.lit("no result").alias("reason"))


def results_of(items: DataFrame, c: Config, diarize: Stage, recognise: Stage | Chunked, tell: Tell | None = None) -> DataFrame:
    """(input_path, id, source_index, status, reason, times, transcript, meta_asr, meta_diar) of every item: SUCCESS, BAD_SAMPLE or FAILED.

    ``diarize`` gets input_path and id, ``recognise`` also segments (of the rules, in the cut flow; else null); a ``Chunked``
    recogniser gets samples in chunks by the settings' lengths and overlaps. An item that
    either fails on, or gives no result for, is FAILED with that reason; the others go on. Every item has exactly one row.
    """
    told = _staged(items, replace(diarize, name="diarize"), c, tell)
    good = told.where("status = 'SUCCESS'")
    segments = good.select(F.col("input_path").alias("file_id"), F.explode("segments").alias("s")).select("file_id", "s.*")
    lengths = good.select(F.col("input_path").alias("file_id"), F.col("duration_us").alias("audio_us"))
    rules, cut = rules_of(c), c.mode == MODES[1]
    ruled = ruled_segments(segments, lengths, rules, lengths.select("file_id"))
    okay = ruled.verdicts.where("status = 'OK'").select(F.col("file_id").alias("input_path"))
    asked = items.join(okay, "input_path", "left_semi")
    one = F.struct("seg_ix", "spk", "start_us", "end_us")
    parts = ruled.kept.groupBy(F.col("file_id").alias("input_path")).agg(F.array_sort(F.collect_list(one)).alias("segments"))
    asked = asked.join(parts, "input_path", "left") if cut else asked.withColumn("segments", F.lit(None).cast(parts.schema["segments"].dataType))
    asked = settled(asked)
    if isinstance(recognise, Chunked):
        heard = recognise.words(asked, c)
        if tell:
            tell("recognise", {r.status: r["count"] for r in heard.groupBy("status").count().collect()})
    else:
        heard = _staged(asked, replace(recognise, name="recognise"), c, tell)
    words = heard.where("status = 'SUCCESS'").select(F.col("input_path").alias("file_id"), F.posexplode("words").alias("pos", "w")).select("file_id", F.col("pos").cast("long").alias("pos"), "w.*")
    words = words.withColumnRenamed("pos", "word_ix") if cut else words.drop("seg_ix")
    made = documents(words, segments, lengths, rules, round(c.segment_max_sec * 1_000_000) if cut else None, lengths.select("file_id"), ruled)
    failed = told.where("status = 'FAILED'").select("input_path", "reason").union(heard.where("status = 'FAILED'").select("input_path", "reason"))
    failed = failed.union(_lost(items, told)).union(_lost(asked, heard)).groupBy("input_path").agg(F.min("reason").alias("why"))
    times = told.select("input_path", "started_at", "finished_at").union(heard.select("input_path", "started_at", "finished_at"))
    times = times.groupBy("input_path").agg(F.min("started_at").alias("started_at"), F.max("finished_at").alias("finished_at"))
    made = made.withColumnRenamed("file_id", "input_path")
    done = items.join(made, "input_path", "left").join(failed, "input_path", "left").join(times, "input_path", "left")
    broken = F.col("why").isNotNull()
    path = F.col("input_path").alias("audio_path")
    named = {"transcript": F.when(~broken & F.col("transcript").isNotNull(), F.struct(path, F.col("transcript").withField("file_id", F.col("id"))["file_id"].alias("file_id"), *(F.col(f"transcript.{n}") for n in ("status", "speakers", "mapping", "turns", "stats")))),
             "meta_asr": F.when(~broken & F.col("meta_asr").isNotNull(), F.struct(path, "meta_asr.*")), "meta_diar": F.when(~broken, F.struct(path, "meta_diar.*"))}
    return done.select(*items.columns, F.when(broken, "FAILED").otherwise(F.col("status")).alias("status"), F.coalesce("why", "reason").alias("reason"), "started_at", "finished_at", *(v.alias(k) for k, v in named.items()))


def run(spark: SparkSession, c: Config, diarize: Stage, recognise: Stage | Chunked, tell: Tell | None = None) -> Row:
    """Works on what is pending, writes documents and journal below ``c.out_dir``, and returns the summary of all inputs.

    The journal's lines are in the order of the inputs. The summary counts the lines as they are written; ``tell`` hears of each step.
    """
    places = {"transcript": c.transcripts_dir, "meta_asr": c.meta_asr_dir, "meta_diar": c.meta_diar_dir}
    places = {k: os.path.join(c.out_dir, v) for k, v in places.items()}
    log = os.path.join(c.out_dir, "journal")
    if c.item_files:
        recover(c.out_dir)
    items = inputs_of(spark, c)
    pending, skips = items, []
    if c.resume_enabled and _exists(spark, log):
        lines = files.read_journal(spark, log)
        skips.append(journal.skip_rows(journal.skipped_inputs(pending, lines, c.retry_failed), "resume"))
        pending = journal.pending_inputs(pending, lines, c.retry_failed)
    if c.skip_if_outputs_exist and all(_exists(spark, p) for p in places.values()):
        there = (item_ids(spark, p) if c.item_files else spark.read.schema("id string").json(p) for p in places.values())
        left = journal.without_outputs(pending, *there)
        skips.append(journal.skip_rows(pending.join(left.select("id"), "id", "left_anti"), "outputs_exist"))
        pending = left
    pending = settled(pending.select("input_path", "id", "source_index"))
    results = results_of(pending, c, diarize, recognise, tell)
    for more in skips:
        results = results.unionByName(more.join(items, "input_path"), allowMissingColumns=True)
    results = settled(results)
    counts = files.write_results(results.orderBy("source_index"), c.out_dir, places, c.json(), c.item_files)
    if tell:
        tell("written", counts)
    failed = "FAILED" in counts
    return Row(status="done_with_errors" if failed else "done", num_items=sum(counts.values()), counts=counts, exit_code=int(failed))
