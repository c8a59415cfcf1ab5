"""Result documents of a run: transcript, recognition and speaker metadata, one row per file with nested columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquy.functions import millis
from colloquy.operators import intervals, islands
from colloquy.plans.align import Ruled, Rules, cut_words, named_words, ruled_segments
from colloquy.plans.tables import settled


def _listed(df: DataFrame, order: str, name: str, **fields: Column | str) -> DataFrame:
    """(file_id, name): the rows of a file in order as an array of structs."""
    own = [(F.col(c) if isinstance(c, str) else c).alias(k) for k, c in fields.items()]
    rows = df.groupBy("file_id").agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.struct(*own).alias("x")))).alias(name))
    return rows.select("file_id", F.transform(name, lambda r: r["x"]).alias(name))


def heard(words: DataFrame, **more: Column) -> DataFrame:
    """(file_id, words, stats, reassigned): number of words, seconds covered to three places, mean and longest word to four.

    ``more`` are further fields of each word.
    """
    d = F.greatest(F.lit(0), F.col("end_us") - F.col("start_us"))
    item = F.struct("word", millis(F.col("start_us")).alias("start"), millis(F.col("end_us")).alias("end"), *(c.alias(k) for k, c in more.items()))
    sums = words.groupBy("file_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", item.alias("x")))).alias("list"), F.sum("reassigned").alias("reassigned"),
        F.count("*").alias("n"), F.sum(d).alias("s"), F.max(d).alias("m"))
    return sums.select("file_id", F.transform("list", lambda r: r["x"]).alias("words"), "reassigned", F.struct(
        F.col("n").alias("num_words"), millis(F.col("s")).alias("total_covered_sec"),
        (F.expr("(2 * s + 100 * n) div (200 * n)") / 10_000).alias("mean_word_dur"), (F.expr("(m + 50) div 100") / 10_000).alias("max_word_dur")).alias("stats"))


def documents(words: DataFrame, segments: DataFrame, audio_us: int | DataFrame, rules: Rules = Rules(), cut_us: int | None = None, files: DataFrame | None = None,
              ruled: Ruled | None = None) -> DataFrame:
    """(file_id, status, reason, transcript, meta_asr, meta_diar): a row per file with segments, or per file of ``files``.

    Words are (file_id, pos, word, start_us, end_us) of whole files or, where ``cut_us`` gives the length over which segments are
    cut further, (file_id, seg_ix, word_ix, word, start_us, end_us) of the segments that the rules leave, with times in these.
    A rejected file has the status BAD_SAMPLE, its reason, null transcript and null meta_asr; its meta_diar still holds
    speakers and shares, for the journal. ``ruled`` is what the rules made of the segments, where that is known. An accepted file without words has empty lists and zeros.
    """
    ruled = ruled or ruled_segments(segments, audio_us, rules, files)
    named = settled(named_words(words, ruled, rules) if cut_us is None else cut_words(words, ruled))
    turns = _listed(islands.build_turns(named, rules.pause_us), "turn_ix", "turns", speaker="speaker", start=millis(F.col("start_us")), end=millis(F.col("end_us")), text="text")
    names = _listed(ruled.names, "norm", "names", orig="spk", norm="norm")
    parts = _listed(ruled.kept, "seg_ix", "segments", spk="spk", start=millis(F.col("start_us")), end=millis(F.col("end_us")))
    every = _listed(ruled.shares, "spk", "shares", spk="spk", share="share")
    if cut_us is None:
        tables = [turns, heard(named), names, parts, every]
    else:
        items = intervals.segment_items(ruled.kept.drop("seg_ix"), named.select("file_id", "seg_ix"), cut_us)
        items = _listed(items, "seg_ix", "items", segment_id=F.col("seg_ix") - 1, spk="spk", start=millis(F.col("start_us")), end=millis(F.col("end_us")), dur=millis(F.col("dur_us")),
                        num_chunks_after_split="num_chunks", num_words="num_words")
        tables = [turns, heard(named, segment_id=F.col("seg_ix") - 1, speaker_id=F.col("spk")), names, parts, every, items]
    all_of = ruled.verdicts
    for more in tables:
        all_of = all_of.join(more, "file_id", "left")

    def or_empty(name: str) -> Column:
        kind = all_of.schema[name].dataType.simpleString()
        return F.coalesce(F.col(name), F.expr(f"cast(array() as {kind})"))

    gone = F.when(F.col("dropped") == "", F.array().cast("array<string>")).otherwise(F.split("dropped", ","))
    zeros = F.struct(F.lit(0).cast("long").alias("num_words"), *(F.lit(0.0).alias(c) for c in ("total_covered_sec", "mean_word_dur", "max_word_dur")))
    counts = F.coalesce("stats", zeros)
    transcript = F.struct(
        F.col("file_id").cast("string").alias("file_id"), F.lit("SUCCESS").alias("status"), F.transform(or_empty("names"), lambda x: x["norm"]).alias("speakers"),
        F.struct(F.map_from_entries(or_empty("names")).alias("orig_to_norm"), gone.alias("dropped_speakers")).alias("mapping"), or_empty("turns").alias("turns"),
        F.struct(F.size(or_empty("turns")).cast("long").alias("num_turns"), counts["num_words"].alias("num_words"), F.coalesce("reassigned", F.lit(0)).alias("reassigned_words")).alias("stats"),
    )
    mode = F.lit("full_asr_then_align" if cut_us is None else "diar_cut_then_asr").alias("mode")
    batch = [] if cut_us is None else [or_empty("items").alias("asr_batch_items")]
    okay = F.col("status") == "OK"
    why = F.when(F.col("dropped") != "", "third_spk_max_share").when(okay & (F.col("reason") == "disabled"), "disabled")
    return all_of.select(
        "file_id", F.when(okay, "SUCCESS").otherwise("BAD_SAMPLE").alias("status"), F.when(~okay, F.col("reason")).alias("reason"),
        F.when(okay, transcript).alias("transcript"),
        F.when(okay, F.struct(mode, *batch, or_empty("words").alias("words"), counts.alias("stats"))).alias("meta_asr"),
        F.struct(F.transform(or_empty("shares"), lambda x: x["spk"]).alias("speakers"), F.map_from_entries(or_empty("shares")).alias("shares"), or_empty("segments").alias("postprocessed_segments"),
                 gone.alias("dropped_speakers"), why.alias("drop_reason")).alias("meta_diar"),
    )


def words_documents(words: DataFrame, model: str, sample_rate: int = 16_000) -> DataFrame:
    """(file_id, content): a file's words (file_id, pos, word, start_us, end_us) as one JSON document, times to three places."""
    listed = _listed(words, "pos", "words", word="word", start=millis(F.col("start_us")), end=millis(F.col("end_us")))
    whole = F.struct(F.col("file_id").cast("string").alias("audio_path"), F.lit(model).alias("model"), F.lit(sample_rate).alias("sample_rate"), "words")
    return listed.select("file_id", F.to_json(whole).alias("content"))
