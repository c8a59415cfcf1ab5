"""The two transcript flows: words aligned to speakers afterwards, and speech cut by speaker first."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.operators import intervals, islands, speakers
from colloquy.plans.tables import settled


@dataclass(frozen=True)
class Rules:
    """Thresholds of the flows, with times in microseconds; the names are those of the operators' arguments."""

    snap_us: int = 800_000
    island_words: int = 2
    island_us: int = 24_000_000
    pause_us: int = 600_000
    third_max: float = 0.10
    eps: float = 0.05
    max_speakers: int = 3
    enabled: bool = True


@dataclass(frozen=True)
class Ruled:
    """What the rules make of the segments: shares, verdicts, dropped (file_id, spk), segments of accepted files with dropped
    speakers' given away and numbered, and names of the speakers that stay."""

    shares: DataFrame
    verdicts: DataFrame
    dropped: DataFrame
    kept: DataFrame
    names: DataFrame


def ruled_segments(segments: DataFrame, audio_us: int | DataFrame, rules: Rules = Rules(), files: DataFrame | None = None) -> Ruled:
    """Each part is computed once. ``files`` (file_id), if given, lists files that may have no segments at all."""
    segments = settled(segments)
    shares = settled(intervals.speaker_shares(segments, audio_us))
    ruled = settled(speakers.verdict(shares, rules.third_max, rules.eps, max_speakers=rules.max_speakers, enabled=rules.enabled, files=files))
    okay = ruled.where("status = 'OK'")
    dropped = okay.where("dropped != ''").select("file_id", F.col("dropped").alias("spk"))
    kept = settled(intervals.reassign_dropped(segments.join(okay.select("file_id"), "file_id", "left_semi"), dropped))
    stay = shares.join(okay.select("file_id"), "file_id", "left_semi").join(dropped, ["file_id", "spk"], "left_anti")
    return Ruled(shares, ruled, dropped, kept, settled(speakers.ranked_names(stay)))


def _named(words: DataFrame, ruled: Ruled) -> DataFrame:
    return words.join(ruled.names, ["file_id", "spk"], "left").withColumn("spk", F.col("norm")).drop("norm")


def named_words(words: DataFrame, ruled: Ruled, rules: Rules = Rules()) -> DataFrame:
    """Words of accepted files with spk as Spk0, Spk1…: assignment, smoothing, names by share.

    reassigned says how often a word's speaker was snapped to or smoothed.
    """
    accepted = settled(words.join(ruled.verdicts.where("status = 'OK'").select("file_id"), "file_id", "left_semi"))
    given = settled(intervals.assign_words(accepted, ruled.kept.drop("seg_ix"), rules.snap_us))
    smooth = islands.smooth_islands(given, rules.island_words, rules.island_us)
    smooth = smooth.withColumn("reassigned", F.col("snapped").cast("int") + (~F.col("old_spk").eqNullSafe(F.col("spk"))).cast("int"))
    return _named(smooth, ruled).drop("old_spk")


def full_align(words: DataFrame, segments: DataFrame, audio_us: int | DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Turns of every accepted file."""
    return islands.build_turns(settled(named_words(words, ruled_segments(segments, audio_us, rules), rules)), rules.pause_us)


def placed_words(words: DataFrame, segments: DataFrame) -> DataFrame:
    """Words (file_id, seg_ix, word_ix, word, start_us, end_us) that were recognised inside one segment each, with its speaker
    and in the file's time; ``segments`` are numbered."""
    s = segments.select("file_id", "seg_ix", "spk", F.col("start_us").alias("s0"))
    return words.join(s, ["file_id", "seg_ix"]).withColumns(
        {"start_us": F.col("start_us") + F.col("s0"), "end_us": F.col("end_us") + F.col("s0"), "pos": F.struct("seg_ix", "word_ix")}).drop("s0")


def cut_align(words: DataFrame, segments: DataFrame, pause_us: int = 600_000) -> DataFrame:
    """Turns of words that take their segment's speaker, without rules."""
    return islands.build_turns(placed_words(words, intervals.numbered(segments)), pause_us)


def cut_words(words: DataFrame, ruled: Ruled) -> DataFrame:
    """Words of accepted files with their segment's speaker as Spk0, Spk1…; none is ever reassigned."""
    return _named(placed_words(words, ruled.kept), ruled).withColumn("reassigned", F.lit(0))


def word_stats(words: DataFrame) -> DataFrame:
    """(file_id, num_words, covered_us, mean_us, max_us), zeros where there are no durations."""
    d = F.greatest(F.lit(0), F.col("end_us") - F.col("start_us"))
    return words.groupBy("file_id").agg(F.count("*").alias("num_words"), F.coalesce(F.sum(d), F.lit(0)).alias("covered_us"), F.round(F.avg(d), 3).alias("mean_us"), F.coalesce(F.max(d), F.lit(0)).alias("max_us"))
