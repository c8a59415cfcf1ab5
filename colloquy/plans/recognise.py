"""Recognition in chunks as one plan: samples are cut by bounds, chunks of all files share batches, and words meet again per file.

A model sees chunks of samples only and gives a label for each frame; what is a chunk of what, and when it began, stays in tables
and is joined by key. Times are whole microseconds, rounded down within a chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.config import MODES, Config
from colloquy.functions import stripped
from colloquy.models import Stage, apply
from colloquy.operators import intervals, islands
from colloquy.operators.batches import Batches
from colloquy.plans.tables import settled
from colloquy.sources.audio import RATE

#: What a recogniser returns for a chunk: a label for every frame, padding included, and how many frames are its own.
LABELS = "chunk string, labels array<int>, frames int"
#: Samples in a batch of slices, at most, unless one chunk is longer.
SLICES = 4 << 20


@dataclass(frozen=True)
class Alphabet:
    """Texts of the labels, the blank label, and whether texts are word pieces (▁ begins a word) or characters."""

    texts: tuple[str, ...]
    blank: int
    pieces: bool = False

    def text(self, label: Column) -> Column:
        return F.get(F.array(*map(F.lit, self.texts)), label.cast("int"))


def chunk_key(*parts: str) -> Column:
    """A chunk's name out of columns without nulls: different chunks have different names."""
    return F.concat_ws("\x1f", *(F.col(p).cast("string") for p in parts))


def _sample(us: Column) -> Column:
    return F.floor((us * (2 * RATE) + 1_000_000) / 2_000_000).cast("long")


def slices(audio: DataFrame, bounds: DataFrame) -> DataFrame:
    """(file_id, samples) and (file_id, chunk, start_us, end_us) -> (chunk, n_samples, samples): the bounds' parts of the samples.

    A file's samples are moved once, with its list of bounds, and cut in Arrow batches. Bounds are rounded to whole samples,
    halves up, and end with the samples; parts without samples are left out.
    """
    one = F.struct("chunk", _sample(F.col("start_us")).alias("a"), _sample(F.col("end_us")).alias("b"))
    listed = bounds.groupBy("file_id").agg(F.collect_list(one).alias("bounds"))

    def batch_of(names: list[str], parts: list[np.ndarray]) -> pa.RecordBatch:
        n = np.array([len(x) for x in parts], dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        values = pa.array(np.concatenate(parts) if parts else np.empty(0, np.float32), pa.float32())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(n), pa.ListArray.from_arrays(pa.array(offsets), values)], ["chunk", "n_samples", "samples"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                x = batch.column("samples")[k].values.to_numpy(zero_copy_only=False)
                names, parts, held = [], [], 0
                for bound in batch.column("bounds")[k].as_py():
                    part = x[bound["a"] : bound["b"]]
                    if not len(part):
                        continue
                    if held + len(part) > SLICES and parts:
                        yield batch_of(names, parts)
                        names, parts, held = [], [], 0
                    names.append(bound["chunk"])
                    parts.append(part)
                    held += len(part)
                yield batch_of(names, parts)

    rows = audio.where("samples IS NOT NULL").join(listed, "file_id").select("samples", "bounds")
    return rows.mapInArrow(run, "chunk string, n_samples long, samples array<float>")


def chunk_words(heard: DataFrame, alphabet: Alphabet) -> DataFrame:
    """(chunk, labels, frames) -> (chunk, word_ix, word, start_t, end_t, frames): words of each chunk, in frames of it."""
    own = heard.select(F.col("chunk").alias("file_id"), F.slice("labels", F.lit(1), F.greatest(F.lit(0), F.least(F.size("labels"), F.col("frames")))).alias("labels"))
    spans = islands.token_spans(own, alphabet.blank).withColumn("text", alphabet.text(F.col("token_id")))
    words = islands.words_from_tokens(spans.where("text IS NOT NULL"), alphabet.pieces)
    frames = own.select("file_id", F.size("labels").cast("long").alias("frames"))
    return words.join(frames, "file_id").withColumnRenamed("file_id", "chunk")


@dataclass(frozen=True)
class Heard:
    """words: (file_id, pos, word, start_us, end_us) in order; failed: (file_id, reason) of files with a chunk that failed; times: (file_id, started_at, finished_at)."""

    words: DataFrame
    failed: DataFrame
    times: DataFrame


def recognised(audio: DataFrame, bounds: DataFrame, stage: Stage, alphabet: Alphabet, batches: Batches | None = None, max_gap_us: int = 250_000, same_end_us: int = 1_000) -> Heard:
    """Words of (file_id, samples) cut at ``bounds`` (file_id, chunk_ix, start_us, end_us[, stitch][, item]); ``stage`` returns LABELS.

    Chunks are numbered in the order of their words. Where ``stitch`` is true for a file's chunks, as it should be where
    they overlap, a word that repeats the last one kept joins it. A file with a chunk that failed has no words. ``item``, where
    it is given, names what is heard for itself, such as a segment of a file, and stands for file_id in the results. With ``batches``,
    whose length is ``n_samples``, chunks of like length share padded batches, whichever file they belong to.
    """
    item = F.col("item") if "item" in bounds.columns else F.col("file_id")
    stitch = F.col("stitch") if "stitch" in bounds.columns else F.lit(False)
    bounds = bounds.withColumns({"item": item, "stitch": stitch}).withColumn("chunk", chunk_key("item", "chunk_ix"))
    meta = bounds.select("chunk", F.col("item").alias("file_id"), "chunk_ix", "start_us", (F.col("end_us") - F.col("start_us")).alias("dur_us"), "stitch")
    heard = settled(apply(slices(audio, bounds), replace(stage, key="chunk"), batches))
    failed = heard.where("status = 'FAILED'").join(meta, "chunk").groupBy("file_id").agg(F.min("reason").alias("reason"))
    times = heard.join(meta, "chunk").groupBy("file_id").agg(F.min("started_at").alias("started_at"), F.max("finished_at").alias("finished_at"))
    words = chunk_words(heard.where("status = 'SUCCESS'"), alphabet).join(meta, "chunk").join(failed.select("file_id"), "file_id", "left_anti")
    at = lambda t: F.col("start_us") + F.expr(f"{t} * dur_us div frames")
    pos = F.row_number().over(Window.partitionBy("file_id").orderBy("chunk_ix", "word_ix")).cast("long").alias("pos")
    words = settled(words.select("file_id", pos, "word", at("start_t").alias("start_us"), at("end_t").alias("end_us"), "stitch"))
    joined = islands.stitch_words(words.where("stitch").drop("stitch"), max_gap_us, same_end_us)
    return Heard(words.where("NOT stitch").drop("stitch").unionByName(joined), failed, times)


def longform(audio: DataFrame, bounds: DataFrame, stage: Stage, alphabet: Alphabet, batches: Batches | None = None) -> DataFrame:
    """(file_id, chunk_ix, transcription, boundaries, status, reason), a row for every chunk with samples: its text and (start, end) in seconds.

    Characters keep their own spaces, pieces are joined as words; a chunk that failed has a null text and its reason.
    """
    bounds = bounds.withColumn("chunk", chunk_key("file_id", "chunk_ix"))
    heard = settled(apply(slices(audio, bounds), replace(stage, key="chunk"), batches))
    own = F.slice("labels", F.lit(1), F.greatest(F.lit(0), F.least(F.size("labels"), F.col("frames"))))
    texts = F.filter(F.transform(islands.collapse(own, alphabet.blank), alphabet.text), lambda x: x.isNotNull())
    joined = F.array_join(texts, "")
    text = stripped(F.replace(joined, F.lit("▁"), F.lit(" "))) if alphabet.pieces else joined
    seconds = F.struct((F.col("start_us") / 1_000_000).alias("start"), (F.col("end_us") / 1_000_000).alias("end")).alias("boundaries")
    said = heard.select("chunk", F.when(F.col("status") == "SUCCESS", text).alias("transcription"), "status", "reason")
    return bounds.join(said, "chunk").select("file_id", "chunk_ix", "transcription", seconds, "status", "reason")


def fixed_bounds(lengths: DataFrame, size_us: int, overlap_us: int) -> DataFrame:
    """Bounds of (file_id, total_us) in steps of size - overlap; overlapping chunks are stitched."""
    return intervals.hopping_chunks(lengths, size_us, overlap_us).withColumn("stitch", F.lit(overlap_us > 0))


def packed_bounds(speech: DataFrame, lengths: DataFrame, **limits: int) -> DataFrame:
    """Bounds of chunks packed from (file_id, start_us, end_us) of speech, merged first; they do not overlap."""
    parts = intervals.pack_chunks(intervals.merged(speech), lengths=lengths, **limits)
    return parts.select("file_id", F.struct("chunk_ix", "part_ix").alias("chunk_ix"), "start_us", "end_us")


@dataclass(frozen=True)
class Chunked:
    """A recogniser for runs that hears chunks: ``audio`` gives (input_path, samples, reason) of items with input_path.

    Items without samples fail with their reason. ``batches`` are padded batches by ``n_samples``.
    """

    stage: Stage
    alphabet: Alphabet
    audio: Callable[[DataFrame], DataFrame]
    batches: Batches | None = None

    def words(self, asked: DataFrame, c: Config) -> DataFrame:
        """(input_path, words, status, reason, started_at, finished_at) of every item of (input_path, segments), as a recognise stage gives it.

        The full flow cuts files into chunks of ``max_sec`` that overlap by ``overlap_sec``; the cut flow cuts segments, and only
        those over ``segment_max_sec`` into chunks that overlap. Words of segments have times within them.
        """
        micros = lambda sec: round(sec * 1_000_000)
        audio = settled(self.audio(asked).select("input_path", "samples", "reason"))
        sound = audio.where("samples IS NOT NULL").select(F.col("input_path").alias("file_id"), "samples")
        if c.mode == MODES[1]:
            parts = asked.select(F.col("input_path").alias("file_id"), F.explode("segments").alias("s")).select("file_id", "s.spk", "s.start_us", "s.end_us", "s.seg_ix")
            long = parts.select("file_id", "seg_ix", F.col("start_us").alias("from_us"), (F.col("end_us") - F.col("start_us") > micros(c.segment_max_sec)).alias("stitch"))
            cut = intervals.segment_chunks(parts.drop("seg_ix"), micros(c.max_sec), micros(c.overlap_sec), micros(c.segment_max_sec)).join(long, ["file_id", "seg_ix"])
            # Each segment is heard for itself: what is stitched are the chunks of one segment.
            own = F.struct("file_id", "seg_ix", "from_us").alias("item")
            bounds = cut.select("file_id", own, "chunk_ix", "start_us", "end_us", "stitch")
        else:
            lengths = sound.select("file_id", F.expr(f"size(samples) * 1000000L div {RATE}").alias("total_us"))
            none = F.lit(None).cast("long")
            bounds = fixed_bounds(lengths, micros(c.max_sec), micros(c.overlap_sec)).withColumn("item", F.struct("file_id", none.alias("seg_ix"), F.lit(0).cast("long").alias("from_us")))
        heard = recognised(sound, bounds, self.stage, self.alphabet, self.batches)
        one = F.struct(F.col("file_id.seg_ix").alias("seg_ix"), "word", (F.col("start_us") - F.col("file_id.from_us")).alias("start_us"), (F.col("end_us") - F.col("file_id.from_us")).alias("end_us"))
        words = heard.words.select(F.col("file_id.file_id").alias("input_path"), F.struct(F.col("file_id.seg_ix").alias("seg_ix"), "pos", one.alias("x")).alias("o"))
        words = words.groupBy("input_path").agg(F.transform(F.array_sort(F.collect_list("o")), lambda r: r["x"]).alias("words"))
        failed = heard.failed.groupBy(F.col("file_id.file_id").alias("input_path")).agg(F.min("reason").alias("why"))
        times = heard.times.groupBy(F.col("file_id.file_id").alias("input_path")).agg(F.min("started_at").alias("started_at"), F.max("finished_at").alias("finished_at"))
        out = asked.select("input_path").join(audio.select("input_path", F.col("samples").isNull().alias("mute"), "reason"), "input_path", "left")
        out = out.join(words, "input_path", "left").join(failed, "input_path", "left").join(times, "input_path", "left")
        why = F.coalesce("why", F.when(F.coalesce("mute", F.lit(True)), F.coalesce("reason", F.lit("no result"))))
        empty = F.expr(f"cast(array() as {words.schema['words'].dataType.simpleString()})")
        return settled(out.select("input_path", F.when(why.isNull(), F.coalesce("words", empty)).alias("words"), F.when(why.isNull(), "SUCCESS").otherwise("FAILED").alias("status"), why.alias("reason"), "started_at", "finished_at"))
