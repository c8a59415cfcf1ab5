"""Intervals: segments are (file_id, spk, start_us, end_us), times are whole microseconds, so ties and sums are exact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.operators.scans import scanned


def numbered(segments: DataFrame) -> DataFrame:
    """Adds seg_ix from 1 in the order (start, end, speaker)."""
    return segments.withColumn("seg_ix", F.row_number().over(Window.partitionBy("file_id").orderBy("start_us", "end_us", "spk")).cast("long"))


def speaker_shares(segments: DataFrame, audio_us: int | DataFrame) -> DataFrame:
    """(file_id, spk, dur_us, share, first_seg_ix): a speaker's part of the audio, at most 1; 0 for audio without length.

    ``audio_us`` is the length of all files or a table (file_id, audio_us) of their lengths.
    """
    sums = numbered(segments).groupBy("file_id", "spk").agg(
        F.sum(F.greatest(F.lit(0), F.col("end_us") - F.col("start_us"))).alias("dur_us"), F.min("seg_ix").alias("first_seg_ix"))
    sums = sums.join(audio_us, "file_id", "left") if isinstance(audio_us, DataFrame) else sums.withColumn("audio_us", F.lit(audio_us))
    share = F.when(F.col("audio_us") > 0, F.least(F.lit(1.0), F.col("dur_us") / F.col("audio_us").cast("double"))).otherwise(0.0)
    return sums.select("file_id", "spk", "dur_us", share.alias("share"), "first_seg_ix")


def merged(intervals: DataFrame) -> DataFrame:
    """(file_id, start_us, end_us) of the union; touching intervals join."""
    w = Window.partitionBy("file_id").orderBy("start_us", "end_us")
    reach = F.max("end_us").over(w.rowsBetween(Window.unboundedPreceding, -1))
    runs = intervals.withColumn("_reach", reach).withColumn("_run", F.sum(F.when(F.col("_reach").isNull() | (F.col("start_us") > F.col("_reach")), 1).otherwise(0)).over(w))
    return runs.groupBy("file_id", "_run").agg(F.min("start_us").alias("start_us"), F.max("end_us").alias("end_us")).drop("_run")


def union_length(intervals: DataFrame) -> DataFrame:
    return merged(intervals).groupBy("file_id").agg(F.sum(F.col("end_us") - F.col("start_us")).alias("union_us"), F.count("*").alias("n_intervals"))


def hopping_chunks(files: DataFrame, size_us: int, overlap_us: int) -> DataFrame:
    """(file_id, total_us) -> (file_id, chunk_ix, start_us, end_us): steps of size - overlap; the chunk that reaches the end is the last."""
    if not 0 <= overlap_us < size_us:
        raise ValueError("overlap must be at least 0 and below the size")
    step = size_us - overlap_us
    last = F.greatest(F.lit(0), F.ceil((F.col("total_us") - size_us) / step)).cast("long")
    return (
        files.where("total_us > 0").select("file_id", "total_us", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("chunk_ix"))
        .select("file_id", "chunk_ix", (F.col("chunk_ix") * step).alias("start_us"), F.least(F.col("total_us"), F.col("chunk_ix") * step + size_us).alias("end_us"))
    )


def segment_chunks(segments: DataFrame, size_us: int, overlap_us: int, segment_max_us: int) -> DataFrame:
    """(file_id, seg_ix, spk, chunk_ix, start_us, end_us): each segment's hopping chunks, in the file's time.

    Chunks are at most ``size_us`` and ``segment_max_us`` long and overlap only in segments over ``segment_max_us``. Segments
    that are shorter than half a sample of 16 kHz have none.
    """
    size = min(size_us, segment_max_us)
    if not 0 <= overlap_us < size:
        raise ValueError("overlap must be at least 0 and below the chunk size")
    sample = lambda c: F.expr(f"({c} * 32000 + 1000000) div 2000000")
    s = numbered(segments).where(sample("end_us") > sample("start_us")).withColumn("_d", F.col("end_us") - F.col("start_us"))
    s = s.withColumn("_step", F.when(F.col("_d") > segment_max_us, size - overlap_us).otherwise(size).cast("long"))
    s = s.withColumn("chunk_ix", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"greatest(0L, (_d - {size} + _step - 1) div _step)"))))
    at = F.col("chunk_ix") * F.col("_step")
    return s.select("file_id", "seg_ix", "spk", "chunk_ix", (F.col("start_us") + at).alias("start_us"), (F.col("start_us") + F.least(F.col("_d"), at + size)).alias("end_us"))


def segment_items(segments: DataFrame, words: DataFrame, segment_max_us: int) -> DataFrame:
    """(file_id, seg_ix, spk, start_us, end_us, dur_us, num_chunks, num_words): words carry seg_ix; segments without any count 0.

    num_chunks says how often ``segment_max_us`` fits, plus one, for longer segments; overlaps are not counted in.
    """
    counts = words.groupBy("file_id", "seg_ix").agg(F.count("*").alias("num_words"))
    d = F.greatest(F.lit(0).cast("long"), F.col("end_us") - F.col("start_us"))
    chunks = F.when(F.col("dur_us") <= segment_max_us, F.lit(1).cast("long")).otherwise(F.expr(f"dur_us div {segment_max_us} + 1"))
    items = numbered(segments).withColumn("dur_us", d).withColumn("num_chunks", chunks).join(counts, ["file_id", "seg_ix"], "left")
    return items.select("file_id", "seg_ix", "spk", "start_us", "end_us", "dur_us", "num_chunks", F.coalesce("num_words", F.lit(0)).alias("num_words"))


def assign_words(words: DataFrame, segments: DataFrame, snap_us: int, bin_us: int = 60_000_000) -> DataFrame:
    """Words with spk and snapped: the speaker who overlaps a word most, else of the two segments around it the nearer one.

    Equal overlaps go to the largest name, equal gaps to the earlier segment; a gap over ``snap_us`` leaves the word without
    speaker. As the words come in order, a segment that ended before an earlier word is out of reach for all later ones, by
    running maxima of word starts and segment ends. Overlaps join on time bins, neighbours by one window over both tables:
    neither compares all pairs of a file.
    """
    by = Window.partitionBy("file_id")
    upto = Window.unboundedPreceding, Window.currentRow
    w = words.withColumn("_w", F.max("start_us").over(by.orderBy("pos").rowsBetween(*upto)))
    s = numbered(segments).withColumn("_pm", F.max("end_us").over(by.orderBy("seg_ix").rowsBetween(*upto)))
    s = s.select("file_id", "seg_ix", "spk", F.col("start_us").alias("s0"), F.col("end_us").alias("s1"), "_pm")
    # Words sort before segments at equal times: what a word has seen are the segments whose running end lies before it.
    both = w.select("file_id", F.col("_w").alias("v"), F.lit(0).alias("kind"), "pos", F.lit(None).cast("long").alias("ix")).unionByName(
        s.select("file_id", F.col("_pm").alias("v"), F.lit(1).alias("kind"), F.lit(None).cast("long").alias("pos"), F.col("seg_ix").alias("ix")))
    seen = F.coalesce(F.max("ix").over(by.orderBy("v", "kind").rowsBetween(*upto)), F.lit(0)).alias("_last")
    w = w.join(both.select("file_id", "pos", "kind", seen).where("kind = 0").drop("kind"), ["file_id", "pos"])

    bins = lambda a, b: F.explode(F.sequence(F.floor(a / bin_us), F.floor(b / bin_us)))
    wb = w.select("file_id", "pos", "start_us", "end_us", "_last", bins(F.col("start_us"), F.greatest("start_us", "end_us")).alias("bin"))
    sb = s.where("s1 >= s0").select("file_id", "seg_ix", "spk", "s0", "s1", bins(F.col("s0"), F.col("s1")).alias("bin"))
    pairs = wb.join(sb, ["file_id", "bin"]).where(
        "seg_ix > _last AND s0 <= end_us AND least(end_us, s1) > greatest(start_us, s0)"
    ).where(F.col("bin") == F.floor(F.greatest("start_us", "s0") / bin_us))
    best = pairs.groupBy("file_id", "pos", "spk").agg(F.sum(F.least("end_us", "s1") - F.greatest("start_us", "s0")).alias("ov")).groupBy("file_id", "pos").agg(
        F.max_by("spk", F.struct("ov", "spk")).alias("_over"))

    near = s.select("file_id", "seg_ix", "spk", "s0", "s1")
    gap = lambda p: F.least(2 * F.abs(F.col("start_us") - F.col(f"{p}1")), 2 * F.abs(F.col("end_us") - F.col(f"{p}0")),
                            F.abs(F.col("start_us") + F.col("end_us") - F.col(f"{p}0") - F.col(f"{p}1")))
    left = near.select("file_id", F.col("seg_ix").alias("_last"), F.col("spk").alias("l"), F.col("s0").alias("l0"), F.col("s1").alias("l1"))
    right = near.select("file_id", (F.col("seg_ix") - 1).alias("_last"), F.col("spk").alias("r"), F.col("s0").alias("r0"), F.col("s1").alias("r1"))
    out = w.join(left, ["file_id", "_last"], "left").join(right, ["file_id", "_last"], "left").join(best, ["file_id", "pos"], "left")
    first = F.col("l").isNotNull() & (F.col("r").isNull() | (gap("l") <= gap("r")))
    snap = F.when(first, F.when(gap("l") <= 2 * snap_us, F.col("l"))).otherwise(F.when(gap("r") <= 2 * snap_us, F.col("r")))
    return out.select(*words.columns, F.coalesce("_over", snap).alias("spk"), (F.col("_over").isNull() & snap.isNotNull()).alias("snapped"))


def reassign_dropped(segments: DataFrame, dropped: DataFrame) -> DataFrame:
    """Segments where speakers in ``dropped`` (file_id, spk) give theirs to the speaker of the kept segment with the nearest
    middle, the first in order at ties; files without kept segments vanish. (file_id, seg_ix, spk, start_us, end_us)."""
    flagged = numbered(segments).join(dropped.select("file_id", "spk", F.lit(True).alias("_d")), ["file_id", "spk"], "left").withColumn("_m", F.col("start_us") + F.col("end_us"))
    # The nearest kept middles on either side come from one window each over all segments of the file, ordered by middle.
    w = Window.partitionBy("file_id").orderBy("_m", "seg_ix")
    kept = F.when(F.col("_d").isNull(), F.struct("_m", "seg_ix", "spk"))
    down = F.last(kept, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    up = F.first(kept, ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    # At one middle the first in order counts, also below.
    same = F.min(F.when(F.col("_d").isNull(), F.struct("seg_ix", "spk"))).over(Window.partitionBy("file_id", "_m"))
    two = flagged.withColumn("_same", same).withColumns({"_down": down, "_up": up})
    firsts = flagged.where("_d IS NULL").groupBy("file_id", "_m").agg(F.min(F.struct("seg_ix", "spk")).alias("_first"))
    d = firsts.select("file_id", F.col("_m").alias("_dm"), F.col("_first").alias("_df"))
    two = two.withColumn("_dm", F.col("_down._m")).join(d, ["file_id", "_dm"], "left")
    dd, du = F.col("_m") - F.col("_down._m"), F.col("_up._m") - F.col("_m")
    below = F.col("_up").isNull() | (F.col("_down").isNotNull() & ((dd < du) | ((dd == du) & (F.col("_df.seg_ix") < F.col("_up.seg_ix")))))
    nearest = F.coalesce(F.col("_same.spk"), F.when(below, F.col("_df.spk")).otherwise(F.col("_up.spk")))
    out = two.select("file_id", F.when(F.col("_d").isNull(), F.col("spk")).otherwise(nearest).alias("spk"), "start_us", "end_us").where("spk IS NOT NULL")
    return numbered(out)


def pack_chunks(intervals: DataFrame, max_us: int = 22_000_000, min_us: int = 15_000_000, strict_us: int = 30_000_000, least_us: int = 200_000, lengths: DataFrame | None = None) -> DataFrame:
    """(file_id, chunk_ix, part_ix, start_us, end_us) from merged speech intervals, in order.

    A chunk closes before an interval that would make it longer than ``max_us``, or once it is longer than ``min_us``; it
    starts at 0 in a file, and later at its first interval. Chunks over ``strict_us`` are cut into equal parts, with ends
    rounded down to whole microseconds; one of at most ``least_us`` that would be the last is dropped. With ``lengths`` (file_id,
    total_us) intervals end where their file's audio does at the latest.
    """
    if lengths is not None:
        intervals = intervals.join(lengths.select("file_id", "total_us"), "file_id").withColumn("end_us", F.least("end_us", "total_us"))

    def step(state: tuple[int, int, int] | None, values: tuple) -> tuple[tuple[int, int, int], tuple]:
        chunk, a, b = state or (0, 0, 0)
        start, end = values
        if b - a > least_us and (end - a > max_us or b - a > min_us):
            chunk, a = chunk + 1, max(0, start)
        return (chunk, a, end), (chunk, a)

    each = scanned(intervals.select("file_id", "start_us", "end_us"), "file_id", ["start_us", "end_us"], ["start_us", "end_us"], step, "chunk_ix int, a long")
    chunks = each.groupBy("file_id", "chunk_ix", "a").agg(F.max_by("end_us", F.struct("start_us", "end_us")).alias("b"))
    # Only the last chunk of a file can be as short as this: others were closed because they were longer.
    chunks = chunks.where(F.col("b") - F.col("a") > least_us)
    n = F.when(F.col("b") - F.col("a") > strict_us, F.expr(f"(b - a) div {strict_us} + 1")).otherwise(1)
    parts = chunks.withColumn("n", n).withColumn("part_ix", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n").cast("long") - 1)))
    return parts.select("file_id", "chunk_ix", "part_ix", F.expr("a + (b - a) * part_ix div n").alias("start_us"), F.expr("a + (b - a) * (part_ix + 1) div n").alias("end_us"))
