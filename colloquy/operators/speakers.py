"""Speaker verdicts and names from shares (file_id, spk, share, first_seg_ix)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def verdict(shares: DataFrame, third_max: float = 0.10, eps: float = 0.05, min_dominant: float = 0.0, max_speakers: int = 3, enabled: bool = True, files: DataFrame | None = None) -> DataFrame:
    """(file_id, n_speakers, status, reason, keep, dropped) with keep and dropped as sorted names joined by commas.

    One or two speakers are kept if the larger share reaches ``min_dominant``. Of three, shares within ``eps`` (exclusive)
    reject the file; else the smallest, the later one at ties, is dropped if it is at most ``third_max``, or the file is
    rejected. More than three, or than ``max_speakers``, reject it. Disabled, all are kept with the reason ``disabled``. Of
    ``files`` (file_id), those that have no speaker are rejected too, with no_speakers.
    """
    if files is not None:
        ruled = verdict(shares, third_max, eps, min_dominant, max_speakers, enabled)
        n, okay = F.coalesce("n_speakers", F.lit(0)), F.lit(not enabled)
        status = F.coalesce("status", F.when(okay, "OK").otherwise("BAD_SAMPLE"))
        reason = F.when(F.col("status").isNotNull(), F.col("reason")).when(okay, "disabled").otherwise("no_speakers")
        empty = (F.coalesce(c, F.lit("")).alias(c) for c in ("keep", "dropped"))
        return files.select("file_id").join(ruled, "file_id", "left").select("file_id", n.alias("n_speakers"), status.alias("status"), reason.alias("reason"), *empty)
    ranked = shares.withColumn("k", F.row_number().over(Window.partitionBy("file_id").orderBy(F.desc("share"), "first_seg_ix")))
    files = ranked.groupBy("file_id").agg(
        F.count("*").alias("n"), F.max("share").alias("hi"), F.min("share").alias("lo"),
        F.max(F.when(F.col("k") == 3, F.col("share"))).alias("third"), F.max(F.when(F.col("k") == 3, F.col("spk"))).alias("third_spk"),
        F.array_sort(F.collect_list("spk")).alias("all"),
    )
    n = F.col("n")
    if not enabled:
        return files.select("file_id", n.alias("n_speakers"), F.lit("OK").alias("status"), F.lit("disabled").alias("reason"), F.array_join("all", ",").alias("keep"), F.lit("").alias("dropped"))
    reason = (
        F.when(n > F.lit(min(3, max_speakers)), F.concat(F.lit("too_many_speakers:"), n.cast("string")))
        .when((n == 1) & (F.col("hi") < min_dominant), F.lit("single_speaker_low_share"))
        .when((n == 2) & (F.col("hi") < min_dominant), F.lit("two_speakers_low_dominance"))
        .when((n == 3) & (F.col("hi") - F.col("lo") < eps), F.lit("three_speakers_equal_shares"))
        .when((n == 3) & (F.col("third") > third_max), F.lit("three_speakers_no_small_third"))
    )
    drop = reason.isNull() & (n == 3)
    keep = F.when(reason.isNotNull(), F.lit("")).when(drop, F.array_join(F.array_remove("all", F.col("third_spk")), ",")).otherwise(F.array_join("all", ","))
    return files.select("file_id", n.alias("n_speakers"), F.when(reason.isNull(), "OK").otherwise("BAD_SAMPLE").alias("status"), reason.alias("reason"),
                        keep.alias("keep"), F.when(drop, F.col("third_spk")).otherwise(F.lit("")).alias("dropped"))


def ranked_names(shares: DataFrame) -> DataFrame:
    """(file_id, spk, norm): Spk0 has the largest share; ties by name."""
    k = F.row_number().over(Window.partitionBy("file_id").orderBy(F.desc("share"), "spk")) - 1
    return shares.select("file_id", "spk", F.concat(F.lit("Spk"), k.cast("string")).alias("norm"))
