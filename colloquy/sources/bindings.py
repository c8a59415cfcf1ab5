"""Stand-ins for speech data out of the driver's tables: an hour of ``events`` plays as a second."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MICROS = "timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts) div 3600"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts", F.expr(MICROS).alias("t"))


def words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even events: (file_id, pos, word, start_us, end_us)."""
    e = _events(spark, sf_dir).where("event_id % 2 = 0")
    return e.selectExpr("user_id AS file_id", "row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos", "event_type AS word",
                        "t AS start_us", "t + cast(round(value * 100) AS bigint) * 100 AS end_us", "event_id").withColumn("pos", F.col("pos").cast("long"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd events: (file_id, spk, start_us, end_us)."""
    e = _events(spark, sf_dir).where("event_id % 2 = 1")
    return e.selectExpr("user_id AS file_id", "'speaker_' || cast((event_id div 2) % 3 AS string) AS spk", "t AS start_us", "t + cast(round(value * 100) AS bigint) * 2000 AS end_us")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").selectExpr("conv_id AS file_id", "turn AS pos", "role AS speaker", "text")


def event_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.selectExpr("user_id AS file_id", "struct(ts, event_id) AS pos", "event_type AS speaker", "cast(event_id AS string) AS text")


def journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line per event: the type decides the status."""
    e = table(spark, sf_dir, "events")
    status = F.element_at(F.array(*map(F.lit, ("SUCCESS", "BAD_SAMPLE", "FAILED", "SKIPPED", "FAILED"))), (F.col("event_id") % 5 + 1).cast("int"))
    return e.select(F.col("event_id").alias("line_no"), F.concat(F.lit("/audio/"), F.col("user_id").cast("string"), F.lit(".wav")).alias("input_path"), status.alias("status"))


def inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.concat(F.lit("/audio/"), F.col("c_custkey").cast("string"), F.lit(".wav")).alias("input_path"), (F.col("c_custkey") % 997).cast("string").alias("id"))


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """64 numbers as 16 frames of 4 classes: (file_id, labels), the first largest class of each frame; class 3 is blank."""
    label = "transform(sequence(0, 15), t -> array_position(slice(embedding, t * 4 + 1, 4), array_max(slice(embedding, t * 4 + 1, 4))) - 1)"
    return table(spark, sf_dir, "embeddings").selectExpr("vec_id AS file_id", f"{label} AS labels")
