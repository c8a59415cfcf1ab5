"""Optional streaming: a manifest folder read as a stream, its checkpoint in place of the journal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from colloquy.functions import stem
from colloquy.sources.files import MANIFEST


def manifest_stream(spark: SparkSession, folder: str) -> DataFrame:
    """(path, id, duration_sec) of JSON-lines manifests as they arrive."""
    rows = spark.readStream.schema(MANIFEST).json(folder)
    return rows.withColumn("id", F.coalesce(F.nullif(F.col("id"), F.lit("")), stem(F.col("path"))))


def run_new(stream: DataFrame, work: Callable[[DataFrame], None], checkpoint: str) -> StreamingQuery:
    """Hands what is new to ``work``, once per batch, and ends when all is done."""
    return stream.writeStream.foreachBatch(lambda batch, _: work(batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
