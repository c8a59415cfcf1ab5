"""Manifests, journals, transcripts and audio in files; order is an explicit column wherever it matters."""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.functions import SPACE, stem, stripped
from colloquy.sources.items import system_of, write_items

MANIFEST = "path string, id string, duration_sec double"
TRANSCRIPT = "file_id string, audio_path string, status string, turns array<struct<speaker:string,start:double,`end`:double,text:string>>"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value) of the lines that are not blank: line_no numbers them from 0, in the order of file names and, within a file, of lines.

    A file's splits are read in parallel and each of them in order, so a line's place is that in its split plus the lines of
    all splits before it: one row a split is summed, and no line is sorted.
    """
    order = ["file", "block"]
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")).where(stripped(F.col("value")) != "")
    lines = lines.withColumn("at", F.monotonically_increasing_id())
    splits = lines.groupBy(*order).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)  # one row for each split of a file
    splits = splits.select(*order, (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("start"))
    return lines.join(splits, order).select("file", (F.col("start") + F.col("at")).alias("line_no"), "value")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(source_index, path, id, duration_sec): a path per line in .txt, else JSON lines; an empty id becomes the path's stem.

    ``path`` is a file or a folder, whose files follow each other by name; source_index numbers the items from 0.
    """
    lines = read_lines(spark, path)
    if path.endswith(".txt"):
        rows = lines.select("line_no", stripped(F.col("value")).alias("path"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("double").alias("duration_sec"))
    else:
        rows = lines.select("line_no", F.from_json("value", MANIFEST).alias("x")).select("line_no", "x.*")
    return rows.select(F.col("line_no").alias("source_index"), "path", F.coalesce(F.nullif(F.col("id"), F.lit("")), stem(F.col("path"))).alias("id"), "duration_sec")


def read_glob(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """(path, relative, id, bytes, mtime) of the files below ``folder`` that match, by path; contents are not read.

    The reader passes over files of no bytes.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    plain = F.regexp_replace("path", "^file:/*", "/")
    root = "/" + re.sub("^file:/*|^/", "", folder).rstrip("/") + "/"
    below = F.when(plain.startswith(root), F.substring(plain, F.lit(len(root) + 1), F.char_length(plain))).otherwise(plain)
    return files.orderBy("path").select(plain.alias("path"), below.alias("relative"), stem(plain).alias("id"), F.col("length").alias("bytes"), F.col("modificationTime").alias("mtime"))


def with_digests(files: DataFrame) -> DataFrame:
    """Adds md5, that of a file's whole content, to (path, …), and reads each file once, in pieces of a MiB; null for what cannot be read."""
    names = files.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for path in batch.column("path").to_pylist():
                system, place = system_of(path)
                digest = hashlib.md5(usedforsecurity=False)
                try:
                    with system.open_input_stream(place, compression=None) as f:
                        while piece := f.read(1 << 20):
                            digest.update(piece)
                    made.append(digest.hexdigest())
                except OSError:
                    made.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.string())], [*names, "md5"])

    return files.mapInArrow(run, T.StructType([*files.schema.fields, T.StructField("md5", T.StringType())]))


def resolved(rows: DataFrame, folder: str) -> DataFrame:
    """Relative paths under ``folder``."""
    return rows.withColumn("path", F.when(F.col("path").startswith("/"), F.col("path")).otherwise(F.concat(F.lit(folder.rstrip("/") + "/"), F.col("path"))))


def read_journal(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, input_path, status, reason) of an append-only JSON-lines journal; line_no has an order, that of the lines.

    Lines say in which run they were written and as which of its lines. Journals without that are in the order of their files'
    times, which copying may change, then names and, within a file, of its lines.
    """
    fields = "input_path string, status string, reason string, run string, ordinal long"
    place = F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = spark.read.text(path).select(place.alias("t"), F.monotonically_increasing_id().alias("i"), F.from_json("value", fields).alias("x"))
    at = F.struct(F.coalesce("x.run", F.lit("")).alias("run"), F.when(F.col("x.run").isNull(), F.col("t")).alias("time"), F.coalesce("x.ordinal", "i").alias("ordinal"))
    return lines.where("x.input_path IS NOT NULL").select(at.alias("line_no"), "x.input_path", "x.status", "x.reason")


def append_journal(rows: DataFrame, path: str, config: str | None = None) -> dict[str, int]:
    """Appends a line for every row, and gives the number of lines by status. Columns other than these are optional.

    Each call is a run: its id begins with the time, so ids sort as runs do. Lines without times get the run's, in UTC. ``config``
    is the run's configuration as JSON, which must hold no secret. Lines are counted while they are written.
    """
    now = datetime.now(timezone.utc).isoformat(timespec="microseconds")
    own = ["input_path", "id", "started_at", "finished_at", "status", "reason", "shares", "speakers"]
    stamps = {c: F.coalesce(*([F.col(c)] if c in rows.columns else []), F.lit(now)) for c in ("started_at", "finished_at")}
    rows = rows.withColumns(stamps)
    more = [F.from_json(F.lit(config), F.schema_of_json(F.lit(config))).alias("config")] if config else []
    lines = rows.select(F.lit(f"{now}-{uuid.uuid4().hex[:8]}").alias("run"), F.monotonically_increasing_id().alias("ordinal"), *(c for c in own if c in rows.columns), *more)
    seen = Observation()
    lines.observe(seen, *(F.count_if(F.col("status") == s).alias(s) for s in STATES)).write.mode("append").json(path)
    return {s: n for s, n in sorted(seen.get.items()) if n}


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """(file_id, pos, speaker, text), a row per turn; documents without a list of turns give none."""
    docs = spark.read.schema(TRANSCRIPT).option("multiLine", "true").json(path)
    name = stem(F.col("_metadata.file_path"))
    return docs.select(F.coalesce("file_id", name).alias("file_id"), F.posexplode("turns").alias("pos", "t")).select("file_id", "pos", "t.speaker", "t.text")


def turn_counts(spark: SparkSession, path: str) -> DataFrame:
    """(file_id, turns) of every document, 0 where it has no list of turns."""
    docs = spark.read.schema(TRANSCRIPT).option("multiLine", "true").json(path)
    name = stem(F.col("_metadata.file_path"))
    return docs.select(F.coalesce("file_id", name).alias("file_id"), F.coalesce(F.size("turns"), F.lit(0)).alias("turns")).withColumn("turns", F.greatest("turns", F.lit(0)).cast("long"))


def most_turns(counts: DataFrame, limit: int | None = None) -> DataFrame:
    """(file_id, turns) with most turns first, ties by id; the first ``limit`` of them, all for None. Negative limits are errors."""
    if limit is not None and limit < 0:
        raise ValueError("the limit must be at least 0")
    ordered = counts.orderBy(F.desc("turns"), "file_id")
    return ordered if limit is None else ordered.limit(limit)


#: An item's states, and the documents of a successful item, by column and folder.
STATES = ("SUCCESS", "BAD_SAMPLE", "FAILED", "SKIPPED")
OUTPUTS = {"transcript": "transcripts", "meta_asr": "meta_asr", "meta_diar": "meta_diar"}


def write_results(results: DataFrame, folder: str, places: dict[str, str] | None = None, config: str | None = None, item_files: bool = False) -> dict[str, int]:
    """A SUCCESS row's documents, those of OUTPUTS that are columns, under their folders or those of ``places``; every row's status in ``journal``.

    Documents are JSON lines in part files or, with ``item_files``, a file for each item and output (see ``colloquy.sources.items``).
    BAD_SAMPLE lines carry shares and speakers, where there is a meta_diar. The frame is evaluated once for each output: write
    model results to a table first. A commit covers one output, or with ``item_files`` all of them; the journal comes last, so what
    it names exists. Gives the number of rows by status.
    """
    folders = {column: (places or {}).get(column) or f"{folder}/{name}" for column, name in OUTPUTS.items() if column in results.columns}
    good = results.where("status = 'SUCCESS'")
    if item_files:
        write_items(good, {c: os.path.relpath(p, folder) for c, p in folders.items()}, folder)
    else:
        for column, place in folders.items():
            good.select("id", f"{column}.*").write.mode("append").json(place)
    if "meta_diar" in results.columns:
        bad = F.col("status") == "BAD_SAMPLE"
        results = results.withColumns({c: F.when(bad, F.col(f"meta_diar.{c}")) for c in ("shares", "speakers")})
    return append_journal(results, f"{folder}/journal", config)


def duration_manifest(files: DataFrame, drop_zero: bool = False) -> DataFrame:
    """(path, duration_sec, duration_source, bytes, mtime, id) in the order (duration_sec, path).

    A duration that is missing, not a number or negative counts as 0, from the source ``none``; ``drop_zero`` drops those of 0.
    """
    bad = F.col("duration_sec").isNull() | F.isnan("duration_sec") | (F.col("duration_sec") < 0)
    source = F.col("duration_source") if "duration_source" in files.columns else F.lit("header")
    rows = files.withColumns({"duration_source": F.when(bad, "none").otherwise(source), "duration_sec": F.when(bad, 0.0).otherwise(F.col("duration_sec"))})
    rows = rows.where("duration_sec > 0") if drop_zero else rows
    return rows.select("path", "duration_sec", "duration_source", "bytes", "mtime", "id").orderBy("duration_sec", "path")


def manifest_counts(files: DataFrame, drop_zero: bool = False) -> DataFrame:
    """One row (written, dropped_zero)."""
    usable = F.coalesce(F.col("duration_sec") > 0, F.lit(False)) & ~F.coalesce(F.isnan("duration_sec"), F.lit(False))
    dropped = F.count_if(~usable) if drop_zero else F.lit(0).cast("long")
    return files.agg(F.count("*").alias("n"), dropped.alias("dropped_zero")).select((F.col("n") - F.col("dropped_zero")).alias("written"), "dropped_zero")


def write_manifest(rows: DataFrame, path: str) -> None:
    """Sorted JSON lines; part files are in the order of their names."""
    rows.write.mode("overwrite").json(path)


def write_dialogs(rows: DataFrame, path: str) -> None:
    """Dialog rows as one array of speaker -> text maps per dialog."""
    maps = rows.groupBy("file_id", "row_ix").agg(F.map_from_entries(F.collect_list(F.struct("speaker", "text"))).alias("row"))
    maps.groupBy("file_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("row_ix", F.to_json("row").alias("row")))), lambda x: x["row"]).alias("rows")).write.mode("overwrite").json(path)


def parse_segment_line(line: Column) -> Column:
    """``start end speaker`` -> struct(spk, start_us, end_us); null where the line is none or ends before it begins."""
    pattern = rf"^{SPACE}*([0-9]+(?:\.[0-9]+)?){SPACE}+([0-9]+(?:\.[0-9]+)?){SPACE}+(\S+){SPACE}*$"
    a, b = F.regexp_extract(line, pattern, 1), F.regexp_extract(line, pattern, 2)
    micros = lambda x: F.round(x.try_cast("decimal(20,9)") * 1_000_000).cast("long")
    return F.when(micros(b) > micros(a), F.struct(F.regexp_extract(line, pattern, 3).alias("spk"), micros(a).alias("start_us"), micros(b).alias("end_us")))
