"""Exact dedup by Grace hashing: partition records to spill files, recursively, until a bucket's distinct contents fit an
open-addressing table that compares complete contents.

Two passes keep hot groups apart. The first runs inside each input partition without a shuffle, so a text that holds a
third of all rows shrinks to one record per partition. The second shuffles these records by their hash and runs the same
algorithm again; a text meets there once per input partition at most.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.shared import WHITE, aside, must_differ, names_but, plain_name, quoted, small_batches, spread_join, written

#: Bytes of distinct contents in a table before its bucket is split.
TABLE_BYTES = 48 << 20
#: Buckets of one split: 4 bits of the hash a level, so 16 levels use up the 64 bits.
FAN_BITS, LEVELS = 4, 16


class OpenTable:
    """Linear probing over (hash, complete content); an entry keeps the smallest id that it has seen."""

    def __init__(self):
        self.slots, self.mask = [-1] * 1024, 1023
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.least: list[int] = []
        self.held = 0

    def put(self, key: int, content: bytes, ident: int) -> int:
        """The entry's number."""
        at = (key ^ key >> 32) & self.mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == key and self.contents[entry] == content:
                if ident < self.least[entry]:
                    self.least[entry] = ident
                return entry
            at = at + 1 & self.mask
        entry = self.slots[at] = len(self.hashes)
        self.hashes.append(key)
        self.contents.append(content)
        self.least.append(ident)
        self.held += len(content) + 100
        if 2 * len(self.hashes) > self.mask:
            self._double()
        return entry

    def _double(self) -> None:
        self.mask = 2 * self.mask + 1
        self.slots = [-1] * (self.mask + 1)
        for entry, key in enumerate(self.hashes):
            at = (key ^ key >> 32) & self.mask
            while self.slots[at] >= 0:
                at = at + 1 & self.mask
            self.slots[at] = entry


#: Columns and rows of the batches that come back.
NAMES, ROWS = ["ident", "least", "hash", "content"], 512

Record = pa.RecordBatch  # of: hash int64, ident int64, content binary


def _read(path: str) -> Iterator[Record]:
    if os.path.exists(path):
        with pa.ipc.open_stream(path) as stream:
            yield from stream


def grace(batches: Iterable[Record], limit: int = TABLE_BYTES, level: int = 0, folder: str | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, OpenTable]]:
    """Yields (idents, the numbers of their entries, the table), for all records, a batch and a bucket at a time.

    A bucket's records go to a file and its distinct contents to a table; once these pass ``limit`` all records go to spill
    files by the next bits of the hash, and each file is a bucket of its own. What is kept of a record besides is its id and
    its entry's number, in a second file that is read back when the table is complete. So copies never make a bucket larger,
    in memory at least, and a single text in any number of copies needs one entry. Only contents that share all 64 bits of
    their hash stay together beyond the limit.
    """
    own = tempfile.mkdtemp(prefix="grace-", dir=folder)
    try:
        table, source, log, sink = OpenTable(), iter(batches), os.path.join(own, "log"), None
        found, pairs = os.path.join(own, "entries"), None
        over = False
        for batch in source:
            if sink is None:
                sink = pa.ipc.new_stream(log, batch.schema, options=pa.ipc.IpcWriteOptions(compression="lz4"))
                pairs = pa.ipc.new_stream(found, pa.schema([("ident", pa.int64()), ("entry", pa.int64())]))
            sink.write_batch(batch)
            entries = [table.put(key & 0xFFFFFFFFFFFFFFFF, content, ident) for key, ident, content in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            pairs.write_batch(pa.RecordBatch.from_arrays([batch.columns[1], pa.array(entries, pa.int64())], ["ident", "entry"]))
            if table.held > limit and level < LEVELS:
                over = True
                break
        if sink is not None:
            sink.close()
            pairs.close()
        if not over:
            for batch in _read(found):
                yield *(c.to_numpy() for c in batch.columns), table
            return
        del table
        os.remove(found)
        sinks: dict[int, pa.ipc.RecordBatchStreamWriter] = {}
        for batch in _then(_read(log), source):
            keys = batch.columns[0].to_numpy().view(np.uint64)
            buckets = (keys >> np.uint64(64 - FAN_BITS * (level + 1)) & np.uint64((1 << FAN_BITS) - 1)).astype(np.int64)
            for k in np.unique(buckets).tolist():
                if k not in sinks:
                    sinks[k] = pa.ipc.new_stream(os.path.join(own, str(k)), batch.schema, options=pa.ipc.IpcWriteOptions(compression="lz4"))
                sinks[k].write_batch(batch.take(pa.array(np.nonzero(buckets == k)[0])))
        for stream in sinks.values():
            stream.close()
        os.remove(log)
        for k in sorted(sinks):
            yield from grace(_read(os.path.join(own, str(k))), limit, level + 1, own)
            os.remove(os.path.join(own, str(k)))
    finally:
        shutil.rmtree(own, ignore_errors=True)


def _then(first: Iterator[Record], second: Iterator[Record]) -> Iterator[Record]:
    yield from first
    yield from second


def _grouped(records: DataFrame, limit: int, contents: bool) -> DataFrame:
    """(hash, ident, content) of a partition -> (ident, least[, hash, content]).

    least is the smallest id of an equal content in that partition; with ``contents`` its own row carries hash and content.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for idents, entries, table in grace(batches, limit):
            least = np.fromiter(map(table.least.__getitem__, entries.tolist()), dtype=np.int64, count=len(entries))
            for a in range(0, len(idents), ROWS):
                part, own, at = idents[a : a + ROWS], least[a : a + ROWS], entries[a : a + ROWS].tolist()
                made = [pa.array(part), pa.array(own)]
                if contents:
                    first = (part == own).tolist()
                    keys = [table.hashes[e] if f else None for e, f in zip(at, first, strict=True)]
                    made.append(pa.array([k - (1 << 64) if k is not None and k >> 63 else k for k in keys], pa.int64()))
                    made.append(pa.array([table.contents[e] if f else None for e, f in zip(at, first, strict=True)], pa.binary()))
                yield pa.RecordBatch.from_arrays(made, NAMES[: len(made)])

    return records.mapInArrow(run, "ident long, least long" + ", hash long, content binary" * contents)


def exact_dedup(df: DataFrame, ident: str = "doc_id", text: str = "text", limit: int = TABLE_BYTES) -> DataFrame:
    """Adds keep_id, group_size, kept and text_sha256 to every row of ``df``; equal-named columns are replaced, all others pass
    through whatever their names.

    Texts are equal when they are identical after each run of ASCII white space became one space; null counts as empty, so
    null, empty and no other texts form one group (a text of spaces alone is one space). The row with the smallest id stays,
    null ids last; of repeated rows with one id the first read stays, and exactly one row of each group is kept. Whole texts
    are compared, however long, in UTF-8, where bytes that are none count as U+FFFD. An empty table gives an empty result.
    """
    added = ["keep_id", "group_size", "kept", "text_sha256"]
    must_differ(df, text, *added)
    small_batches(df.sparkSession)
    there, back = aside(df, added)
    plain = F.regexp_replace(F.coalesce(F.col("plain"), F.lit("")), WHITE, " ")
    # The rows get their ids once, in a table: later stages agree on them even if a task runs again.
    source = df.select(*there, *(c.alias(n) for c, n in zip(quoted([ident, text]), ("id", "plain"), strict=True))).withColumn("plain", plain)
    names = [f"c{k}" for k in range(len(there))]
    rows = written(source.select(*names, "id", F.monotonically_increasing_id().alias("uid"), F.sha2("plain", 256).alias("text_sha256"), F.xxhash64("plain").alias("hash")), "exact-rows")
    content = F.col(names[[plain_name(df, c) for c in names_but(df, added)].index(plain_name(df, text))])
    record = rows.withColumn("plain", content).select("hash", F.col("uid").alias("ident"), F.encode(plain, "UTF-8").alias("content"))
    local = written(_grouped(record, limit, True), "exact-local")
    record = local.where("ident = least").select("hash", "ident", "content")
    classes = _grouped(record.repartition(F.col("hash")), limit, False).select(F.col("ident").alias("local"), F.col("least").alias("class"))

    pairs = local.select(F.col("ident").alias("uid"), F.col("least").alias("local"))
    order = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("uid"))
    within = rows.select("id", "uid").join(pairs, "uid").groupBy("local").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    within = written(within.join(classes, "local"), "exact-within")
    found = within.groupBy("class").agg(F.min("first").alias("first"), F.sum("n").alias("group_size"), F.count("*").alias("n"))
    # The small tables meet first, and decide what is kept; texts are joined, and shuffled, once.
    found = spread_join(within.select("class", "local", F.col("n").alias("rows")), written(found, "exact-classes"), ["class"])
    found = spread_join(pairs, written(found.select("local", F.col("rows").alias("n"), "first", "group_size"), "exact-found"), ["local"])
    found = found.select("uid", F.col("first.id").alias("keep_id"), "group_size", (F.col("uid") == F.col("first.uid")).alias("kept"))
    return rows.join(found, "uid").select(*back, *added)
