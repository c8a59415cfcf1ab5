"""WARC archives: a deterministic sharded writer, and its reader.

Records are put in one order, by id, payload and url, and cut into shards of about equal size where running sums of their
sizes say so; what a file holds therefore follows from the rows alone, not from how Spark split them. Each shard is one
task's stream: it writes files that are rolled by their compressed size, every record a gzip member of its own, with headers and
digests made anew. Payloads of some length that occur again are written once; the others are ``revisit`` records that refer to it.

Only payloads to be written are moved, and once: all else is planned on ids and digests. Files are written under temporary
names, one folder for each attempt of a task; the attempts that Spark commits are named in a table, from which a second job
moves the files to their names. The manifest is written last. Readers read what it lists, and check sizes and digests.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from colloquy.llm.shared import HOT, quoted, raw, small_batches, spread_join, written

#: Bytes before compression in a shard at least, shards at most, and compressed bytes after which a file is full.
SHARD, SHARDS, ROLL = 16 << 20, 65_536, 256 << 20
#: Bytes from which equal payloads are written once; bytes that a record's headers are taken for; records of one key planned together.
REVISIT_FROM, HEADERS, CHUNK = 1000, 512, 10_000
DATE = "1970-01-01T00:00:00Z"
#: The profile of revisits by digest, and names of fields.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SOURCE = "X-Source-Id"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

_KEY = ["id", "sha256", "uri", "chunk"]
_FILES = "shard int, part int, name string, temporary string, records long, bytes long, sha256 string"


def _sha1(content: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(content).digest()).decode()


def record_id(ident: int | None, uri: bytes | None, sha256: str, nth: int) -> str:
    name = b"\x00".join([str(ident).encode(), b"-" if uri is None else b"=" + uri, sha256.encode(), str(nth).encode()])
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha1(name).digest()[:16], version=5)}>"


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as a gzip member of its own."""
    head = "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("WARC-Block-Digest", _sha1(block)), ("Content-Length", str(len(block)))])
    return gzip.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n", mtime=0)


def _uri(uri: bytes | None) -> str:
    """Bytes that a header line cannot hold are percent-encoded."""
    return "about:blank" if uri is None else quote(uri, safe="!#$%&'()*+,-./:;=?@[]_~")


def _fields(kind: str, ident: int | None, uri: bytes | None, digest: str, name: str, date: str) -> list[tuple[str, str]]:
    own = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", date), ("WARC-Target-URI", _uri(uri)), ("WARC-Payload-Digest", digest), ("Content-Type", "application/http; msgtype=response")]
    return own if ident is None else [*own, (SOURCE, str(ident))]


class Files:
    """The files of a task: the one that is open, its shard, and what was written; a full one is closed before the next record."""

    def __init__(self, where: str, prefix: str, roll: int, date: str):
        self.system, self.top = fs.FileSystem.from_uri(where)
        self.prefix, self.roll, self.date = prefix, roll, date
        self.folder = f"_temporary/{uuid.uuid4().hex}"
        self.shard, self.stream, self.done = -1, None, []
        self.system.create_dir(f"{self.top}/{self.folder}", recursive=True)

    def put(self, shard: int, content: bytes) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.part = shard, 0
        elif self.stream and self.bytes >= self.roll:
            self.close()
            self.part += 1
        if not self.stream:
            self.name = f"{self.prefix}-{shard:05d}-{self.part:05d}.warc.gz"
            self.stream = self.system.open_output_stream(f"{self.top}/{self.folder}/{self.name}", compression=None)
            self.records, self.bytes, self.digest = 0, 0, hashlib.sha256()
            about = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(None, self.name.encode(), "", 0)), ("WARC-Date", self.date), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")]
            self._write(record(about, b"format: WARC File Format 1.1\r\n"))
        self._write(content)
        self.records += 1

    def _write(self, content: bytes) -> None:
        self.stream.write(content)
        self.bytes += len(content)
        self.digest.update(content)

    def close(self) -> None:
        if self.stream:
            self.stream.close()
            self.stream = None
            self.done.append((self.shard, self.part, self.name, f"{self.folder}/{self.name}", self.records, self.bytes, self.digest.hexdigest()))

    def take(self) -> pa.RecordBatch:
        done, self.done = self.done, []
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        columns = list(zip(*done, strict=True)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [f.split()[0] for f in _FILES.split(", ")])


def _planned(df: DataFrame, ident: str, url: str, payload: str, shard: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(plan, hot, pages): the records in order with their shards, hot payloads with the key of their response, and the rows by key.

    A row of the plan stands for up to CHUNK records of equal rows: ``responses`` and ``revisits`` of them.
    """
    content = raw(df, payload)
    keys = [quoted([ident])[0].cast("long").alias("id"), quoted([url])[0].cast("string").cast("binary").alias("uri"), F.sha2(content, 256).alias("sha256")]
    size = F.octet_length(content).cast("long")
    pages = df.select(*keys, size.alias("bytes"), content.alias("payload"))
    short = F.when(F.col("bytes") < REVISIT_FROM, F.col("payload"))
    rows = pages.select("id", "uri", "sha256", F.sha1("payload").alias("sha1"), "bytes", short.alias("payload"))
    rows = written(rows.groupBy(*rows.columns).agg(F.count("*").alias("times")), "warc-rows")
    groups = written(rows.groupBy("sha256").agg(F.max(F.struct("id", "uri")).alias("top"), F.count("*").alias("n")), "warc-groups")
    total = rows.count()
    hot = groups.where(F.col("n") * HOT > total).where("n > 1").select("sha256", "top")
    chunk = F.explode(F.expr(f"sequence(0L, (times - 1) div {CHUNK})")).alias("chunk")
    plan = spread_join(rows, groups, ["sha256"], total=total).select("*", chunk).withColumn("n", F.expr(f"least({CHUNK}L, times - chunk * {CHUNK})"))
    first = (F.struct("id", "uri").eqNullSafe(F.col("top")) & (F.col("chunk") == 0)).cast("long")
    plan = plan.withColumn("responses", F.when(F.col("bytes") < REVISIT_FROM, F.col("n")).otherwise(first)).withColumn("revisits", F.col("n") - F.col("responses")).drop("times", "n")
    plan = plan.withColumn("cost", F.col("responses") * F.col("bytes") + (F.col("responses") + F.col("revisits")) * HEADERS)
    plan = written(plan.repartitionByRange(*_KEY).withColumn("range", F.spark_partition_id()), "warc-plan")
    sums = plan.groupBy("range").agg(F.sum("cost").alias("cost"))
    # One row for each range that was sorted.
    starts = sums.select("range", F.coalesce(F.sum("cost").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    before = Window.partitionBy("range").orderBy(*_KEY).rowsBetween(Window.unboundedPreceding, -1)
    each = max(shard, (plan.agg(F.coalesce(F.sum("cost"), F.lit(0))).first()[0]) // SHARDS + 1)
    at = F.expr(f"int((start + ahead) div {each})")
    plan = plan.withColumn("ahead", F.coalesce(F.sum("cost").over(before), F.lit(0))).join(starts, "range").withColumn("shard", at)
    return written(plan.drop("range", "cost", "ahead", "start"), "warc-shards"), hot, pages


def _place(ident: int | None, sha256: str, uri: bytes | None, chunk: int) -> tuple:
    """A key in Spark's order, nulls first."""
    return ident is not None, ident or 0, sha256, uri is not None, uri or b"", chunk


def write_warc(df: DataFrame, path: str, ident: str = "page_id", url: str = "url", payload: str = "html", prefix: str = "pages", shard: int = SHARD, roll: int = ROLL, date: str = DATE) -> DataFrame:
    """Writes a record for every row of ``df`` to the folder ``path``; gives the manifest (shard, part, name, records, bytes, sha256).

    Of rows with equal payloads of REVISIT_FROM bytes or more, that with the largest id (then url) is a ``response``, the others are
    ``revisit`` records that refer to it; of rows that repeat all of these one is the response. All shorter payloads are responses. Null
    payloads are empty, null urls ``about:blank``, null ids have no id in the record and are the smallest; ids are whole numbers.
    Payloads are bytes and need not be UTF-8; each is held in memory by itself. Other columns are ignored, whatever their names.
    An empty table gives a manifest without files. ``df`` is read twice, so it should be a table, and an error says so where its
    readings differ. All files come out the same, to the byte, however the rows are split and in whatever order they are read.

    ``path`` is a folder that all executors share and that pyarrow can write to (file, hdfs, s3, gs); a folder with a manifest
    is not written again, and what runs that died have left in one without is replaced.
    """
    spark = df.sparkSession
    small_batches(spark)
    top = fs.FileSystem.from_uri(path)
    if top[0].get_file_info(f"{top[1]}/manifest/_SUCCESS").type != fs.FileType.NotFound:
        raise FileExistsError(f"{path} has a manifest")
    plan, hot, pages = _planned(df, ident, url, payload, shard)
    # No more than SHARDS rows: the first key of each shard.
    firsts = plan.groupBy("shard").agg(F.min(F.struct(*_KEY)).alias("first")).orderBy("shard").collect()
    bounds = [_place(r.first["id"], r.first["sha256"], None if r.first["uri"] is None else bytes(r.first["uri"]), r.first["chunk"]) for r in firsts]
    shards = [r.shard for r in firsts]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            at, keep = [], []
            for i, u, s in zip(*(batch.column(k).to_pylist() for k in (0, 1, 2)), strict=True):
                own = hashlib.sha1(repr((i, u, s)).encode()).digest()
                keep.append(own not in seen)  # equal rows go on once for each task, or a few times
                if len(seen) > 100_000:
                    seen.clear()
                seen.add(own)
                at.append(shards[max(0, bisect_right(bounds, _place(i, s, u, 0)) - 1)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32())], ["id", "uri", "sha256", "payload", "shard"]).filter(pa.array(keep, pa.bool_()))

    long = pages.where(F.col("bytes") >= REVISIT_FROM).join(F.broadcast(hot), "sha256", "left")
    long = long.where(F.col("top").isNull() | F.struct("id", "uri").eqNullSafe(F.col("top"))).select("id", "uri", "sha256", "payload")
    long = long.mapInArrow(deal, "id long, uri binary, sha256 string, payload binary, shard int")
    none = F.lit(None)
    both = plan.select("shard", *_KEY, F.lit(0).alias("kind"), "payload", "sha1", "bytes", "responses", "revisits", "top").unionByName(long.select(
        "shard", "id", "sha256", "uri", F.lit(0).cast("long").alias("chunk"), F.lit(1).alias("kind"), "payload", none.cast("string").alias("sha1"), none.cast("long").alias("bytes"),
        none.cast("long").alias("responses"), none.cast("long").alias("revisits"), none.cast("struct<id:long,uri:binary>").alias("top")))
    both = both.repartition(max(1, len(shards)), "shard").sortWithinPartitions("shard", *_KEY, "kind")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, waiting = Files(path, prefix, roll, date), None

        def response(row: dict, content: bytes, nth: int) -> None:
            own = _fields("response", row["id"], row["uri"], _sha1(content), record_id(row["id"], row["uri"], row["sha256"], nth), date)
            files.put(row["shard"], record(own, _HTTP % len(content) + content))

        def revisits(row: dict) -> None:
            there, start = row["top"], row["chunk"] * CHUNK + row["responses"]
            digest = "sha1:" + base64.b32encode(bytes.fromhex(row["sha1"])).decode()
            refers = [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(there["id"], there["uri"], row["sha256"], 0)), ("WARC-Refers-To-Target-URI", _uri(there["uri"]))]
            for nth in range(start, start + row["revisits"]):
                own = _fields("revisit", row["id"], row["uri"], digest, record_id(row["id"], row["uri"], row["sha256"], nth), date)
                files.put(row["shard"], record([*own, *refers], _HTTP % row["bytes"]))

        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(c)[k].as_py() for c, n in enumerate(batch.schema.names)}
                if row["kind"] == 0:
                    if waiting:
                        raise RuntimeError("the input changed between its two readings")
                    if row["bytes"] >= REVISIT_FROM and row["responses"]:
                        waiting = row
                        continue
                    for nth in range(row["responses"]):
                        response(row, row["payload"], row["chunk"] * CHUNK + nth)
                    revisits(row)
                elif waiting:
                    if (row["id"], row["uri"], row["sha256"]) != (waiting["id"], waiting["uri"], waiting["sha256"]):
                        raise RuntimeError("the input changed between its two readings")
                    response(waiting, row["payload"], 0)
                    revisits(waiting)
                    waiting = None
            yield files.take()
        if waiting:
            raise RuntimeError("the input changed between its two readings")
        files.close()
        yield files.take()

    made = written(both.mapInArrow(write, _FILES), "warc-files")

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(path)
        for batch in batches:
            for name, temporary in zip(batch.column("name").to_pylist(), batch.column("temporary").to_pylist(), strict=True):
                # An attempt before this one may have moved it.
                if system.get_file_info(f"{folder}/{temporary}").type != fs.FileType.NotFound:
                    system.move(f"{folder}/{temporary}", f"{folder}/{name}")
                elif system.get_file_info(f"{folder}/{name}").type == fs.FileType.NotFound:
                    raise RuntimeError(f"{name} is lost")
            yield batch

    # Moved by a job of its own whose rows become the manifest.
    top[0].create_dir(top[1], recursive=True)
    made.mapInArrow(move, _FILES).drop("temporary").write.mode("overwrite").parquet(f"{path}/manifest")
    if top[0].get_file_info(f"{top[1]}/_temporary").type != fs.FileType.NotFound:
        top[0].delete_dir(f"{top[1]}/_temporary")
    return spark.read.schema(made.drop("temporary").schema).parquet(f"{path}/manifest")


def members(stream: pa.NativeFile, note: Callable[[bytes], None]) -> Iterator[bytes]:
    """The gzip members of a stream, one at a time; ``note`` sees the bytes as they were read."""
    own, out = zlib.decompressobj(31), []
    while piece := stream.read(1 << 20):
        note(piece)
        while piece:
            out.append(own.decompress(piece))
            piece = own.unused_data
            if own.eof:
                yield b"".join(out)
                own, out = zlib.decompressobj(31), []
    if any(out):
        raise ValueError("the last record is not whole")


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """(fields, block) of a record, whose length and digest must hold."""
    head, _, rest = content.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if not first.startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n" or fields.get("WARC-Block-Digest", _sha1(block)) != _sha1(block):
        raise ValueError("a record is damaged")
    return fields, block


def read_warc(spark: SparkSession, path: str, contents: bool = True) -> DataFrame:
    """(name, record_id, record_type, id, uri, payload_bytes, payload_digest, refers_to[, payload]) of what the manifest lists.

    payload_digest is hexadecimal; refers_to is the record id of a revisit's response. Files whose size or digest is not the
    manifest's, and records whose lengths or digests do not hold, are errors. Payloads are left out unless ``contents``.
    """
    listed = spark.read.parquet(f"{path}/manifest")
    kinds = [pa.string()] * 3 + [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    names = ["name", "record_id", "record_type", "id", "uri", "payload_bytes", "payload_digest", "refers_to", "payload"]
    schema = ", ".join(f"{n} {'long' if k == pa.int64() else 'binary' if k == pa.binary() else 'string'}" for n, k in zip(names, kinds, strict=True))

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(path)
        for batch in batches:
            for name, size, sha in zip(*(batch.column(c).to_pylist() for c in ("name", "bytes", "sha256")), strict=True):
                digest, seen, rows, held = hashlib.sha256(), [0], [], 0

                def note(piece: bytes, digest=digest, seen=seen) -> None:
                    digest.update(piece)
                    seen[0] += len(piece)

                with system.open_input_stream(f"{folder}/{name}", compression=None) as stream:
                    for content in members(stream, note):
                        fields, block = parse(content)
                        kind = fields["WARC-Type"]
                        if kind not in ("response", "revisit"):
                            continue
                        body = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
                        if body is not None and _sha1(body) != fields["WARC-Payload-Digest"]:
                            raise ValueError("a payload is damaged")
                        said = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        ident = fields.get(SOURCE)
                        rows.append((name, fields["WARC-Record-ID"], kind, None if ident is None else int(ident), fields["WARC-Target-URI"],
                                     None if body is None else len(body), said, fields.get("WARC-Refers-To"), body if contents else None))
                        held += len(content) if contents else 500
                        if held > 8 << 20:
                            yield batch_of(rows)
                            rows, held = [], 0
                if (seen[0], digest.hexdigest()) != (size, sha):
                    raise ValueError(f"{name} is not the file that was written")
                yield batch_of(rows)

    # A task for each file, whatever the session's settings.
    out = listed.repartition(max(1, listed.count()), F.col("name")).mapInArrow(read, schema)
    return out if contents else out.drop("payload")


def pages_of(records: DataFrame) -> DataFrame:
    """(id, payload_bytes, payload_digest, record_type, refers_to) of records: revisits with the id and length of their response.

    Every revisit's response must be among the records, as it is in what ``write_warc`` writes. One that very many refer to meets them by broadcast.
    """
    own = written(records.select("record_id", "record_type", "id", "payload_bytes", "payload_digest", "refers_to"), "warc-records")
    again = own.where("record_type = 'revisit'").select("id", "payload_digest", "record_type", "refers_to")
    asked = again.groupBy("refers_to").agg(F.count("*").alias("n"))
    there = own.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("id").alias("there"), "payload_bytes").join(asked, "refers_to")
    found = spread_join(again, written(there, "warc-responses"), ["refers_to"])
    columns = ["id", "payload_bytes", "payload_digest", "record_type"]
    return own.where("record_type = 'response'").select(*columns, F.lit(None).cast("long").alias("refers_to")).unionByName(found.select(*columns, F.col("there").alias("refers_to")))


SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
r AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest, row_number() OVER (PARTITION BY h ORDER BY page_id DESC NULLS LAST) AS nth, max(page_id) OVER (PARTITION BY h) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes < 1000 OR nth = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes < 1000 OR nth = 1 THEN NULL ELSE top END AS refers_to FROM r
"""
