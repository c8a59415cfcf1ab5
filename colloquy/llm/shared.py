"""Helpers shared by the operators: shared storage, hot keys, foreign columns, word splitting, hashing and bounded label samples."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Python's ``bytes.split()`` splits at exactly these six bytes, so words are ``bytes.split()`` of the UTF-8 text.
WHITE = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"

#: Rows and bytes in an Arrow batch, whichever is reached first; a single text may be larger.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 256, "spark.sql.execution.arrow.maxBytesPerBatch": 32 << 20}

#: A key is hot if it holds more than one in so many rows; so there are fewer hot keys than this, whatever the data.
HOT = 10_000
#: Bytes in a bucket of a table that is laid out by a key.
BUCKET = 128 << 20


_temporary: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``). Where it is unset, a local session gets a temporary folder; a
    cluster has no folder of its own that all executors see, so there it is an error."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        where = _temporary.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="colloquy-"))
    return where.rstrip("/")


def _place(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/colloquy/{spark.sparkContext.applicationId}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{_place(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, name: str, size: int) -> DataFrame:
    """Like ``written``, but laid out by ``key``: later joins on it move the other side only, not these rows.

    ``size`` is the number of bytes in ``df``: there is a bucket for each BUCKET of them, and at least as many as the session
    has shuffle partitions.
    """
    spark = df.sparkSession
    n = max(-(-size // BUCKET), int(spark.conf.get("spark.sql.shuffle.partitions")))
    table = f"colloquy_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    out = df.repartition(n, F.col(key)).write.option("compression", "zstd").option("path", f"{_place(spark)}/{table}")
    out.bucketBy(n, key).format("parquet").saveAsTable(table)
    return spark.table(table)


def clear(spark: SparkSession) -> None:
    """Deletes all tables that this application's operators wrote; call it when their results have been used or stored."""
    for table in [t.name for t in spark.catalog.listTables() if t.name.startswith("colloquy_") and not t.isTemporary]:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    path = spark._jvm.org.apache.hadoop.fs.Path(_place(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bounds(right: DataFrame, n: str = "n") -> tuple[int, int, int]:
    """The sum, the largest and the smallest ``n`` of a table, zeros for an empty one."""
    return tuple(right.agg(*(F.coalesce(f(n), F.lit(0)) for f in (F.sum, F.max, F.min))).first())


def spread_join(left: DataFrame, right: DataFrame, on: list[str], n: str = "n", total: int | None = None, known: tuple[int, int, int] | None = None) -> DataFrame:
    """Inner join of ``left`` with ``right``, which has one row per key and the number ``n`` of left rows that the key has.

    Rows of hot keys stay where they are and meet their key's row by broadcast: fewer than HOT keys can be hot, which bounds
    it. All other keys, each with at most one in HOT of the rows, are shuffled. Both sides are evaluated twice, so they should be
    written tables or plain scans. Keys are not null. ``total``, where known, is a number that the sum of ``n`` does not exceed.

    ``known`` are the ``bounds`` of ``n``. Where they show that no key is hot, or that all are, one join of both sides does, which
    evaluates each once: every exchange costs the driver a thread and a plan, so callers in rounds give them.
    """
    if known is not None:
        total, most, least = known
        if not total or least * HOT > total:
            return left.join(F.broadcast(right.drop(n)), on)
        if most * HOT <= total:
            return left.join(right.drop(n), on)
    if total is None:
        total = right.agg(F.coalesce(F.sum(n), F.lit(0))).first()[0]
    hot = right.where(F.col(n) * HOT > F.lit(total)).drop(n)
    keys = hot.select(*(F.col(c).alias(f"hot_{c}") for c in on))
    match = [F.col(c) == F.col(f"hot_{c}") for c in on]
    rest = left.join(F.broadcast(keys), match, "left_anti").join(right.where(F.col(n) * HOT <= F.lit(total)).drop(n), on)
    return rest.unionByName(left.join(F.broadcast(hot), on))


def quoted(names: list[str]) -> list:
    """Columns by their literal names, dots included."""
    return [F.col(f"`{n.replace('`', '``')}`") for n in names]


def plain_name(df: DataFrame, name: str) -> str:
    """What the session tells names apart by: capitals count only where it says so."""
    return name if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true" else name.lower()


def names_but(df: DataFrame, but: tuple[str, ...] | list[str]) -> list[str]:
    """The names of ``df`` that are none of ``but`` to the session."""
    gone = {plain_name(df, n) for n in but}
    return [c for c in df.columns if plain_name(df, c) not in gone]


def must_differ(df: DataFrame, *names: str) -> None:
    if len({plain_name(df, n) for n in names}) < len(names):
        raise ValueError("columns must differ from each other and from the results: " + ", ".join(names))


def aside(df: DataFrame, but: tuple[str, ...] | list[str] = ()) -> tuple[list[Column], list[Column]]:
    """The columns of ``df`` other than ``but`` under the names c0, c1, …, and back from there.

    Operators name their own columns otherwise, so no column of a user's can clash with them.
    """
    names = names_but(df, but)
    there = [c.alias(f"c{k}") for k, c in enumerate(quoted(names))]
    return there, [F.col(f"c{k}").alias(name) for k, name in enumerate(names)]


def raw(df: DataFrame, text: str) -> Column:
    """The bytes of a text column, none for null; they may be invalid UTF-8, which strings in Python cannot be."""
    return F.coalesce(quoted([text])[0].cast("binary"), F.expr("X''"))


def decoded(content: bytes) -> str:
    """Text of bytes; what is no UTF-8 becomes U+FFFD."""
    return content.decode("utf-8", "replace")


def strings(contents: list[bytes]) -> pa.Array:
    """Bytes as a text column, without a check of their encoding."""
    return pa.array(contents, pa.binary()).cast(pa.string(), safe=False)


def with_columns(df: DataFrame, source: Column, made: list[T.StructField], start: Callable[[], Callable[[pa.Array], list[pa.Array]]], end: Callable[[], None] | None = None) -> DataFrame:
    """Adds the columns ``made`` to every row of ``df``; equal-named columns are replaced, all others pass through.

    ``start()`` runs once in each task and gives a function from a batch's values of ``source`` to the columns; ``end()`` runs after.
    """
    small_batches(df.sparkSession)
    there, back = aside(df, [f.name for f in made])
    names = [f"c{k}" for k in range(len(there))] + [f"made{k}" for k in range(len(made))]
    taken = df.select(*there, source.alias("source"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = start()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *call(batch.columns[-1])], names)
        if end:
            end()

    schema = T.StructType([*taken.schema.fields[:-1], *(T.StructField(f"made{k}", f.dataType) for k, f in enumerate(made))])
    return taken.mapInArrow(run, schema).select(*back, *(F.col(f"made{k}").alias(f.name) for k, f in enumerate(made)))


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches by rows and bytes; only ever lowers the session's settings."""
    for key, most in BATCH.items():
        number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", spark.conf.get(key).lower()).groups()
        now = int(number) << 10 * ("kmgtp".find(unit) + 1 if unit else 0)
        if not 0 < now <= most:
            spark.conf.set(key, str(most))


class WordHashes(dict):
    """Word (bytes) -> 64-bit hash, computed once per worker and word; forgets all words when it grows too large.

    Words over LONG bytes, such as whole texts in scripts without spaces, are not remembered, so their size is no matter.
    """

    MOST, LONG = 200_000, 64

    def __missing__(self, word: bytes) -> int:
        return self.keep(word, xxhash.xxh3_64_intdigest(word))

    def keep(self, word: bytes, value: int) -> int:
        if len(word) <= self.LONG:
            if len(self) >= self.MOST:
                self.clear()
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that low and high bits of sums and products become usable."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


class Rolling:
    """Hashes of all ``n``-word windows by prefix sums of a polynomial modulo 2**64 (an odd base has an inverse)."""

    def __init__(self, base: int):
        self.base, self.inverse = base | 1, pow(base | 1, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            for name, step in (("up", self.base), ("down", self.inverse)):
                factors = np.full(n, step, dtype=np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))

    def windows(self, values: np.ndarray, n: int) -> np.ndarray:
        if len(values) < n:
            return np.empty(0, dtype=np.uint64)
        self._grow(len(values) + 1)
        sums = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(values * self.up[: len(values)], out=sums[1:])
        return (sums[n:] - sums[:-n]) * self.down[: len(values) - n + 1]


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, seed: int, where=None) -> DataFrame:
    """At most ``rows`` labelled documents, the smallest by a seeded hash of the id: (doc_id, text, label).

    Drawn among the ids that ``docs`` has, which costs a pass over ids, not texts; a distributed top-k then bounds the sample.
    Rows with a null label or id are left out; of several labels for one id the largest counts, and of several rows with
    one id the least text, null last.
    """
    chosen = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    if where is not None:
        chosen = chosen.where(where)
    chosen = (
        chosen.groupBy("doc_id").agg(F.max(label).cast("int").alias("label")).join(docs.select("doc_id"), "doc_id", "left_semi")
        .orderBy(F.xxhash64(F.col("doc_id"), F.lit(seed)), "doc_id").limit(rows)
    )
    # At most ``rows`` pairs of two numbers: a proven bound for the broadcast.
    found = docs.select("doc_id", F.col("text")).join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
