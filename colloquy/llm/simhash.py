"""SimHash near-dedup by meet-in-the-middle ball hashing.

If two fingerprints differ in at most 2r bits, some value lies within r bits of both. So each fingerprint emits all values
within r bits, these are shuffled, and fingerprints that meet at one value are linked: at most 2r bits lie between them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.components import components
from colloquy.llm.shared import bounds, must_differ, quoted, raw, small_batches, spread_join, written

BITS, SHINGLE, SEED, WITHIN = 64, 4, 42, 4
#: For the lossless sieve: blocks of 8 bits of which four differing bits leave at least four untouched.
BLOCKS = 8

_lower_a = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_bit_of = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def fingerprint(text: bytes, words: int = SHINGLE, seed: int = SEED) -> int:
    """Bit b is set if it is set in over half of the XXH64 of the shingles; words split at ASCII white space, A-Z in lower case.

    Fewer words than a shingle make one shingle; no words give 0.
    """
    own = text.translate(_lower_a).split()
    if not own:
        return 0
    joined = b" ".join(own)
    ends = np.cumsum(np.fromiter(map(len, own), dtype=np.int64, count=len(own)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(words, len(own))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(starts[: len(own) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)), dtype=np.uint64)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    counts = np.concatenate([np.bincount(octets[:, j], minlength=256) @ _bit_of for j in range(8)])
    return sum(1 << b for b in np.nonzero(2 * counts > len(hashes))[0].tolist())


def fingerprints(df: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, fp): fp is the fingerprint's 64 bits as a signed long; null texts count as empty. Texts are taken as bytes."""
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.array([fingerprint(t) for t in batch.columns[1].to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.columns[0], pa.array(made)], ["id", "fp"])

    kind = df.select(*quoted([ident])).schema[0].dataType.simpleString()
    return df.select(*quoted([ident]), raw(df, text)).mapInArrow(run, f"id {kind}, fp long")


def ball(fp: str, radius: int, bits: int = BITS) -> str:
    """SQL: the array of all values within ``radius`` (0 to 2) bits of ``fp``."""
    one = f"transform(sequence(0, {bits - 1}), i -> {fp} ^ shiftleft(1L, i))"
    two = f"flatten(transform(sequence(0, {bits - 2}), i -> transform(sequence(i + 1, {bits - 1}), j -> {fp} ^ shiftleft(1L, i) ^ shiftleft(1L, j))))"
    return f"concat(array({fp}){', ' + one if radius else ''}{', ' + two if radius > 1 else ''})"


def sieve(fps: DataFrame) -> DataFrame:
    """Drops fingerprints that no other one can be near: four differing bits leave four of eight bytes alike, so a
    fingerprint stays only if it shares some four bytes, in place, with another. No link is lost. A key's count, minimum and
    maximum are pre-aggregated, so a frequent key is never gathered; where they show just two fingerprints, their bits decide."""
    masks = [sum(0xFF << 8 * b for b in chosen) for chosen in combinations(range(BLOCKS), BLOCKS - WITHIN)]
    masks = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]
    keys = fps.select("fp", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in masks))).alias("mask", "key"))
    keys = keys.select("fp", F.xxhash64("mask", "key").alias("key"))
    shared = keys.groupBy("key").agg(F.min("fp").alias("a"), F.max("fp").alias("b"), F.count("*").alias("n")).where("n > 1")
    shared = written(shared, "simhash-shared")
    pairs = shared.where((F.col("n") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= WITHIN)).select(F.explode(F.array("a", "b")).alias("fp"))
    # Larger groups name their members by a merge join always, whose cost follows the input; a broadcast would grow with it.
    more = keys.join(shared.where("n > 2").select("key").hint("merge"), "key", "left_semi").select("fp")
    return pairs.union(more).distinct()


def links(fps: DataFrame) -> DataFrame:
    """(a, b) of distinct fingerprints within WITHIN bits, enough of them to connect all that are linked.

    ``fps`` has one column fp, without repeats. At a value meet at most 2,081 fingerprints, the size of a ball, whatever the
    data; they are pairwise linked, so edges from the smallest to each other one say it all. Pairs are verified by their bits.
    """
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    spread = fps.select("fp", F.explode(F.expr(ball("fp", WITHIN // 2))).alias("value"))
    met = spread.groupBy("value").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    stars = met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a != b").distinct()
    return stars.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= WITHIN)


def near_dedup(df: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """(ident, fp, component_id) for every row: component_id is the smallest id reachable over links, itself included.

    Rows of one fingerprint are linked, texts without words (null, empty) among them, with fingerprint 0. Rows with a null id
    belong to their component and get its smallest id, null if it has none. Repeated rows are rows. Whole texts are read,
    however long, as bytes, so invalid UTF-8 is no error. Other columns are ignored. Empty tables give none.
    """
    must_differ(df, ident, "fp", "component_id")
    rows = written(fingerprints(df, ident, text), "simhash-rows")
    distinct = written(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")), "simhash-distinct")
    kept = written(sieve(distinct.select("fp")), "simhash-sieved")
    roots = components(written(links(kept), "simhash-links"))
    # Fingerprints with links, far fewer than all, get their component's smallest id; the others are components by themselves.
    joined = written(distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left"), "simhash-joined")
    linked = joined.where("root IS NOT NULL")
    least = written(linked.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("k")), "simhash-least")
    of_fp = spread_join(linked.select("fp", "n", "root"), least, ["root"], "k", known=bounds(least, "k")).select("fp", "n", "component_id")
    of_fp = written(of_fp.union(joined.where("root IS NULL").select("fp", "n", "least")), "simhash-components")
    return spread_join(rows, of_fp, ["fp"], known=bounds(of_fp)).select(F.col("id").alias(ident), "fp", "component_id")


def hex_fingerprint(fp: str = "fp"):
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))
