"""Substring dedup by relative Lempel-Ziv factors over indexed reference blocks.

The reference is the corpus itself. Each document is indexed by content-chosen blocks: of the 25-word blocks inside every
50-word window the one with the least hash is its seed, so equal windows have equal seeds wherever they lie, and a tenth of
the positions are seeds. Only seeds that two different texts share can begin a factor; documents with such seeds are read
again, and the index holds, for every window over a shared seed, the place where it begins in the smallest document.

A document is then factored greedily: from a window that the index knows in a smaller document, the factor grows while each
next window continues in the same reference block. As every window over a shared seed is looked up, those across the boundary
of two factors are looked up too, so the spans are exact where factors alone would miss a window that straddles them.
Hashes only propose: each factor's words are compared with the words of its reference block. Where they differ, two windows
share a hash by chance or by design; all windows with such a hash are looked up once more by their words themselves.

Whole copies are set aside first, after their words were compared: all but the smallest of them are one factor from end to end.
Equal requests for comparison are made once, so a passage in a third of all documents is compared with its block once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.shared import HOT, Rolling, WordHashes, bucketed, mixed, quoted, raw, small_batches, spread_join, strings, written

WINDOW, SEED = 50, 25
#: Bytes of claims that meet one reference text at a time.
LIST = 4 << 20


class Windows:
    """Word hashes of a text; its windows' hashes (two of 64 bits) and seeds."""

    def __init__(self, window: int = WINDOW, seed: int = SEED, key_bits: int = 64):
        self.window, self.seed, self.mask = window, seed, np.uint64((1 << key_bits) - 1)
        self.words = WordHashes()
        self.one, self.two = Rolling(0xB5AD4ECEDA1CE2A9), Rolling(0x27BB2EE687B0B0FD)

    def hashes(self, words: list[bytes]) -> np.ndarray:
        return self.words.of(words)

    def seeds(self, h: np.ndarray) -> np.ndarray:
        """The seed of each window; empty for texts shorter than a window."""
        if len(h) < self.window:
            return np.empty(0, np.uint64)
        blocks = mixed(self.one.windows(h, self.seed))
        return np.lib.stride_tricks.sliding_window_view(blocks, self.window - self.seed + 1).min(axis=1)

    def keys(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return mixed(self.one.windows(h, self.window)) & self.mask, mixed(self.two.windows(mixed(h), self.window)) & self.mask


def _longs(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _kind(rows: DataFrame) -> str:
    return rows.schema["doc_id"].dataType.simpleString()


def profile(rows: DataFrame) -> DataFrame:
    """(uid, doc_id, n_words, w1, w2, seeds) of (uid, doc_id, text): hashes of the whole word sequence, and the distinct seeds of a long enough text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Windows()
        for batch in batches:
            n, first, second, seeds = [], [], [], []
            for t in batch.columns[2].to_pylist():
                h = own.hashes(t.split())
                n.append(len(h))
                first.append(int(_longs(mixed(own.one.windows(h, len(h))))[0]) if len(h) else 0)
                second.append(int(_longs(mixed(own.two.windows(mixed(h), len(h))))[0]) if len(h) else 0)
                seeds.append(_longs(np.unique(own.seeds(h))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(n, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(seeds, pa.list_(pa.int64()))],
                ["uid", "doc_id", "n_words", "w1", "w2", "seeds"])

    return rows.select("uid", "doc_id", "text").mapInArrow(run, f"uid long, doc_id {_kind(rows)}, n_words long, w1 long, w2 long, seeds array<long>")


def window_keys(docs: DataFrame, key_bits: int) -> DataFrame:
    """(uid, doc_id, text, shared seeds) -> (uid, doc_id, starts, k1, k2): the windows whose seed is shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Windows(key_bits=key_bits)
        for batch in batches:
            starts, first, second = [], [], []
            for t, shared in zip(batch.columns[2].to_pylist(), batch.columns[3], strict=True):
                h = own.hashes(t.split())
                at = np.nonzero(np.isin(_longs(own.seeds(h)), shared.values.to_numpy()))[0]
                one, two = own.keys(h)
                starts.append(at.astype(np.int32))
                first.append(_longs(one[at]))
                second.append(_longs(two[at]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(starts, pa.list_(pa.int32())), pa.array(first, pa.list_(pa.int64())), pa.array(second, pa.list_(pa.int64()))],
                ["uid", "doc_id", "starts", "k1", "k2"])

    return docs.select("uid", "doc_id", "text", "shared").mapInArrow(run, f"uid long, doc_id {_kind(docs)}, starts array<int>, k1 array<long>, k2 array<long>")


def factors(starts: np.ndarray, refs: np.ndarray, places: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts of known windows, their references and places in these, in any order -> first word, end, reference and place of factors:
    each grows while the next window continues in the same block."""
    order = np.lexsort((places, refs, starts))
    starts, refs, places = starts[order].astype(np.int64), refs[order], places[order].astype(np.int64)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (starts[1:] != starts[:-1] + 1) | (refs[1:] != refs[:-1]) | (places[1:] != places[:-1] + 1)
    at = np.flatnonzero(new)
    ends = starts[np.append(at[1:], len(starts))[: len(at)] - 1] + window
    return starts[at], ends, refs[at], places[at]


def spans(covered: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Covered stretches, in any order -> maximal ones."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(covered):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_KNOWN = "array<struct<start:int,ref:long,place:int>>"


def _factors(column: pa.Array, k: int) -> tuple[np.ndarray, ...]:
    """The factors of a row's known windows, without a Python object for each window."""
    own = column[k].values
    if own is None:
        return (np.empty(0, np.int64),) * 4
    return factors(*(own.field(n).to_numpy(zero_copy_only=False) for n in ("start", "ref", "place")))


def requests(docs: DataFrame) -> DataFrame:
    """(uid, text, known) -> (ref, place, words): what each factor claims to stand at a place of a reference."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            refs, places, contents = [], [], []
            for k, t in enumerate(batch.columns[1].to_pylist()):
                words = t.split()
                for a, b, ref, place in zip(*(x.tolist() for x in _factors(batch.columns[2], k)), strict=True):
                    refs.append(ref)
                    places.append(place)
                    contents.append(b" ".join(words[a:b]))
            yield pa.RecordBatch.from_arrays([pa.array(refs, pa.int64()), pa.array(places, pa.int32()), pa.array(contents, pa.binary())], ["ref", "place", "words"])

    return docs.select("uid", "text", "known").mapInArrow(run, "ref long, place int, words binary")


def refuted(rows: DataFrame, claims: DataFrame, key_bits: int) -> DataFrame:
    """(ref, place, words) -> (k1, k2) of the windows of claims whose words are not those of the row with that uid.

    A row's claims meet it in lists of about LIST bytes, each with its text, so neither many claims nor a long text pile up.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Windows(key_bits=key_bits)
        for batch in batches:
            first, second = [], []
            for t, listed in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = t.split()
                for claim in listed:
                    claimed, place = claim["words"].split(), claim["place"]
                    if words[place : place + len(claimed)] != claimed:
                        one, two = own.keys(own.hashes(claimed))
                        first += _longs(one).tolist()
                        second += _longs(two).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(first, pa.int64()), pa.array(second, pa.int64())], ["k1", "k2"])

    of_ref = written(claims.groupBy("ref").agg(F.count("*").alias("n"), (F.floor(F.sum(F.octet_length("words")) / LIST) + 1).alias("lists")), "substring-claimed")
    dealt = spread_join(claims, of_ref, ["ref"]).withColumn("list", F.expr("pmod(xxhash64(place, words), lists)"))
    listed = dealt.groupBy("ref", "list").agg(F.collect_list(F.struct("place", "words")).alias("claims"))
    return rows.join(listed.withColumnRenamed("ref", "uid"), "uid").select("text", "claims").mapInArrow(run, "k1 long, k2 long")


def window_words(docs: DataFrame) -> DataFrame:
    """(uid, text, starts) -> (uid, start, words) of the windows at ``starts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uid, t, starts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = t.split()
                for k in range(0, len(starts), 4096):
                    part = starts[k : k + 4096]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([uid] * len(part), pa.int64()), pa.array(part, pa.int32()), pa.array([b" ".join(words[a : a + WINDOW]) for a in part], pa.binary())],
                        ["uid", "start", "words"])

    return docs.select("uid", "text", "starts").mapInArrow(run, "uid long, start int, words binary")


def equal_words(pairs: DataFrame) -> DataFrame:
    """Those of (uid, first, ta, tb) whose texts have the same words: (uid, first)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = [a.split() == b.split() for a, b in zip(batch.columns[2].to_pylist(), batch.columns[3].to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["uid", "first"]).filter(pa.array(same, pa.bool_()))

    return pairs.select("uid", "first", "ta", "tb").mapInArrow(run, "uid long, first long")


def copies_of(rows: DataFrame, own: DataFrame) -> DataFrame:
    """(uid, first): rows whose words are all those of another row, the one with the smallest (doc_id, uid) among them.

    Hashes propose the groups, words decide. The first row's text is repeated for every HOT copies, so no group meets in one task.
    """
    first = F.min(F.struct("doc_id", "uid")).alias("first")
    groups = own.groupBy("w1", "w2", "n_words").agg(first, F.count("*").alias("n")).where("n > 1")
    groups = written(groups.select("w1", "w2", "n_words", F.col("first.uid").alias("first"), "n", F.expr(f"n div {HOT}").alias("salts")), "substring-groups")
    pairs = spread_join(own.select("uid", "w1", "w2", "n_words"), groups, ["w1", "w2", "n_words"]).where("uid != first")
    pairs = written(pairs.select("uid", "first", F.expr("pmod(xxhash64(uid), salts + 1)").alias("salt"), "salts"), "substring-copies")
    asked = pairs.groupBy("first").agg(F.max("salts").alias("salts"))
    there = rows.select(F.col("uid").alias("first"), F.col("text").alias("tb")).join(asked, "first")
    there = there.select("first", "tb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts"))).alias("salt"))
    here = rows.select("uid", F.col("text").alias("ta")).join(pairs.select("uid", "first", "salt"), "uid")
    return written(equal_words(here.join(there, ["first", "salt"])), "substring-equal")


def known_windows(rows: DataFrame, kept: DataFrame, key_bits: int) -> DataFrame:
    """(uid, known) of the rows of ``kept`` (uid, doc_id, seeds): their windows that a smaller document has too, and where."""
    seeds = kept.select("uid", "doc_id", F.explode("seeds").alias("seed"))
    shared = seeds.groupBy("seed").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count("*").alias("n")).where("a != b")
    shared = written(shared.select("seed", "n"), "substring-shared")
    asked = spread_join(seeds, shared, ["seed"]).groupBy("uid").agg(F.collect_list("seed").alias("shared"))
    windows = written(window_keys(rows.join(asked, "uid"), key_bits), "substring-windows")
    each = windows.select("uid", "doc_id", F.explode(F.arrays_zip("starts", "k1", "k2")).alias("w")).select("uid", "doc_id", F.col("w.starts").alias("start"), "w.k1", "w.k2")
    index = each.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "uid", "start")).alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n")).where("least.doc_id < most")
    index = written(index.select("k1", "k2", "least", "n"), "substring-index")
    found = spread_join(each, index, ["k1", "k2"])

    def listed(found: DataFrame) -> DataFrame:
        own = found.where(F.col("doc_id") > F.col("least.doc_id")).select("uid", F.struct("start", F.col("least.uid").alias("ref"), F.col("least.start").alias("place")).alias("x"))
        return own.groupBy("uid").agg(F.collect_list("x").cast(_KNOWN).alias("known"))

    known = written(listed(found), "substring-known")
    claims = written(requests(rows.join(known, "uid")).distinct(), "substring-claims")
    bad = written(refuted(rows, claims, key_bits).distinct(), "substring-refuted")
    if bad.isEmpty():
        return known
    # Windows that share a hash but not the words: words themselves are their key.
    again = each.join(bad, ["k1", "k2"], "left_semi").groupBy("uid").agg(F.collect_list("start").alias("starts"))
    spelt = window_words(rows.join(again, "uid")).join(kept.select("uid", "doc_id"), "uid")
    spelt = written(spelt, "substring-spelt")
    least = spelt.groupBy("words").agg(F.min(F.struct("doc_id", "uid", "start")).alias("least"))
    exact = spelt.join(least, "words")
    columns = ["uid", "doc_id", "start", "least"]
    return written(listed(found.join(bad, ["k1", "k2"], "left_anti").select(columns).union(exact.select(columns))), "substring-known")


def substring_dedup(df: DataFrame, ident: str = "doc_id", text: str = "text", key_bits: int = 64) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept_text) for every row of ``df``; doc_id is ``ident``, of any type that has an order.

    A window is 50 consecutive words of one text, split at ASCII white space. Each word goes that lies in a window whose words
    also begin somewhere in a document with a smaller id; windows are those of the input. kept_text joins what stays by one
    space. Null and empty texts have no words. Rows with a null id are neither compared nor cut. Rows that repeat an id do not
    cut each other, and are cut alike where their words are equal. Words are compared as bytes, so invalid UTF-8 is kept as it
    is. ``key_bits`` is the width of each of a window's two hashes; the result is the same for any. Texts of any length are read whole. Other columns are ignored, whatever their names. Empty tables give empty results.
    """
    spark = df.sparkSession
    small_batches(spark)
    size = df.agg(F.coalesce(F.sum(F.octet_length(quoted([text])[0])), F.lit(0))).first()[0]
    kind = df.select(*quoted([ident])).schema[0].dataType
    rows = bucketed(df.select(F.monotonically_increasing_id().alias("uid"), quoted([ident])[0].alias("doc_id"), raw(df, text).alias("text")), "uid", "substring-rows", size)
    own = written(profile(rows), "substring-profile")
    long = own.where((F.col("n_words") >= WINDOW) & F.col("doc_id").isNotNull())
    # Of texts with the same words only one goes on; copies with a larger id go as a whole, and those with the same id as it does.
    copies = copies_of(rows, long)
    known = known_windows(rows, long.join(copies, "uid", "left_anti"), key_bits)
    ids = long.select("uid", "doc_id")
    pairs = copies.join(ids, "uid").join(ids.select(F.col("uid").alias("first"), F.col("doc_id").alias("least")), "first")
    pairs = written(pairs.select("uid", "first", (F.col("doc_id") > F.col("least")).alias("whole")), "substring-copies")
    twins = pairs.where("NOT whole").select(F.col("uid").alias("twin"), F.col("first").alias("uid"))
    marks = known.union(known.join(twins, "uid").select(F.col("twin").alias("uid"), "known")).select("uid", "known", F.lit(False).alias("whole"))
    marks = marks.union(pairs.where("whole").select("uid", F.lit(None).cast(_KNOWN), "whole"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, gone, found, left = [], [], [], []
            for k, (t, whole) in enumerate(zip(batch.columns[1].to_pylist(), batch.columns[3].to_pylist(), strict=True)):
                words = t.split()
                covered = [(0, len(words))] if whole else spans(list(zip(*(x.tolist() for x in _factors(batch.columns[2], k)[:2]), strict=True)))
                stay, at = [], 0
                for a, b in covered:
                    stay += words[at:a]
                    at = b
                stay += words[at:]
                n.append(len(words))
                gone.append(len(words) - len(stay))
                found.append([{"first": a, "end": b} for a, b in covered])
                left.append(b" ".join(stay))
            yield pa.RecordBatch.from_arrays(
                [batch.columns[0], pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(found, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))), strings(left)],
                ["doc_id", "n_words", "n_removed", "spans", "kept_text"])

    return rows.join(marks, "uid", "left").select("doc_id", "text", "known", "whole").mapInArrow(
        cut, f"doc_id {kind.simpleString()}, n_words long, n_removed long, spans array<struct<first:int,end:int>>, kept_text string")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50),
k AS (SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS h FROM p),
f AS (SELECT doc_id, list(DISTINCT i) AS s FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS m FROM k) WHERE doc_id > m GROUP BY doc_id),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM (SELECT doc_id, unnest(s) AS i FROM f)),
c AS (SELECT doc_id, list(j) AS js FROM g GROUP BY doc_id),
x AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
y AS (SELECT x.doc_id, array_to_string(list(x.word ORDER BY x.j), ' ') AS kept FROM x LEFT JOIN g ON x.doc_id = g.doc_id AND x.j = g.j WHERE g.j IS NULL GROUP BY x.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(len(c.js), 0)::BIGINT AS n_removed, sha256(coalesce(y.kept, '')) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN y USING (doc_id)
"""
