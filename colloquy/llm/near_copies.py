"""Near copies by Jaccard: texts are linked if at least four fifths of their distinct five-word shingles are common.

Candidates share a band of five of 160 minima (32 bands): of pairs at exactly 0.8 one in 300,000 shares none, of closer pairs
fewer. Of these, pairs go whose bitmaps differ in more bits than the sets may in shingles: a bitmap has a bit for each of 1,024
classes of hashes, set if the set has an odd number of that class, so each differing bit takes a shingle that only one side
has, and no link is lost. What is left is decided by its exact Jaccard. Only connectivity is asked for, so a band's members are
first compared with one leader, that with most candidates; a band whose members are all connected needs no further pair.
What stays apart is compared pair by pair, bitmaps first. Groups that another method has found may be decided first, in the
same way; bands then find only what these have not connected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquy.llm.components import components
from colloquy.llm.shared import Rolling, WordHashes, bounds, mixed, raw, small_batches, spread_join, written

SHINGLE, BANDS, ROWS = 5, 32, 5
#: A pair is linked if PARTS * common >= LEAST * all of its shingles.
LEAST, PARTS = 4, 5
#: Bits in a bitmap.
BITS = 1024
#: Pairs that meet one copy of a text, and members of a band that one task compares with the others.
GROUP = 1000
#: More star rounds go before pairs while these would be more than so many per member.
PAIRS_PER_MEMBER = 16

_lower_a = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_factors = np.random.default_rng(42).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingles:
    """The sorted distinct hashes of a text's shingles; words split at ASCII white space, A-Z in lower case.

    Fewer words than a shingle make one shingle; no words make none.
    """

    def __init__(self, words: int = SHINGLE):
        self.size, self.words, self.rolling = words, WordHashes(), Rolling(0xB5AD4ECEDA1CE2A9)

    def of(self, text: bytes) -> np.ndarray:
        h = self.words.of(text.translate(_lower_a).split())
        return np.unique(mixed(self.rolling.windows(h, min(self.size, len(h))))) if len(h) else h


def bands(shingles: np.ndarray) -> list[int]:
    """A key of each band, none for an empty set."""
    if not len(shingles):
        return []
    least = np.full(len(_factors), np.iinfo(np.uint64).max)
    for a in range(0, len(shingles), 1024):
        least = np.minimum(least, mixed(shingles[a : a + 1024, None] * _factors).min(axis=0))
    raw = least.tobytes()
    return [xxhash.xxh3_64_intdigest(raw[k * 8 * ROWS : (k + 1) * 8 * ROWS], k) for k in range(BANDS)]


def bitmap(shingles: np.ndarray) -> bytes:
    """BITS bits: which classes of hashes (their lowest bits) have an odd number of members."""
    odd = np.bincount((shingles & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _longs(x: list[int]) -> np.ndarray:
    return np.array(x, np.uint64).view(np.int64)


def profile(rows: DataFrame) -> DataFrame:
    """(uid, doc_id, text) -> (uid, doc_id, s1, s2, n, keys, bits): a 128-bit hash of the shingle set, its size, bands and bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Shingles()
        for batch in batches:
            first, second, n, keys, bits = [], [], [], [], []
            for t in batch.columns[2].to_pylist():
                s = own.of(t)
                whole = xxhash.xxh3_128_intdigest(s.tobytes())
                first.append(whole & (1 << 64) - 1)
                second.append(whole >> 64)
                n.append(len(s))
                keys.append(_longs(bands(s)))
                bits.append(np.frombuffer(bitmap(s), np.int64))
            made = [pa.array(_longs(first)), pa.array(_longs(second)), pa.array(n, pa.int64()), *(pa.array(x, pa.list_(pa.int64())) for x in (keys, bits))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *made], ["uid", "doc_id", "s1", "s2", "n", "keys", "bits"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"uid long, doc_id {kind}, s1 long, s2 long, n long, keys array<long>, bits array<long>")


def _sides(pairs: DataFrame) -> tuple[DataFrame, dict[str, tuple[int, int, int]]]:
    """(side, node, n) of the (a, b), n being the pairs that have the node on that side, and the bounds of n by side; none for no pairs."""
    sides = F.explode(F.array(*(F.struct(F.lit(x).alias("side"), F.col(x).alias("node")) for x in "ab"))).alias("s")
    asked = written(pairs.select(sides).groupBy("s.side", "s.node").agg(F.count("*").alias("n")), "near-asked")
    found = asked.groupBy("side").agg(F.sum("n"), F.max("n"), F.min("n")).collect()
    return asked, {r[0]: tuple(r[1:]) for r in found}


def alike(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """Those of the (a, b) whose texts' Jaccard is large enough. Only texts that are asked for are moved. ``pairs`` are a table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, last, one = Shingles(), None, None
        for batch in batches:
            stay = []
            for a, s, t in zip(batch.columns[0].to_pylist(), batch.columns[2].to_pylist(), batch.columns[3].to_pylist(), strict=True):
                if a != last:
                    last, one = a, own.of(s)
                two = own.of(t)
                common = len(np.intersect1d(one, two, assume_unique=True))
                stay.append(PARTS * common >= LEAST * (len(one) + len(two) - common))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(stay, pa.bool_()))

    asked, known = _sides(pairs)
    if not known:
        return pairs
    texts = written(rows.select("uid", "text").join(asked.select(F.col("node").alias("uid")), "uid", "left_semi").withColumnRenamed("uid", "node"), "near-texts")
    # A text that is asked for often, on either side, is repeated for every GROUP pairs, so that they do not meet in one task.
    both, there, on = pairs, {}, {"a": ["a"], "b": ["b"]}
    for x, other in ("a", "b"), ("b", "a"):
        there[x] = texts.select(F.col("node").alias(x), F.col("text").alias(f"t{x}"))
        if known[x][1] >= GROUP:
            salts = asked.where(F.col("side") == x).select(F.col("node").alias(x), "n", F.expr(f"n div {GROUP} + 1").alias("salts"))
            on[x].append(f"salt_{x}")
            both = written(spread_join(both, salts, [x], known=known[x]).withColumn(f"salt_{x}", F.expr(f"pmod(xxhash64({other}), salts)")).drop("salts"), "near-salted")
            there[x] = there[x].join(salts, x).select(x, f"t{x}", F.explode(F.expr("sequence(0L, salts - 1)")).alias(f"salt_{x}"))
    both = both.join(there["b"], on["b"]).join(there["a"], on["a"])
    return both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _fit():
    """Whether sizes na and nb and bitmaps bits_a and bits_b allow for the Jaccard.

    Of two sets that differ in d shingles, s in number together, the Jaccard is (s - d) / (s + d), and d is no less than the
    difference of the sizes and the number of differing bits.
    """
    bits = sum(F.bit_count(F.col("bits_a")[k].bitwiseXOR(F.col("bits_b")[k])) for k in range(BITS // 64))
    most = (PARTS - LEAST) * (F.col("na") + F.col("nb"))
    return ((PARTS + LEAST) * F.abs(F.col("na") - F.col("nb")) <= most) & ((PARTS + LEAST) * bits <= most)


def _close(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs that fit, each once, smaller node first."""
    pairs = written(pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "near-candidates")
    asked, known = _sides(pairs)
    if not known:
        return pairs
    asked = written(asked.withColumnRenamed("n", "k").join(nodes.select(F.col("uid").alias("node"), "n", "bits"), "node"), "near-sides")
    for x in "ab":
        # A node of very many pairs, as a leader is, meets them by broadcast; nodes are of one size.
        own = asked.where(F.col("side") == x).select(F.col("node").alias(x), "k", F.col("n").alias(f"n{x}"), F.col("bits").alias(f"bits_{x}"))
        pairs = spread_join(pairs, own, [x], "k", known=known[x])
        pairs = written(pairs, "near-sided") if x == "a" else pairs
    return pairs.where(_fit()).select("a", "b")


def _apart(members: DataFrame, roots: DataFrame) -> tuple[DataFrame, int, int]:
    """Members with their roots and the size of their band, without the bands whose members are connected; their number and that of all pairs in a band."""
    own = members.select("key", "node").join(roots.withColumnRenamed("root", "to"), "node", "left").select("key", "node", F.coalesce("to", "node").alias("root"))
    own = written(own, "near-members")
    left = own.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("size")).where("x != y").select("key", "size", F.col("size").alias("n"))
    left = written(left, "near-left")
    *known, pairs = left.agg(F.expr("coalesce(sum(n), 0)"), F.max("n"), F.min("n"), F.sum(F.col("n") * (F.col("n") - 1) / 2)).first()
    if not known[0]:
        return own, 0, 0
    return written(spread_join(own, left, ["key"], known=tuple(known)), "near-apart"), known[0], pairs


def _all_pairs(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs that fit of one band and different roots. Only these leave the join.

    A large band is split: one side's members are dealt into blocks of GROUP, and the other side meets each block.
    """
    own = members.join(nodes.select(F.col("uid").alias("node"), "n", "bits"), "node").withColumn("blocks", F.expr(f"size div {GROUP} + 1"))
    own = written(own, "near-blocks")

    def side(x: str, block):
        return own.select("key", block.alias("block"), F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("root").alias(f"r{x}"), F.col("bits").alias(f"bits_{x}"))

    one, other = side("a", F.expr("pmod(xxhash64(node), blocks)")), side("b", F.explode(F.expr("sequence(0L, blocks - 1)")))
    return one.join(other, ["key", "block"]).where(F.expr("a < b AND ra != rb") & _fit()).select("a", "b").distinct()


def links(spread: DataFrame, nodes: DataFrame, rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(node, root) for the nodes (uid, n, bits) of distinct sets that links connect; enough pairs are compared to connect all that are alike and share a key.

    ``spread`` has the (node, key), each once. ``known`` is such a result: its links hold, and what they connect is not compared again.
    """
    shared = spread.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b"), F.count("*").alias("size")).where("size > 1")
    shared = written(shared, "near-shared")
    large = shared.where("size > 2").select("key", "size", F.col("size").alias("n"))
    members = written(spread_join(spread, large, ["key"], known=bounds(large)), "near-members")
    # The leader of a band is its member with most candidates over all bands, most likely that which others were copied from.
    degree = members.groupBy("node").agg(F.sum("size").alias("degree"))
    members, pairs = members.join(degree, "node"), shared.where("size = 2").select("a", "b")
    if known is None:
        members = members.withColumn("root", F.col("node"))
    else:
        members = members.join(known, "node", "left").withColumn("root", F.coalesce("root", "node"))
        for x in "ab":
            pairs = pairs.join(known.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")), x, "left")
        pairs = pairs.where("coalesce(ra, a) != coalesce(rb, b)").select("a", "b")
    members = written(members, "near-members")

    def stars(of: DataFrame, order) -> DataFrame:
        lead = of.groupBy("key").agg(F.max(F.struct(order.alias("o"), F.col("node").alias("a"), F.col("root").alias("ra"))).alias("l"), F.count("*").alias("n")).select("key", "l.*", "n")
        lead = written(lead, "near-leaders")
        return spread_join(of, lead, ["key"], known=bounds(lead)).where("root != ra").select("a", F.col("node").alias("b"))

    tested = written(_close(pairs.union(stars(members, F.col("degree"))), nodes), "near-pairs")
    found = written(alike(tested, rows), "near-links")
    found = found if known is None else known.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")).union(found)
    turn, before = 0, None
    while True:
        roots = written(components(found), "near-roots")
        members, left, pairs = _apart(members, roots)
        if not left:
            return roots
        turn += 1
        last = pairs <= PAIRS_PER_MEMBER * left or (before is not None and left > 0.9 * before)
        before = left
        more = _all_pairs(members, nodes) if last else _close(stars(members, F.xxhash64("node", F.lit(turn))), nodes)
        more = written(more.join(tested, ["a", "b"], "left_anti"), "near-pairs")
        tested = tested.union(more)
        found = found.union(written(alike(more, rows), "near-links"))
        if last:
            return written(components(found), "near-roots")


def _grouped(groups: DataFrame, own: DataFrame, nodes: DataFrame, known: tuple[int, int, int]) -> DataFrame:
    """(node, key), each once, of the groups (uid, key) with several members: every copy of a set brings its key to the set's node. ``known`` bounds the copies."""
    sizes = written(groups.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "near-sizes")
    sets = nodes.select("s1", "s2", "copies", F.col("uid").alias("node"))
    of_row = spread_join(own.select("uid", "s1", "s2"), sets, ["s1", "s2"], "copies", known=known).select("uid", "node")
    return spread_join(groups, sizes, ["key"], known=bounds(sizes)).join(of_row, "uid").select("node", "key").distinct()


def near_copies(rows: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """(uid, doc_id, component) for every row of (uid, doc_id, text): component is a uid, the same for all that links connect.

    ``groups`` are (uid, key) of rows that another method takes for near copies, keys being longs, one for each row: their texts
    are compared first, links by their exact Jaccard alone, and bands then look for all that is not connected yet. ``rows`` is a written table with unique uids; its doc_ids may be null or repeated. Null texts count as empty; texts without words
    are one component, as are texts of equal shingle sets. Texts of any length and bytes are read whole. Empty tables give none.
    """
    small_batches(rows.sparkSession)
    rows = rows.select("uid", "doc_id", raw(rows, "text").alias("text"))
    own = written(profile(rows), "near-profile")
    nodes = own.groupBy("s1", "s2").agg(F.min(F.struct("uid", "n", "keys", "bits")).alias("m"), F.count("*").alias("copies")).select("s1", "s2", "copies", "m.*")
    nodes = written(nodes, "near-nodes")
    copies, known = bounds(nodes, "copies"), None
    if groups is not None:
        known = links(written(_grouped(written(groups, "near-groups"), own, nodes, copies), "near-grouped"), nodes, rows)
    spread = nodes.select(F.col("uid").alias("node"), F.explode("keys").alias("key"))
    roots = links(spread, nodes, rows, known).withColumnRenamed("node", "uid")
    of_set = nodes.select("s1", "s2", "copies", "uid").join(roots, "uid", "left").select("s1", "s2", "copies", F.coalesce("root", "uid").alias("component"))
    of_set = written(of_set, "near-components")
    return spread_join(own.select("uid", "doc_id", "s1", "s2"), of_set, ["s1", "s2"], "copies", known=copies).select("uid", "doc_id", "component")
