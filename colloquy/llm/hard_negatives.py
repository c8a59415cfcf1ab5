"""Hard negatives by product quantisation with stored residual norms; every result is decided by exact integer products.

Vectors become whole numbers. Codebooks of whole-numbered centroids, one for each pair of components, are fitted on a bounded
sample; every row is indexed by its codes and by the norm of what they leave over. For an anchor a table of products with all
centroids gives each row's score up to |anchor| * |rest| (Cauchy-Schwarz). Rows whose bounds cannot reach the first places, or
the window of a positive, are dropped; all others get their exact score. Nothing is approximate in the result.

Anchors and rows are dealt into blocks of bounded size. Each pair of blocks is a task's work of its own and leaves at most
``depth`` rows for each anchor (and positive), so neither a label nor an anchor gathers rows anywhere. Anchors are a share of the rows,
so the products grow with the square of the table, as the search set against all rows asks for; only they do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.shared import quoted, small_batches, written

#: Components in a part, centroids of a part's codebook, and rows of the sample that codebooks are fitted on (of vectors of
#: over BLOCK / SAMPLE components fewer, so that the sample has no more than BLOCK of them).
PART, CENTROIDS, SAMPLE = 2, 256, 4096
#: Components in a block of rows, and anchors in a block.
BLOCK, ANCHORS = 1 << 20, 1024


def codebooks(sample: np.ndarray, rounds: int = 4) -> np.ndarray:
    """(parts, CENTROIDS, PART) whole-numbered centroids by k-means on (rows, parts * PART); the sample is in a fixed order."""
    out = []
    for part in np.split(sample.astype(np.float64), sample.shape[1] // PART, axis=1):
        # Seeds evenly along the first component; those without rows stay where they are.
        seeds = part[np.lexsort((part[:, 1], part[:, 0]))][np.linspace(0, len(part) - 1, CENTROIDS).astype(int)]
        for _ in range(rounds):
            near = _nearest(part, seeds)
            n = np.bincount(near, minlength=CENTROIDS)
            means = np.stack([np.bincount(near, weights=part[:, k], minlength=CENTROIDS) for k in range(PART)], axis=1) / np.maximum(n, 1)[:, None]
            seeds = np.where(n[:, None] > 0, means, seeds)
        out.append(np.rint(seeds))
    return np.stack(out).astype(np.int64)


def _nearest(rows: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Any choice is right, as the rest's norm is stored; so rounding in the distances does no harm."""
    c = centroids.astype(np.float64)
    return (np.square(c).sum(axis=1) - 2 * rows.astype(np.float64) @ c.T).argmin(axis=1)


class Index:
    """Codes of rows and norms of their rests."""

    def __init__(self, books: np.ndarray, dims: int, kind: type):
        self.books, self.parts, self.dims, self.kind = books, len(books), dims, kind
        self.offsets = np.arange(self.parts) * CENTROIDS

    def padded(self, vectors: np.ndarray) -> np.ndarray:
        return np.pad(vectors, ((0, 0), (0, self.parts * PART - self.dims)))

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, norms) of whole-numbered rows; norms are rounded up."""
        wide = self.padded(vectors)
        codes, square = np.empty((len(vectors), self.parts), np.uint8), np.zeros(len(vectors))
        for k in range(self.parts):
            own = wide[:, k * PART : (k + 1) * PART]
            codes[:, k] = _nearest(own, self.books[k])
            square += np.square((own - self.books[k][codes[:, k]]).astype(np.float64)).sum(axis=1)
        return codes, np.sqrt(square) * (1 + 1e-9) + 1e-6

    def table(self, anchor: np.ndarray) -> np.ndarray:
        """Products of an anchor's parts with all centroids, one part after the other."""
        own = self.padded(anchor[None])[0].reshape(self.parts, 1, PART)
        return (self.books * own).sum(axis=2).ravel()


def _array(content: bytes, kind: type, *shape: int) -> np.ndarray:
    return np.frombuffer(content, dtype=kind).reshape(shape)


class Cell:
    """A block of anchors meets a block of rows: exact first places among the rows of a cell."""

    def __init__(self, index: Index, row: dict):
        n, d = row["n"], index.dims
        self.index = index
        self.uids, self.ids, self.labels = (_array(row[c], np.int64, n) for c in ("uids", "ids", "labels"))
        self.norms, self.vectors = _array(row["norms"], np.float64, n), _array(row["vectors"], np.int64, n, d)
        self.exact = self.vectors.astype(index.kind)
        self.at = _array(row["codes"], np.uint8, n, index.parts).astype(np.intp) + index.offsets

    def bounds(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest score that each row can have."""
        about = self.index.table(anchor)[self.at].sum(axis=1)
        slack = np.floor(self.norms * (np.sqrt(np.square(anchor.astype(np.float64)).sum()) * (1 + 1e-9)) + 1).astype(np.int64)
        return about - slack, about + slack

    def best(self, anchor: np.ndarray, rows: np.ndarray, least: np.ndarray, most: np.ndarray, depth: int, inside: Callable[[np.ndarray], np.ndarray] | None = None) -> list[tuple[int, int, int]]:
        """(score, id, row) of the first ``depth`` of ``rows`` by score and id, of those in a window if ``inside`` is one.

        ``inside`` tells of scores by their signs: -1 below the window, 0 in it, 1 above it.
        """
        low, high = least[rows], most[rows]
        sure = low
        if inside:
            at_low, at_high = inside(low), inside(high)
            sure = low[(at_low == 0) & (at_high == 0)]
            may = (at_high >= 0) & (at_low <= 0)
            rows, high = rows[may], high[may]
        if len(sure) > depth:
            rows = rows[high >= np.partition(sure, len(sure) - depth)[len(sure) - depth]]
        scores = (self.exact[rows] @ anchor.astype(self.index.kind)).astype(np.int64)
        if inside:
            may = inside(scores) == 0
            rows, scores = rows[may], scores[may]
        first = np.lexsort((self.uids[rows], self.ids[rows], -scores))[:depth]
        return [(int(scores[k]), int(self.ids[rows[k]]), int(rows[k])) for k in first]


def _blocks(rows: DataFrame, index: Index, blocks: int, salt: int) -> DataFrame:
    """(block, n, uids, ids, labels, codes, norms, vectors): rows dealt by their own number into ``blocks`` blocks, each packed in one row."""

    def pack(batch: pa.Table) -> pa.Table:
        vectors = np.zeros((batch.num_rows, index.dims), np.int64)
        lists = batch["x"].combine_chunks()
        lengths = np.diff(lists.offsets.to_numpy())
        vectors[np.arange(index.dims) < lengths[:, None]] = lists.flatten().to_numpy()
        codes, norms = index.encode(vectors)
        parts = [batch["uid"].to_numpy(), batch["id"].to_numpy(), batch["label"].to_numpy(), codes, norms, vectors]
        return pa.table([batch["block"][:1].combine_chunks(), pa.array([batch.num_rows], pa.int64()), *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in parts)],
                        ["block", "n", "uids", "ids", "labels", "codes", "norms", "vectors"])

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(salt)), F.lit(blocks)))
    return dealt.groupBy("block").applyInArrow(pack, "block long, n long, uids binary, ids binary, labels binary, codes binary, norms binary, vectors binary")


def hard_negatives(df: DataFrame, anchors: Column, ident: str = "vec_id", vector: str = "embedding", label: str | Column = "label", scale: int = 256,
                   window: tuple[int, int] = (80, 100), positives: int = 5, negatives: int = 5) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``df``.

    Components count as floor(scale * x), and a row's score is its product with the anchor. ``anchors``, a condition on the columns
    of ``df``, says which rows are anchors. An anchor's positives are its first ``positives`` other rows of the same label, by score,
    ties by the smaller id. For each of them, the first ``negatives`` rows of another label are returned whose score s has
    window[0] * p <= window[1] * s <= window[1] * p, where p is the positive's score; a negative p has none.
    Rows with a null id, label or vector, or with a component that is null or not finite, take no part. Shorter vectors count as
    filled up with zeros. Rows that repeat an id are rows of their own, as anchors, positives and negatives; equal scores and ids
    keep the order of reading. Ids and labels are whole numbers. Tables whose products could leave 64 bits are refused by an
    error. Other columns are ignored, whatever their names. Tables without anchors, and empty ones, give empty results.
    """
    small_batches(df.sparkSession)
    own = quoted([label])[0] if isinstance(label, str) else label
    x = F.col("v")
    rows = df.select(F.monotonically_increasing_id().alias("uid"), quoted([ident])[0].cast("long").alias("id"), own.cast("long").alias("label"),
                     F.transform(quoted([vector])[0], lambda c: c.cast("double")).alias("v"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite)
    # Beyond 2**62 a double's floor would not fit a long; such tables are refused below.
    floors = F.transform(x, lambda c: F.floor(F.greatest(F.lit(-(2.0**62)), F.least(F.lit(2.0**62), c * scale))))
    rows = written(rows.withColumn("x", floors).drop("v"), "negatives-rows")
    greatest = F.max(F.expr("aggregate(x, 0D, (s, c) -> greatest(s, abs(double(c))))"))
    total, searched, dims, top = rows.agg(F.count("*"), F.count_if("anchor"), F.coalesce(F.max(F.size("x")), F.lit(0)), F.coalesce(greatest, F.lit(0.0))).first()
    dims = max(dims, 1)
    # Scores are multiplied by the window's bounds, and centroids lie within the greatest component.
    if (2 * top + 1) ** 2 * (dims + PART) * max(window) >= 2**62:
        raise ValueError("products of these vectors need more than 64 bits")
    kind = np.float64 if top**2 * dims < 2**52 else np.int64
    # A bounded sample, the least by a hash of their content, brought to one width.
    drawn = rows.orderBy(F.xxhash64("id", "x"), "id", "uid").limit(max(1, min(SAMPLE, BLOCK // dims))).select("x").collect() if total else []
    width = -(-dims // PART) * PART
    sample = np.zeros((max(1, len(drawn)), width), np.int64)
    for k, r in enumerate(drawn):
        sample[k, : len(r.x)] = r.x
    index = Index(codebooks(sample), dims, kind)
    n_rows, n_anchors = max(1, -(-total * dims // BLOCK)), max(1, -(-searched // ANCHORS))
    packed = written(_blocks(rows, index, n_rows, 1), "negatives-blocks")
    asked = written(_blocks(rows.where("anchor"), index, n_anchors, 2).select(
        F.col("block").alias("a_block"), F.struct("n", "uids", "ids", "labels", "vectors").alias("a")), "negatives-anchors")
    # Each block of rows meets each block of anchors: a stated search set against all rows, in blocks.
    cells = packed.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_anchors - 1).cast("long"))).alias("a_block"), "block", F.struct(*packed.columns[1:]).alias("r"))
    meet = ["a_block", "block"]
    there = asked.select("a_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_rows - 1).cast("long"))).alias("block"), "a")

    def anchors_of(cell: dict) -> Iterator[tuple[int, int, int, np.ndarray]]:
        n = cell["n"]
        uids, ids, labels = (_array(cell[c], np.int64, n).tolist() for c in ("uids", "ids", "labels"))
        yield from zip(uids, ids, labels, _array(cell["vectors"], np.int64, n, dims), strict=True)

    def first_same(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                cell, out = Cell(index, batch.column(0)[k].as_py()), []
                for uid, ident, kind_of, v in anchors_of(batch.column(1)[k].as_py()):
                    same = np.flatnonzero((cell.labels == kind_of) & (cell.uids != uid))
                    if len(same):
                        found = cell.best(v, same, *cell.bounds(v), positives)
                        out += [(uid, ident, s, other, int(cell.uids[at])) for s, other, at in found]
                yield _table(out, "a_uid", "anchor_id", "score", "id", "uid")

    def in_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = window
        for batch in batches:
            for k in range(batch.num_rows):
                cell, out = Cell(index, batch.column(0)[k].as_py()), []
                goals = {x["a_uid"]: x["goals"] for x in batch.column(2)[k].as_py() or ()}
                for uid, ident, kind_of, v in anchors_of(batch.column(1)[k].as_py()):
                    if uid not in goals:
                        continue
                    other, (least, most) = np.flatnonzero(cell.labels != kind_of), cell.bounds(v)
                    for goal in goals[uid]:
                        p = goal["score"]
                        found = cell.best(v, other, least, most, negatives, lambda s, p=p: (s > p).astype(np.int8) - (s * high < low * p)) if p >= 0 else []
                        out += [(uid, ident, goal["nth"], goal["id"], p, s, name, int(cell.uids[at])) for s, name, at in found]
                yield _table(out, "a_uid", "anchor_id", "nth", "positive_id", "positive_score", "score", "id", "uid")

    order = [F.col("score").desc(), F.col("id"), F.col("uid")]
    near = cells.join(there, meet).select("r", "a").mapInArrow(first_same, "a_uid long, anchor_id long, score long, id long, uid long")
    nth = F.row_number().over(Window.partitionBy("a_uid").orderBy(*order))
    near = near.withColumn("nth", nth.cast("long")).where(F.col("nth") <= positives)
    # An anchor's block follows from its number, so its goals travel with the block: ``positives`` rows for each of its anchors.
    near = near.groupBy("a_uid").agg(F.collect_list(F.struct("nth", "id", "score")).alias("goals")).withColumn("a_block", F.pmod(F.xxhash64("a_uid", F.lit(2)), F.lit(n_anchors)))
    goals = near.groupBy("a_block").agg(F.collect_list(F.struct("a_uid", "goals")).alias("goals"))
    goals = written(goals, "negatives-goals")
    asked = asked.join(goals, "a_block").select("a_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_rows - 1).cast("long"))).alias("block"), "a", "goals")
    hard = cells.join(asked, meet).select("r", "a", "goals").mapInArrow(
        in_windows, "a_uid long, anchor_id long, nth long, positive_id long, positive_score long, score long, id long, uid long")
    rank = F.row_number().over(Window.partitionBy("a_uid", "nth").orderBy(*order))
    return hard.withColumn("rank", rank).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _table(rows: list[tuple[int, ...]], *names: str) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], list(names))


SQL = r"""
WITH c AS (SELECT row_number() OVER () AS uid, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.uid AS a, a.id AS anchor_id, r.uid, r.id, r.label = a.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
      FROM c a JOIN c r ON a.uid <> r.uid WHERE a.id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id, uid) <= 5),
n AS (SELECT p.anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.a, p.uid ORDER BY s.score DESC, s.id, s.uid) AS rank
      FROM p JOIN s ON p.a = s.a AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
