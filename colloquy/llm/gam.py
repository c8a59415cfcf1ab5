"""Quality classifier: a generalised additive model with pairwise interactions.

Boosting visits the features in turn, again and again; each visit adds a small step tree of one feature to its table. Pairs
are ranked by how well a four-cell table explains what the single features left over, and the best get tables of their own.
A score is a sum of table look-ups, vectorised over a batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from colloquy.llm.shared import decoded, labelled_sample, raw, with_columns
from colloquy.llm.text_stats import FEATURES, TextStats


@dataclass(frozen=True)
class Settings:
    """sample_rows bounds the training sample; leaves is the size of a tree; pairs how many interactions are kept."""

    sample_rows: int = 12_000
    bins: int = 48
    pair_bins: int = 8
    rounds: int = 120
    pair_rounds: int = 60
    pairs: int = 10
    leaves: int = 3
    rate: float = 0.15
    least: float = 2.0
    seed: int = 13


@dataclass
class Gam:
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    bias: float
    pair_cuts: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of the rows of ``x``."""
        total = np.full(len(x), self.bias)
        for j, (cuts, table) in enumerate(zip(self.cuts, self.tables, strict=True)):
            total += table[np.searchsorted(cuts, x[:, j], side="right")]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[np.searchsorted(self.pair_cuts[a], x[:, a], side="right"), np.searchsorted(self.pair_cuts[b], x[:, b], side="right")]
        return total


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    own = np.unique(values)
    if len(own) <= bins:
        return (own[1:] + own[:-1]) / 2
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g, h, least):
    return g * g / (h + 1.0) * (h >= least)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, least: float) -> np.ndarray:
    """Bins' sums of gradients and curvatures -> a step per bin, from the best cuts found one after another."""
    spans = [(0, len(g))]
    up_g, up_h = np.concatenate([[0.0], np.cumsum(g)]), np.concatenate([[0.0], np.cumsum(h)])
    while len(spans) < leaves:
        best = (1e-12, None, None)
        for a, b in spans:
            if b - a < 2:
                continue
            lg, lh = up_g[a + 1 : b] - up_g[a], up_h[a + 1 : b] - up_h[a]
            tg, th = up_g[b] - up_g[a], up_h[b] - up_h[a]
            gain = np.where((lh >= least) & (th - lh >= least), _gain(lg, lh, least) + _gain(tg - lg, th - lh, least) - _gain(tg, th, least), 0.0)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (a, b), a + 1 + k)
        if best[1] is None:
            break
        a, b = best[1]
        spans.remove((a, b))
        spans += [(a, best[2]), (best[2], b)]
    out = np.empty(len(g))
    for a, b in spans:
        out[a:b] = -(up_g[b] - up_g[a]) / (up_h[b] - up_h[a] + 1.0)
    return out


def fit(x: np.ndarray, y: np.ndarray, s: Settings = Settings()) -> Gam:
    """Trains on all rows given; one class alone, or no rows, gives a model that knows only the share of ones."""
    share = (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(share / (1 - share)))
    cuts = [_edges(x[:, j], s.bins) if len(x) else np.zeros(0) for j in range(x.shape[1])]
    model = Gam(cuts, [np.zeros(len(c) + 1) for c in cuts], bias)
    model.pair_cuts = [_edges(x[:, j], s.pair_bins) if len(x) else np.zeros(0) for j in range(x.shape[1])]
    if not len(y) or y.min() == y.max():
        return model
    at = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(cuts)]
    total = np.full(len(y), bias)

    def slopes():
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return p - y, p * (1 - p)

    for _ in range(s.rounds):
        for j, table in enumerate(model.tables):
            if len(table) < 2:
                continue
            g, h = slopes()
            step = s.rate * _tree(np.bincount(at[j], g, len(table)), np.bincount(at[j], h, len(table)), s.leaves, s.least)
            table += step
            total += step[at[j]]
    g, h = slopes()
    rough = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(model.pair_cuts)]
    widths = [len(c) + 1 for c in model.pair_cuts]
    ranked = []
    for a, b in combinations(range(x.shape[1]), 2):
        cell = rough[a] * widths[b] + rough[b]
        sg = np.bincount(cell, g, widths[a] * widths[b]).reshape(widths[a], widths[b]).cumsum(0).cumsum(1)
        sh = np.bincount(cell, h, widths[a] * widths[b]).reshape(widths[a], widths[b]).cumsum(0).cumsum(1)
        quarters = [(v[:-1, :-1], v[:-1, -1:] - v[:-1, :-1], v[-1:, :-1] - v[:-1, :-1], v[-1, -1] - v[:-1, -1:] - v[-1:, :-1] + v[:-1, :-1]) for v in (sg, sh)]
        gain = sum(_gain(q, r, s.least) for q, r in zip(*quarters, strict=True))
        if gain.size:
            ranked.append((float(gain.max()), a, b))
    for _, a, b in sorted(ranked, key=lambda r: (-r[0], r[1], r[2]))[: s.pairs]:
        model.pairs.append((a, b))
        model.pair_tables.append(np.zeros((widths[a], widths[b])))
    for _ in range(s.pair_rounds):
        for (a, b), table in zip(model.pairs, model.pair_tables, strict=True):
            g, h = slopes()
            cell = rough[a] * widths[b] + rough[b]
            sg, sh = (np.bincount(cell, v, table.size).reshape(table.shape) for v in (g, h))
            # A tree of depth two: the best cut of one feature, then each side's own cut of the other.
            first = _tree(sg.sum(1), sh.sum(1), 2, s.least)
            step = np.empty_like(table)
            for value in np.unique(first):
                side = first == value
                step[side] = _tree(sg[side].sum(0), sh[side].sum(0), 2, s.least)
            step *= s.rate
            table += step
            total += step[rough[a], rough[b]]
    return model


def _features(contents: pa.Array, stats: TextStats) -> list[list[float]]:
    return [stats.features(t, t.encode()) for t in map(decoded, contents.to_pylist())]


def featured(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``features``: FEATURES of the whole text; null counts as empty. Other columns pass through."""

    def start():
        stats = TextStats()
        return lambda contents: [pa.array(_features(contents, stats), pa.list_(pa.float64()))]

    return with_columns(df, raw(df, text), [T.StructField("features", T.ArrayType(T.DoubleType()))], start)


def train(docs: DataFrame, labels: DataFrame, where=None, s: Settings = Settings(), label: str = "quality") -> Gam:
    """Fits on at most ``s.sample_rows`` labelled documents; their features, computed on executors, reach the driver."""
    rows = featured(labelled_sample(docs, labels, label, s.sample_rows, s.seed, where)).drop("text").toPandas()
    x = np.array(rows["features"].tolist(), dtype=np.float64).reshape(-1, len(FEATURES))
    order = np.lexsort((*x.T, rows["doc_id"].to_numpy()))
    return fit(x[order], rows["label"].to_numpy().astype(np.float64)[order], s)


def score(df: DataFrame, model: Gam, text: str = "text") -> DataFrame:
    """Adds score (0 to 1) and predicted (1 if score >= 0.5) to every row; equal-named columns are replaced, all others pass through.

    Null and empty texts have zeros as features and get the score of these. Texts are read whole, however long; bytes that are
    no UTF-8 count as U+FFFD. Repeated rows and equal texts get equal scores. An empty table gives an empty result.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def start():
        stats, gam = TextStats(), sent.value

        def call(contents: pa.Array) -> list[pa.Array]:
            x = np.array(_features(contents, stats), dtype=np.float64).reshape(-1, len(FEATURES))
            p = 1 / (1 + np.exp(-np.clip(gam.scores(x), -30, 30)))
            return [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]

        return call

    return with_columns(df, raw(df, text), [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())], start)
