"""Quality rules: fixed rules on counts, then a logistic regression on hashed word and character n-grams.

The regression is trained on a bounded sample of labelled rows, its probabilities are calibrated on another part of that
sample (Platt scaling), and whole texts are scored in Arrow batches against a fixed threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from colloquy.llm.shared import Rolling, decoded, labelled_sample, mixed, raw, small_batches, with_columns
from colloquy.llm.text_stats import BASE, TextStats


@dataclass(frozen=True)
class Settings:
    """sample_rows bounds the training sample; threshold is the least probability of good quality that a kept text has."""

    bits: int = 18
    words: tuple[int, ...] = (1, 2)
    chars: tuple[int, ...] = (2, 3)
    sample_rows: int = 3000
    rounds: int = 100
    rate: float = 0.15
    decay: float = 1e-4
    threshold: float = 0.5
    min_words: int = 10
    max_repeat_percent: int = 20
    seed: int = 5


class Grams:
    """Text -> hashed n-gram numbers below ``2**bits``, an array for each family: n-grams of words, then of characters (code points)."""

    def __init__(self, s: Settings):
        self.s, self.stats = s, TextStats()
        self.roll = Rolling(0xD6E8FEB86659FD93)

    def of(self, text: str, hashes: np.ndarray) -> list[np.ndarray]:
        down = np.uint64(64 - self.s.bits)
        code = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64) + np.uint64(1)
        found = [(self.roll.windows(hashes, n), n) for n in self.s.words] + [(self.roll.windows(code, n), 64 + n) for n in self.s.chars]
        return [(mixed(h ^ np.uint64(0x51ED270B * salt)) >> down).astype(np.int64) for h, salt in found]


def _scale(k: int) -> float:
    """Each family's shares add up to 1 and are scaled alike, so long and short texts compare."""
    return 20.0 / max(1, k) if k else 0.0


def row_of(text: str, grams: Grams) -> tuple[np.ndarray, np.ndarray]:
    """(columns, values) of a text; at most ``2**bits`` of them for each family, however long the text is."""
    _, hashes = grams.stats.split(text.encode())
    columns, values = [], []
    for part in grams.of(text, hashes):
        own, count = np.unique(part, return_counts=True)
        columns.append(own)
        values.append(count * _scale(len(part)))
    return np.concatenate(columns).astype(np.int32), np.concatenate(values).astype(np.float32)


Rows = tuple[np.ndarray, np.ndarray, np.ndarray]


def stacked(rows: list[tuple[np.ndarray, np.ndarray]]) -> Rows:
    """Compressed sparse rows: (starts, columns, values)."""
    starts = np.concatenate([[0], np.cumsum([len(c) for c, _ in rows])]).astype(np.int64)
    return starts, np.concatenate([np.zeros(0, np.int32), *(c for c, _ in rows)]), np.concatenate([np.zeros(0, np.float32), *(v for _, v in rows)])


def dots(starts, columns, values, w) -> np.ndarray:
    sums = np.concatenate([[0.0], np.cumsum(w[columns] * values, dtype=np.float64)])
    return sums[starts[1:]] - sums[starts[:-1]]


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, s: Settings) -> tuple[np.ndarray, float, float]:
    """(weights with the intercept last, slope, shift): probability = sigmoid(slope * score + shift).

    Every fourth row is kept from the regression for the calibration, whatever their number. Adam steps over all other rows at
    once. Where these are of one class, or none, all weights are zero and the calibration alone decides.
    """
    size = 1 << s.bits
    y = labels.astype(np.float64)
    held = np.arange(len(y)) % 4 == 3
    w, bias = np.zeros(size), 0.0
    yt = y[~held]
    if len(set(yt)) == 2:
        starts, columns, values = stacked([r for r, k in zip(rows, held, strict=True) if not k])
        m = v = np.zeros(size + 1)
        row = np.repeat(np.arange(len(yt)), np.diff(starts))
        balance = np.where(yt > 0, 0.5 / yt.mean(), 0.5 / (1 - yt.mean()))
        for k in range(1, s.rounds + 1):
            p = 1 / (1 + np.exp(-np.clip(dots(starts, columns, values, w) + bias, -30, 30)))
            error = (p - yt) * balance / len(yt)
            g = np.append(np.bincount(columns, weights=values * error[row], minlength=size) + s.decay * w, error.sum())
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            step = s.rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-6)
            w, bias = w - step[:-1], bias - step[-1]
    scores = dots(*stacked([r for r, k in zip(rows, held, strict=True) if k]), w) + bias
    slope, shift = platt(scores, y[held])
    return np.append(w, bias).astype(np.float32), slope, shift


def platt(scores: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton steps for the two numbers of a sigmoid, with a little shrinking so that separable scores stay finite."""
    good, bad = y.sum(), (1 - y).sum()
    goal = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
    a, b = 1.0 / max(1.0, np.abs(scores).mean() if len(scores) else 1.0), 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * scores + b, -30, 30)))
        e, q = p - goal, np.maximum(p * (1 - p), 1e-9)
        grad = np.array([e @ scores + 1e-3 * a, e.sum()])
        hess = np.array([[q @ scores**2 + 1e-3, q @ scores], [q @ scores, q.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(hess, grad), -2, 2)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(max(a, 1e-6)), float(b)


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings(), label: str = "quality") -> tuple[np.ndarray, float, float]:
    """Fits on at most ``s.sample_rows`` labelled documents. Executors turn their texts into numbers; only these reach the driver."""
    small_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, s.sample_rows, s.seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(s)
        for batch in batches:
            made = [row_of(decoded(t), grams) for t in batch.columns[2].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *(pa.array([r[k].tobytes() for r in made], pa.binary()) for k in (0, 1))], ["doc_id", "label", "at", "value"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.select("doc_id", "label", raw(sample, "text")).mapInArrow(run, f"doc_id {kind}, label int, at binary, value binary").toPandas().sort_values("doc_id", kind="stable")
    return fit([(np.frombuffer(c, np.int32), np.frombuffer(v, np.float32)) for c, v in zip(rows["at"], rows["value"], strict=True)], rows["label"].to_numpy(), s)


def judge(df: DataFrame, model: tuple[np.ndarray, float, float], s: Settings = Settings(), text: str = "text") -> DataFrame:
    """Adds BASE, base_failed, score and kept to every row; equal-named columns are replaced, all others pass through.

    Null texts count as texts without words: they and all texts of under ``min_words`` words fail the fixed rules. score is
    the calibrated probability of good quality; kept is true if no fixed rule failed and score is at least the threshold.
    Texts are read whole, however long; bytes that are no UTF-8 count as U+FFFD. Repeated rows and equal texts get equal
    results. An empty table gives an empty result.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def start():
        weights, slope, shift = sent.value
        grams = Grams(s)

        def call(contents: pa.Array) -> list[pa.Array]:
            base, scores = [], []
            for t in map(decoded, contents.to_pylist()):
                words, hashes = grams.stats.split(t.encode())
                base.append(grams.stats.base(t, words, hashes))
                parts = grams.of(t, hashes)
                scores.append(sum(float(weights[p].sum()) * _scale(len(p)) for p in parts) + float(weights[-1]))
            counts = np.array(base, dtype=np.int64).reshape(-1, len(BASE))
            failed = (counts[:, 0] < s.min_words) | (100 * counts[:, 4] > s.max_repeat_percent * counts[:, 0])
            p = 1 / (1 + np.exp(-np.clip(slope * np.array(scores, dtype=np.float64) + shift, -30, 30)))
            return [*(pa.array(c) for c in counts.T), pa.array(failed), pa.array(p), pa.array(~failed & (p >= s.threshold))]

        return call

    made = [T.StructField(c, T.LongType()) for c in BASE]
    made += [T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    return with_columns(df, raw(df, text), made, start)
