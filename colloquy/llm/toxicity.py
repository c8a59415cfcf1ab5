"""Toxicity: FTRL-proximal logistic regression on hashed word n-grams and skip-grams.

Each coordinate has its own learning rate, and L1 keeps most weights at exactly zero, so that the broadcast model is a short
list of numbers and weights. Training sees a bounded sample of labelled rows; all texts are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from colloquy.llm.shared import WordHashes, decoded, labelled_sample, mixed, raw, small_batches, with_columns


@dataclass(frozen=True)
class Settings:
    """sample_rows bounds the training sample; alpha, beta, l1 and l2 are FTRL's; words are the lengths of the n-grams and skips
    the gaps of the skip-grams, which are pairs with so many words between. stems are numbers of letters: single words count as
    stemmed ones too, cut to so many, so that inflected and compound forms share a weight."""

    bits: int = 20
    sample_rows: int = 6_000
    epochs: int = 8
    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 1.0
    words: tuple[int, ...] = (1, 2)
    skips: tuple[int, ...] = (1,)
    stems: tuple[int, ...] = (5, 6)
    seed: int = 9


#: Bytes that the ends of a word may lose, so that a word is the same before a comma or a mark: ASCII other than letters and digits.
EDGES = bytes(b for b in range(33, 127) if not chr(b).isalnum())


class BareWords(WordHashes):
    """Hashes of words without their EDGES, or of the first ``letters`` characters of what is left."""

    def __init__(self, letters: int = 0):
        super().__init__()
        self.letters = letters

    def __missing__(self, word: bytes) -> int:
        bare = word.strip(EDGES)
        if self.letters:
            bare = bare.decode()[: self.letters].encode()
        return self.keep(word, xxhash.xxh3_64_intdigest(bare, self.letters))


class Grams:
    """Text -> numbers of its word n-grams and skip-grams, lower case."""

    STEP = np.uint64(0xC2B2AE3D27D4EB4F)

    def __init__(self, s: Settings):
        self.s, self.words, self.stems = s, BareWords(), [BareWords(k) for k in s.stems]

    def of(self, text: str) -> np.ndarray:
        words = text.lower().encode().split()
        h = self.words.of(words)
        own = list(dict.fromkeys(words)) if self.stems else []
        parts, gram = [mixed(stems.of(own)) for stems in self.stems], h
        for n in range(1, max(self.s.words) + 1):
            if n > 1:
                gram = mixed(gram[:-1] * self.STEP) + h[n - 1 :] if len(h) >= n else h[:0]
            if n in self.s.words:
                parts.append(mixed(gram + np.uint64(n)))
        for k in self.s.skips:
            parts.append(mixed(mixed(h[: -k - 1] * self.STEP) + h[k + 1 :] + np.uint64(64 + k)) if len(h) > k + 1 else h[:0])
        return (np.concatenate(parts) >> np.uint64(64 - self.s.bits)).astype(np.int64)


def fit(rows: list[np.ndarray], labels: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, float]:
    """(numbers, weights, intercept) of the weights that are not zero; rows (distinct numbers each) are visited in a fixed random order."""
    size = (1 << s.bits) + 1  # the last coordinate is the intercept, without L1
    z, n = np.zeros(size), np.zeros(size)
    order = np.random.default_rng(s.seed)
    sets = [np.append(r, np.int32(size - 1)) for r in rows]
    l1 = s.l1

    def weights(at):
        own = z[at]
        w = -(own - np.sign(own) * l1) / ((s.beta + np.sqrt(n[at])) / s.alpha + s.l2)
        w[np.abs(own) <= l1] = 0.0
        if at[-1] == size - 1:
            w[-1] = -own[-1] / ((s.beta + np.sqrt(n[size - 1])) / s.alpha)
        return w

    for _ in range(s.epochs):
        for k in order.permutation(len(sets)):
            at = sets[k]
            w = weights(at)
            g = 1 / (1 + np.exp(-min(30.0, max(-30.0, w.sum())))) - labels[k]
            squares = n[at]
            z[at] += g - (np.sqrt(squares + g * g) - np.sqrt(squares)) / s.alpha * w
            n[at] = squares + g * g
    w = weights(np.arange(size))
    found = np.nonzero(w[:-1])[0]
    return found, w[found], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, where=None, s: Settings = Settings(), label: str = "toxic") -> tuple[np.ndarray, np.ndarray, float]:
    """Fits on at most ``s.sample_rows`` labelled documents of those that ``where`` (on the label table) admits.

    Executors turn the sampled texts into numbers; only these reach the driver. Without labels all scores are 0.5.
    """
    small_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, label, s.sample_rows, s.seed, where)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(s)
        for batch in batches:
            made = [np.unique(grams.of(decoded(t))).astype(np.int32).tobytes() for t in batch.columns[2].to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(made, pa.binary())], ["doc_id", "label", "grams"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.select("doc_id", "label", raw(sample, "text")).mapInArrow(run, f"doc_id {kind}, label int, grams binary").toPandas().sort_values("doc_id", kind="stable")
    return fit([np.frombuffer(g, np.int32) for g in rows["grams"]], rows["label"].to_numpy(), s)


def score(df: DataFrame, model: tuple[np.ndarray, np.ndarray, float], s: Settings = Settings(), text: str = "text") -> DataFrame:
    """Adds score (0 to 1) and predicted (1 if score >= 0.5) to every row; equal-named columns are replaced, all others pass through.

    Null and empty texts get the intercept's probability. Texts are read whole, however long; bytes that are no UTF-8 count as
    U+FFFD. Repeated rows and equal texts get equal scores. An empty table gives an empty result.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def start():
        found, w, bias = sent.value
        dense = np.zeros(1 << s.bits, np.float32)
        dense[found] = w
        grams = Grams(s)

        def call(contents: pa.Array) -> list[pa.Array]:
            sums = []
            for t in contents.to_pylist():
                at = grams.of(decoded(t))
                own = np.unique(at[dense[at] != 0])
                sums.append(float(dense[own].sum(dtype=np.float64)) + bias)
            p = 1 / (1 + np.exp(-np.clip(np.array(sums, dtype=np.float64), -30, 30)))
            return [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]

        return call

    return with_columns(df, raw(df, text), [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())], start)
