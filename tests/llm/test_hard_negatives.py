"""Hard negatives against plain Python, on awkward rows and with small blocks."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquy.llm import hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score string, `a_uid` int"


def plain(rows, anchor, window=(80, 100), k=5, scale=256):
    own = []
    for uid, (ident, v, label) in enumerate(rows):
        if ident is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            own.append((uid, ident, label, [math.floor(scale * float(np.float32(x))) for x in v]))
    out = []
    for uid, ident, label, v in own:
        if not anchor(ident):
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), name, other, kind == label) for other, name, kind, w in own if other != uid]
        scored.sort()
        for minus, name, _, _ in [s for s in scored if s[3]][:k]:
            fit = [s for s in scored if not s[3] and window[0] * -minus <= window[1] * -s[0] <= window[1] * -minus][:k]
            out += [(ident, name, n + 1, s[1], -minus, -s[0]) for n, s in enumerate(fit)]
    return sorted(out)


def rows_of(seed, n, dims=7, spread=1.0):
    rng = random.Random(seed)
    middle = [[rng.gauss(0, spread) for _ in range(dims)] for _ in range(6)]
    rows = [(k, [x + rng.gauss(0, 0.4) for x in rng.choice(middle)], rng.randrange(4)) for k in range(n)]
    # Copies with other ids and other labels, repeated rows, short and empty vectors, and what takes no part.
    rows += [(1000 + k, rows[k][1], rows[k][2]) for k in range(60)] + [(2000 + k, rows[k][1], (rows[k][2] + 1) % 4) for k in range(60)] + [rows[10]] * 5
    rows += [(3000, [0.5], 1), (3010, [], 1), (3020, None, 1), (3030, [None] * dims, 1), (3040, [1.0, math.nan], 2), (3050, [math.inf] * dims, 0), (3060, [1.0] * dims, None), (None, [1.0] * dims, 1)]
    rng.shuffle(rows)
    return rows


def ours(spark, rows, **more):
    df = spark.createDataFrame([(*r, "mine", 1) for r in rows], SCHEMA).coalesce(1)
    return sorted(map(tuple, hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, **more).collect()))


def test_equals_plain_python(spark, monkeypatch):
    rows = rows_of(1, 400)
    want = plain(rows, lambda i: i % 10 == 0)
    assert len(want) > 300 and ours(spark, rows) == want
    # Many blocks of rows and of anchors, and few rows for the codebooks: the same rows come out.
    monkeypatch.setattr(hard_negatives, "BLOCK", 500)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 9)
    monkeypatch.setattr(hard_negatives, "SAMPLE", 3)
    assert ours(spark, rows) == want
    assert ours(spark, rows, window=(95, 100), positives=2, negatives=3) != want


def test_bounds_hold_and_filter():
    """Scores lie within their bounds, whatever the codebooks; and bounds do drop rows, so the index is what selects."""
    rng = np.random.default_rng(2)
    vectors = rng.integers(-130, 130, (3000, 9))
    for books in (hard_negatives.codebooks(np.pad(vectors[:500], ((0, 0), (0, 1)))), rng.integers(-99, 99, (5, 256, 2))):
        index = hard_negatives.Index(books, 9, np.float64)
        codes, norms = index.encode(vectors)
        n = len(vectors)
        own = np.arange(n, dtype=np.int64).tobytes()
        cell = hard_negatives.Cell(index, {"n": n, "uids": own, "ids": own, "labels": own, "codes": codes.tobytes(), "norms": norms.tobytes(), "vectors": vectors.astype(np.int64).tobytes()})
        for anchor in vectors[:20]:
            least, most = cell.bounds(anchor)
            score = vectors @ anchor
            assert (least <= score).all() and (score <= most).all()
    fitted = hard_negatives.Index(hard_negatives.codebooks(np.pad(vectors[:500], ((0, 0), (0, 1)))), 9, np.float64)
    codes, norms = fitted.encode(vectors)
    cell = hard_negatives.Cell(fitted, {"n": n, "uids": own, "ids": own, "labels": own, "codes": codes.tobytes(), "norms": norms.tobytes(), "vectors": vectors.astype(np.int64).tobytes()})
    seen = []
    cell.exact = type("Seen", (), {"__getitem__": lambda self, rows: seen.append(len(rows)) or vectors[rows].astype(float)})()
    least, most = cell.bounds(vectors[0])
    cell.best(vectors[0], np.arange(1, n), least, most, 5)
    assert seen[0] < n / 10


def test_large_components(spark):
    """Products beyond 53 bits stay exact; those beyond 64 are refused."""
    rng = random.Random(4)
    rows = [(k, [rng.choice([-1, 1]) * (1e5 + rng.randrange(9) / 256) for _ in range(3)], k % 2) for k in range(80)]
    assert ours(spark, rows) == plain(rows, lambda i: i % 10 == 0)
    with pytest.raises(ValueError):
        ours(spark, [(0, [1e30], 1)])


def test_empty(spark):
    assert ours(spark, []) == [] and ours(spark, [(10, [1.0], 1)]) == [] and ours(spark, [(11, [1.0], 1), (12, [1.0], 2)]) == []
    assert ours(spark, [(20, None, 1), (None, [1.0], 2)]) == []
