"""Trained operators, sharding, fingerprints and the pipeline's stages against naive versions of themselves."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from colloquy.llm import bpe, gam, mixing, quality_rules, queries, sharding, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sigmoid(x):
    return 1 / (1 + math.exp(-min(30.0, max(-30.0, x))))


def texts_of(seed, n):
    rng = random.Random(seed)
    return [" ".join(rng.choice(("Bad,", "bad", "good", "goodness", "über", "x!", "y", "naïvely", "Z", "zz")) for _ in range(rng.randint(0, 30))) for _ in range(n)]


# FTRL


def plain_grams(text):
    """Distinct grams of a text by name: words, pairs, pairs around a word, and words cut to five and six letters."""
    bare = [w.strip(toxicity.EDGES.decode()) for w in text.lower().split()]
    out = {("w", w) for w in bare} | {("ww", *p) for p in zip(bare, bare[1:])} | {("w_w", *p) for p in zip(bare, bare[2:])}
    return out | {(k, w[:k]) for w in bare for k in (5, 6)}


def test_grams_are_what_they_say():
    s = toxicity.Settings(bits=60)
    grams, number = toxicity.Grams(s), {}
    for t in texts_of(1, 400):
        own, got = plain_grams(t), set(grams.of(t).tolist())
        assert len(own) == len(got)
        for one in own:  # equal grams have equal numbers in all texts: those seen before must be among these
            assert number.get(one) is None or number[one] in got
        if len(own) <= 4:
            fresh = [g for g in own if g not in number]
            if len(fresh) == 1:
                number[fresh[0]] = (got - {number[g] for g in own if g in number}).pop()


@pytest.mark.parametrize("l1", [0.0, 0.6, 4.0])
def test_ftrl_equals_naive(l1):
    rng = np.random.default_rng(2)
    s = toxicity.Settings(bits=6, epochs=3, l1=l1)
    rows = [np.unique(rng.integers(0, 64, rng.integers(0, 9))).astype(np.int32) for _ in range(120)]
    y = np.array([float(len(r) and r.min() < 9) for r in rows])
    z, n = Counter(), Counter()

    def weight(i):
        if i == "bias":
            return -z[i] / ((s.beta + math.sqrt(n[i])) / s.alpha)
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((s.beta + math.sqrt(n[i])) / s.alpha + s.l2)

    order = np.random.default_rng(s.seed)
    for _ in range(s.epochs):
        for k in order.permutation(len(rows)):
            at = [*rows[k].tolist(), "bias"]
            w = {i: weight(i) for i in at}
            g = sigmoid(sum(w.values())) - y[k]
            for i in at:
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / s.alpha * w[i]
                n[i] += g * g
    found, w, bias = toxicity.fit(rows, y, s)
    want = {i: weight(i) for i in range(64) if weight(i)}
    assert found.tolist() == sorted(want) and np.allclose(w, [want[i] for i in sorted(want)]) and abs(bias - weight("bias")) < 1e-9
    assert not l1 or len(found) < 64


def test_scores_of_weights(spark):
    s, texts = toxicity.Settings(bits=12), texts_of(3, 60)
    rng = np.random.default_rng(3)
    found = np.sort(rng.choice(1 << 12, 900, replace=False))
    model = found, rng.normal(size=900), -0.3
    weights, grams = dict(zip(found.tolist(), model[1].tolist(), strict=True)), toxicity.Grams(s)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in toxicity.score(df, model, s).collect():
        p = sigmoid(sum(weights.get(i, 0.0) for i in set(grams.of(r.text).tolist())) - 0.3)
        assert abs(r.score - p) < 1e-6 and r.predicted == (r.score >= 0.5)


@pytest.mark.parametrize(("query", "label", "modulus", "held"), [(queries.op6_toxicity, "toxic", 5, 0), (queries.op10_gam, "quality", 3, 1)])
def test_held_out_labels_change_no_score(spark, sf, tmp_path, query, label, modulus, held):
    """With the labels of held-out rows turned round all scores are the same; with those of other rows they are not."""
    out = [{r.doc_id: r.score for r in query(spark, sf).collect()}]
    for k, inside in enumerate((True, False)):
        (tmp_path / f"{k}").mkdir()
        spark.read.parquet(f"{sf}/documents.parquet").write.parquet(f"{tmp_path}/{k}/documents.parquet")
        rows = spark.read.parquet(f"{sf}/labels.parquet")
        turned = (F.crc32(F.col("doc_id").cast("string")) % modulus == held) == F.lit(inside)
        rows.withColumn(label, F.when(turned, 1 - F.col(label)).otherwise(F.col(label))).write.parquet(f"{tmp_path}/{k}/labels.parquet")
        out.append({r.doc_id: r.score for r in query(spark, f"{tmp_path}/{k}").collect()})
    assert out[0] == out[1] != out[2]


# Boosting


def plain_tree(rows, leaves, least):
    """(bin, g, h) rows and the number of bins' best cuts, one after another, by trying all of them."""
    rows, n = rows
    gain = lambda part: (sum(g for _, g, _ in part) ** 2 / (sum(h for _, _, h in part) + 1) if sum(h for _, _, h in part) >= least else 0.0)
    spans = [(0, n)]
    while len(spans) < leaves:
        best = None
        for a, b in spans:
            for cut in range(a + 1, b):
                left, right = [r for r in rows if a <= r[0] < cut], [r for r in rows if cut <= r[0] < b]
                if min(sum(h for _, _, h in left), sum(h for _, _, h in right)) >= least:
                    more = gain(left) + gain(right) - gain(left + right)
                    if more > 1e-12 and (best is None or more > best[0] + 1e-12):
                        best = (more, (a, b), cut)
        if best is None:
            break
        spans.remove(best[1])
        spans += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.empty(n)
    for a, b in spans:
        own = [r for r in rows if a <= r[0] < b]
        out[a:b] = -sum(g for _, g, _ in own) / (sum(h for _, _, h in own) + 1)
    return out


def test_boosting_equals_naive():
    rng = np.random.default_rng(4)
    x = rng.integers(0, 6, (70, 3)).astype(float)
    y = ((x[:, 0] > 2) ^ (x[:, 1] > 3) | (rng.random(70) < 0.1)).astype(float)
    s = gam.Settings(rounds=4, pair_rounds=3, pairs=2, pair_bins=6, bins=6)
    model = gam.fit(x, y, s)
    at = [[int(v > np.array(c)) if np.ndim(c) == 0 else sum(v >= e for e in c) for v in x[:, j]] for j, c in enumerate(model.cuts)]
    share = (y.sum() + 1) / (len(y) + 2)
    total = [math.log(share / (1 - share))] * len(y)
    slopes = lambda: [(sigmoid(t) - v, sigmoid(t) * (1 - sigmoid(t))) for t, v in zip(total, y, strict=True)]
    tables = [np.zeros(len(c) + 1) for c in model.cuts]
    for _ in range(s.rounds):
        for j, table in enumerate(tables):
            step = s.rate * plain_tree(([(at[j][i], g, h) for i, (g, h) in enumerate(slopes())], len(table)), s.leaves, s.least)
            table += step
            total = [t + step[at[j][i]] for i, t in enumerate(total)]
    assert all(np.allclose(a, b) for a, b in zip(model.tables, tables, strict=True))
    # Pairs: the two that four cells explain best, then trees of depth two.
    left, best = slopes(), []
    for a, b in ((0, 1), (0, 2), (1, 2)):
        most = 0.0
        for i in range(1, len(tables[a])):
            for k in range(1, len(tables[b])):
                cells = {}
                for row, (g, h) in enumerate(left):
                    c = cells.setdefault((at[a][row] >= i, at[b][row] >= k), [0.0, 0.0])
                    c[0], c[1] = c[0] + g, c[1] + h
                most = max(most, sum(g * g / (h + 1) for g, h in cells.values() if h >= s.least))
        best.append((-most, a, b))
    assert model.pairs == [(a, b) for _, a, b in sorted(best)[:2]] and (0, 1) in model.pairs
    made = [np.zeros((len(tables[a]), len(tables[b]))) for a, b in model.pairs]
    for _ in range(s.pair_rounds):
        for (a, b), table in zip(model.pairs, made, strict=True):
            now = slopes()
            first = plain_tree(([(at[a][i], g, h) for i, (g, h) in enumerate(now)], len(tables[a])), 2, s.least)
            step = np.empty_like(table)
            for value in set(first.tolist()):
                side = {k for k, v in enumerate(first.tolist()) if v == value}
                step[sorted(side)] = plain_tree(([(at[b][i], g, h) for i, (g, h) in enumerate(now) if at[a][i] in side], len(tables[b])), 2, s.least)
            table += s.rate * step
            total = [t + s.rate * step[at[a][i], at[b][i]] for i, t in enumerate(total)]
    assert all(np.allclose(a, b) for a, b in zip(model.pair_tables, made, strict=True)) and np.allclose(model.scores(x), total)


# Regression


def test_regression_equals_dense():
    rng, s = np.random.default_rng(5), quality_rules.Settings(bits=5, rounds=30)
    rows, dense = [], np.zeros((90, 32))
    for k in range(90):
        at = np.sort(rng.choice(32, rng.integers(0, 12), replace=False)).astype(np.int32)
        dense[k, at] = v = rng.random(len(at)).astype(np.float32)
        rows.append((at, v.astype(np.float32)))
    y = (dense[:, :8].sum(1) > dense[:, 8:16].sum(1)).astype(int)
    held = np.arange(90) % 4 == 3
    x = np.hstack([dense[~held], np.ones((sum(~held), 1))])
    t, w, m, v = y[~held], np.zeros(33), np.zeros(33), np.zeros(33)
    weight = np.where(t > 0, 0.5 / t.mean(), 0.5 / (1 - t.mean())) / len(t)
    for k in range(1, 31):
        g = x.T @ ((1 / (1 + np.exp(-(x @ w))) - t) * weight) + s.decay * np.append(w[:-1], 0)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - s.rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-6)
    got, slope, shift = quality_rules.fit(rows, y, s)
    assert np.allclose(got, w, atol=1e-4)
    # The calibration is where its loss has no slope.
    scores, own = dense[held] @ w[:-1] + w[-1], y[held]
    goal = np.where(own > 0, (own.sum() + 1) / (own.sum() + 2), 1 / ((1 - own).sum() + 2))

    def loss(a, b):
        p = 1 / (1 + np.exp(-(a * scores + b)))
        return -(goal * np.log(p) + (1 - goal) * np.log(1 - p)).sum() + 0.5e-3 * a * a

    assert all(loss(slope, shift) <= loss(slope + i, shift + k) + 1e-9 for i in (-1e-3, 0, 1e-3) for k in (-1e-3, 0, 1e-3))


def test_verdicts_of_weights(spark):
    """Scores and verdicts by counting grams one by one."""
    s = quality_rules.Settings(bits=12)
    rng = np.random.default_rng(6)
    model = rng.normal(size=(1 << 12) + 1).astype(np.float32), 1.3, 0.2
    texts = [*texts_of(7, 50), "tiny", "", "one two three four five six seven eight nine ten eleven é"]
    grams = quality_rules.Grams(s)
    for r in quality_rules.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), model, s).collect():
        total = float(model[0][-1])
        for part in grams.of(r.text, grams.stats.split(r.text.encode())[1]):
            for at, n in Counter(part.tolist()).items():
                total += float(model[0][at]) * n * 20 / len(part)
        p = sigmoid(1.3 * total + 0.2)
        words = WORD.findall(r.text)
        fives = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
        again = {j for k in range(len(words) - 4) if fives[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
        failed = len(words) < 10 or 100 * len(again) > 20 * len(words)
        assert abs(r.score - p) < 1e-5 and r.base_failed == failed and (r.kept == (not failed and r.score >= 0.5))


# Sharding


def test_shards_follow_from_the_matrix(spark, sf):
    """Where every row goes, from the counts drawn and the hash order alone."""
    seed, shards = 11, 24
    docs = spark.read.parquet(f"{sf}/documents.parquet").dropDuplicates(["doc_id"])
    content = F.coalesce(F.col("text").cast("binary"), F.expr("X''"))
    own = [F.col("doc_id"), (F.octet_length(content) + 8).cast("long"), F.crc32(content)]
    one = lambda k: F.xxhash64(F.lit(seed + k), *own)
    rows = docs.select("doc_id", F.pmod(one(0), F.lit(16)).cast("long").alias("part"), one(1).alias("a"), sharding.uniform(F.lit(seed + 2), *own).alias("u")).collect()
    sizes = spark.createDataFrame(sorted(Counter(r.part for r in rows).items()), "part long, n long")
    counts = {r.part: r.upto for r in sharding.matrix(sizes, shards, 1, seed).collect()}
    assert {p: u[-1] for p, u in counts.items()} == dict(Counter(r.part for r in rows))
    want, members = {}, {}
    for part, upto in counts.items():
        for at, r in enumerate(sorted((r for r in rows if r.part == part), key=lambda r: (r.a, r.doc_id))):
            members.setdefault(sum(x <= at for x in upto), []).append((r.u, r.doc_id))
    for shard, inside in members.items():
        want.update({doc: (shard, slot) for slot, (_, doc) in enumerate(sorted(inside))})
    assert {r.doc_id: (r.shard, r.slot) for r in sharding.shard_rows(docs, shards).collect()} == want


# Fingerprints


def test_op9_query_equals_brute_force(spark, sf):
    table = dict(duckdb.connect().sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
    prints = {}
    for i, t in table.items():
        words = WORD.findall((t or "").translate({k: k + 32 for k in range(65, 91)}))
        shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([" ".join(words)] if words else [])
        votes = np.zeros(64, int)
        for x in shingles:
            h = xxhash.xxh64_intdigest(x.encode(), 42)
            votes += np.array([h >> b & 1 for b in range(64)])
        prints[i] = sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))
    ids = sorted(prints)
    fp = np.array([prints[i] for i in ids], dtype=np.uint64)
    root = list(range(len(ids)))

    def find(k):
        while root[k] != k:
            root[k] = k = root[root[k]]
        return k

    for k in range(len(ids)):
        for other in np.flatnonzero(np.bitwise_count(fp ^ fp[k]) <= 4):
            a, b = sorted((find(k), find(int(other))))
            root[b] = a
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op9_simhash(spark, sf).collect()}
    assert got == {i: (f"{prints[i]:016x}", ids[find(k)]) for k, i in enumerate(ids)}


# The pipeline


def test_stages_equal_plain_versions(spark, sf):
    """Exact dedup, mixing and encoding of what the stage before has left, each against a plain version of itself."""
    docs = corpus_pipeline.quality(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    docs = corpus_pipeline.written(docs, "test-quality")
    first = {}
    for r in docs.orderBy("doc_id").collect():
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r.text or ""), r.doc_id)
    left = corpus_pipeline.written(corpus_pipeline.exact(spark, docs, sf), "test-exact")
    assert sorted(r.doc_id for r in left.collect()) == sorted(first.values())
    con = duckdb.connect()
    con.register("documents", left.toPandas())
    taken = {r[0]: (r[1], r[4]) for r in con.sql(mixing.SQL).fetchall()}
    mixed = corpus_pipeline.written(corpus_pipeline.mixed(spark, left, sf), "test-mixed")
    text, got = {r.doc_id: r.text for r in left.collect()}, {}
    for r in mixed.collect():
        got.setdefault(r.doc_id, []).append(r.text)
    for i, (size, n) in taken.items():
        copies = [text[i]] * (n // size) if size else []
        own = sorted(got.pop(i, []), key=len, reverse=True)
        assert own[: len(copies)] == copies and sum(len(WORD.findall(t)) for t in own) == n
        assert len(own) == len(copies) + (n % size > 0 if size else 0) and all(text[i].startswith(t.rstrip()) for t in own)
    assert not got
    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path(queries.VOCABULARY)), special_tokens={})
    for r in corpus_pipeline.tokens(spark, mixed, sf).collect():
        assert r.tokens == encoding.encode_ordinary(r.text) and r.n_tokens == len(r.tokens) and r.round_trip
