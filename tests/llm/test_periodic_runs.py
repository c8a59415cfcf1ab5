"""Periodic runs against their definition."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from colloquy.llm import periodic_runs, queries


def by_definition(words, least=12):
    """Per period, maximal stretches of words equal to those a period before them; of equal stretches the smallest period."""
    taken = {}
    for q in range(1, len(words) // 2 + 1):
        i = q
        while i < len(words):
            j = i
            while j < len(words) and words[j] == words[j - q]:
                j += 1
            if j - i >= q:
                taken.setdefault((i - q, j), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in taken.items() if b - a >= max(least, 2 * q))


def repetitive(rng):
    n = rng.randint(0, 70)
    words = [rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(n)]
    for _ in range(3 if n > 3 and rng.random() < 0.7 else 0):
        a, p = rng.randrange(n), rng.randint(1, 14)
        for i in range(a + p, min(n, a + rng.randint(1, 60))):
            words[i] = words[i - p]
    return words


@pytest.mark.parametrize("block", [4, 1024])
def test_runs_equal_definition(monkeypatch, block):
    monkeypatch.setattr(periodic_runs.Ends, "MOST", block)
    rng, finder = random.Random(block), periodic_runs.Finder()
    for _ in range(4000):
        words = repetitive(rng)
        for least in (2, 12):
            assert periodic_runs.runs_of(words, least) == by_definition(words, least)
        assert finder.runs([b"w%d" % w for w in words]) == by_definition(words)


def test_squares_come_from_the_automaton(monkeypatch):
    """Without the automaton's squares there are no runs: nothing else finds them."""
    words = [b"x", b"a", b"b", b"c"] * 10
    assert periodic_runs.Finder().runs(words) == [(0, 40, 4)]
    monkeypatch.setattr(periodic_runs.Automaton, "squares", lambda self: iter(()))
    assert periodic_runs.Finder().runs(words) == []


def test_sets_of_ends_are_ordered(monkeypatch):
    monkeypatch.setattr(periodic_runs.Ends, "MOST", 4)
    rng = random.Random(3)
    order = rng.sample(range(500), 200)
    own, there = periodic_runs.Ends(order[0]), [order[0]]
    for p in order[1:]:
        assert own.add(p) == (max((x for x in there if x < p), default=None), min((x for x in there if x > p), default=None))
        there.append(p)
    assert list(own) == sorted(order) and own.size == 200


def test_long_texts():
    for words, runs in (([7] * 150_000, [(0, 150_000, 1)]), (list(range(700)) * 150, [(0, 105_000, 700)]), (list(range(60_000)) * 2, [(0, 120_000, 60_000)]), (list(range(100_000)), [])):
        assert periodic_runs.runs_of(words) == runs


def test_query_equals_definition(spark, sf):
    """The whole query on whole texts, the repeats that its contract writes into them included."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got, altered = queries.op13_periodic_runs(spark, sf).collect(), 0
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        words, h = (texts[r.doc_id] or "").encode().split(), zlib.crc32(str(r.doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            altered += 1
        if n > 4000:
            continue  # the definition is quadratic
        runs = by_definition(words)
        gone = {i for a, length, q in runs for i in range(a + q, a + length)}
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        assert (r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest()
    assert altered > 50


def test_odd_rows(spark):
    same = "a b c d e f " * 4
    rows = [(1, None, "x", 1), (2, "", "x", 1), (None, same, "x", 1), (3, same, "x", 1), (3, same, "x", 1), (4, " \t\n", "x", 1), (5, "one " * 11, "x", 1), (6, "one " * 12, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `odd.name` string, n_words int")
    got = sorted(map(tuple, periodic_runs.find_runs(df).select("doc_id", "`odd.name`", "n_words", F.size("runs").alias("n"), "collapsed_text").collect()), key=str)
    once = "a b c d e f"
    assert got == sorted([(1, "x", 0, 0, ""), (2, "x", 0, 0, ""), (None, "x", 24, 1, once), (3, "x", 24, 1, once), (3, "x", 24, 1, once), (4, "x", 0, 0, ""), (5, "x", 11, 0, " ".join(["one"] * 11)), (6, "x", 12, 1, "one")], key=str)
    empty = periodic_runs.digests(periodic_runs.find_runs(df.limit(0)))
    assert empty.count() == 0
    bad = spark.createDataFrame([(1, bytearray(b"\xff \xfe " * 8))], "doc_id long, text binary").withColumn("text", F.col("text").cast("string"))
    assert periodic_runs.find_runs(bad).selectExpr("runs[0].period", "cast(collapsed_text as binary)").first()[:] == (2, b"\xff \xfe")
