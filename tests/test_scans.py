"""Ordered scans against plain loops, on many keys, across batches, and on one long key."""

import random
import time

from pyspark.sql import functions as F

from colloquy.operators import intervals, islands, scans


def test_state_follows_the_key(spark):
    """Sums so far, with keys that span batches and share partitions."""
    rng = random.Random(1)
    rows = [(f, k, rng.randint(-9, 9)) for f in range(7) for k in range(rng.randint(1, 900))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "file_id long, k int, x int")
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "100")
    try:
        got = scans.scanned(df, "file_id", ["k"], ["x"], lambda s, v: ((s or 0) + v[0], ((s or 0) + v[0],)), "total long").collect()
    finally:
        spark.conf.set(key, before)
    want = {}
    for f, k, x in sorted(rows):
        want[f, k] = want.get((f, k - 1), 0) + x
    assert {(r.file_id, r.k): r.total for r in got} == want and len(got) == len(rows)


def test_packing_ends_with_the_audio(spark):
    rng, rows, want = random.Random(2), [], []
    lengths = [(f, rng.randint(0, 300)) for f in range(200)]
    for f, total in lengths:
        t, own = 0, []
        for _ in range(rng.randint(0, 12)):
            t += rng.randint(1, 30)
            own.append((f, t, t + (d := rng.randint(1, 45))))
            t += d
        rows += own
        chunks, a, b = [], 0, 0
        for _, start, end in own:
            end = min(end, total)
            if b - a > 2 and (end - a > 60 or b - a > 40):
                chunks.append((a, b))
                a = start
            b = end
        if b - a > 2:
            chunks.append((a, b))
        for k, (a, b) in enumerate(chunks):
            n = (b - a) // 80 + 1 if b - a > 80 else 1
            want += [(f, k, i, a + (b - a) * i // n, a + (b - a) * (i + 1) // n) for i in range(n)]
    df = spark.createDataFrame(rows, "file_id long, start_us long, end_us long")
    got = intervals.pack_chunks(df, 60, 40, 80, 2, spark.createDataFrame(lengths, "file_id long, total_us long"))
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_one_long_dialog(spark):
    """100,000 turns of one dialog, and as many equal words in a row, in time that is linear in them."""
    n = 100_000
    turns = spark.range(n).select(F.lit(1).alias("file_id"), F.col("id").alias("pos"), F.concat(F.lit("s"), F.col("id") % 3).alias("speaker"), F.lit("t").alias("text"))
    words = spark.range(n).select(F.lit(1).alias("file_id"), F.col("id").alias("pos"), F.lit("w").alias("word"), (F.col("id") * 100_000).alias("start_us"), (F.col("id") * 100_000 + 50_000).alias("end_us"))
    began = time.monotonic()
    rows = islands.dialog_rows(turns)
    assert rows.agg(F.max("row_ix")).first()[0] == (n - 1) // 3 and rows.count() == n
    # A word within the gap of the one kept joins it: every third is kept.
    assert islands.stitch_words(words).count() == (n + 2) // 3
    assert time.monotonic() - began < 60


def test_windows_before_a_scan_save_its_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("file_id"), F.col("id").alias("pos"), F.lit("a").alias("speaker"), F.lit("t").alias("text"))
    plan = islands.dialog_rows(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 0 and plan.count("MapInArrow") >= 1
