"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix, in DataFrame operations only.

Rows fall into logical partitions. How many rows partition p sends to shard s is drawn exactly: the matrix of counts has the
distribution that a uniform shuffle of all rows would give, with the partition sizes and the shard sizes as its margins.
It is drawn down a tree over the partitions, a level at a time, each node dividing its shard capacities over its children
by multivariate hypergeometric draws; so no step holds the whole matrix. Rows are permuted within their partition, dealt out
by the counts (the exchange), and permuted again within their shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.shared import aside, must_differ, quoted, written

#: Children of a tree node, and rows of a logical partition: their number follows from the number of rows alone.
FAN, PARTITION_ROWS = 16, 20_000


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash of ``parts``: 53 bits."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def _draw(marked: str, total: str, taken: str, u: str) -> str:
    """SQL: a hypergeometric count by inverting its distribution, for ``taken`` of ``total`` of which ``marked`` count.

    Weights follow from one another by their ratio, from 12 standard deviations (and 12) below the mean to as many above,
    cut to the support; the rest weighs less than the rounding of doubles. One pass sums them, a second finds the count.
    """
    return f"""
      transform(array(named_struct('m', double({marked}), 'n', double({total}), 't', double({taken}), 'u', {u})), q ->
        transform(array(named_struct(
            'a', bigint(greatest(0D, q.t + q.m - q.n, floor(q.t * q.m / greatest(q.n, 1D) - 12 - 12 * sqrt(q.t * q.m / greatest(q.n, 1D) * (1 - q.m / greatest(q.n, 1D)))))),
            'b', bigint(least(q.m, q.t, ceil(q.t * q.m / greatest(q.n, 1D) + 12 + 12 * sqrt(q.t * q.m / greatest(q.n, 1D) * (1 - q.m / greatest(q.n, 1D)))))))), r ->
          aggregate(sequence(r.a, greatest(r.a, r.b)),
            named_struct('w', 1D, 'c', 0D, 'k', r.a, 'goal', q.u * aggregate(sequence(r.a, greatest(r.a, r.b)), named_struct('w', 1D, 'c', 0D),
                (s, k) -> named_struct('w', s.w * ((q.m - k) * (q.t - k)) / ((k + 1) * (q.n - q.m - q.t + k + 1)), 'c', s.c + s.w), s -> s.c)),
            (s, k) -> named_struct('w', s.w * ((q.m - k) * (q.t - k)) / ((k + 1) * (q.n - q.m - q.t + k + 1)), 'c', s.c + s.w,
                'k', if(s.c <= s.goal, k, s.k), 'goal', s.goal), s -> s.k))[0])[0]"""


def matrix(sizes: DataFrame, shards: int, levels: int, seed: int) -> DataFrame:
    """(part, upto array): the running sums over shards of the counts drawn for each partition of ``sizes`` (part, n)."""
    cells = f"sequence(0, {shards - 1})"
    nodes = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.min("part") * 0, F.lit(0)).alias("node")).select(
        "node",
        F.expr(f"transform({cells}, j -> n div {shards} + if(j < n % {shards}, 1L, 0L))").alias("caps"),
    )
    for level in range(levels):
        width = FAN ** (levels - level - 1)
        below = sizes.groupBy(F.expr(f"part div {width * FAN}").alias("node")).agg(
            F.array(*(F.sum(F.when(F.expr(f"part div {width} % {FAN}") == c, F.col("n")).otherwise(F.lit(0))) for c in range(FAN))).alias("kids")
        )
        u = f"shiftrightunsigned(xxhash64({seed}, {level}, node, c, j), 11) / {float(1 << 53)!r}"
        # For each child in turn, and in it each shard in turn: a count out of what that shard still can take.
        one_child = f"""aggregate({cells}, named_struct('left', kids[c], 'pool', aggregate(z.caps, 0L, (p, x) -> p + x), 'got', cast(array() as array<bigint>)),
            (y, j) -> transform(array({_draw('z.caps[j]', 'y.pool', 'y.left', u)}), d -> named_struct('left', y.left - d, 'pool', y.pool - z.caps[j], 'got', array_append(y.got, d)))[0], y -> y.got)"""
        all_kids = f"""aggregate(sequence(0, {FAN - 1}), named_struct('caps', caps, 'out', cast(array() as array<array<bigint>>)),
            (z, c) -> transform(array({one_child}), g -> named_struct('caps', zip_with(z.caps, g, (a, b) -> a - b), 'out', array_append(z.out, g)))[0], z -> z.out)"""
        nodes = (
            nodes.join(below, "node").select("node", F.posexplode(F.expr(all_kids)).alias("c", "caps"))
            .select((F.col("node") * FAN + F.col("c")).alias("node"), "caps").where("aggregate(caps, 0L, (p, x) -> p + x) > 0")
        )
        if level:
            nodes = nodes.repartition(F.col("node"))
    upto = "transform(caps, (x, i) -> aggregate(slice(caps, 1, i + 1), 0L, (p, y) -> p + y))"
    return nodes.select(F.col("node").alias("part"), F.expr(upto).alias("upto"))


def shard_rows(df: DataFrame, shards: int, ident: str = "doc_id", text: str = "text", carry: tuple[str, ...] = (), seed: int = 11) -> DataFrame:
    """(ident, *carry, size, text_crc32, law, shard, slot, grown_shard) for every row of ``df``.

    Law ``rows``: shard sizes differ by one at most, the first shards being the larger; a shard's slots run from 0 without
    gaps, in uniformly random order. size: UTF-8 bytes of the text plus 8 (null: 8, checksum of no bytes). grown_shard is
    null: this law has no stable assignment for another shard count. Copies and equal texts are rows like any other, as
    exact sizes and a uniform shuffle leave no room to keep groups together. The result follows from the rows and ``seed``,
    not from the session's settings; only where rows repeat id, size and checksum do places depend on how the input was
    split, as such rows are told apart by where they were read. So they spread like others, null ids and null texts too.
    Texts of any length and with any bytes are read whole. Columns in ``carry`` may have any name that is no result's to the session, which may ignore capitals. Empty
    tables give empty results.
    """
    results = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    must_differ(df, ident, *carry, *results)
    there, back = aside(df.select(*quoted([ident, *carry])))
    content = F.coalesce(F.col("text").cast("binary"), F.expr("X''"))
    base = df.select(*quoted([ident, *carry, text])).toDF(*(f"c{k}" for k in range(len(there))), "text").select(
        *(f"c{k}" for k in range(len(there))), (F.octet_length(content) + 8).cast("long").alias("size"), F.crc32(content).alias("text_crc32"), F.spark_partition_id().alias("read"))
    base = written(base, "shard-rows")
    total = base.count()
    levels = 1
    while FAN**levels * PARTITION_ROWS < total:
        levels += 1
    parts = FAN**levels
    own = [F.col("c0"), F.col("size"), F.col("text_crc32")]
    # Rows that repeat all of these within one input partition get numbers, so that they do not all fall into one place.
    nth = F.row_number().over(Window.partitionBy(*own, "read").orderBy(F.lit(0)))
    base = base.withColumn("nth", nth).withColumn("again", F.when(F.col("nth") > 1, F.struct("nth", "read")))
    own.append(F.col("again"))
    base = base.withColumn("part", F.pmod(F.xxhash64(F.lit(seed), *own), F.lit(parts)).cast("long")).drop("nth", "read")
    base = written(base, "shard-parts")
    counts = matrix(base.groupBy("part").agg(F.count("*").alias("n")), shards, levels, seed)
    first = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed + 1), *own), *own)
    dealt = base.withColumn("at", F.row_number().over(first) - 1).join(counts, "part").withColumn("shard", F.expr("aggregate(upto, 0, (s, x) -> s + if(x <= at, 1, 0))"))
    dealt = dealt.drop("at", "part", "upto")
    # The second permutation: random keys, cut into equal ranges so that no shard is one task.
    ranges = max(1, parts // 4)
    dealt = written(dealt.withColumn("u", uniform(F.lit(seed + 2), *own)), "shard-dealt").withColumn("range", F.floor(F.col("u") * ranges))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("shard", "range").agg(F.count("*").alias("n")).select("shard", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    second = Window.partitionBy("shard", "range").orderBy("u", *own)
    return (
        dealt.withColumn("in_range", F.row_number().over(second) - 1).join(starts, ["shard", "range"])
        .select(*back, "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
                (F.col("start") + F.col("in_range")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )
