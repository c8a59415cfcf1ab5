"""Mixing sources to target weights, in DataFrame operations only.

Rows get hash-random keys; each source is sorted by key within ranges of the key, a distributed prefix sum gives the words
before each row, and the source is cut at its exact budget after as many whole epochs as the budget holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.llm.shared import WORD, aside, must_differ, quoted, written

#: Weights of the sources in code-point order, repeating; a target stops at this many times its source's size.
WEIGHTS, MOST_EPOCHS = (5, 2, 1), 3


#: Rows for each range of the key, on average and beyond 64 ranges.
RANGE_ROWS = 50_000


def mix_key(ident: Column, size: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit("null")), F.lit(":"), size.cast("string")))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(name, source_size, target) of ``sizes`` (name, source_size), one row per source.

    Capping and resharing the excess by weight until none is above its cap ends where target = min(cap, level * weight) for
    the one level at which targets add up to all sizes. Sources reach their caps in the order of cap / weight, so running
    sums over that order give the level without iterating. Windows here run over one row per source.
    """
    ranked = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, map(float, weights))), (F.row_number().over(Window.orderBy("name")) - 1) % len(weights) + 1))
    ranked = ranked.withColumn("cap", F.col("source_size") * float(most)).withColumn("ratio", F.col("cap") / F.col("w"))
    every = Window.partitionBy(F.lit(1))
    order = every.orderBy("ratio", "name")
    ranked = (
        ranked.withColumn("total", F.sum("source_size").over(every))
        .withColumn("capped", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("w_left", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("total") - F.col("capped")) / F.col("w_left"))
    )
    # The first source in this order whose cap is not below the level: it and all after it get level * weight.
    level = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "name", "level"))).over(every)["level"]
    return ranked.select("name", "source_size", F.least(F.col("cap"), level * F.col("w")).alias("target"))


def mix(df: DataFrame, ident: str = "doc_id", text: str = "text", source: str = "source", carry: tuple[str, ...] = (), seed: int = 7) -> DataFrame:
    """(ident, *carry, size, source_size, target, taken) for every row of ``df``.

    size counts words, runs other than ASCII white space (null: 0); taken counts the words that the mix takes from the row,
    repeats included: the whole row in each full epoch, and in the last one the part that lies before the source's budget,
    so that a source's taken words add up to its target rounded to a whole number. Only the row at the cut is taken in part.
    Null sources are one source, after all others. Sources without words get 0. Rows are in the order of a hash of id and size,
    ties by id and size; rows that repeat both may swap places, so reruns take the same words. Repeated ids, null ids among
    them, spread by size, and equal rows are tallied by input partition before they are shuffled, so none is a hot key.
    Texts of any length and with any bytes are read whole. Columns in ``carry`` may have any name that is no result's to the session, which may ignore capitals. An empty
    table gives an empty result.
    """
    results = ["size", "source_size", "target", "taken"]
    must_differ(df, ident, *carry, *results)
    there, back = aside(df.select(*quoted([ident, *carry])))
    rows = df.select(*quoted([ident, *carry, text, source]))
    names = [f"c{k}" for k in range(len(there))] + ["text", "source"]
    rows = rows.toDF(*names).select(
        *names[:-2],
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source").cast("string"))).alias("name"),
        F.spark_partition_id().alias("read"),
    ).withColumn("key", mix_key(F.col("c0"), F.col("size"), seed))
    rows = written(rows, "mix-rows").withColumn("id", F.coalesce(F.concat(F.lit("0"), F.col("c0").cast("string")), F.lit("1")))
    ranges = 64 + rows.count() // RANGE_ROWS
    same = ["name", "key", "id", "size", "read"]
    in_range = F.floor(F.conv(F.substring("key", 1, 6), 16, 10).cast("long") * ranges / float(1 << 24))
    tallies = written(rows.groupBy(*same).agg(F.count("*").alias("n")).withColumn("range", in_range), "mix-tallies")
    words = F.col("n") * F.col("size")
    sums = tallies.groupBy("name", "range").agg(F.sum(words).alias("words"))
    before = Window.partitionBy("name").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("name", "range", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    plan = targets(sums.groupBy("name").agg(F.sum("words").alias("source_size"))).withColumn("budget", F.floor(F.col("target") + 0.5))
    inside = Window.partitionBy("name", "range").orderBy(*same[1:]).rowsBetween(Window.unboundedPreceding, -1)
    ahead = tallies.withColumn("ahead", F.coalesce(F.sum(words).over(inside), F.lit(0))).join(starts.join(plan, "name"), ["name", "range"]).drop("range", "n")
    whole = F.floor(F.col("budget") / F.greatest(F.col("source_size"), F.lit(1)))
    nth = F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(0))) - 1
    part = F.col("budget") - whole * F.col("source_size") - F.col("start") - F.col("ahead") - F.col("nth") * F.col("size")
    return (
        rows.withColumn("nth", nth).join(ahead, same)
        .select(*back, "size", "source_size", "target",
                (whole * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), part))).cast("long").alias("taken"))
    )


def copies(mixed: DataFrame, text: str = "text") -> DataFrame:
    """A row for each time that the mix takes a row; the one at the cut keeps its first words, spacing included."""
    times = F.expr("int(taken div greatest(size, 1L) + if(taken % greatest(size, 1L) > 0, 1, 0))")
    out = mixed.where("taken > 0").withColumn("epoch", F.explode(F.sequence(F.lit(1), times)))
    words = F.col("taken") - (F.col("epoch") - 1) * F.col("size")
    # Pieces of a word and the space after it; a text that begins with space has one piece more.
    pieces = F.split(F.col(text), "(?<=[\\x20\\x09-\\x0D])(?=[^\\x20\\x09-\\x0D])")
    lead = F.when(F.col(text).rlike("^[\\x20\\x09-\\x0D]"), 1).otherwise(0)
    cut = F.array_join(F.slice(pieces, F.lit(1), (words + lead).cast("int")), "")
    return out.withColumn(text, F.when(words < F.col("size"), cut).otherwise(F.col(text)))


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS name, md5('7:' || coalesce(doc_id::VARCHAR, 'null') || ':' || len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))) AS key
  FROM documents),
s AS (SELECT name, sum(size)::BIGINT AS source_size,
             CASE (row_number() OVER (ORDER BY name) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
      FROM d GROUP BY name),
r AS (SELECT *, 3.0::DOUBLE * source_size AS cap, 3.0::DOUBLE * source_size / w AS ratio, sum(source_size) OVER () AS total FROM s),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY ratio, name ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))::DOUBLE
             / sum(w) OVER (ORDER BY ratio, name ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM r),
t AS (SELECT name, source_size, least(cap, w * (SELECT lev FROM l WHERE ratio >= lev ORDER BY ratio, name LIMIT 1)) AS target FROM l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS budget,
             coalesce(sum(d.size) OVER (PARTITION BY d.name ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
      FROM d JOIN t USING (name))
SELECT doc_id, size, source_size, round(target, 6) AS target,
       ((budget // greatest(source_size, 1)) * size + greatest(0, least(size, budget % greatest(source_size, 1) - ahead)))::BIGINT AS taken
FROM p
"""
