"""A corpus pipeline of five stages: each stage's result is written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import bpe, exact_dedup, mixing, near_copies, quality_rules, simhash
from colloquy.llm.queries import VOCABULARY
from colloquy.llm.shared import aside, bucketed, names_but, plain_name, quoted, written


def _packed(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text and ``more``, with all other columns packed into one under names of its own, so that none can clash with an operator's."""
    there, _ = aside(docs, ["doc_id", "text", *more])
    return docs.select("doc_id", "text", *more, F.struct(*there, F.lit(0).alias("none")).alias("row"))


def _unpacked(docs: DataFrame, *more: str, but: tuple[str, ...] = ()) -> list:
    """The columns of ``docs``, in their order, without ``but``."""
    own, rest = {plain_name(docs, c) for c in ("doc_id", "text", *more)}, names_but(docs, ["doc_id", "text", *more])
    return [quoted([c])[0] if plain_name(docs, c) in own else F.col(f"row.c{rest.index(c)}").alias(c) for c in names_but(docs, but)]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go; null and empty texts are rejected.

    Each row is judged by its whole text, of any length, so repeated rows and ids fare alike; an empty table stays empty.
    """
    model = quality_rules.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = quality_rules.judge(_packed(docs), model)
    return out.where("kept").select(*_unpacked(docs))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, that with the smallest doc_id; null ids come last, and of repeated rows one stays.

    Null counts as empty. Whole texts of any length are compared; an empty table stays empty.
    """
    out = exact_dedup.exact_dedup(_packed(docs))
    return out.where("kept").select(*_unpacked(docs))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies (five-word Jaccard of 0.8 or more) stays, that with the smallest doc_id.

    SimHash groups all rows by balls around their fingerprints, and an exact check of the texts follows in each group. Copies with
    more differing bits than balls reach are then looked for among what is not connected yet, by bands and the same exact check.
    Rows are told apart by an id of their own, so null and repeated doc_ids are compared by their texts like all others. A null
    doc_id stays only if its component has no other; of rows that repeat the smallest doc_id in one component, one stays.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    rows = bucketed(_packed(docs).withColumn("uid", F.monotonically_increasing_id()), "uid", "pipeline-near-rows", size)
    groups = simhash.near_dedup(rows.select("uid", "text"), "uid").select("uid", F.col("component_id").alias("key"))
    found = near_copies.near_copies(rows.select("uid", "doc_id", "text"), groups)
    first = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid")).alias("first"))
    keep = written(first.select("first.uid"), "pipeline-near")
    return rows.join(keep, "uid", "left_semi").select(*_unpacked(docs))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row as often as its source's budget takes it; the row at the cut keeps its first words.

    Null sources are one source, null texts have no words and are not taken, repeated rows and ids are rows of their own, and texts
    of any length are counted whole. An empty table stays empty.
    """
    taken = mixing.copies(mixing.mix(_packed(docs, "source"), carry=("text", "source", "row")))
    return taken.select(*_unpacked(docs, "source"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ids, their number, and whether decoding gives the text's bytes back (not where they are no UTF-8).

    Every row is encoded whole, whatever its length and whether it repeats; null texts have no ids. An empty table stays empty.
    """
    codec = bpe.Bpe(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    out = codec.decode(codec.encode(_packed(docs)))
    same = F.col("decoded") == F.coalesce(F.col("text").cast("binary"), F.expr("X''"))
    rest = _unpacked(docs, but=("tokens", "n_tokens", "round_trip"))
    return out.select(*rest, "tokens", F.size("tokens").cast("long").alias("n_tokens"), same.alias("round_trip"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality), ("exact dedup", exact), ("near-dedup", near), ("mixing sources", mixed), ("byte-level bpe", tokens),
]

#: Neither a trained classifier nor byte-pair merges can be said in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
