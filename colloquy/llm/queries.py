"""The registered queries of this subpackage: each applies one operator to its whole table and derives the digest columns."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.llm import bpe, exact_dedup, gam, hard_negatives, mixing, periodic_runs, quality_rules, sharding, simhash, substring_dedup, toxicity, url_filter, warc
from colloquy.llm.shared import WORD, shared_dir

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _remainder(n: int):
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = bpe.Bpe(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(codec.decode(codec.encode(docs).drop("text")))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup.exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages).select("page_id", "host", "path", "rule", "verdict", "template", "bad_share")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_rules.train(docs, _table(spark, sf_dir, "labels"))
    out = quality_rules.judge(docs, model)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_rows(docs, 24)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"), where=_remainder(5) != 0)
    out = toxicity.score(docs, model)
    return out.select("doc_id", (_remainder(5) == 0).alias("held_out"), "score", "predicted")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).withColumn("target", F.round("target", 6))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring_dedup.substring_dedup(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = simhash.near_dedup(docs)
    return out.select("doc_id", simhash.hex_fingerprint().alias("fingerprint"), "component_id")


def op10_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = gam.train(docs, _table(spark, sf_dir, "labels"), where=_remainder(3) != 1)
    out = gam.score(docs, model)
    return out.select("doc_id", (_remainder(3) == 1).alias("held_out"), "score", "predicted")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), F.col("vec_id") % 100 == 0, label=label)


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = f"{shared_dir(spark)}/colloquy/{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex}"
    warc.write_warc(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), where)
    return warc.pages_of(warc.read_warc(spark, where, contents=False)).withColumnRenamed("id", "page_id")


def with_repeats(docs: DataFrame) -> DataFrame:
    """The words of every tenth document by a checksum of its id, from a place on, replaced by repeats of the first few of them."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"({WORD})"), F.lit(1))
    planned = "transform(array(g % size(w)), a -> struct(a AS a, 1 + (size(w) - a) div (3 + g % 8) AS p))[0]"
    chosen = docs.withColumn("h", h).withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("g", F.expr("h div 10"))
    chosen = chosen.withColumn("plan", F.when(F.size("w") > 0, F.expr(planned)))
    repeated = "array_join(transform(sequence(0, size(w) - 1), i -> w[int(if(i < plan.a, i, plan.a + (i - plan.a) % plan.p))]), ' ')"
    return chosen.withColumn("text", F.when(F.col("plan").isNotNull(), F.expr(repeated)).otherwise(F.col("text"))).drop("h", "w", "g", "plan")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return periodic_runs.digests(periodic_runs.find_runs(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_bpe, op2_exact_dedup, op3_url_filter, op4_quality_rules, op5_sharding, op6_toxicity, op7_mixing, op8_substring_dedup, op9_simhash, op10_gam, op11_hard_negatives, op12_warc, op13_periodic_runs)
}

EXACT_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
m AS (SELECT doc_id, t, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM m
"""

SQL: dict[str, str] = {"op2_exact_dedup": EXACT_SQL, "op7_mixing": mixing.SQL, "op8_substring_dedup": substring_dedup.SQL, "op11_hard_negatives": hard_negatives.SQL, "op12_warc": warc.SQL}
