"""Columns of the user's: names that differ from an operator's only in case, ``_``, backticks, dots and spaces pass through or are replaced."""

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from colloquy.llm import bpe, exact_dedup, gam, hard_negatives, mixing, periodic_runs, quality_rules, queries, shared, sharding, simhash, substring_dedup, toxicity, url_filter, warc

ODD = ("_", "a`b", "x.y", "two words", "row", "c0", "UID", "Item", "Path", "É")
#: Results of some operator, in other capitals.
CLASH = ("Score", "Kept", "Keep_ID", "SIZE", "Predicted", "Verdict", "Host", "N_Words", "Runs", "Tokens", "Decoded", "Taken", "Target", "Shard", "Slot")


@pytest.fixture(scope="module")
def docs(spark):
    texts = ["one two three four five six seven eight nine ten eleven twelve. " * 3, "other words of a text that is long enough to be kept by the rules of all", None, "", "short"]
    rows = [(k, texts[k % 5], ("s", None)[k % 2], f"http://h.org/a/{k}", "en", *(f"mine{c}" for c in (*ODD, *CLASH))) for k in range(15)]
    names = ["doc_id", "text", "source", "url", "lang", *ODD, *CLASH]
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string, url string, lang string, " + ", ".join(f"d{k} string" for k in range(len(ODD) + len(CLASH))))
    return shared.written(plain, "columns").toDF(*names)


def _fitted(train):
    return lambda spark, df: train(df.limit(0).select("doc_id", "text"), spark.createDataFrame([], "doc_id long, quality int, toxic int"))


def _others(df):
    return tuple(c for c in df.columns if c not in ("doc_id", "text"))


ADDING = {
    "op1": lambda spark, df: (codec := bpe.Bpe(spark, P.path(queries.VOCABULARY), P.PATTERN)).decode(codec.encode(df)),
    "op2": lambda spark, df: exact_dedup.exact_dedup(df),
    "op3": lambda spark, df: url_filter.filter_urls(df),
    "op4": lambda spark, df: quality_rules.judge(df, _fitted(quality_rules.train)(spark, df)),
    "op6": lambda spark, df: toxicity.score(df, _fitted(toxicity.train)(spark, df)),
    "op10": lambda spark, df: gam.score(df, _fitted(gam.train)(spark, df)),
    "op13": lambda spark, df: periodic_runs.find_runs(df),
}


@pytest.mark.parametrize("name", ADDING)
def test_added_columns_replace_and_others_pass(spark, docs, name):
    got = ADDING[name](spark, docs)
    low = [c.lower() for c in got.columns]
    assert len(set(low)) == len(low) and set(ODD) - {"Path"} <= set(got.columns)
    row = got.where("doc_id = 3").select(*shared.quoted([c for c in got.columns if c in (*ODD, *CLASH) and c != "Path"])).first()
    assert all(v == f"mine{c}" for c, v in row.asDict().items() if isinstance(v, str)) and got.count() == 15


@pytest.mark.parametrize("name", ["op5", "op7"])
def test_carried_columns(spark, docs, name):
    call = {"op5": lambda df, carry: sharding.shard_rows(df, 3, carry=carry), "op7": lambda df, carry: mixing.mix(df, carry=carry)}[name]
    clash = {"op5": "Shard", "op7": "Taken"}[name]
    carry = tuple(c for c in _others(docs) if c.lower() not in ("size", "shard", "slot", "taken", "target"))
    got = call(docs, carry)
    assert got.count() == 15 and set(carry) <= set(got.columns) and got.select("`a``b`").distinct().first()[0] == "minea`b"
    with pytest.raises(ValueError):
        call(docs, (clash,))


def test_operators_that_ignore_columns(spark, docs, tmp_path):
    assert substring_dedup.substring_dedup(docs).count() == simhash.near_dedup(docs).count() == 15
    assert warc.write_warc(docs, f"{tmp_path}/w", ident="doc_id", payload="text").agg(F.sum("records")).first()[0] == 15
    vectors = docs.withColumn("embedding", F.array(F.col("doc_id").cast("float"))).withColumn("label", F.col("doc_id") % 3)
    assert hard_negatives.hard_negatives(vectors, F.col("doc_id") % 5 == 0, ident="doc_id").count() >= 0


def test_stages_keep_columns(spark, docs, sf):
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, sf)
        more = ["tokens", "n_tokens", "round_trip"] if name == corpus_pipeline.STAGES[-1][0] else []
        assert got.columns == [c for c in docs.columns if c.lower() not in more] + more
        kept = got.where("doc_id = 0").select(*shared.quoted([c for c in got.columns if c in (*ODD, *CLASH)])).first()
        assert kept is None or all(v == f"mine{c}" for c, v in kept.asDict().items())
        assert stage(spark, docs.limit(0), sf).count() == 0


def test_case_counts_where_the_session_says_so(spark, docs):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        got = toxicity.score(docs, _fitted(toxicity.train)(spark, docs))
        assert {"Score", "score", "Predicted", "predicted"} <= set(got.columns)
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")
