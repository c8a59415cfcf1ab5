"""Every registered query against its SQL, and that the data reach the branches that matter."""

import glob
import os

import duckdb
import pytest

from colloquy import catalog
from colloquy.sources import bindings


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def _rows(frame, cols):
    plain = lambda x: None if x is None or x != x else float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x
    return sorted((tuple(map(plain, r)) for r in frame[cols].astype(object).itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, sf, duck, name):
    ours, theirs = catalog.QUERIES[name](spark, sf).toPandas(), duck.sql(catalog.SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and len(ours)
    assert _rows(ours, sorted(ours.columns)) == _rows(theirs, sorted(ours.columns))


def test_not_vacuous(spark, sf):
    assigned = catalog.assign_words(spark, sf)
    assert assigned.where("snapped").count() and assigned.where("spk IS NULL").count() and assigned.where("NOT snapped AND spk IS NOT NULL").count()
    assert catalog.smooth_islands(spark, sf).where("old_spk <> spk").count()
    assert catalog.stitch_words(spark, sf).count() < bindings.words(spark, sf).count()
    reasons = {r[0] for r in catalog.speaker_verdict(spark, sf).select("reason").distinct().collect()}
    assert {None, "three_speakers_equal_shares", "three_speakers_no_small_third"} <= reasons
