"""The registered queries and their SQL for the same tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquy.functions import clock
from colloquy.models import Stage, apply
from colloquy.operators import intervals, islands, journal, speakers, transducer
from colloquy.operators.batches import Batches, padded, planned
from colloquy.plans import align, documents, recognise
from colloquy.plans.tables import scratch
from colloquy.sources import bindings as b
from colloquy.sources import audio, containers, files, items

AUDIO_US, SNAP_US, PAUSE_US, ISLAND_US = 720_000_000, 800_000, 600_000, 24_000_000
THIRD_MAX, EPS = 0.10, 0.05
RULES = align.Rules(snap_us=SNAP_US, island_us=ISLAND_US, pause_us=PAUSE_US, third_max=THIRD_MAX, eps=EPS)

Q = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Q] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def put(f: Q) -> Q:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = "WITH RECURSIVE " + sql
        return f

    return put


# Shared pieces of the SQL side.
EVENTS = "ev AS (SELECT *, date_diff('microsecond', TIMESTAMP '2024-01-01 00:00:00', ts) // 3600 AS t FROM events)"
WORDS = EVENTS + """, words AS (SELECT user_id AS file_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, event_type AS word,
  t AS start_us, t + round(value * 100)::BIGINT * 100 AS end_us, event_id FROM ev WHERE event_id % 2 = 0)"""
SEGS = """segs AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY start_us, end_us, spk) AS seg_ix FROM
  (SELECT user_id AS file_id, 'speaker_' || ((event_id // 2) % 3) AS spk, t AS start_us, t + round(value * 100)::BIGINT * 2000 AS end_us FROM ev WHERE event_id % 2 = 1))"""
SHARES = "shares AS (SELECT file_id, spk, sum(greatest(0, end_us - start_us))::BIGINT AS dur_us, least(1.0::DOUBLE, sum(greatest(0, end_us - start_us)) / 720000000.0::DOUBLE) AS share, min(seg_ix) AS first_seg_ix FROM segs GROUP BY ALL)"


def assigned_sql(words: str, segs: str, out: str) -> str:
    return f"""
  s_{out} AS (SELECT *, max(end_us) OVER (PARTITION BY file_id ORDER BY seg_ix) AS pm FROM {segs}),
  w_{out} AS (SELECT *, max(start_us) OVER (PARTITION BY file_id ORDER BY pos) AS w FROM {words}),
  p_{out} AS (SELECT w.file_id, w.pos, count(s.seg_ix) AS last FROM w_{out} w LEFT JOIN s_{out} s ON s.file_id = w.file_id AND s.pm < w.w GROUP BY ALL),
  o_{out} AS (SELECT file_id, pos, spk, sum(ov) AS ov FROM (SELECT w.file_id, w.pos, s.spk, least(w.end_us, s.end_us) - greatest(w.start_us, s.start_us) AS ov
     FROM w_{out} w JOIN p_{out} p USING (file_id, pos) JOIN s_{out} s ON s.file_id = w.file_id AND s.seg_ix > p.last AND s.start_us <= w.end_us) WHERE ov > 0 GROUP BY ALL),
  b_{out} AS (SELECT file_id, pos, spk FROM o_{out} QUALIFY row_number() OVER (PARTITION BY file_id, pos ORDER BY ov DESC, spk DESC) = 1),
  n_{out} AS (SELECT w.file_id, w.pos, s.spk, least(2 * abs(w.start_us - s.end_us), 2 * abs(w.end_us - s.start_us), abs(w.start_us + w.end_us - s.start_us - s.end_us)) AS gap
     FROM w_{out} w JOIN p_{out} p USING (file_id, pos) JOIN s_{out} s ON s.file_id = w.file_id AND s.seg_ix IN (p.last, p.last + 1)
     QUALIFY row_number() OVER (PARTITION BY w.file_id, w.pos ORDER BY gap, s.seg_ix) = 1),
  {out} AS (SELECT w.* EXCLUDE (w), coalesce(b.spk, CASE WHEN n.gap <= {2 * SNAP_US} THEN n.spk END) AS spk, b.spk IS NULL AND coalesce(n.gap <= {2 * SNAP_US}, false) AS snapped
     FROM w_{out} w LEFT JOIN b_{out} b USING (file_id, pos) LEFT JOIN n_{out} n USING (file_id, pos))"""


def smoothed_sql(words: str, out: str) -> str:
    return f"""
  r1_{out} AS (SELECT *, sum(c) OVER (PARTITION BY file_id ORDER BY pos) AS run FROM (SELECT *, CASE WHEN row_number() OVER x = 1 OR lag(spk) OVER x IS DISTINCT FROM spk THEN 1 ELSE 0 END AS c FROM {words} WINDOW x AS (PARTITION BY file_id ORDER BY pos))),
  r2_{out} AS (SELECT file_id, run, any_value(spk) AS s, count(*) AS n, arg_max(end_us, pos) - arg_min(start_us, pos) AS d FROM r1_{out} GROUP BY ALL),
  r3_{out} AS (SELECT *, lag(s) OVER x AS l, lead(s) OVER x AS r FROM r2_{out} WINDOW x AS (PARTITION BY file_id ORDER BY run)),
  r4_{out} AS (SELECT *, coalesce(s IS NOT NULL AND l = r AND s <> l AND n <= 2 AND greatest(0, d) <= {ISLAND_US}, false) AS e FROM r3_{out}),
  r5_{out} AS (SELECT *, sum(CASE WHEN e THEN 0 ELSE 1 END) OVER (PARTITION BY file_id ORDER BY run) AS g FROM r4_{out}),
  r6_{out} AS (SELECT file_id, run, l FROM (SELECT *, row_number() OVER (PARTITION BY file_id, g, e ORDER BY run) AS k FROM r5_{out}) WHERE e AND k % 2 = 1),
  {out} AS (SELECT a.* EXCLUDE (c, run, spk), a.spk AS old_spk, coalesce(f.l, a.spk) AS spk FROM r1_{out} a LEFT JOIN r6_{out} f USING (file_id, run))"""


def turns_sql(words: str, out: str) -> str:
    return f"""
  g1_{out} AS (SELECT *, greatest(0, start_us - coalesce(lag(end_us) OVER (PARTITION BY file_id ORDER BY pos), start_us)) AS gap FROM {words}),
  g2_{out} AS (SELECT *, lag(spk) OVER (PARTITION BY file_id ORDER BY pos) AS before FROM g1_{out} WHERE spk IS NOT NULL),
  g3_{out} AS (SELECT *, sum(CASE WHEN before IS NULL OR before <> spk OR gap > {PAUSE_US} THEN 1 ELSE 0 END) OVER (PARTITION BY file_id ORDER BY pos) AS turn_ix FROM g2_{out}),
  {out} AS (SELECT file_id, turn_ix::BIGINT AS turn_ix, any_value(spk) AS speaker, arg_min(start_us, pos) AS start_us, arg_max(end_us, pos) AS end_us, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n_words FROM g3_{out} GROUP BY ALL)"""


VERDICT = f"""
  k AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY share DESC, first_seg_ix) AS k FROM shares),
  f AS (SELECT file_id, count(*) AS n, max(share) AS hi, min(share) AS lo, max(CASE WHEN k = 3 THEN share END) AS third, max(CASE WHEN k = 3 THEN spk END) AS third_spk, list_sort(list(spk)) AS everyone FROM k GROUP BY file_id),
  v AS (SELECT *, CASE WHEN n > 3 THEN 'too_many_speakers:' || n WHEN n = 3 AND hi - lo < {EPS} THEN 'three_speakers_equal_shares' WHEN n = 3 AND third > {THIRD_MAX} THEN 'three_speakers_no_small_third' END AS reason FROM f),
  verdict AS (SELECT file_id, n AS n_speakers, CASE WHEN reason IS NULL THEN 'OK' ELSE 'BAD_SAMPLE' END AS status, reason,
    CASE WHEN reason IS NOT NULL THEN '' WHEN n = 3 THEN array_to_string(list_filter(everyone, lambda x: x <> third_spk), ',') ELSE array_to_string(everyone, ',') END AS keep,
    CASE WHEN reason IS NULL AND n = 3 THEN third_spk ELSE '' END AS dropped FROM v)"""
REASSIGNED = """
  rk AS (SELECT s.*, d.spk IS NOT NULL AS gone FROM segs_in s LEFT JOIN dropped_in d ON d.file_id = s.file_id AND d.spk = s.spk),
  rn AS (SELECT a.file_id, a.seg_ix, k.spk FROM rk a JOIN rk k ON k.file_id = a.file_id AND NOT k.gone WHERE a.gone
         QUALIFY row_number() OVER (PARTITION BY a.file_id, a.seg_ix ORDER BY abs(k.start_us + k.end_us - a.start_us - a.end_us), k.seg_ix) = 1),
  reassigned AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY start_us, end_us, spk) AS seg_ix FROM
    (SELECT rk.file_id, CASE WHEN gone THEN rn.spk ELSE rk.spk END AS spk, start_us, end_us FROM rk LEFT JOIN rn USING (file_id, seg_ix) WHERE NOT gone OR rn.spk IS NOT NULL))"""
SMALLEST = "dropped_in AS (SELECT file_id, spk FROM shares QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY share, spk) = 1)"
FRAMES = """fr AS (SELECT vec_id AS file_id, t, list_position(list_slice(embedding, t * 4 + 1, t * 4 + 4), list_max(list_slice(embedding, t * 4 + 1, t * 4 + 4)))::BIGINT - 1 AS label FROM embeddings, range(16) r(t)),
  lb AS (SELECT *, lag(label) OVER (PARTITION BY file_id ORDER BY t) AS before FROM fr)"""
SPANS = FRAMES + """, sr AS (SELECT *, sum(CASE WHEN before IS NULL OR before <> label THEN 1 ELSE 0 END) OVER (PARTITION BY file_id ORDER BY t) AS run FROM lb),
  spans AS (SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY run) AS span_ix, token_id, start_t, end_t FROM
    (SELECT file_id, run, any_value(label) AS token_id, min(t) AS start_t, max(t) + 1 AS end_t FROM sr WHERE label <> 3 GROUP BY ALL))"""
MERGED = """tr AS (SELECT *, sum(CASE WHEN before IS NULL OR before <> speaker THEN 1 ELSE 0 END) OVER (PARTITION BY file_id ORDER BY pos) AS run FROM
    (SELECT *, lag(speaker) OVER (PARTITION BY file_id ORDER BY pos) AS before FROM turns WHERE trim(speaker) <> '' AND trim(text, E' \\t\\n\\r') <> '')),
  merged AS (SELECT file_id, run::BIGINT AS run, speaker, string_agg(trim(text, E' \\t\\n\\r'), ' ' ORDER BY pos) AS text, count(*) AS n FROM tr GROUP BY file_id, run, speaker)"""


@query("turns AS (SELECT conv_id AS file_id, turn AS pos, role AS speaker, text FROM conversations), " + MERGED + """,
  m AS (SELECT *, row_number() OVER (PARTITION BY file_id ORDER BY run) AS k FROM merged),
  fold AS (SELECT file_id, k, speaker, text, 0 AS row_ix, [speaker] AS here FROM m WHERE k = 1
    UNION ALL SELECT m.file_id, m.k, m.speaker, m.text,
      CASE WHEN list_contains(f.here, m.speaker) AND len(f.here) >= 2 THEN f.row_ix + 1 ELSE f.row_ix END,
      CASE WHEN list_contains(f.here, m.speaker) AND len(f.here) >= 2 THEN [m.speaker] WHEN list_contains(f.here, m.speaker) THEN f.here ELSE list_append(f.here, m.speaker) END
    FROM fold f JOIN m ON m.file_id = f.file_id AND m.k = f.k + 1)
  SELECT file_id, row_ix, speaker, string_agg(text, ' ' ORDER BY k) AS text FROM fold GROUP BY file_id, row_ix, speaker""")
def dialog_rows(spark, sf_dir):
    return islands.dialog_rows(b.turns(spark, sf_dir))


@query("turns AS (SELECT user_id AS file_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, event_type AS speaker, event_id::VARCHAR AS text FROM events), " + MERGED + " SELECT * FROM merged")
def merge_adjacent(spark, sf_dir):
    return islands.merge_adjacent(b.event_turns(spark, sf_dir))


def _own_speakers(words: DataFrame) -> DataFrame:
    return words.withColumn("spk", F.when(F.col("event_id") % 7 != 0, F.concat(F.lit("speaker_"), F.expr("cast((event_id div 2) % 3 AS string)"))))


@query(WORDS + ", own AS (SELECT *, CASE WHEN event_id % 7 <> 0 THEN 'speaker_' || ((event_id // 2) % 3) END AS spk FROM words)," + turns_sql("own", "built") + " SELECT * FROM built")
def build_turns(spark, sf_dir):
    return islands.build_turns(_own_speakers(b.words(spark, sf_dir)), PAUSE_US)


@query(FRAMES + " SELECT file_id, coalesce(string_agg(label::VARCHAR, ',' ORDER BY t) FILTER (label <> 3 AND (before IS NULL OR before <> label)), '') AS tokens FROM lb GROUP BY file_id")
def ctc_collapse(spark, sf_dir):
    return b.frames(spark, sf_dir).select("file_id", F.array_join(islands.collapse(F.col("labels"), 3).cast("array<string>"), ",").alias("tokens"))


@query(SPANS + " SELECT * FROM spans")
def token_spans(spark, sf_dir):
    return islands.token_spans(b.frames(spark, sf_dir), 3)


@query(SPANS + """, i AS (SELECT *, sum(CASE WHEN token_id = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY file_id ORDER BY span_ix) AS island FROM spans),
  w AS (SELECT file_id, island, string_agg(CASE token_id WHEN 0 THEN 'a' ELSE 'b' END, '' ORDER BY span_ix) AS word, min(start_t) AS start_t, max(end_t) AS end_t FROM i WHERE token_id <> 2 GROUP BY ALL)
  SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY island) AS word_ix, word, start_t, end_t FROM w""")
def words_from_tokens(spark, sf_dir):
    spans = islands.token_spans(b.frames(spark, sf_dir), 3).withColumn("text", F.element_at(F.array(*map(F.lit, "ab|")), (F.col("token_id") + 1).cast("int")))
    return islands.words_from_tokens(spans, pieces=False)


@query(SPANS + """, i AS (SELECT *, sum(CASE WHEN token_id IN (0, 2) THEN 1 ELSE 0 END) OVER (PARTITION BY file_id ORDER BY span_ix) AS island FROM spans),
  w AS (SELECT file_id, island, string_agg(['a', 'b', 'c'][token_id + 1], '' ORDER BY span_ix) AS word, min(start_t) AS start_t, max(end_t) AS end_t FROM i GROUP BY ALL)
  SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY island) AS word_ix, word, start_t, end_t FROM w""")
def words_from_pieces(spark, sf_dir):
    spans = islands.token_spans(b.frames(spark, sf_dir), 3).withColumn("text", F.element_at(F.array(*map(F.lit, ("▁a", "b", "▁c"))), (F.col("token_id") + 1).cast("int")))
    return islands.words_from_tokens(spans, pieces=True)


def _shares(spark, sf_dir):
    return intervals.speaker_shares(b.segments(spark, sf_dir), AUDIO_US)


@query(EVENTS + "," + SEGS + "," + SHARES + " SELECT file_id, spk, dur_us, round(share, 6) AS share, first_seg_ix FROM shares")
def speaker_shares(spark, sf_dir):
    return _shares(spark, sf_dir).withColumn("share", F.round("share", 6))


@query(EVENTS + "," + SEGS + """, i AS (SELECT *, max(end_us) OVER (PARTITION BY file_id ORDER BY start_us, end_us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM segs),
  j AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_us > reach THEN 1 ELSE 0 END) OVER (PARTITION BY file_id ORDER BY start_us, end_us ROWS UNBOUNDED PRECEDING) AS run FROM i),
  u AS (SELECT file_id, run, min(start_us) AS a, max(end_us) AS b FROM j GROUP BY ALL) SELECT file_id, sum(b - a)::BIGINT AS union_us, count(*) AS n_intervals FROM u GROUP BY file_id""")
def interval_union(spark, sf_dir):
    return intervals.union_length(b.segments(spark, sf_dir))


@query(WORDS + """, f AS (SELECT file_id, max(end_us) AS total FROM words GROUP BY file_id), c AS (SELECT file_id, total, unnest(range(0, greatest(0, ceil((total - 22000000) / 21700000.0))::BIGINT + 1)) AS chunk_ix FROM f WHERE total > 0)
  SELECT file_id, chunk_ix, chunk_ix * 21700000 AS start_us, least(total, chunk_ix * 21700000 + 22000000) AS end_us FROM c""")
def hopping_chunks(spark, sf_dir):
    files = b.words(spark, sf_dir).groupBy("file_id").agg(F.max("end_us").alias("total_us"))
    return intervals.hopping_chunks(files, 22_000_000, 300_000)


@query(WORDS + "," + SEGS + "," + assigned_sql("words", "segs", "assigned") + " SELECT file_id, pos, word, start_us, end_us, spk, snapped FROM assigned")
def assign_words(spark, sf_dir):
    return intervals.assign_words(b.words(spark, sf_dir).drop("event_id"), b.segments(spark, sf_dir), SNAP_US)


def _smallest(shares: DataFrame) -> DataFrame:
    return shares.groupBy("file_id").agg(F.min_by("spk", F.struct("share", "spk")).alias("spk"))


@query(EVENTS + "," + SEGS + "," + SHARES + "," + SMALLEST + ", segs_in AS (SELECT * FROM segs)," + REASSIGNED + " SELECT file_id, spk, start_us, end_us, seg_ix FROM reassigned")
def reassign_dropped(spark, sf_dir):
    return intervals.reassign_dropped(b.segments(spark, sf_dir), _smallest(_shares(spark, sf_dir)))


@query(WORDS + "," + SEGS + "," + assigned_sql("words", "segs", "assigned") + "," + smoothed_sql("assigned", "smooth") + " SELECT file_id, pos, old_spk, spk FROM smooth")
def smooth_islands(spark, sf_dir):
    words = intervals.assign_words(b.words(spark, sf_dir).drop("event_id"), b.segments(spark, sf_dir), SNAP_US)
    return islands.smooth_islands(words, 2, ISLAND_US).select("file_id", "pos", "old_spk", "spk")


@query(WORDS + """, f AS (SELECT file_id, pos, word, start_us, end_us, pos AS kp, start_us AS ks, end_us AS ke FROM words WHERE pos = 1
    UNION ALL SELECT w.file_id, w.pos, w.word, w.start_us, w.end_us,
      CASE WHEN w.word = f.word AND (abs(w.start_us - f.ks) < 250000 OR abs(w.end_us - f.ke) < 1000) THEN f.kp ELSE w.pos END,
      CASE WHEN w.word = f.word AND (abs(w.start_us - f.ks) < 250000 OR abs(w.end_us - f.ke) < 1000) THEN f.ks ELSE w.start_us END,
      CASE WHEN w.word = f.word AND abs(w.start_us - f.ks) < 250000 THEN greatest(f.ke, w.end_us) WHEN w.word = f.word AND abs(w.end_us - f.ke) < 1000 THEN f.ke ELSE w.end_us END
    FROM f JOIN words w ON w.file_id = f.file_id AND w.pos = f.pos + 1)
  SELECT file_id, kp AS pos, any_value(word) AS word, any_value(ks) AS start_us, max(ke) AS end_us FROM f GROUP BY file_id, kp""")
def stitch_words(spark, sf_dir):
    return islands.stitch_words(b.words(spark, sf_dir))


@query(EVENTS + "," + SEGS + "," + SHARES + "," + VERDICT + " SELECT * FROM verdict")
def speaker_verdict(spark, sf_dir):
    return speakers.verdict(_shares(spark, sf_dir), THIRD_MAX, EPS)


@query(EVENTS + "," + SEGS + "," + SHARES + " SELECT file_id, spk, 'Spk' || (row_number() OVER (PARTITION BY file_id ORDER BY share DESC, spk) - 1) AS norm FROM shares")
def speaker_rank(spark, sf_dir):
    return speakers.ranked_names(_shares(spark, sf_dir))


JOURNAL = "j AS (SELECT event_id AS line_no, '/audio/' || user_id || '.wav' AS input_path, ['SUCCESS', 'BAD_SAMPLE', 'FAILED', 'SKIPPED', 'FAILED'][event_id % 5 + 1] AS status FROM events), inputs AS (SELECT '/audio/' || c_custkey || '.wav' AS input_path, (c_custkey % 997)::VARCHAR AS id FROM customer), l AS (SELECT input_path, max(line_no) AS line_no, arg_max(status, line_no) AS status FROM j GROUP BY input_path)"


@query(JOURNAL + " SELECT * FROM l")
def journal_latest(spark, sf_dir):
    return journal.latest(b.journal(spark, sf_dir))


@query(JOURNAL + " SELECT input_path, coalesce(max(line_no) FILTER (status <> 'SKIPPED'), max(line_no)) AS line_no, coalesce(arg_max(status, line_no) FILTER (status <> 'SKIPPED'), 'SKIPPED') AS status FROM j GROUP BY input_path")
def journal_latest_retryable(spark, sf_dir):
    return journal.latest(b.journal(spark, sf_dir), literal=False)


@query(JOURNAL + " SELECT input_path, id FROM inputs WHERE input_path NOT IN (SELECT input_path FROM l WHERE status <> 'FAILED')")
def resume_pending(spark, sf_dir):
    return journal.pending_inputs(b.inputs(spark, sf_dir), b.journal(spark, sf_dir), retry_failed=True)


@query(JOURNAL + " SELECT input_path, id FROM inputs WHERE input_path IN (SELECT input_path FROM l)")
def resume_skipped(spark, sf_dir):
    return journal.skipped_inputs(b.inputs(spark, sf_dir), b.journal(spark, sf_dir))


@query(JOURNAL + " SELECT input_path, id FROM inputs WHERE NOT (id IN (SELECT (o_custkey % 997)::VARCHAR FROM orders WHERE o_orderkey % 2 = 0) AND id IN (SELECT (o_custkey % 997)::VARCHAR FROM orders WHERE o_orderkey % 3 = 0))")
def outputs_missing(spark, sf_dir):
    ids = b.table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 997).cast("string").alias("id"))
    return journal.without_outputs(b.inputs(spark, sf_dir), ids.where("o_orderkey % 2 = 0"), ids.where("o_orderkey % 3 = 0"))


@query(JOURNAL + " SELECT status, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM j), 1)::DOUBLE AS percent FROM j GROUP BY status")
def status_counts(spark, sf_dir):
    return journal.status_counts(b.journal(spark, sf_dir))


@query(JOURNAL + " SELECT id, count(*) AS n FROM inputs GROUP BY id HAVING count(*) > 1")
def duplicate_ids(spark, sf_dir):
    return journal.duplicate_ids(b.inputs(spark, sf_dir))


@query(WORDS + " SELECT file_id, count(*) AS num_words, sum(greatest(0, end_us - start_us))::BIGINT AS covered_us, round(avg(greatest(0, end_us - start_us)), 3) AS mean_us, max(greatest(0, end_us - start_us)) AS max_us FROM words GROUP BY file_id")
def word_stats(spark, sf_dir):
    return align.word_stats(b.words(spark, sf_dir))


@query("d AS (SELECT doc_id::VARCHAR AS id, lang || '/' || doc_id || '.wav' AS path, n_chars / 100.0::DOUBLE AS duration_sec FROM documents WHERE n_chars > 0) SELECT * FROM d")
def manifest_by_duration(spark, sf_dir):
    d = b.table(spark, sf_dir, "documents").where("n_chars > 0").selectExpr("cast(doc_id AS string) AS id", "concat(lang, '/', doc_id, '.wav') AS path", "n_chars / 100D AS duration_sec")
    return d.orderBy("duration_sec", "path")


@query("SELECT conv_id AS file_id, count(*) AS turns FROM conversations GROUP BY conv_id ORDER BY turns DESC, file_id LIMIT 20".replace("SELECT conv_id", "t AS (SELECT 1) SELECT conv_id", 1))
def topk_by_turns(spark, sf_dir):
    return files.most_turns(b.turns(spark, sf_dir).groupBy("file_id").agg(F.count("*").alias("turns")), 20)


@query(WORDS + """ SELECT file_id, pos, CASE WHEN start_us >= 3600000000 THEN CASE WHEN start_us // 3600000000 < 10 THEN '0' ELSE '' END || (start_us // 3600000000) || ':' ELSE '' END
  || lpad((start_us // 60000000 % 60)::VARCHAR, 2, '0') || ':' || lpad((start_us // 1000000 % 60)::VARCHAR, 2, '0') || ':' || lpad((start_us // 10000 % 100)::VARCHAR, 2, '0') AS at FROM words""")
def format_time(spark, sf_dir):
    return b.words(spark, sf_dir).select("file_id", "pos", clock(F.col("start_us")).alias("at"))


@query(EVENTS + "," + SEGS + """, i AS (SELECT *, max(end_us) OVER (PARTITION BY file_id ORDER BY start_us, end_us ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM segs),
  j AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_us > reach THEN 1 ELSE 0 END) OVER (PARTITION BY file_id ORDER BY start_us, end_us ROWS UNBOUNDED PRECEDING) AS run FROM i),
  u AS (SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY run) AS k, min(start_us) AS x, max(end_us) AS y FROM j GROUP BY file_id, run),
  f AS (SELECT file_id, k, 0 AS c, 0::BIGINT AS a, y AS e, false AS cut, 0::BIGINT AS pa, 0::BIGINT AS pb FROM u WHERE k = 1
    UNION ALL SELECT u.file_id, u.k, CASE WHEN z THEN f.c + 1 ELSE f.c END, CASE WHEN z THEN greatest(0, u.x) ELSE f.a END, u.y, z, f.a, f.e
      FROM f JOIN u ON u.file_id = f.file_id AND u.k = f.k + 1, LATERAL (SELECT f.e - f.a > 200000 AND (u.y - f.a > 22000000 OR f.e - f.a > 15000000) AS z)),
  c AS (SELECT file_id, c - 1 AS chunk_ix, pa AS a, pb AS b FROM f WHERE cut UNION ALL SELECT file_id, c, a, e FROM f WHERE e - a > 200000 QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY k DESC) = 1 AND k = (SELECT max(k) FROM u WHERE u.file_id = f.file_id)),
  p AS (SELECT *, CASE WHEN b - a > 30000000 THEN (b - a) // 30000000 + 1 ELSE 1 END AS n FROM c), q AS (SELECT *, unnest(range(0, n)) AS part_ix FROM p)
  SELECT file_id, chunk_ix, part_ix, a + (b - a) * part_ix // n AS start_us, a + (b - a) * (part_ix + 1) // n AS end_us FROM q""")
def pack_chunks(spark, sf_dir):
    return intervals.pack_chunks(intervals.merged(b.segments(spark, sf_dir)))


#: From words and segments to turns, as the full flow does it.
ALIGNED = (WORDS + "," + SEGS + "," + SHARES + "," + VERDICT + """, okay AS (SELECT file_id, dropped FROM verdict WHERE status = 'OK'),
  segs_in AS (SELECT segs.* FROM segs JOIN okay USING (file_id)), dropped_in AS (SELECT file_id, dropped AS spk FROM okay WHERE dropped <> ''), words_in AS (SELECT words.* FROM words JOIN okay USING (file_id)),"""
  + REASSIGNED + "," + assigned_sql("words_in", "reassigned", "assigned") + "," + smoothed_sql("assigned", "smooth") + """,
  names AS (SELECT file_id, spk, 'Spk' || (row_number() OVER (PARTITION BY file_id ORDER BY share DESC, spk) - 1) AS norm FROM shares ANTI JOIN dropped_in USING (file_id, spk)),
  named AS (SELECT s.* EXCLUDE (spk), n.norm AS spk FROM smooth s LEFT JOIN names n USING (file_id, spk)),""" + turns_sql("named", "built"))


@query(ALIGNED + " SELECT * FROM built")
def full_align(spark, sf_dir):
    return align.full_align(b.words(spark, sf_dir).drop("event_id"), b.segments(spark, sf_dir), AUDIO_US, RULES)


@query(WORDS + "," + SEGS + """, w AS (SELECT file_id, (pos - 1) // 3 + 1 AS seg_ix, pos AS word_ix, word, (pos % 3) * 200000 AS a, (pos % 3) * 200000 + 150000 AS e FROM words),
  own AS (SELECT w.file_id, row_number() OVER (PARTITION BY w.file_id ORDER BY seg_ix, word_ix) AS pos, word, a + start_us AS start_us, e + start_us AS end_us, spk FROM w JOIN segs USING (file_id, seg_ix)),""" + turns_sql("own", "built") + " SELECT * FROM built")
def cut_align(spark, sf_dir):
    w = b.words(spark, sf_dir).selectExpr("file_id", "(pos - 1) div 3 + 1 AS seg_ix", "pos AS word_ix", "word", "(pos % 3) * 200000 AS start_us", "(pos % 3) * 200000 + 150000 AS end_us")
    return align.cut_align(w, b.segments(spark, sf_dir), PAUSE_US)


@query("e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(0, 64)) AS i FROM embeddings), m AS (SELECT vec_id, i % 4 AS cls, avg(round(x, 4)) AS v FROM e GROUP BY ALL), s AS (SELECT vec_id, cls, exp(v) AS ex FROM m) SELECT vec_id, cls::INTEGER AS cls, round(ex / sum(ex) OVER (PARTITION BY vec_id), 4) AS prob FROM s")
def mean_pool(spark, sf_dir):
    """Means over 16 frames of 4 classes, as probabilities."""
    e = b.table(spark, sf_dir, "embeddings")
    mean = lambda c: F.aggregate(F.sequence(F.lit(0), F.lit(15)), F.lit(0.0), lambda s, t: s + F.round(F.get("embedding", t * 4 + c).cast("double"), 4)) / 16
    soft = e.select("vec_id", F.array(*(F.exp(mean(c)) for c in range(4))).alias("x")).withColumn("total", F.aggregate("x", F.lit(0.0), lambda s, v: s + v))
    return soft.select("vec_id", "total", F.posexplode("x").alias("cls", "v")).select("vec_id", "cls", F.round(F.col("v") / F.col("total"), 4).alias("prob"))


@query(WORDS + "," + SEGS + " SELECT s.file_id, s.seg_ix, count(w.pos) AS n_words FROM segs s LEFT JOIN words w ON w.file_id = s.file_id AND (w.pos - 1) // 3 + 1 = s.seg_ix GROUP BY ALL")
def words_per_segment(spark, sf_dir):
    w = b.words(spark, sf_dir).selectExpr("file_id", "(pos - 1) div 3 + 1 AS seg_ix", "pos")
    return intervals.numbered(b.segments(spark, sf_dir)).join(w, ["file_id", "seg_ix"], "left").groupBy("file_id", "seg_ix").agg(F.count("pos").alias("n_words"))


def _ms(c: str) -> str:
    return f"(({c} + 500) // 1000)::BIGINT"


@query(ALIGNED + f""", wd AS (SELECT smooth.*, greatest(0, end_us - start_us) AS d FROM smooth),
  ws AS (SELECT file_id, count(*) AS num_words, sum(snapped::INT + (old_spk IS DISTINCT FROM spk)::INT)::BIGINT AS reassigned_words, ((sum(d) + 500) // 1000)::BIGINT / 1000.0::DOUBLE AS total_covered_sec,
    ((2 * sum(d) + 100 * count(*)) // (200 * count(*)))::BIGINT / 10000.0::DOUBLE AS mean_word_dur, ((max(d) + 50) // 100)::BIGINT / 10000.0::DOUBLE AS max_word_dur FROM wd GROUP BY file_id),
  ts AS (SELECT file_id, count(*) AS num_turns, string_agg(speaker || '@' || {_ms("start_us")} || '-' || {_ms("end_us")} || ' ' || text, '|' ORDER BY turn_ix) AS turns FROM built GROUP BY file_id),
  ns AS (SELECT file_id, string_agg(norm || '=' || spk, ',' ORDER BY norm) AS mapping FROM names GROUP BY file_id),
  sg AS (SELECT file_id, string_agg(spk || '@' || {_ms("start_us")} || '-' || {_ms("end_us")}, '|' ORDER BY seg_ix) AS segments FROM reassigned GROUP BY file_id),
  sh AS (SELECT file_id, string_agg(spk || '=' || round(share * 1000000)::BIGINT, ',' ORDER BY spk) AS shares FROM shares GROUP BY file_id)
  SELECT v.file_id, CASE WHEN v.status = 'OK' THEN 'SUCCESS' ELSE 'BAD_SAMPLE' END AS status, v.reason, v.dropped, sh.shares, ns.mapping AS mapping, coalesce(sg.segments, '') AS segments,
    coalesce(ts.turns, '') AS turns, coalesce(num_turns, 0) AS num_turns, coalesce(num_words, 0) AS num_words, coalesce(reassigned_words, 0) AS reassigned_words,
    coalesce(total_covered_sec, 0.0) AS total_covered_sec, coalesce(mean_word_dur, 0.0) AS mean_word_dur, coalesce(max_word_dur, 0.0) AS max_word_dur
  FROM verdict v JOIN sh USING (file_id) LEFT JOIN ns ON v.status = 'OK' AND ns.file_id = v.file_id LEFT JOIN sg ON sg.file_id = v.file_id LEFT JOIN ts ON ts.file_id = v.file_id LEFT JOIN ws ON ws.file_id = v.file_id""")
def result_documents(spark, sf_dir):
    """The nested documents of every file, flattened for comparison; rejected files have empty turns and zeros."""
    d = documents.documents(b.words(spark, sf_dir).drop("event_id"), b.segments(spark, sf_dir), AUDIO_US, RULES)
    ms = lambda x: F.round(x * 1000).cast("long").cast("string")
    span = lambda x, name: F.concat(x[name], F.lit("@"), ms(x["start"]), F.lit("-"), ms(x["end"]))
    pairs = lambda entries, text: F.array_join(F.transform(F.array_sort(entries), text), ",")
    names = F.transform(F.map_entries("transcript.mapping.orig_to_norm"), lambda e: F.concat(e["value"], F.lit("="), e["key"]))
    return d.select(
        "file_id", "status", "reason", F.array_join("meta_diar.dropped_speakers", ",").alias("dropped"),
        pairs(F.map_entries("meta_diar.shares"), lambda e: F.concat(e["key"], F.lit("="), F.round(e["value"] * 1_000_000).cast("long").cast("string"))).alias("shares"),
        F.array_join(F.array_sort(names), ",").alias("mapping"),
        F.array_join(F.transform("meta_diar.postprocessed_segments", lambda x: span(x, "spk")), "|").alias("segments"),
        F.coalesce(F.array_join(F.transform("transcript.turns", lambda x: F.concat(span(x, "speaker"), F.lit(" "), x["text"])), "|"), F.lit("")).alias("turns"),
        *(F.coalesce(f"transcript.stats.{c}", F.lit(0)).alias(c) for c in ("num_turns", "num_words", "reassigned_words")),
        *(F.coalesce(f"meta_asr.stats.{c}", F.lit(0.0)).alias(c) for c in ("total_covered_sec", "mean_word_dur", "max_word_dur")))


@query(EVENTS + "," + SEGS + """, g AS (SELECT *, end_us - start_us AS d, CASE WHEN end_us - start_us > 22000000 THEN 21000000 ELSE 22000000 END AS step FROM segs WHERE (end_us * 32000 + 1000000) // 2000000 > (start_us * 32000 + 1000000) // 2000000),
  c AS (SELECT *, unnest(range(0, greatest(0, (d - 22000000 + step - 1) // step) + 1)) AS chunk_ix FROM g)
  SELECT file_id, seg_ix, spk, chunk_ix, start_us + chunk_ix * step AS start_us, start_us + least(d, chunk_ix * step + 22000000) AS end_us FROM c""")
def segment_chunks(spark, sf_dir):
    return intervals.segment_chunks(b.segments(spark, sf_dir), 22_000_000, 1_000_000, 22_000_000)


@query(WORDS + "," + SEGS + """, n AS (SELECT file_id, (pos - 1) // 3 + 1 AS seg_ix, count(*) AS num_words FROM words GROUP BY ALL)
  SELECT file_id, seg_ix, spk, start_us, end_us, greatest(0, end_us - start_us) AS dur_us, CASE WHEN end_us - start_us <= 22000000 THEN 1 ELSE (end_us - start_us) // 22000000 + 1 END AS num_chunks, coalesce(num_words, 0) AS num_words FROM segs LEFT JOIN n USING (file_id, seg_ix)""")
def segment_items(spark, sf_dir):
    w = b.words(spark, sf_dir).selectExpr("file_id", "(pos - 1) div 3 + 1 AS seg_ix")
    return intervals.segment_items(b.segments(spark, sf_dir), w, 22_000_000)


@query(JOURNAL + ", c AS (SELECT status, count(*) AS n FROM j GROUP BY status) SELECT CASE WHEN bool_or(status = 'FAILED') THEN 'done_with_errors' ELSE 'done' END AS status, sum(n)::BIGINT AS num_items, string_agg(status || '=' || n, ',' ORDER BY status) AS counts, bool_or(status = 'FAILED')::INT AS exit_code FROM c")
def run_summary(spark, sf_dir):
    counts = F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",")
    return journal.summary(b.journal(spark, sf_dir)).withColumn("counts", counts)


def _audio_files(spark, sf_dir):
    """Customers play as files: some durations are negative, missing or 0."""
    c = b.table(spark, sf_dir, "customer")
    return c.selectExpr("concat('/a/', c_custkey, '.wav') AS path", "CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN 0D WHEN c_custkey % 13 = 0 THEN double('NaN') ELSE c_acctbal END AS duration_sec",
                        "c_custkey AS bytes", "c_custkey AS mtime", "cast(c_custkey AS string) AS id")


FILES = """f AS (SELECT '/a/' || c_custkey || '.wav' AS path, CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN 0 WHEN c_custkey % 13 = 0 THEN 'NaN'::DOUBLE ELSE c_acctbal END AS d, c_custkey AS bytes, c_custkey AS mtime, c_custkey::VARCHAR AS id FROM customer),
  g AS (SELECT *, d IS NULL OR isnan(d) OR d < 0 AS bad FROM f)"""


@query(FILES + " SELECT path, CASE WHEN bad THEN 0 ELSE d END AS duration_sec, CASE WHEN bad THEN 'none' ELSE 'header' END AS duration_source, bytes, mtime, id FROM g")
def duration_manifest(spark, sf_dir):
    return files.duration_manifest(_audio_files(spark, sf_dir))


@query(FILES + " SELECT count(*) FILTER (NOT bad AND d > 0) AS written, count(*) FILTER (bad OR d = 0) AS dropped_zero FROM g")
def manifest_counts(spark, sf_dir):
    return files.manifest_counts(_audio_files(spark, sf_dir), drop_zero=True)


#: The cut flow: words of every segment that the rules leave, with its speaker.
CUT = (WORDS + "," + SEGS + "," + SHARES + "," + VERDICT + """, okay AS (SELECT file_id, dropped FROM verdict WHERE status = 'OK'),
  segs_in AS (SELECT segs.* FROM segs JOIN okay USING (file_id)), dropped_in AS (SELECT file_id, dropped AS spk FROM okay WHERE dropped <> ''),""" + REASSIGNED + """,
  names AS (SELECT file_id, spk, 'Spk' || (row_number() OVER (PARTITION BY file_id ORDER BY share DESC, spk) - 1) AS norm FROM shares JOIN okay USING (file_id) ANTI JOIN dropped_in USING (file_id, spk)),
  w AS (SELECT file_id, (pos - 1) // 3 + 1 AS seg_ix, pos AS word_ix, word, (pos % 3) * 200000 AS a, (pos % 3) * 200000 + 150000 AS e FROM words),
  own AS (SELECT w.file_id, seg_ix, row_number() OVER (PARTITION BY w.file_id ORDER BY seg_ix, word_ix) AS pos, word, a + start_us AS start_us, e + start_us AS end_us, n.norm AS spk
    FROM w JOIN reassigned r USING (file_id, seg_ix) LEFT JOIN names n ON n.file_id = w.file_id AND n.spk = r.spk),""" + turns_sql("own", "built"))


@query(CUT + f""", ts AS (SELECT file_id, count(*) AS num_turns, string_agg(speaker || '@' || {_ms("start_us")} || ' ' || text, '|' ORDER BY turn_ix) AS turns FROM built GROUP BY file_id),
  ws AS (SELECT file_id, count(*) AS num_words, string_agg((seg_ix - 1) || spk, ',' ORDER BY pos) AS words FROM own GROUP BY file_id),
  sc AS (SELECT file_id, seg_ix, count(*) AS k FROM own GROUP BY ALL),
  it AS (SELECT r.file_id, string_agg((r.seg_ix - 1) || r.spk || '@' || {_ms("r.start_us")} || '-' || {_ms("r.end_us")} || 'x' || CASE WHEN end_us - start_us <= 22000000 THEN 1 ELSE (end_us - start_us) // 22000000 + 1 END || ':' || coalesce(k, 0), '|' ORDER BY r.seg_ix) AS items
    FROM reassigned r LEFT JOIN sc ON sc.file_id = r.file_id AND sc.seg_ix = r.seg_ix GROUP BY r.file_id)
  SELECT v.file_id, CASE WHEN v.status = 'OK' THEN 'SUCCESS' ELSE 'BAD_SAMPLE' END AS status, v.reason, coalesce(ts.turns, '') AS turns, coalesce(num_turns, 0) AS num_turns, coalesce(num_words, 0) AS num_words, coalesce(ws.words, '') AS words, coalesce(it.items, '') AS items
  FROM verdict v LEFT JOIN ts USING (file_id) LEFT JOIN ws USING (file_id) LEFT JOIN it USING (file_id)""")
def cut_documents(spark, sf_dir):
    """The documents of the cut flow, flattened for comparison."""
    w = b.words(spark, sf_dir).selectExpr("file_id", "(pos - 1) div 3 + 1 AS seg_ix", "pos AS word_ix", "word", "(pos % 3) * 200000 AS start_us", "(pos % 3) * 200000 + 150000 AS end_us")
    d = documents.documents(w, b.segments(spark, sf_dir), AUDIO_US, RULES, cut_us=22_000_000)
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    ms = lambda x: F.round(x * 1000).cast("long").cast("string")
    joined = lambda name, by, f: F.coalesce(F.array_join(F.transform(name, f), by), F.lit(""))
    number = lambda x: x.cast("string")
    return d.select(
        "file_id", "status", "reason", joined("transcript.turns", "|", lambda t: text(t["speaker"], "@", ms(t["start"]), " ", t["text"])).alias("turns"),
        *(F.coalesce(f"transcript.stats.{c}", F.lit(0)).alias(c) for c in ("num_turns", "num_words")),
        joined("meta_asr.words", ",", lambda x: text(number(x["segment_id"]), x["speaker_id"])).alias("words"),
        joined("meta_asr.asr_batch_items", "|", lambda x: text(number(x["segment_id"]), x["spk"], "@", ms(x["start"]), "-", ms(x["end"]), "x", number(x["num_chunks_after_split"]), ":", number(x["num_words"]))).alias("items"))


@query(JOURNAL + ", p AS (SELECT input_path, arg_min(status, line_no) AS a, arg_max(status, line_no) AS z, min(line_no) AS f FROM j GROUP BY input_path) SELECT input_path, CASE WHEN f % 2 = 0 THEN z ELSE a END AS status FROM p")
def journal_files(spark, sf_dir):
    """Two runs append to a journal: every path, then some of them again; their last lines, read from the files."""
    ends = b.journal(spark, sf_dir).groupBy("input_path").agg(F.min_by("status", "line_no").alias("a"), F.max_by("status", "line_no").alias("z"), F.min("line_no").alias("f"))
    path = scratch(spark, "journal")
    files.append_journal(ends.select("input_path", F.col("a").alias("status")), path)
    files.append_journal(ends.where("f % 2 = 0").select("input_path", F.col("z").alias("status")), path)
    return journal.latest(files.read_journal(spark, path)).select("input_path", "status")


@query("d AS (SELECT lang || '/' || doc_id || '.wav' AS path, CASE WHEN doc_id % 3 = 0 THEN doc_id::VARCHAR ELSE 'own' || doc_id END AS id, n_chars / 100.0::DOUBLE AS duration_sec FROM documents) SELECT CASE WHEN path LIKE 'e%' THEN '/' || path ELSE '/audio/' || path END AS path, id, duration_sec FROM d")
def manifest_files(spark, sf_dir):
    """Documents play as a manifest that is written as JSON lines, read, and resolved below a folder; empty ids become stems."""
    d = b.table(spark, sf_dir, "documents").selectExpr("concat(if(lang LIKE 'e%', '/', ''), lang, '/', doc_id, '.wav') AS path", "if(doc_id % 3 = 0, '', concat('own', doc_id)) AS id", "n_chars / 100D AS duration_sec")
    path = scratch(spark, "manifest")
    files.write_manifest(d.orderBy("duration_sec", "path"), path)
    return files.resolved(files.read_manifest(spark, path), "/audio").select("path", "id", "duration_sec")


@query("t AS (SELECT 1) SELECT event_id, 'speaker_' || event_id % 3 AS spk, event_id * 1000000 + 500000 AS start_us, (event_id + event_id % 4) * 1000000 + 250000 AS end_us FROM events WHERE event_id % 4 > 0 AND event_id % 5 > 0")
def segment_lines(spark, sf_dir):
    """Events play as lines of a diarizer; what is no line or ends before it begins is dropped."""
    e = b.table(spark, sf_dir, "events").select("event_id", F.expr("if(event_id % 5 = 0, 'no line', concat(' ', event_id, '.5  ', event_id + event_id % 4, '.25 speaker_', event_id % 3))").alias("line"))
    return e.select("event_id", files.parse_segment_line(F.col("line")).alias("x")).where("x IS NOT NULL").select("event_id", "x.*")


@query(SQL["dialog_rows"].removeprefix("WITH RECURSIVE ").replace("SELECT file_id, row_ix, speaker, string_agg", ", out AS (SELECT file_id, row_ix, speaker, string_agg", 1)
       + ") SELECT file_id, count(DISTINCT row_ix) AS n_rows, count(*) AS n_entries, sum(length(text))::BIGINT AS n_chars FROM out GROUP BY file_id")
def dialog_files(spark, sf_dir):
    """Dialog rows written as an array of maps for each dialog, and read again."""
    path = scratch(spark, "dialogs")
    files.write_dialogs(islands.dialog_rows(b.turns(spark, sf_dir)), path)
    read = spark.read.schema("file_id long, rows array<string>").json(path)
    maps = read.select("file_id", F.posexplode("rows").alias("row_ix", "row")).select("file_id", "row_ix", F.explode(F.from_json("row", "map<string,string>")).alias("speaker", "text"))
    return maps.groupBy("file_id").agg(F.count_distinct("row_ix").alias("n_rows"), F.count("*").alias("n_entries"), F.sum(F.char_length("text")).alias("n_chars"))


@query("s AS (SELECT vec_id, round_even(greatest(-1, least(1, unnest(embedding)))::FLOAT * 32767::FLOAT, 0)::BIGINT AS x FROM embeddings) SELECT vec_id, count(*) / 16000.0::DOUBLE AS duration_sec, sum(x)::BIGINT AS total, max(x) AS top FROM s GROUP BY vec_id")
def wav_files(spark, sf_dir):
    """Vectors play as samples that are written as WAV contents, and decoded again."""
    e = b.table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("path"), F.col("embedding").alias("samples"))
    x = audio.decode(audio.encode(e)).withColumn("xs", F.transform("samples", lambda v: F.round(v * 32768).cast("long")))
    return x.select(F.col("path").cast("long").alias("vec_id"), "duration_sec", F.aggregate("xs", F.lit(0).cast("long"), lambda s, v: s + v).alias("total"), F.array_max("xs").alias("top"))


#: Eight vectors play as a file of samples; every four of them are a frame whose label is the place of the first largest; label 3 is blank.
HEARD = """au AS (SELECT vec_id // 8 AS file_id, flatten(list(embedding ORDER BY vec_id)) AS xs FROM embeddings GROUP BY ALL),
  ln AS (SELECT file_id, xs, len(xs) AS n, len(xs) * 1000000 // 16000 AS total FROM au)"""
WORDS_OF_CHUNKS = """cs AS (SELECT *, (a * 32000 + 1000000) // 2000000 AS s0, least((b * 32000 + 1000000) // 2000000, n) AS s1 FROM bd),
  cf AS (SELECT *, (s1 - s0) // 4 AS frames FROM cs WHERE s1 > s0),
  ft AS (SELECT *, unnest(range(0, frames)) AS t FROM cf),
  fl AS (SELECT file_id, k, a, b, frames, t, list_position(list_slice(xs, s0 + 4 * t + 1, s0 + 4 * t + 4), list_max(list_slice(xs, s0 + 4 * t + 1, s0 + 4 * t + 4))) - 1 AS label FROM ft),
  fr AS (SELECT *, sum(CASE WHEN before IS NULL OR before <> label THEN 1 ELSE 0 END) OVER (PARTITION BY file_id, k ORDER BY t) AS run FROM (SELECT *, lag(label) OVER (PARTITION BY file_id, k ORDER BY t) AS before FROM fl)),
  sp AS (SELECT file_id, k, a, b, frames, run, any_value(label) AS label, min(t) AS t0, max(t) + 1 AS t1 FROM fr WHERE label <> 3 GROUP BY ALL),
  si AS (SELECT *, sum(CASE WHEN label = 2 THEN 1 ELSE 0 END) OVER (PARTITION BY file_id, k ORDER BY run) AS island FROM sp),
  sw AS (SELECT file_id, k, a, b, frames, island, string_agg(CASE label WHEN 0 THEN 'a' ELSE 'b' END, '' ORDER BY run) AS word, min(t0) AS t0, max(t1) AS t1 FROM si WHERE label <> 2 GROUP BY ALL),
  hw AS (SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY k, island) AS pos, word, a + t0 * (b - a) // frames AS start_us, a + t1 * (b - a) // frames AS end_us FROM sw)"""


def _samples(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    one = F.sort_array(F.collect_list(F.struct("vec_id", "embedding")))
    audio_of = b.table(spark, sf_dir, "embeddings").groupBy(F.expr("vec_id div 8").alias("file_id")).agg(F.flatten(F.transform(one, lambda x: x["embedding"])).alias("samples"))
    return audio_of, audio_of.select("file_id", F.expr("size(samples) * 1000000L div 16000").alias("total_us"))


def _loudest() -> Callable:
    """A stand-in for a model: a chunk's frames are four samples each, and a frame's label is the place of its first largest."""

    def run(batch):
        import pandas as pd

        x, n = padded(list(batch["samples"]))
        labels = x[:, : x.shape[1] // 4 * 4].reshape(len(x), -1, 4).argmax(axis=2)
        return pd.DataFrame({"chunk": batch["chunk"].to_numpy(), "labels": list(labels), "frames": n // 4})

    return run


def _recognised(audio_of: DataFrame, bounds: DataFrame) -> DataFrame:
    heard = recognise.recognised(audio_of, bounds, Stage(_loudest, recognise.LABELS), recognise.Alphabet(("a", "b", "|"), 3), Batches("n_samples", 4096, 64), 600, 100)
    return heard.words


@query(HEARD + ", bd AS (SELECT file_id, xs, n, k, k * 4000 AS a, least(total, k * 4000 + 6000) AS b FROM (SELECT *, unnest(range(0, greatest(0, ceil((total - 6000) / 4000.0))::BIGINT + 1)) AS k FROM ln)), " + WORDS_OF_CHUNKS + """,
  st AS (SELECT file_id, pos, word, start_us, end_us, pos AS kp, start_us AS ks, end_us AS ke FROM hw WHERE pos = 1
    UNION ALL SELECT w.file_id, w.pos, w.word, w.start_us, w.end_us,
      CASE WHEN w.word = f.word AND (abs(w.start_us - f.ks) < 600 OR abs(w.end_us - f.ke) < 100) THEN f.kp ELSE w.pos END,
      CASE WHEN w.word = f.word AND (abs(w.start_us - f.ks) < 600 OR abs(w.end_us - f.ke) < 100) THEN f.ks ELSE w.start_us END,
      CASE WHEN w.word = f.word AND abs(w.start_us - f.ks) < 600 THEN greatest(f.ke, w.end_us) WHEN w.word = f.word AND abs(w.end_us - f.ke) < 100 THEN f.ke ELSE w.end_us END
    FROM st f JOIN hw w ON w.file_id = f.file_id AND w.pos = f.pos + 1)
  SELECT file_id, kp AS pos, any_value(word) AS word, any_value(ks) AS start_us, max(ke) AS end_us FROM st GROUP BY file_id, kp""")
def recognise_fixed(spark, sf_dir):
    """Samples in chunks of a fixed length that overlap, in batches over all files, to words that are stitched."""
    audio_of, lengths = _samples(spark, sf_dir)
    return _recognised(audio_of, recognise.fixed_bounds(lengths, 6_000, 2_000))


@query(HEARD + """, vp AS (SELECT file_id, total, 2000 * j AS x, 2000 * j + 2000 AS y FROM (SELECT *, unnest(range(0, n // 32)) AS j FROM ln) WHERE xs[32 * j + 1] > 0),
  vm AS (SELECT *, sum(CASE WHEN before = x THEN 0 ELSE 1 END) OVER (PARTITION BY file_id ORDER BY x) AS run FROM (SELECT *, lag(y) OVER (PARTITION BY file_id ORDER BY x) AS before FROM vp)),
  u AS (SELECT file_id, row_number() OVER (PARTITION BY file_id ORDER BY run) AS k, min(x) AS x, least(max(y), any_value(total)) AS y FROM vm GROUP BY file_id, run),
  f AS (SELECT file_id, k, 0 AS c, 0::BIGINT AS a, y AS e, false AS cut, 0::BIGINT AS pa, 0::BIGINT AS pb FROM u WHERE k = 1
    UNION ALL SELECT u.file_id, u.k, CASE WHEN z THEN f.c + 1 ELSE f.c END, CASE WHEN z THEN u.x ELSE f.a END, u.y, z, f.a, f.e
      FROM f JOIN u ON u.file_id = f.file_id AND u.k = f.k + 1, LATERAL (SELECT f.e - f.a > 100 AND (u.y - f.a > 9000 OR f.e - f.a > 6000) AS z)),
  pc AS (SELECT file_id, c - 1 AS c, pa AS a, pb AS b FROM f WHERE cut UNION ALL SELECT file_id, c, a, e FROM f WHERE e - a > 100 QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY k DESC) = 1 AND k = (SELECT max(k) FROM u WHERE u.file_id = f.file_id)),
  pn AS (SELECT *, CASE WHEN b - a > 12000 THEN (b - a) // 12000 + 1 ELSE 1 END AS m FROM pc), pp AS (SELECT *, unnest(range(0, m)) AS part FROM pn),
  bd AS (SELECT pp.file_id, xs, n, pp.c * 1000 + part AS k, a + (b - a) * part // m AS a, a + (b - a) * (part + 1) // m AS b FROM pp JOIN ln USING (file_id)), """ + WORDS_OF_CHUNKS + " SELECT * FROM hw")
def recognise_packed(spark, sf_dir):
    """Samples in chunks packed from speech, where the first of 32 samples is above 0, to words."""
    audio_of, lengths = _samples(spark, sf_dir)
    at = F.explode(F.filter(F.sequence(F.lit(0), F.expr("size(samples) div 32 - 1")), lambda j: F.get("samples", 32 * j) > 0)).alias("j")
    speech = audio_of.where("size(samples) >= 32").select("file_id", at).selectExpr("file_id", "j * 2000L AS start_us", "j * 2000L + 2000 AS end_us")
    return _recognised(audio_of, recognise.packed_bounds(speech, lengths, max_us=9_000, min_us=6_000, strict_us=12_000, least_us=100))


#: A predictor's outputs by the last label and by the one before it, for no label (first) and labels 0 to 2; the joint adds them to a frame.
LAST, BEFORE = ((0, 0, 0, 10), (-40, 10, 5, 20), (15, -45, 0, 10), (5, 10, -50, 25)), ((0, 0, 0, 0), (-5, 0, 10, 5), (0, -10, 5, 0), (10, 0, -5, 10))


def _tables() -> tuple:
    """A stand-in for a transducer's predictor and joint, in whole numbers; the state is the last label."""
    import numpy as np

    last, before = np.array(LAST, dtype=float), np.array(BEFORE, dtype=float)
    return lambda labels, states: (last[labels + 1] + before[states + 1], labels), lambda frames, outputs: frames + outputs, np.int64(-1)


def _sql_list(rows: tuple) -> str:
    return "[" + ", ".join(f"[{', '.join(map(str, r))}]" for r in rows) + "]"


@query(f"""fv AS (SELECT vec_id, list_transform(embedding, lambda x: floor(100 * x::DOUBLE)::BIGINT) AS xs FROM embeddings),
  d AS (SELECT vec_id, xs, 0 AS t, 0 AS n, 0 AS p, 0 AS q, '' AS labels, len(xs) // 4 AS frames FROM fv
    UNION ALL SELECT vec_id, xs, CASE WHEN go THEN t ELSE t + 1 END, CASE WHEN go THEN n + 1 ELSE 0 END, CASE WHEN go THEN k ELSE p END, CASE WHEN go THEN p ELSE q END,
      CASE WHEN go THEN labels || CASE WHEN labels = '' THEN '' ELSE ',' END || (k - 1) ELSE labels END, frames
    FROM (SELECT *, n < 3 AND k < 4 AS go FROM (SELECT *, list_position(s, list_max(s)) AS k FROM (SELECT *, [{', '.join(f"xs[4 * t + {c}] + l[p + 1][{c}] + b[q + 1][{c}]" for c in (1, 2, 3, 4))}] AS s
      FROM (SELECT *, {_sql_list(LAST)} AS l, {_sql_list(BEFORE)} AS b FROM d) WHERE t < frames))))
  SELECT vec_id, labels FROM d WHERE t = frames""")
def transducer_labels(spark, sf_dir):
    """Vectors play as 16 frames of four numbers; the predictor remembers two labels, and a frame emits three at most."""
    e = b.table(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda x: F.floor(x.cast("double") * 100).cast("double")).alias("frames"))
    got = apply(e, transducer.stage(_tables, 3, 4, "vec_id", "long", most=3))
    return got.select("vec_id", F.array_join(F.col("labels").cast("array<string>"), ",").alias("labels"))


@query("""it AS (SELECT doc_id % 16 AS part, doc_id, coalesce(n_chars, 0)::BIGINT AS length, row_number() OVER (PARTITION BY doc_id % 16 ORDER BY coalesce(n_chars, 0), doc_id) AS k FROM documents),
  bt AS (SELECT part, k, doc_id, length, 0 AS batch, 0 AS nth FROM it WHERE k = 1
    UNION ALL SELECT i.part, i.k, i.doc_id, i.length, CASE WHEN z THEN f.batch + 1 ELSE f.batch END, CASE WHEN z THEN 0 ELSE f.nth + 1 END
      FROM bt f JOIN it i ON i.part = f.part AND i.k = f.k + 1, LATERAL (SELECT f.nth + 1 >= 24 OR (f.nth + 2) * i.length > 20000 AS z))
  SELECT part, batch::BIGINT AS batch, nth::BIGINT AS nth, doc_id, length, max(length) OVER (PARTITION BY part, batch) AS padded_to FROM bt""")
def length_batches(spark, sf_dir):
    """Documents play as recordings of their number of characters, dealt by length into padded batches of 16 workers."""
    return planned(b.table(spark, sf_dir, "documents"), "doc_id", Batches("n_chars", 20_000, 24), F.col("doc_id") % 16)


@query("t AS (SELECT 1) SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN NULL WHEN vec_id % 2 = 0 THEN len(embedding) / 16000.0::DOUBLE ELSE (vec_id * 37 + 1) / 44100.0::DOUBLE END AS duration_sec, CASE WHEN vec_id % 7 = 0 THEN 'none' WHEN vec_id % 2 = 0 THEN 'riff' ELSE 'flac' END AS duration_source FROM embeddings")
def container_durations(spark, sf_dir):
    """Even vectors play as samples in WAV files, odd ones as lengths in FLAC headers, every seventh as no audio; durations without decoding."""
    e = b.table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("path"), F.col("embedding").alias("samples"), "vec_id")
    stream = F.concat(F.expr("unhex('664C614300000022')"), F.expr("unhex(repeat('00', 10))"), F.expr("unhex(lpad(hex(shiftleft(44100L, 44) + shiftleft(1L, 41) + shiftleft(15L, 36) + vec_id * 37 + 1), 16, '0'))"), F.expr("unhex(repeat('00', 16))"))
    heads = e.where("vec_id % 2 = 1").select("path", F.when(F.col("vec_id") % 7 == 0, F.lit("no audio").cast("binary")).otherwise(stream).alias("content"))
    waves = audio.encode(e.where("vec_id % 2 = 0")).select("path", F.when(F.col("path").cast("long") % 7 == 0, F.substring("content", 1, 20)).otherwise(F.col("content")).alias("content"))
    rows = files.duration_manifest(containers.durations(waves.unionByName(heads)).withColumns({"bytes": F.lit(0), "mtime": F.lit(0), "id": F.col("path")}))
    return rows.select(F.col("path").cast("long").alias("vec_id"), F.when(F.col("duration_source") != "none", F.col("duration_sec")).alias("duration_sec"), "duration_source")


@query("w AS (SELECT " + repr([[float(x) for x in row] for row in audio.mel_filters(4, 32)]) + """ AS mel),
  fr AS (SELECT vec_id, embedding AS xs, unnest(range(0, (len(embedding) - 32) // 16 + 1)) AS f FROM embeddings),
  fk AS (SELECT *, unnest(range(0, 17)) AS k FROM fr), fn AS (SELECT *, unnest(range(0, 32)) AS n FROM fk),
  ft AS (SELECT vec_id, f, k, sum(xs[16 * f + n + 1]::DOUBLE * (0.5 - 0.5 * cos(2 * pi() * n / 32)) * cos(2 * pi() * k * n / 32)) AS re, sum(xs[16 * f + n + 1]::DOUBLE * (0.5 - 0.5 * cos(2 * pi() * n / 32)) * sin(2 * pi() * k * n / 32)) AS im FROM fn GROUP BY ALL),
  mb AS (SELECT *, unnest(range(0, 4)) AS band FROM ft)
  SELECT vec_id, f::BIGINT AS frame, band::INTEGER AS band, round(ln(greatest(1e-9::DOUBLE, least(1e9::DOUBLE, sum((re * re + im * im) * mel[k + 1][band + 1])))), 4) AS value FROM mb, w GROUP BY vec_id, f, band""")
def log_mel_frames(spark, sf_dir):
    """Vectors play as samples that come in three parts; their features are those of the whole."""
    e = b.table(spark, sf_dir, "embeddings")
    cuts = F.array(F.slice("embedding", 1, 21), F.slice("embedding", 22, 5), F.slice("embedding", 27, 1_000_000))
    parts = e.select(F.col("vec_id").alias("path"), F.posexplode(cuts).alias("part_ix", "samples"))
    got = audio.feature_parts(parts, 4, "double", hop=16, window=32, center=False).select("path", "first_frame", F.posexplode("features").alias("k", "bands"))
    return got.select(F.col("path").alias("vec_id"), (F.col("first_frame") + F.col("k")).alias("frame"), F.posexplode("bands").alias("band", "value")).withColumn("value", F.round("value", 4))


@query(HEARD + ", bd AS (SELECT file_id, xs, n, k, k * 4000 AS a, least(total, k * 4000 + 6000) AS b FROM (SELECT *, unnest(range(0, greatest(0, ceil((total - 6000) / 4000.0))::BIGINT + 1)) AS k FROM ln)), " + WORDS_OF_CHUNKS + """
  SELECT c.file_id, c.k AS chunk_ix, c.a / 1000000.0::DOUBLE AS start_sec, c.b / 1000000.0::DOUBLE AS end_sec, coalesce(t.text, '') AS transcription
  FROM cf c LEFT JOIN (SELECT file_id, k, string_agg(['a', 'b', '|'][label + 1], '' ORDER BY run) AS text FROM sp GROUP BY ALL) t USING (file_id, k)""")
def longform_chunks(spark, sf_dir):
    """A text and its boundaries for every chunk."""
    audio_of, lengths = _samples(spark, sf_dir)
    got = recognise.longform(audio_of, recognise.fixed_bounds(lengths, 6_000, 2_000), Stage(_loudest, recognise.LABELS), recognise.Alphabet(("a", "b", "|"), 3), Batches("n_samples", 4096, 64))
    return got.select("file_id", "chunk_ix", F.col("boundaries.start").alias("start_sec"), F.col("boundaries.end").alias("end_sec"), "transcription")


@query(WORDS + """ SELECT file_id, count(*) AS n_words, string_agg(word, ' ' ORDER BY pos) AS said, round(sum(((start_us + 500) // 1000) / 1000.0::DOUBLE), 3) AS starts, round(sum(((end_us + 500) // 1000) / 1000.0::DOUBLE), 3) AS ends FROM words GROUP BY file_id""")
def words_documents(spark, sf_dir):
    """Words as a JSON document for each file, written as files of items and read again."""
    made = documents.words_documents(b.words(spark, sf_dir).drop("event_id"), "m").withColumn("id", F.col("file_id").cast("string"))
    path = scratch(spark, "words")
    kind = "audio_path string, model string, sample_rate int, words array<struct<word:string,start:double,`end`:double>>"
    items.write_items(made.select("id", F.from_json("content", kind).alias("doc")), {"doc": "words"}, path)
    read = spark.read.schema(kind).option("multiLine", "true").json(f"{path}/words")
    total = lambda c: F.round(F.aggregate(f"words.{c}", F.lit(0.0), lambda s, x: s + x), 3)
    return read.select(F.col("audio_path").cast("long").alias("file_id"), F.size("words").cast("long").alias("n_words"), F.array_join("words.word", " ").alias("said"), total("start").alias("starts"), total("end").alias("ends"))
