"""Runs: gaps and islands over an explicit order.

Words are (file_id, pos, word, start_us, end_us[, spk]); all windows use the partition key file_id, so a plan that chains
these operators shuffles once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colloquy.functions import stripped
from colloquy.operators.scans import scanned


def _by(*keys: str):
    return Window.partitionBy(*keys)


def run_ids(df: DataFrame, key: str, order: str, changed: Column, name: str = "run") -> DataFrame:
    """Numbers runs from 1: a new one starts where ``changed`` (over the row and its lag) is true."""
    w = _by(key).orderBy(order)
    return df.withColumn(name, F.sum(F.when(changed, 1).otherwise(0)).over(w))


def ordered_text(pos: str, text: str, sep: str = " ") -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(pos, text))), lambda x: x[text]), sep)


def merge_adjacent(turns: DataFrame) -> DataFrame:
    """(file_id, pos, speaker, text) -> (file_id, run, speaker, text, n): blank turns go first, then neighbours of one speaker join."""
    clean = turns.withColumns({"speaker": stripped(F.col("speaker")), "text": stripped(F.col("text"))}).where("speaker != '' AND text != ''")
    before = F.lag("speaker").over(_by("file_id").orderBy("pos"))
    runs = run_ids(clean.withColumn("_before", before), "file_id", "pos", F.col("_before").isNull() | (F.col("_before") != F.col("speaker")))
    return runs.groupBy("file_id", "run", "speaker").agg(ordered_text("pos", "text").alias("text"), F.count("*").alias("n"))


def dialog_rows(turns: DataFrame) -> DataFrame:
    """(file_id, row_ix, speaker, text): a row of a dialog ends before a speaker who already is in it, if it has two or more.

    The row of a turn depends on all turns before it; one dialog's turns are gone through in order, with the row's speakers as state.
    """

    def step(state: tuple[int, set] | None, values: tuple) -> tuple[tuple[int, set], tuple]:
        row, here = state or (0, set())
        if values[0] in here and len(here) >= 2:
            row, here = row + 1, set()
        here.add(values[0])
        return (row, here), (row,)

    each = scanned(merge_adjacent(turns).select("file_id", "run", "speaker", "text"), "file_id", ["run"], ["speaker"], step, "row_ix int")
    return each.groupBy("file_id", "row_ix", "speaker").agg(ordered_text("run", "text").alias("text"))


def build_turns(words: DataFrame, pause_us: int) -> DataFrame:
    """(file_id, turn_ix, speaker, start_us, end_us, text, n_words) from words with spk.

    A turn ends at another speaker or after a pause longer than ``pause_us`` since the previous word of any kind; words
    without a speaker belong to no turn but count as previous words. A turn ends where its last word does.
    """
    w = _by("file_id").orderBy("pos")
    gap = words.withColumn("_gap", F.greatest(F.lit(0), F.col("start_us") - F.coalesce(F.lag("end_us").over(w), F.col("start_us")))).where("spk IS NOT NULL")
    gap = gap.withColumn("_spk", F.lag("spk").over(w))
    runs = run_ids(gap, "file_id", "pos", F.col("_spk").isNull() | (F.col("_spk") != F.col("spk")) | (F.col("_gap") > pause_us), "turn_ix")
    return runs.groupBy("file_id", "turn_ix").agg(
        F.first("spk").alias("speaker"), F.min_by("start_us", "pos").alias("start_us"), F.max_by("end_us", "pos").alias("end_us"),
        stripped(ordered_text("pos", "word")).alias("text"), F.count("*").alias("n_words"),
    )


def smooth_islands(words: DataFrame, max_words: int, max_us: int) -> DataFrame:
    """Words with spk smoothed, old_spk beside it: a short run between two runs of one other speaker takes that speaker.

    Of runs in a row that qualify, every second one is flipped: once the first is, the next has no longer equal neighbours.
    """
    w = _by("file_id").orderBy("pos")
    runs = run_ids(words.withColumn("_b", F.lag("spk").over(w)).withColumn("_r", F.row_number().over(w)), "file_id", "pos", (F.col("_r") == 1) | ~F.col("_b").eqNullSafe(F.col("spk")), "_run")
    per = runs.groupBy("file_id", "_run").agg(
        F.first("spk").alias("s"), F.count("*").alias("n"), (F.max_by("end_us", "pos") - F.min_by("start_us", "pos")).alias("d"))
    r = _by("file_id").orderBy("_run")
    per = per.withColumns({"l": F.lag("s").over(r), "x": F.lead("s").over(r)})
    fits = F.col("s").isNotNull() & (F.col("l") == F.col("x")) & (F.col("s") != F.col("l")) & (F.col("n") <= max_words) & (F.greatest(F.lit(0), F.col("d")) <= max_us)
    per = per.withColumn("e", F.coalesce(fits, F.lit(False)))
    per = per.withColumn("stretch", F.sum(F.when(F.col("e"), 0).otherwise(1)).over(r))
    per = per.withColumn("k", F.row_number().over(Window.partitionBy("file_id", "stretch", "e").orderBy("_run")))
    flip = per.where(F.col("e") & (F.col("k") % 2 == 1)).select("file_id", "_run", F.col("l").alias("_new"))
    return (
        runs.join(flip, ["file_id", "_run"], "left").withColumns({"old_spk": F.col("spk"), "spk": F.coalesce("_new", "spk")})
        .drop("_b", "_r", "_run", "_new")
    )


def stitch_words(words: DataFrame, max_gap_us: int = 250_000, same_end_us: int = 1_000) -> DataFrame:
    """Words without those that repeat the last kept one: the same word starting within the gap extends its end; the same
    word ending within ``same_end_us`` goes. (file_id, pos, word, start_us, end_us) of the words kept."""

    def step(state: tuple | None, values: tuple) -> tuple[tuple, tuple]:
        pos, word, start, end = values
        if state and word == state[1]:
            if abs(start - state[2]) < max_gap_us:
                return (*state[:3], max(state[3], end)), (state[0], end)
            if abs(end - state[3]) < same_end_us:
                return state, (state[0], None)
        return values, (pos, end)

    kept = scanned(words.select("file_id", "pos", "word", "start_us", "end_us"), "file_id", ["pos"], ["pos", "word", "start_us", "end_us"], step, "kept long, reach long")
    return kept.groupBy("file_id", F.col("kept").alias("pos")).agg(
        F.min_by("word", kept["pos"]).alias("word"), F.min_by("start_us", kept["pos"]).alias("start_us"), F.max("reach").alias("end_us"))


def collapse(labels: Column, blank: int) -> Column:
    """The labels that are not blank and not the frame before's: greedy decoding of one array."""
    return F.filter(labels, lambda x, i: (x != blank) & ((i == 0) | (F.get(labels, i - 1) != x)))


def token_spans(frames: DataFrame, blank: int) -> DataFrame:
    """(file_id, labels) -> (file_id, span_ix, token_id, start_t, end_t): runs of one label, blanks dropped, ends exclusive."""
    each = frames.select("file_id", F.posexplode("labels").alias("t", "label")).withColumn("t", F.col("t").cast("long"))
    w = _by("file_id").orderBy("t")
    runs = run_ids(each.withColumn("_b", F.lag("label").over(w)), "file_id", "t", F.col("_b").isNull() | (F.col("_b") != F.col("label")))
    spans = runs.where(F.col("label") != blank).groupBy("file_id", "run").agg(
        F.first("label").alias("token_id"), F.min("t").alias("start_t"), (F.max("t") + 1).alias("end_t"))
    return spans.select("file_id", F.row_number().over(_by("file_id").orderBy("run")).cast("long").alias("span_ix"), "token_id", "start_t", "end_t")


def words_from_tokens(spans: DataFrame, pieces: bool) -> DataFrame:
    """Spans with text -> (file_id, word_ix, word, start_t, end_t).

    Characters: white space and ``|`` separate words and belong to none. Pieces: one that begins with ▁ starts a word.
    """
    text = F.col("text")
    split = text.startswith("▁") if pieces else (text == "|") | ((text != "") & (stripped(text) == ""))
    runs = run_ids(spans, "file_id", "span_ix", split, "island")
    if not pieces:
        runs = runs.where(~split)
    words = runs.groupBy("file_id", "island").agg(ordered_text("span_ix", "text", "").alias("word"), F.min_by("start_t", "span_ix").alias("start_t"), F.max_by("end_t", "span_ix").alias("end_t"))
    if pieces:
        words = words.withColumn("word", stripped(F.replace("word", F.lit("▁"), F.lit(" "))))
    words = words.where(stripped(F.col("word")) != "")
    return words.select("file_id", F.row_number().over(_by("file_id").orderBy("island")).cast("long").alias("word_ix"), "word", "start_t", "end_t")
