"""The append-only journal (line_no, input_path, status) and what follows from it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: States that a rerun leaves alone.
FINAL = ("SUCCESS", "BAD_SAMPLE", "SKIPPED")


def latest(journal: DataFrame, literal: bool = True) -> DataFrame:
    """(input_path, line_no, status) of each path's last line.

    ``literal=False`` looks past SKIPPED lines where there are others, so that a skipped failure can still be retried.
    """
    order = F.struct("line_no") if literal else F.struct((F.col("status") != "SKIPPED").alias("real"), F.col("line_no"))
    return journal.groupBy("input_path").agg(F.max_by(F.struct("line_no", "status"), order).alias("x")).select("input_path", "x.*")


def skipped_inputs(inputs: DataFrame, journal: DataFrame, retry_failed: bool = False, literal: bool = True) -> DataFrame:
    """Inputs that a resumed run skips."""
    done = latest(journal, literal).where(F.col("status").isin(*FINAL) | ((F.col("status") == "FAILED") & F.lit(not retry_failed)))
    return inputs.join(done.select("input_path"), "input_path", "left_semi")


def pending_inputs(inputs: DataFrame, journal: DataFrame, retry_failed: bool = False, literal: bool = True) -> DataFrame:
    """Inputs that a resumed run works on; decided before any model sees them."""
    done = latest(journal, literal).where(F.col("status").isin(*FINAL) | ((F.col("status") == "FAILED") & F.lit(not retry_failed)))
    return inputs.join(done.select("input_path"), "input_path", "left_anti")


def without_outputs(inputs: DataFrame, *outputs: DataFrame) -> DataFrame:
    """Inputs (id) that lack one of the outputs (id) at least."""
    have = outputs[0].select("id").distinct()
    for more in outputs[1:]:
        have = have.join(more.select("id"), "id", "left_semi")
    return inputs.join(have, "id", "left_anti")


def status_counts(journal: DataFrame) -> DataFrame:
    """(status, n, percent of all lines in tenths)."""
    counts = journal.groupBy("status").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))  # a row per status
    return counts.select("status", "n", F.round(100 * F.col("n") / total, 1).alias("percent"))


def duplicate_ids(inputs: DataFrame) -> DataFrame:
    return inputs.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")


def skip_rows(inputs: DataFrame, reason: str) -> DataFrame:
    """The lines of inputs that are skipped."""
    return inputs.select("input_path", F.lit("SKIPPED").alias("status"), F.lit(reason).alias("reason"))


def summary(journal: DataFrame) -> DataFrame:
    """One row (status, num_items, counts, exit_code) for the lines of a run; counts is a map in the order of its keys."""
    counts = journal.groupBy("status").agg(F.count("*").alias("n"))
    total = counts.agg(F.array_sort(F.collect_list(F.struct("status", "n"))).alias("x"), F.coalesce(F.sum("n"), F.lit(0)).alias("num_items"))
    failed = F.exists("x", lambda r: r["status"] == "FAILED")
    return total.select(F.when(failed, "done_with_errors").otherwise("done").alias("status"), "num_items", F.map_from_entries("x").alias("counts"), failed.cast("int").alias("exit_code"))
