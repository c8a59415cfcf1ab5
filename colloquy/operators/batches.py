"""Batches by length: items of like length share one, so that padding them to the longest costs little.

``planned`` says which batch every item falls into, ``filled`` deals rows inside a task alike. Both go through the items of a part in
order of their length and close a batch before an item that would make it too large, so neither holds more than one batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Batches:
    """``length``: the column with an item's length; ``padded``: a batch's rows times its longest item, at most, unless it is
    one item that is longer by itself; ``rows``: items in a batch, at most."""

    length: str
    padded: int
    rows: int = 1024

    def __post_init__(self) -> None:
        if self.padded < 1 or self.rows < 1:
            raise ValueError("batches must have room for an item")


class Filling:
    """Items in order of their length: ``full(length)`` says that the next one begins a new batch."""

    def __init__(self, plan: Batches):
        self.plan, self.n = plan, 0

    def full(self, length: int) -> bool:
        closes = self.n > 0 and (self.n >= self.plan.rows or (self.n + 1) * length > self.plan.padded)
        self.n = 1 if closes else self.n + 1
        return closes


def _lengths(column: pd.Series) -> list[int]:
    return [0 if x is None or x != x else int(x) for x in column.tolist()]


def filled(frames: Iterator[pd.DataFrame], plan: Batches) -> Iterator[pd.DataFrame]:
    """Rows in order of ``plan.length`` (null: 0) -> batches of them."""
    filling, held = Filling(plan), []
    for frame in frames:
        start = 0
        for k, length in enumerate(_lengths(frame[plan.length])):
            if filling.full(length):
                held.append(frame.iloc[start:k])
                yield pd.concat([f for f in held if len(f)], ignore_index=True)
                held, start = [], k
        held.append(frame.iloc[start:])
    held = [f for f in held if len(f)]
    if held:
        yield pd.concat(held, ignore_index=True)


def padded(rows: list) -> tuple[np.ndarray, np.ndarray]:
    """Arrays of any lengths -> (one array, filled up with zeros; their lengths); an empty list is an error."""
    if not len(rows):
        raise ValueError("no items")
    lengths = np.array([len(x) for x in rows], dtype=np.int64)
    out = np.zeros((len(rows), int(lengths.max())), dtype=np.asarray(rows[0]).dtype if lengths[0] else np.float32)
    for k, x in enumerate(rows):
        out[k, : len(x)] = x
    return out, lengths


def planned(items: DataFrame, key: str, plan: Batches, part: Column) -> DataFrame:
    """(part, batch, nth, key, length, padded_to) of every item: batches are numbered from 0 in each part.

    Items of a part are in order of length, then key; ``part`` says what one worker gets, and its rows are gone through one
    after the other, not gathered. padded_to is the length of the batch's longest item. A null length counts as 0.
    """
    kind = items.schema[key].dataType.simpleString()
    rows = items.select(part.cast("long").alias("part"), F.col(key), F.coalesce(F.col(plan.length).cast("long"), F.lit(0)).alias("length"))
    rows = rows.repartition(F.col("part")).sortWithinPartitions("part", "length", key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, number, filling, held = None, 0, Filling(plan), []

        def close() -> pa.RecordBatch:
            n, longest = len(held), held[-1][1] if held else 0
            columns = [pa.array([here] * n, pa.int64()), pa.array([number] * n, pa.int64()), pa.array(range(n), pa.int64()),
                       pa.array([x[0] for x in held], own), pa.array([x[1] for x in held], pa.int64()), pa.array([longest] * n, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, ["part", "batch", "nth", key, "length", "padded_to"])

        for batch in batches:
            own = batch.schema.field(key).type
            for at, name, length in zip(*(batch.column(c).to_pylist() for c in ("part", key, "length")), strict=True):
                fresh = not held or at != here
                if fresh:
                    if held:
                        yield close()
                    here, number, filling, held = at, 0, Filling(plan), []
                if filling.full(length):
                    yield close()
                    number, held = number + 1, []
                held.append((name, length))
        if held:
            yield close()

    return rows.mapInArrow(run, f"part long, batch long, nth long, `{key}` {kind}, length long, padded_to long")
