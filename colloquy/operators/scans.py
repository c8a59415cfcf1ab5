"""Ordered scans: what a row gets depends on all rows of its key before it, through a small state.

Where windows cannot say it, rows are sorted by key and order inside their partition and gone through once, in Arrow batches. The
state is a few numbers or names, no key is gathered, and the cost is linear in the rows. Input that windows have already
dealt by the key is not shuffled again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type


def scanned(df: DataFrame, key: str, order: list[str], reads: list[str], step: Callable[[Any, tuple], tuple[Any, tuple]], made: str) -> DataFrame:
    """Adds the columns ``made``: ``step(state, values)`` gives the next state and the row's new values.

    ``values`` are those of ``reads``; the state is None at a key's first row.
    """
    added = T.StructType.fromDDL(made).fields
    rows = df.repartition(F.col(key)).sortWithinPartitions(key, *order)
    kinds = [to_arrow_type(f.dataType) for f in added]
    names = [*rows.columns, *(f.name for f in added)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, state = None, None
        for batch in batches:
            out = []
            for at, *values in zip(*(batch.column(c).to_pylist() for c in (key, *reads)), strict=True):
                if at != here:
                    here, state = at, None
                state, got = step(state, tuple(values))
                out.append(got)
            columns = list(zip(*out, strict=True)) if out else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names)

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, *added]))
