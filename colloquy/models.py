"""Where acoustic models plug in: a provider is loaded once per Python worker and gets batches of rows.

No model comes with this library. A provider turns a pandas batch into rows of a declared schema; errors stay with the item
they hit, as status and reason, and a batch that fails is tried again item by item. Keys that go in are compared with those
that come out, so an item that a provider drops, doubles or makes up is a failure of that item and never a silent loss.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from colloquy.operators.batches import Batches, filled


@dataclass(frozen=True)
class Stage:
    """A model stage: ``load()`` gives ``run(batch)``, which returns rows with ``schema``; ``key`` names the items.

    A run returns one row for each of its items, or where ``single`` is false one or more. ``name`` is that of the model's place: a
    worker holds one provider for each place, the last one, so two models that follow each other do not fill one device.
    """

    load: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]]
    schema: str
    key: str = "file_id"
    single: bool = True
    name: str = "model"


#: What every stage adds to its rows: the times of the batch that the item was in, in UTC.
ADDED = ("status", "reason", "started_at", "finished_at")
_loaded: dict[str, tuple[str, Callable]] = {}


def _provider(place: str, key: str, load: Callable[[], Callable]) -> Callable:
    """The worker process's own provider. Tasks get this function by its name, so all of them see one cache."""
    if place not in _loaded or _loaded[place][0] != key:
        _loaded.pop(place, None)
        _loaded[place] = key, load()
    return _loaded[place][1]


def _keys(frame: pd.DataFrame, key: str) -> list:
    return [None if x is None or x != x else x for x in frame[key].tolist()]


def _now() -> str:
    return datetime.now(timezone.utc).isoformat(timespec="microseconds")


def apply(df: DataFrame, stage: Stage, batches: Batches | None = None) -> DataFrame:
    """Rows of the stage for all rows of ``df``, with status (SUCCESS or FAILED), reason and times; failures have nulls elsewhere.

    An item for which the provider returns nothing is FAILED with the reason ``no result``, one that a single stage returns more
    often than it was asked for with ``returned twice``; rows under keys that were not asked for fail the items of the call.
    With ``batches`` a partition's rows are sorted by length and dealt into padded batches; else batches are as the rows come.
    Filter before this call: filters do not move through it.
    """
    schema = T.StructType([*T.StructType.fromDDL(stage.schema).fields, *(T.StructField(n, T.StringType()) for n in ADDED)])
    names = [f.name for f in schema.fields]
    # Stages of one factory differ in what they have captured, so what is sent to the tasks is the key.
    own = hashlib.sha256(cloudpickle.dumps(stage.load)).hexdigest()

    def called(run: Callable, batch: pd.DataFrame) -> tuple[pd.DataFrame, set]:
        """The provider's rows for those keys that came back as often as they should, and these keys."""
        began = _now()
        out = run(batch)
        asked, got = Counter(_keys(batch, stage.key)), Counter(_keys(out, stage.key))
        if foreign := [k for k in got if k not in asked]:
            raise LookupError(f"a row that was not asked for: {foreign[0]!r}")
        good = {k for k, n in asked.items() if (got[k] == n if stage.single else got[k])}
        if len(batch) == 1 and not good:
            raise LookupError("returned twice" if len(out) else "no result")
        kept = out[[k in good for k in _keys(out, stage.key)]]
        return kept.assign(status="SUCCESS", reason=None, started_at=began, finished_at=_now()), good

    def failed(item: pd.DataFrame, began: str, error: Exception) -> pd.DataFrame:
        reason = str(error) if isinstance(error, LookupError) and type(error) is LookupError else repr(error)
        return pd.DataFrame([{**dict.fromkeys(names), stage.key: item[stage.key].iloc[0], "status": "FAILED", "reason": reason, "started_at": began, "finished_at": _now()}])

    def work(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run = _provider(stage.name, own, stage.load)
        for batch in filled(rows, batches) if batches else rows:
            began, good = _now(), set()
            if len(batch) > 1:
                try:
                    out, good = called(run, batch)
                    yield out[names]
                except Exception:  # noqa: BLE001  any model error: find the items that cause it
                    good = set()
            for k in [k for k, key in enumerate(_keys(batch, stage.key)) if key not in good]:
                item = batch.iloc[k : k + 1]
                try:
                    yield called(run, item)[0][names]
                except Exception as error:  # noqa: BLE001
                    yield failed(item, began, error)[names]

    if batches:
        df = df.sortWithinPartitions(batches.length)
    return df.mapInPandas(work, schema)
