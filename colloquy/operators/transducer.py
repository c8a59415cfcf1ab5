"""Greedy transducer decoding of whole batches: one step for all items at a time, with masks for those that still go on."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd

from colloquy.models import Stage

#: Labels (-1 at the start) and states -> outputs and states, each with one row for an item; joint: frames and outputs -> scores.
Predict = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
Joint = Callable[[np.ndarray, np.ndarray], np.ndarray]


def greedy(frames: np.ndarray, lengths: np.ndarray, predict: Predict, joint: Joint, start: np.ndarray, blank: int, most: int = 10) -> list[np.ndarray]:
    """Labels of (items, frames, size) padded frames, of which ``lengths`` are an item's own.

    In each frame an item emits labels until blank scores best, the first of equals, or it has emitted ``most``. Only labels move the
    predictor, which starts from ``start``, the state of one item. A frame takes as many steps as its most talkative item.
    """
    n = len(frames)
    output, state = predict(np.full(n, -1), np.repeat(start[None], n, axis=0))
    output, state = output.copy(), state.copy()
    items, labels = [], []
    for t in range(frames.shape[1] if n else 0):
        active = np.flatnonzero(lengths > t)
        for _ in range(most):
            if not len(active):
                break
            best = joint(frames[active, t], output[active]).argmax(axis=1)
            active, best = active[best != blank], best[best != blank]
            if len(active):
                items.append(active)
                labels.append(best)
                output[active], state[active] = predict(best, state[active])
    if not items:
        return [np.empty(0, np.int64)] * n
    who, what = np.concatenate(items), np.concatenate(labels)
    order = np.argsort(who, kind="stable")
    return np.split(what[order], np.cumsum(np.bincount(who, minlength=n))[:-1])


def stage(load: Callable[[], tuple[Predict, Joint, np.ndarray]], blank: int, size: int, key: str, kind: str, most: int = 10) -> Stage:
    """A stage that decodes (key, frames): ``frames`` are an item's numbers, ``size`` for each frame; it returns (key, labels).

    Batches are padded; ``colloquy.operators.batches`` deals items of like length together.
    """

    def start() -> Callable[[pd.DataFrame], pd.DataFrame]:
        predict, joint, state = load()

        def run(batch: pd.DataFrame) -> pd.DataFrame:
            given = [np.asarray(x, dtype=np.float64) for x in batch["frames"]]
            lengths = np.array([len(x) // size for x in given])
            padded = np.zeros((len(given), int(lengths.max()), size))
            for k, (x, n) in enumerate(zip(given, lengths, strict=True)):
                padded[k, :n] = x[: n * size].reshape(n, size)
            return pd.DataFrame({key: batch[key].to_numpy(), "labels": greedy(padded, lengths, predict, joint, state, blank, most)})

        return run

    return Stage(start, f"{key} {kind}, labels array<long>", key)
