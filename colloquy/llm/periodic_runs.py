"""Periodic runs of words, found with a suffix automaton whose states' end positions are merged small to large.

A run is a stretch of consecutive words with smallest period q, at least twice as long as q, that no neighbouring word
extends. Each document is searched by itself, so nothing is shuffled. A state of the automaton stands for the substrings
that end at the same positions. Its ordered set of end positions is the union of its children's in the link tree; wherever a
merge makes two positions neighbours at a distance d not above the state's length, a square of period d ends at the second one.
Every run has such a pair: a factor of the length of its period does not occur inside its own square, so its two ends are
neighbours in the first set that holds both. Squares are then extended to both sides, once for each run.

Words without any repeated window of ``least // 2`` words near them are set aside first, which loses nothing: a run of
``least`` or more words has at least half as many consecutive words that recur one period on, so all of its words lie in such windows.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquy.llm.shared import Rolling, WordHashes, mixed, raw, strings, with_columns

LEAST = 12


class Ends:
    """An ordered set of positions, in sorted blocks, so that an insertion moves no more than a block."""

    MOST = 1024

    def __init__(self, first: int):
        self.blocks, self.tops, self.size = [array("i", [first])], [first], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def add(self, p: int) -> tuple[int | None, int | None]:
        """Inserts ``p``, which is new; gives its neighbours."""
        k = min(bisect_left(self.tops, p), len(self.tops) - 1)
        block = self.blocks[k]
        at = bisect_left(block, p)
        before = block[at - 1] if at else self.tops[k - 1] if k else None
        after = block[at] if at < len(block) else None  # beyond the last block's end there is nothing
        block.insert(at, p)
        self.tops[k] = block[-1]
        self.size += 1
        if len(block) > self.MOST:
            half = len(block) // 2
            self.blocks[k : k + 1] = [block[:half], block[half:]]
            self.tops[k : k + 1] = [block[half - 1], block[-1]]
        return before, after


class Automaton:
    """Suffix automaton of a sequence of small numbers. Most states have one way out, which is kept in arrays."""

    def __init__(self, symbols: list[int]):
        self.length, self.link = array("i", [0]), array("i", [-1])
        self.symbol, self.to, self.more = array("i", [-1]), array("i", [-1]), {}
        #: The position at which a state was made, -1 for copies: a state's end positions are those below it in the link tree.
        self.made = array("i", [-1])
        last = 0
        for at, c in enumerate(symbols):
            last = self._extend(last, c, at)

    def _state(self, length: int, link: int, made: int) -> int:
        self.length.append(length)
        self.link.append(link)
        self.symbol.append(-1)
        self.to.append(-1)
        self.made.append(made)
        return len(self.length) - 1

    def _next(self, s: int, c: int) -> int:
        if self.symbol[s] == c:
            return self.to[s]
        more = self.more.get(s)
        return -1 if more is None else more.get(c, -1)

    def _put(self, s: int, c: int, to: int) -> None:
        if self.symbol[s] in (-1, c):
            self.symbol[s], self.to[s] = c, to
        else:
            self.more.setdefault(s, {})[c] = to

    def _extend(self, last: int, c: int, at: int) -> int:
        new = self._state(self.length[last] + 1, 0, at)
        p = last
        while p != -1 and (q := self._next(p, c)) == -1:
            self._put(p, c, new)
            p = self.link[p]
        if p == -1:
            return new
        if self.length[q] != self.length[p] + 1:
            copy = self._state(self.length[p] + 1, self.link[q], -1)
            self.symbol[copy], self.to[copy] = self.symbol[q], self.to[q]
            if q in self.more:
                self.more[copy] = dict(self.more[q])
            while p != -1 and self._next(p, c) == q:
                self._put(p, c, copy)
                p = self.link[p]
            self.link[q] = copy
            q = copy
        self.link[new] = q
        return new

    def squares(self) -> Iterator[tuple[int, int]]:
        """(period, last position) of squares, every run's among them: new neighbours in the merged sets of end positions."""
        # Longest first, so children come before their parents; the root has length 0 and no squares.
        order = array("i", np.argsort(-np.frombuffer(self.length, dtype=np.int32), kind="stable").astype(np.int32).tobytes())
        #: By state; a set of one position, as most are, is the position itself.
        sets: dict[int, Ends | int] = {}
        for s in order:
            if s == 0:
                break
            own = sets.pop(s, None)
            if self.made[s] >= 0:
                if own is None:
                    own = self.made[s]
                else:
                    own = yield from self._near(own, self.made[s], self.length[s])
            up = self.link[s]
            if up == 0:
                continue
            there = sets.get(up)
            if there is None:
                sets[up] = own
                continue
            if isinstance(there, int) or isinstance(own, Ends) and there.size < own.size:
                there, own = own, there
            for p in (own,) if isinstance(own, int) else own:
                there = yield from self._near(there, p, self.length[up])
            sets[up] = there

    @staticmethod
    def _near(ends: Ends | int, p: int, length: int) -> Iterator[tuple[int, int]]:
        """Adds ``p`` to a set and gives it back."""
        if isinstance(ends, int):
            ends = Ends(ends)
        before, after = ends.add(p)
        if before is not None and p - before <= length:
            yield p - before, p
        if after is not None and after - p <= length:
            yield after - p, after
        return ends


def _while_equal(words: np.ndarray, at: int, d: int, step: int) -> int:
    """How many words on from ``at``, going by ``step``, equal the word ``d`` before them; by blocks of growing size."""
    n, size = 0, 32
    while True:
        if step > 0:
            a, b = at + n, min(at + n + size, len(words))
        else:
            a, b = max(at - n - size + 1, d), at - n + 1
        if a >= b:
            return n
        differ = np.flatnonzero(words[a:b] != words[a - d : b - d])
        if len(differ):
            return n + int(differ[0] if step > 0 else b - a - 1 - differ[-1])
        n, size = n + b - a, size * 2


def runs_of(symbols: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``least`` symbols and twice their period, by start and period."""
    words = np.array(symbols, dtype=np.int32)
    found: dict[tuple[int, int], int] = {}
    #: Per period the stretches found so far, by their start; two of one period overlap by less than it, so one look decides.
    known: dict[int, list[tuple[int, int]]] = {}
    for d, last in Automaton(symbols).squares():
        own = known.setdefault(d, [])
        first = last - 2 * d + 1
        k = bisect_left(own, (first + 1, 0)) - 1
        if k >= 0 and own[k][1] > last:
            continue
        right = _while_equal(words, last + 1, d, 1)
        left = _while_equal(words, first + d - 1, d, -1)
        a, b = first - left, last + 1 + right
        insort(own, (a, b))
        found[a, b] = min(d, found.get((a, b), d))
    return sorted((a, b - a, d) for (a, b), d in found.items() if b - a >= max(least, 2 * d))


class Finder:
    """Per task: hashes of words; the runs of a text's words."""

    def __init__(self, least: int = LEAST):
        self.least, self.gram = least, max(1, least // 2)
        self.words, self.roll = WordHashes(), Rolling(0xC2B2AE3D27D4EB4F)

    def regions(self, words: list[bytes]) -> list[tuple[int, int]]:
        """Stretches covered by windows of ``gram`` words whose hash occurs twice: every run lies inside one of them."""
        if len(words) < self.least:
            return []
        windows = mixed(self.roll.windows(self.words.of(words), self.gram))
        order = np.sort(windows)
        again = np.unique(order[1:][order[1:] == order[:-1]])
        if not len(again):
            return []
        starts = np.flatnonzero(np.isin(windows, again))
        gaps = np.flatnonzero(starts[1:] > starts[:-1] + self.gram)
        firsts = starts[np.concatenate([[0], gaps + 1])]
        ends = starts[np.concatenate([gaps, [len(starts) - 1]])] + self.gram
        return [(int(a), int(b)) for a, b in zip(firsts, ends, strict=True) if b - a >= self.least]

    def runs(self, words: list[bytes]) -> list[tuple[int, int, int]]:
        out = []
        for a, b in self.regions(words):
            names: dict[bytes, int] = {}
            symbols = [names.setdefault(w, len(names)) for w in words[a:b]]
            out += [(a + start, length, period) for start, length, period in runs_of(symbols, self.least)]
        return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run contains after its first period."""
    edges = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    keep = np.cumsum(edges[:-1]) == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k] if runs else words


RUN = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])


def find_runs(df: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """Adds n_words, runs (start, length, period; by start, then period) and collapsed_text to every row of ``df``.

    Words are runs of bytes other than ASCII white space, compared as bytes, so invalid UTF-8 counts as itself. A run has
    at least ``least`` words and twice its smallest period. collapsed_text joins by one space the words that no run contains
    after its first period. Null and empty texts have no words and no runs. Texts are read whole; the automaton takes some 150
    bytes for each word of a stretch that repeats, so a text of five million words that repeat takes below one GB.
    Rows are independent: ties, repeated rows, null ids and empty tables need no rule. Equal-named columns are replaced, whatever
    their case where the session ignores it; all others pass through.
    """
    item = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def start() -> Callable[[pa.Array], list[pa.Array]]:
        finder = Finder(least)

        def call(texts: pa.Array) -> list[pa.Array]:
            counts, lists, left = [], [], []
            for t in texts.to_pylist():
                words = t.split()
                runs = finder.runs(words)
                counts.append(len(words))
                lists.append([{"start": a, "length": n, "period": q} for a, n, q in runs])
                left.append(b" ".join(collapsed(words, runs)))
            return [pa.array(counts, pa.int64()), pa.array(lists, pa.list_(item)), strings(left)]

        return call

    made = [T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed_text", T.StringType())]
    return with_columns(df, raw(df, text), made, start)


def digests(found: DataFrame, ident: str = "doc_id") -> DataFrame:
    """(ident, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256): the longest run and digests of all."""
    best = F.expr("array_max(transform(runs, r -> struct(r.length AS length, -r.start AS start, -r.period AS period)))")
    lines = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || '\n'), '')")
    return found.select(ident, "runs", "collapsed_text", best.alias("best"), lines.alias("lines")).select(
        ident, F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"))
