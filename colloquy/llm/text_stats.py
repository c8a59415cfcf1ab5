"""Counts over one whole text that the quality operators share."""

from __future__ import annotations

from collections import Counter

import numpy as np

from colloquy.llm.shared import Rolling, WordHashes, mixed

#: Characters that count as symbols, and white space.
SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\x0c\r"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "word_length", "word_length_spread", "symbol_share", "upper_share", "digit_share", "punctuation_share", "other_share", "distinct_share",
    "top_word_share", "repeat_share", "repeat2_share", "adjacent_share", "dup_line_share", "log_lines", "words_per_line", "bar_share", "end_share", "capital_share",
    "bang_share", "long_share", "short_share", "symbol_words",
)


def repeated(windows: np.ndarray, n: int, words: int) -> int:
    """Words that lie in an ``n``-word window found twice or more."""
    if not len(windows):
        return 0
    _, back, count = np.unique(windows, return_inverse=True, return_counts=True)
    edges = np.zeros(words + 1, dtype=np.int64)
    starts = np.nonzero(count[back] > 1)[0]
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + n, -1)
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


class TextStats:
    """Per worker: word hashes and window hashes."""

    def __init__(self):
        self.words, self.roll = WordHashes(), Rolling(0x9E3779B97F4A7C15)

    def split(self, raw: bytes) -> tuple[list[bytes], np.ndarray]:
        words = raw.split()
        return words, self.words.of(words)

    def base(self, text: str, words: list[bytes], hashes: np.ndarray) -> tuple[int, int, int, int, int]:
        """BASE of a text."""
        seen: set[str] = set()
        dup = 0
        if "\n" in text:
            for line in text.split("\n"):
                if line.strip(SPACES):
                    dup += line in seen
                    seen.add(line)
        n = len(words)
        return (
            n, len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup,
            repeated(mixed(self.roll.windows(hashes, 5)), 5, n),
        )

    def features(self, text: str, raw: bytes) -> list[float]:
        """FEATURES of a text; shares lie between 0 and 1, and a text without words has zeros."""
        words, hashes = self.split(raw)
        n, chars, symbols, dup, repeat = self.base(text, words, hashes)
        if not n:
            return [0.0] * len(FEATURES)
        code = np.frombuffer(raw, dtype=np.uint8)
        kinds = np.bincount(code, minlength=256)
        lengths = np.fromiter(map(len, words), dtype=np.float64, count=n)
        upper, digit, wide = kinds[65:91].sum(), kinds[48:58].sum(), kinds[128:].sum()
        lower = kinds[97:123].sum()
        ends = kinds[ord(".")] + kinds[ord("?")]
        marks = kinds[33:127].sum() - upper - digit - lower - symbols
        counts = np.array(list(Counter(words).values()))
        lines = text.count("\n") + 1
        firsts = sum(w[0] < 128 and 65 <= w[0] <= 90 for w in words)
        marked = sum(w[-1] in b"#*$%&|<>" for w in words)
        size = max(1, len(raw))
        return [
            float(np.log1p(n)), float(lengths.mean()), float(lengths.std()), symbols / size, upper / size, digit / size, marks / size, wide / size, len(counts) / n,
            counts.max() / n, repeat / n, repeated(mixed(self.roll.windows(hashes, 2)), 2, n) / n, float(np.mean(hashes[1:] == hashes[:-1])) if n > 1 else 0.0,
            dup / lines, float(np.log1p(lines)), n / lines, kinds[ord("|")] / n, ends / n, firsts / n,
            kinds[ord("!")] / n, float(np.mean(lengths > 14)), float(np.mean(lengths < 3)), marked / n,
        ]
