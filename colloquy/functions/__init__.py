"""Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What Python's str.strip() removes, for Java's regular expressions.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"


def stripped(text: Column) -> Column:
    """``text`` without white space of any kind at its ends."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def stem(path: Column) -> Column:
    """The last path part without its last ending; a leading dot is no ending."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)/*$", 1), r"(?<=.)\.[^.]*$", "")


def clock(micros: Column) -> Column:
    """[HH:]MM:SS:cc with hundredths cut off, not rounded; hours only where there are any."""
    two = lambda x: F.lpad(x.cast("string"), 2, "0")
    hours = F.floor(micros / 3_600_000_000)
    rest = F.concat_ws(":", two(F.floor(micros / 60_000_000) % 60), two(F.floor(micros / 1_000_000) % 60), two(F.floor(micros / 10_000) % 100))
    long = F.concat(F.when(hours < 10, two(hours)).otherwise(hours.cast("string")), F.lit(":"), rest)
    return F.when(hours > 0, long).otherwise(rest)


def seconds_to_micros(seconds: Column) -> Column:
    return F.round(seconds * 1_000_000).cast("long")


def millis(micros: Column) -> Column:
    """Seconds to three places, halves up, by whole numbers; for times that are not negative."""
    return F.floor((micros + 500) / 1000) / 1000


def token_text(ids: Column, vocabulary: list[str]) -> Column:
    """The pieces of ``ids`` as text: ``▁`` begins a word. Ids beyond the vocabulary, the blank among them, are left out."""
    pieces = F.array(*map(F.lit, vocabulary))
    known = F.filter(F.transform(ids, lambda i: F.get(pieces, i.cast("int"))), lambda p: p.isNotNull())
    return stripped(F.replace(F.array_join(known, ""), F.lit("▁"), F.lit(" ")))
