"""The cleaning chain as one pass over code points.

The texts of a batch lie end to end as one array of code points, and a table gives each point's class: kept, dropped,
horizontal space, line end or other white space. What the regular expressions of the chain do one after the other follows
from the classes of a point and of what stands before it in its run of white space, so all of it is array operations.
Classes are asked of the JVM's regular expressions once, so the pass agrees with the column functions on every code point.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

KEPT, DROPPED, SPACE, LINE_END, OTHER_SPACE = range(5)
#: Code points that are held as arrays at once; a longer text is held alone.
AT_ONCE = 1 << 20

Runs = tuple[tuple[int, ...], tuple[int, ...]]


@lru_cache(maxsize=4)
def class_runs(dropped: tuple[str, ...], spaces: str = r"(?U)\s", horizontal: str = r"[ \t\r\f\x0b]") -> Runs:
    """Where runs of code points of one class begin, and their classes, by patterns as the JVM has them. The order of preference: dropped, line end, horizontal, other space."""
    jvm = SparkContext._active_spark_context._jvm
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    table = np.full(0x110000, KEPT, np.uint8)
    table[0xD800:0xE000] = DROPPED  # do not occur in valid text

    def mark(pattern: str, kind: int) -> None:
        rest = jvm.java.util.regex.Pattern.compile(pattern).matcher(every).replaceAll("")
        hit = np.ones(0x110000, bool)
        hit[np.frombuffer(rest.encode("utf-32-le"), np.uint32)] = False
        hit[0xD800:0xE000] = False
        table[hit] = kind

    mark(spaces, OTHER_SPACE)
    mark(horizontal, SPACE)
    table[ord("\n")] = LINE_END
    for pattern in dropped:
        mark(pattern, DROPPED)
    starts = np.flatnonzero(np.diff(table, prepend=255))
    return tuple(starts.tolist()), tuple(table[starts].tolist())


@lru_cache(maxsize=4)
def _table(runs: Runs) -> np.ndarray:
    starts, kinds = runs
    return np.repeat(np.array(kinds, np.uint8), np.diff([*starts, 0x110000]))


def transduced(texts: list[str], runs: Runs) -> list[str]:
    """Each text without dropped code points, with one space for a run of horizontal space, nothing after a line end but
    what is no white space, and no white space at its ends."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = _table(runs)[codes]
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
    stay = kind != DROPPED
    if not stay.all():
        codes, kind, owner = codes[stay], kind[stay], owner[stay]
    n = len(codes)
    if not n:
        return [""] * len(texts)
    new = np.ones(n, bool)  # of a text
    new[1:] = owner[1:] != owner[:-1]
    blank, place = kind >= SPACE, np.arange(n, dtype=np.int32)
    begins = blank & new
    begins[1:] |= blank[1:] & ~blank[:-1]
    run = np.maximum.accumulate(np.where(begins, place, 0))  # where the run of white space began
    line = np.maximum.accumulate(np.where(kind == LINE_END, place, -1))
    keep = np.ones(n, bool)
    keep[1:] &= ~(blank[1:] & ~begins[1:] & (line[:-1] >= run[1:]))  # after a line end of the same run
    keep[1:] &= ~((kind[1:] == SPACE) & (kind[:-1] == SPACE) & ~new[1:])
    keep &= ~(blank & new[run])  # the run that begins a text
    ends = np.append(new[1:], True)
    last = np.minimum.accumulate(np.where(blank, n, place)[::-1])[::-1]  # the next place that is no white space
    stop = np.minimum.accumulate(np.where(ends, place, n)[::-1])[::-1]  # the text's last place
    keep &= ~(blank & (last > stop))
    codes = np.where(kind == SPACE, np.uint32(32), codes)[keep]
    out, edges = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"), np.cumsum(np.bincount(owner[keep], minlength=len(texts))).tolist()
    return [out[a:b] for a, b in zip([0, *edges], edges)]


def without_urls(text: str, patterns: tuple[tuple[str, re.Pattern], ...]) -> str:
    """Patterns apply only to texts that hold their first characters."""
    for sign, pattern in patterns:
        if sign in text:
            text = pattern.sub("", text)
    return text


def cleaning_column(c: Column, first: Callable[[str], str], runs: Runs, urls: tuple[tuple[str, str], ...], stop_words: tuple[str, ...], least: int = 15, looked_at: int = 100, wordy: int = 50) -> Column:
    """The cleaned text of c, or null for blank and poor ones: under `least` characters, or of over `wordy` words without a stop word among the first `looked_at`."""
    stop = frozenset(stop_words)

    def good(text: str) -> str | None:
        if len(text) < least:
            return None
        words = text.split(None, looked_at)[:looked_at]
        return text if len(words) <= wordy or not stop.isdisjoint(w.lower() for w in words) else None

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        patterns = tuple((sign, re.compile(p)) for sign, p in urls)
        for series in batches:
            out: list[str | None] = [None] * len(series)
            held, size = [], 0
            rows = [(i, t) for i, t in enumerate(series.tolist()) if t is not None and t.strip()]
            for n, (i, text) in enumerate(rows, 1):
                held.append((i, without_urls(first(text), patterns)))
                size += len(held[-1][1])
                if size >= AT_ONCE or n == len(rows):
                    for (j, _), cleaned in zip(held, transduced([t for _, t in held], runs)):
                        out[j] = good(cleaned)
                    held, size = [], 0
            yield pd.Series(out, dtype=object)

    return clean(c)
