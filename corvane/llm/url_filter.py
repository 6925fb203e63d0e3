"""URL rules as globs in one bit-parallel automaton.

Every glob gets a bit for its start and one for each of its symbols, side by side in 64-bit words. One step of Shift-And
moves all globs at once over a character: bits move on where the character fits, stay where a wildcard takes it, and a
bit before a wildcard also sets the wildcard's. Here the step runs over a column of URLs at a time, character by
character, so it is a few numpy operations whatever the number of URLs.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class GlobAutomaton:
    """Globs over bytes: ? is one byte but /, * any run without /, ** any run; all else, and whatever follows a backslash, stands for itself."""

    def __init__(self, globs: Sequence[str]):
        symbols: list[tuple[str, int | None]] = []
        starts, accepts = [], []
        for glob in globs:
            g, at = glob.encode(), 0
            starts.append(len(symbols))
            symbols.append(("start", None))
            while at < len(g):
                if g[at] == 42:
                    run = len(g[at:]) - len(g[at:].lstrip(b"*"))
                    symbols.append(("deep" if run > 1 else "flat", None))
                    at += run
                elif g[at] == 92 and at + 1 < len(g):
                    symbols.append(("byte", g[at + 1]))
                    at += 2
                else:
                    symbols.append(("any", None) if g[at] == 63 else ("byte", g[at]))
                    at += 1
            accepts.append(len(symbols) - 1)
        self.words = max(1, -(-len(symbols) // 64))
        self.begin, self.before = self._mask(starts), self._mask(i - 1 for i, (k, _) in enumerate(symbols) if k in ("flat", "deep"))
        self.fits, self.stays = np.zeros((256, self.words), np.uint64), np.zeros((256, self.words), np.uint64)
        bit = lambda i: (i // 64, np.uint64(1 << i % 64))
        beyond = np.arange(256) != 47
        for i, (kind, byte) in enumerate(symbols):
            word, mask = bit(i)
            if kind == "byte":
                self.fits[byte, word] |= mask
            elif kind == "any":
                self.fits[beyond, word] |= mask
            elif kind != "start":
                self.stays[beyond if kind == "flat" else slice(None), word] |= mask
        self.accepts = [bit(i) for i in accepts]

    def _mask(self, bits) -> np.ndarray:
        out = [0] * self.words
        for b in bits:
            out[b // 64] |= 1 << b % 64
        return np.array(out, np.uint64)

    @staticmethod
    def _shift(d: np.ndarray) -> np.ndarray:
        out = d << np.uint64(1)
        out[:, 1:] |= d[:, :-1] >> np.uint64(63)
        return out

    def _close(self, d: np.ndarray) -> np.ndarray:
        return d | self._shift(d & self.before)

    def matches(self, texts: Sequence[bytes]) -> np.ndarray:
        """texts x globs: whether the whole text fits the glob."""
        lengths = np.array([len(t) for t in texts], np.int64)
        order = np.argsort(-lengths, kind="stable")
        state = np.tile(self._close(self.begin[None, :]), (len(texts), 1))
        flat = np.frombuffer(b"".join(texts), np.uint8)
        offset = np.concatenate([[0], np.cumsum(lengths)])[:-1] if len(texts) else lengths
        live, at = order, 0
        while True:
            live = live[: np.searchsorted(-lengths[live], -at, side="left")]  # those that are longer than at
            if not len(live):
                break
            c = flat[offset[live] + at]
            d = state[live]
            state[live] = self._close(self._shift(d) & self.fits[c] | d & self.stays[c])
            at += 1
        return np.stack([state[:, w] & bit != 0 for w, bit in self.accepts], axis=1) if self.accepts else np.zeros((len(texts), 0), bool)


def literal(text: str) -> str:
    """A glob that only this text fits."""
    return "".join(f"\\{c}" if c in "?*\\" else c for c in text)


_automata: dict[tuple[str, ...], GlobAutomaton] = {}


def automaton(globs: tuple[str, ...]) -> GlobAutomaton:
    """Built once a worker."""
    if globs not in _automata:
        _automata.clear()
        _automata[globs] = GlobAutomaton(globs)
    return _automata[globs]


def host_of(url: Column) -> Column:
    """What stands between the first :// and the next /, ? or # or the end, with A-Z lower-cased; empty if there is no ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """From the end of the host to the next ? or # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]], url_col: str = "url", otherwise: str = "allow") -> DataFrame:
    """The columns of pages, followed by host, path, rule and verdict.

    rules: (verdict, host, path prefix). A rule fits its host and all subdomains; of several that fit, the longest (host
    and path together) decides, and of equally long ones the first. Without a fitting rule, rule is null and the verdict is
    `otherwise`. Hosts and paths of rules stand for themselves, * and ? in them too. A null or malformed URL has an empty host and path, which no rule fits. Columns of pages that already
    have one of the four names give way to the new ones. Repeated rows are judged each for itself, a very long URL in as many
    steps as it has bytes; an empty table gives no rows.
    """
    prepare(pages.sparkSession)
    ranked = sorted(rules, key=lambda r: -len(r[1] + r[2]))
    globs = tuple(f"*.{literal(host + path)}**" for _, host, path in ranked)

    @F.pandas_udf("int")
    def first_fit(canonical: pd.Series) -> pd.Series:
        found = automaton(globs).matches([c.encode() for c in canonical])
        return pd.Series(np.where(found.any(axis=1), found.argmax(axis=1), -1) if globs else np.full(len(canonical), -1))

    out = pages.withColumn("host", host_of(F.col(url_col))).withColumn("path", path_of(F.col(url_col)))
    out = out.withColumn("__fit", first_fit(F.concat(F.lit("."), "host", "path")))
    pick = lambda values, default: F.coalesce(*[F.when(F.col("__fit") == i, F.lit(v)) for i, v in enumerate(values)], default) if values else default
    out = out.withColumn("rule", pick([h + p for _, h, p in ranked], F.lit(None).cast("string")))
    return out.withColumn("verdict", pick([v for v, _, _ in ranked], F.lit(otherwise))).drop("__fit")
