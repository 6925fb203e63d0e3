"""Secret scans: fixed patterns, and a randomness test battery over token-like strings.

A candidate is a run of the characters secrets are written in, with = only as padding at its end. From its characters an
encoding is inferred (digits, hex, base32, base64), and three tests ask whether it looks drawn evenly from that alphabet:
chi-squared uniformity, runs above and below the middle, and serial correlation. Their p-values are combined by Fisher's
method into one value, which is high for random strings and tiny for others. How high other strings of an encoding get is
measured on all documents: their text outside candidates, written in the encoding's alphabet, gives for each length class
a stretch that is put through the same battery. The share of an encoding's stretches of a length that reach a candidate's
value is the candidate's p-value. Benjamini and Hochberg's step-up over all candidates, with weights that favour lengths
where the tests have power, bounds the share of false discoveries.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, id_and_text, prepare, record, trimmed

#: The patterns of the known kinds, in the order in which kinds are listed.
KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
# = only pads: between a name and a value it parts them. A run of 20 may count its padding.
_PADDING = r"=+(?![A-Za-z0-9+/_=-])"
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{20,}}(?:{_PADDING})?|(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]{{1,19}}{_PADDING})[A-Za-z0-9+/_=-]{{20,}}")

_ALPHABETS = ("0123456789", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/")
_PLACE = [{c: i for i, c in enumerate(a)} for a in _ALPHABETS]
_PLACE[1] |= {c: 10 + i for i, c in enumerate("ABCDEF")}
_PLACE[3] |= {"-": 62, "_": 63}
#: The codes of bytes in each alphabet (255: not in it), and the bytes that are not.
_CODES = [np.array([p.get(chr(c), 255) for c in range(256)], np.uint8) for p in _PLACE]
_OTHERS = [bytes(np.flatnonzero(c == 255).astype(np.uint8)) for c in _CODES]
#: Simulated strings that give chi-squared its distribution where cells are too thinly filled for the approximation.
_SIMULATED = 4000
#: Lower bounds of the length classes, and how finely values are kept for counting.
LENGTHS = (20, 24, 32, 40, 64, 128, 256)
_BINS = 256
_COUNTS = "reference boolean, encoding int, length int, bin int, n long"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns. Matches that are too short are dropped after matching, so they still use up their text."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def encoding_of(s: str) -> int | None:
    """The smallest alphabet that holds all characters but = at the end; mixed-case hex is not hex."""
    chars = set(s.rstrip("="))
    for i, place in enumerate(_PLACE):
        if chars and chars <= place.keys() and not (i == 1 and chars & set("ABCDEF") and chars & set("abcdef")):
            return i
    return None


_erfc = np.vectorize(math.erfc, otypes=[float])


def _upper_tail_chi2(x: np.ndarray, k: float) -> np.ndarray:
    """Wilson and Hilferty's approximation."""
    z = ((x / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    return 0.5 * _erfc(z / math.sqrt(2))


@lru_cache(maxsize=None)
def _simulated(k: int, n: int) -> np.ndarray:
    """The sorted statistic of _SIMULATED even strings."""
    rng = np.random.default_rng((k, n))
    counts = np.zeros((_SIMULATED, k), np.int32)
    for _ in range(n):
        counts[np.arange(_SIMULATED), rng.integers(0, k, _SIMULATED)] += 1
    return np.sort(((counts - n / k) ** 2).sum(axis=1) * k / n)


def uniformity(stat: np.ndarray, k: int, n: int) -> np.ndarray:
    """Two-sided p-values of Pearson's statistic: strings that fill an alphabet more evenly than chance does are not random either.

    By simulation with under five characters a cell, at the next smaller of some lengths; beyond the upper half per cent the
    simulated tail goes on as the approximation's does.
    """
    if n >= 5 * k:
        upper = _upper_tail_chi2(stat, k - 1)
        return 2 * np.minimum(upper, 1 - upper)
    n = n if n < 32 else int(32 * 1.1 ** math.floor(math.log(n / 32, 1.1)))
    even = _simulated(k, n)
    edge = even[-_SIMULATED // 200]
    share = (_SIMULATED - np.searchsorted(even, stat - 1e-9)) / _SIMULATED
    tail = 0.005 * _upper_tail_chi2(stat, k - 1) / _upper_tail_chi2(np.array([edge]), k - 1)
    upper = np.where(stat > edge, np.minimum(tail, 0.005), np.maximum(share, 0.005))
    lower = np.maximum(np.searchsorted(even, stat + 1e-9), 0.5) / _SIMULATED
    return np.minimum(1, 2 * np.minimum(upper, lower))


def battery(v: np.ndarray, k: int) -> np.ndarray:
    """Fisher's combination of the three tests for each row of codes below k: anywhere in 0 to 1 for random rows, near 0 for others."""
    rows, n = v.shape
    v = v.astype(np.int64)
    counts = np.bincount((np.arange(rows)[:, None] * k + v).ravel(), minlength=rows * k).reshape(rows, k)
    uniform = uniformity(((counts - n / k) ** 2).sum(axis=1) * k / n, k, n)
    above = 2 * v > k - 1
    up = above.sum(axis=1)
    expected = 2 * up * (n - up) / n + 1
    spread = np.sqrt(np.maximum(1e-9, (expected - 1) * (expected - 2) / (n - 1)))
    changes = (above[:, 1:] != above[:, :-1]).sum(axis=1)
    runs = np.where((up > 0) & (up < n), _erfc(np.abs(1 + changes - expected) / spread / math.sqrt(2)), 0.5 ** (n - 1))
    x = v - v.mean(axis=1, keepdims=True)
    total = (x * x).sum(axis=1)
    serial = np.where(total > 0, _erfc(np.abs((x[:, 1:] * x[:, :-1]).sum(axis=1)) / np.maximum(total, 1e-9) * math.sqrt(n) / math.sqrt(2)), 0.0)
    h = -sum(np.log(np.maximum(p, 1e-300)) for p in (uniform, runs, serial))
    return np.exp(-h) * (1 + h + h * h / 2)  # upper tail of chi-squared with 6 degrees at 2h


def _class(n: int) -> int:
    return max(i for i, low in enumerate(LENGTHS) if n >= low)


def _bins(values: np.ndarray) -> np.ndarray:
    """Even steps of the logarithm down to 1e-32."""
    return np.maximum(0, _BINS - 1 - (-np.log10(np.maximum(values, 1e-32)) * (_BINS - 1) / 32).astype(np.int64))


def _judged(strings: list[tuple[int, bytes]]) -> np.ndarray:
    """The bins of (encoding, string), those of one encoding and length at once. Strings under 8 characters get the lowest."""
    out, groups = np.zeros(len(strings), np.int64), {}
    for i, (e, s) in enumerate(strings):
        groups.setdefault((e, len(s)), []).append(i)
    for (e, n), at in groups.items():
        step = max(1, (1 << 22) // max(n, 1))  # a matrix of 4 million codes at once
        for low in range(0, len(at) if n >= 8 else 0, step):
            part = at[low : low + step]
            codes = _CODES[e][np.frombuffer(b"".join(strings[i][1] for i in part), np.uint8)].reshape(len(part), n)
            out[part] = _bins(battery(codes, len(_ALPHABETS[e])))
    return out


def candidates(texts: list[str]) -> list[list[tuple[int, int, int, int, int]]]:
    """For each text, (start, end, encoding, length class, bin) of token-like strings with a digit or mixed case."""
    found, strings = [], []
    for i, text in enumerate(texts):
        for m in _CANDIDATE.finditer(text):
            s = m[0]
            if (e := encoding_of(s)) is not None and (any(c.isdigit() for c in s) or not (s.islower() or s.isupper() or s.istitle())):
                found.append((i, m.start(), m.end(), e, _class(len(s))))
                strings.append((e, s.rstrip("=").encode()))
    out: list[list] = [[] for _ in texts]
    for (i, *rest), b in zip(found, _judged(strings).tolist()):
        out[i].append((*rest, b))
    return out


def references(texts: list[str]) -> list[tuple[int, int, int]]:
    """(encoding, length class, bin) of ordinary text in each alphabet, for each length class that a text fills, at a place that follows from the text.

    Outside candidates, words are put together as in names (digits as they stand, hex and base32 in their case, base64 with
    capitals at the beginnings of words, whole and abbreviated), without the characters that an alphabet has not.
    """
    strings, classes = [], []
    for text in texts:
        rest = _CANDIDATE.sub(" ", text)
        titled = rest.title()
        for e, written in ((0, rest), (1, rest.lower()), (2, rest.upper()), (3, titled), (3, "".join([w[:3] for w in titled.split()]))):
            stream = written.encode("ascii", "ignore").translate(None, _OTHERS[e])
            place = zlib.crc32(stream)
            for i, low in enumerate(LENGTHS):
                if len(stream) >= low:
                    at = place % (len(stream) - low + 1)
                    strings.append((e, stream[at : at + low]))
                    classes.append(i)
    return [(e, i, b) for (e, _), i, b in zip(strings, classes, _judged(strings).tolist())]


@trimmed
def _measure(batches):
    """Counts of (reference or candidate, encoding, length class, bin) over a partition: a table of bounded size."""
    counts: Counter = Counter()
    for batch in batches:
        texts = batch.column(0).to_pylist()
        counts.update((False, e, c, b) for found in candidates(texts) for _, _, e, c, b in found)
        counts.update((True, *r) for r in references(texts))
    columns = [*zip(*counts)] or [[], [], [], []]
    yield record(arrow_schema(_COUNTS), len(counts), reference=columns[0], encoding=columns[1], length=columns[2], bin=columns[3], n=[*counts.values()])


def discoveries(counts: pd.DataFrame, rate: float) -> list[list[int]]:
    """For each encoding and length class, the lowest bin that counts as random: weighted Benjamini-Hochberg over all candidates."""
    ref = counts[counts["reference"]].groupby(["encoding", "length", "bin"])["n"].sum()
    cand = counts[~counts["reference"]].groupby(["encoding", "length", "bin"])["n"].sum()
    power = np.array([math.log(low) for low in LENGTHS])
    total = int(cand.sum())
    by_length = np.array([cand[cand.index.get_level_values("length") == i].sum() for i in range(len(LENGTHS))], float)
    weights = power / max(1e-9, (power * by_length).sum() / total) if total else power
    cells = []
    for (e, length, b), n in cand.items():
        null = ref[(ref.index.get_level_values("encoding") == e) & (ref.index.get_level_values("length") == length)] if len(ref) else ref
        at = int(null[null.index.get_level_values("bin") >= b].sum()) if len(null) else 0
        p = (1 + at) / (1 + int(null.sum()) if len(null) else 1)
        cells.append((p / weights[length], e, length, b, int(n)))
    cells.sort()
    seen, cut = 0, -1.0
    for p, *_, n in cells:
        seen += n
        if p <= rate * seen / total:
            cut = p
    lowest = [[_BINS] * len(LENGTHS) for _ in _ALPHABETS]
    for p, e, length, b, _ in cells:
        if p <= cut:
            lowest[e][length] = min(lowest[e][length], b)
    return lowest


def _scan(lowest: list[list[int]]):
    schema = arrow_schema("doc_id long, starts string, spans string")

    @trimmed
    def scan(batches):
        for batch in batches:
            base, every, texts = [], [], batch.column(1).to_pylist()
            for text, found in zip(texts, candidates(texts)):
                known = base_spans(text)
                more = [(s, 3, t) for s, t, e, c, b in found if b >= lowest[e][c] and not any(s < y and x < t for x, _, y in known)]
                base.append(_listed(known))
                every.append(_listed(sorted(known + more)))
            yield record(schema, len(base), doc_id=batch.column(0), starts=base, spans=every)

    return scan


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{t}" for s, k, t in spans)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.01) -> DataFrame:
    """doc_id, base_spans, spans: one row per input row, spans as kind:start:end in code points, end exclusive.

    base_spans holds the fixed patterns; spans adds strings that the battery finds random at false discovery rate `rate`
    and that overlap none of them. Null texts are empty and have no spans. Without any candidate, or where no ordinary text of
    an encoding and length stands anywhere to compare with, nothing is added. Very long texts are scanned whole. An empty
    table gives no rows. Spans go by start, then kind; a row's spans depend on its text and on the counts over all texts, so repeated rows agree. Other
    columns are not read.
    """
    spark = prepare(docs.sparkSession)
    source = id_and_text(docs, id_col, text_col)
    counts = source.select("text").mapInArrow(_measure, _COUNTS).groupBy("reference", "encoding", "length", "bin").agg(F.sum("n").alias("n"))
    lowest = discoveries(counts.toPandas().astype({"reference": bool}), rate)  # at most 2 x 4 x 7 x 256 rows
    return source.mapInArrow(_scan(lowest), "doc_id long, starts string, spans string").withColumnRenamed("starts", "base_spans")
