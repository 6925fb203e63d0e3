"""Removal of long repeated passages with a logarithmic family of sparse suffix arrays.

A passage counts as repeated if its 200 bytes also start anywhere else. Not all suffixes are entered. Each window of 200
bytes chooses an anchor, the 100-byte gram with the smallest fingerprint in it (of several, the first), so equal windows
choose the same one, whatever stands around them; successive windows with one anchor form a stretch. A batch is a run of
documents. Its suffix array holds the suffixes that start at its stretches, in the order of their letters as far as the
stretch's last window goes, so equal stretches are neighbours. Grams and stretches are entered first:

* a stretch that stands twice is repeated throughout;
* a stretch whose gram stands only once is not repeated at all;
* of the others, and of one copy of each stretch that shares their gram, every window is entered.

A batch sends its entries, one for each distinct value, to the families of the shards. There they are ordered by digest,
since equality is all that is asked of entries of different batches and digests deal them evenly. A new array is
merge-scanned against each existing level: entries that a level has are long matches and count for it, the rest become a
level of their own, and levels that are no larger merge with it, so that sizes grow geometrically. Answers go back to the
batch, not to documents, so a passage that a third of all documents hold costs a family one entry a batch.

Within a batch the bytes of stretches are compared; between batches, and for single windows, 128-bit digests of the bytes
under a seed drawn anew for each job, so that no text can be made to collide. Fingerprints only choose anchors and, for
grams, rule stretches out: where those of different grams agree, windows are entered in vain.
"""

from __future__ import annotations

import secrets

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, arrow_schema, mixed, pack_runs, prepare, record, trim, trimmed, unpack

WINDOW = 200
GRAM = 100
#: Window starts that are looked at together: fingerprints take some 60 bytes for each, whatever the length of a text.
PIECE = 1 << 20
_TABLE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTOR = 0xD1342543DE82EF95
_powers: list[np.ndarray] = []


def _powers_to(n: int) -> list[np.ndarray]:
    """f^0..f^n and f^0..f^-n modulo 2^64."""
    if not _powers or len(_powers[0]) <= n:
        size, out = 1 << max(16, n.bit_length()), []
        for step in (_FACTOR, pow(_FACTOR, -1, 1 << 64)):
            p = np.ones(1, np.uint64)
            while len(p) < size:
                p = np.concatenate([p, p * np.uint64(step)])
                step = step * step % (1 << 64)
            out.append(p)
        _powers[:] = out
    return _powers


def gram_prints(text: np.ndarray) -> np.ndarray:
    """Fingerprints of all grams of a text, from one running sum."""
    powers, inverse = _powers_to(len(text))
    s = np.zeros(len(text) + 1, np.uint64)
    np.cumsum(_TABLE[text] * powers[: len(text)], out=s[1:])
    return mixed((s[GRAM:] - s[:-GRAM]) * inverse[: len(text) - GRAM + 1])


def stretches(text: bytes, piece: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each maximal row of window starts with one anchor: the first start, their number, and the anchor's gram."""
    flat, at, grams, span, low32 = np.frombuffer(text, np.uint8), [], [], WINDOW - GRAM + 1, np.uint64(0xFFFFFFFF)
    first, number = [np.zeros(0, np.int64)], 0
    for begin in range(0, len(text) - WINDOW + 1, piece):
        g = gram_prints(flat[begin : begin + piece + WINDOW - 1])
        m, width = (g & ~low32) | np.arange(len(g), dtype=np.uint64), 1  # always 32 bits of the print, then the place
        while 2 * width <= span:
            m = np.minimum(m[:-width], m[width:])
            width *= 2
        m = np.minimum(m[: len(m) - (span - width)], m[span - width :])
        anchors = (m & low32).astype(np.int64)
        new = np.flatnonzero(np.diff(anchors, prepend=at[-1][-1] - begin if at else -1))
        first.append(new + begin)
        at.append(anchors + begin)
        grams.append(g[anchors[new]])
        number += len(anchors)
        at[:-1] = [a[-1:] for a in at[:-1]]
    first = np.concatenate(first)
    return first, np.diff(first, append=number), np.concatenate([np.zeros(0, np.uint64), *grams])


class Family:
    """Levels of sorted digests. Each digest stands in one level, with a number by which its total and first batch are kept."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.totals, self.first, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int64), 0

    def insert(self, high: np.ndarray, low: np.ndarray, count: np.ndarray, batch: int) -> np.ndarray:
        """The numbers of a batch's sorted digests: of those that the scan finds in a level, the one they have there."""
        number = np.full(len(high), -1, np.int64)
        for level in self.levels:
            fresh = np.flatnonzero(number < 0)
            at, found = self.scan(level, high[fresh], low[fresh])
            number[fresh[found]] = level[2][at[found]]
        self.totals[number[number >= 0]] += count[number >= 0]
        fresh = np.flatnonzero(number < 0)
        upto = self.size + len(fresh)
        if upto > len(self.totals):
            more = np.zeros(2 * upto - len(self.totals), np.int64)
            self.totals, self.first = np.concatenate([self.totals, more]), np.concatenate([self.first, more])
        number[fresh] = np.arange(self.size, upto)
        self.totals[self.size : upto], self.first[self.size : upto] = count[fresh], batch
        self.size = upto
        new = (high[fresh], low[fresh], number[fresh])
        while self.levels and len(self.levels[-1][0]) <= len(new[0]):
            new = self.merge(self.levels.pop(), new)
        if len(new[0]):
            self.levels.append(new)
        return number

    @staticmethod
    def scan(level, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in a level each digest stands, and whether it does."""
        at, last = np.searchsorted(level[0], high), len(level[0]) - 1
        while True:  # digests that share their first 64 bits stand one after the other
            here = np.minimum(at, last)
            on = (at <= last) & (level[0][here] == high) & (level[1][here] < low)
            if not on.any():
                return here, (at <= last) & (level[0][here] == high) & (level[1][here] == low)
            at = at + on

    @staticmethod
    def merge(a, b) -> tuple[np.ndarray, ...]:
        high, low, number = (np.concatenate([x, y]) for x, y in zip(a, b))
        order = np.lexsort((low, high))
        return high[order], low[order], number[order]


def _distinct(high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct values, how often each stands, where it stands first, and which of them each given one is."""
    order = np.lexsort((low, high))
    h, w = high[order], low[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (w[1:] != w[:-1])])) if len(h) else np.zeros(0, np.int64)
    which = np.zeros(len(high), np.int64)
    if len(high):
        which[order] = np.repeat(np.arange(len(first)), np.diff(first, append=len(h)))
    return h[first], w[first], np.diff(first, append=len(h)), order[first], which


def digests(strings, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The halves of the digests of byte strings."""
    digest = xxhash.xxh3_128_digest
    flat = np.frombuffer(b"".join([digest(x, seed) for x in strings]), "<u8").reshape(-1, 2)
    return np.ascontiguousarray(flat[:, 0]), np.ascontiguousarray(flat[:, 1])


def _steps(keys: np.ndarray) -> bytes:
    """Sorted 64-bit integers as differences, byte by byte: the near-constant high bytes stand together."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unstepped(blob: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(8, -1).T).view(np.uint64).ravel())


_SLICE = "run long, shard int, kind int, high binary, low binary, many binary, counts binary"
_ANSWER = "run long, shard int, kind int, bits binary, totals binary, first binary"


def _cut(run: int, kind: int, bits: int, high: np.ndarray, low: np.ndarray, count: np.ndarray) -> list[tuple]:
    """The slices of one sorted array: one per shard that it has entries for. Grams have no low half."""
    edges = np.searchsorted(high, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)).tolist()
    out = []
    for shard, (a, b) in enumerate(zip([0, *edges], [*edges, len(high)])):
        if b > a:
            many = np.flatnonzero(count[a:b] > 1).astype(np.uint32)
            out.append((run, shard, kind, _steps(high[a:b]), low[a:b].tobytes() if kind else b"", many.tobytes(), count[a:b][many].astype(np.uint32).tobytes()))
    return out


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    return record(schema, len(rows), **{f.name: [r[i] for r in rows] for i, f in enumerate(schema)})


class Batch:
    """The stretches of one run: its suffix array, and grams and stretches as sorted arrays of distinct values."""

    def __init__(self, sizes, texts, seed: int):
        self.texts, self.seed = unpack(sizes, texts), seed
        doc, start, n, gram = [], [], [], [np.zeros(0, np.uint64)]
        for i, text in enumerate(self.texts):
            if len(text) >= WINDOW:
                first, number, g = stretches(text)
                doc.append(np.full(len(first), i))
                start.append(first)
                n.append(number)
                gram.append(g)
        self.doc, self.start, self.n = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (doc, start, n))
        # Anchors are the smallest grams of their windows, so they are spread anew before they are dealt by their leading bits.
        gram = mixed(np.concatenate(gram)) >> np.uint64(16) << np.uint64(16)
        self.gram, _, self.gram_count, _, self.gram_of = _distinct(gram, np.zeros(len(gram), np.uint64))

        all_texts = self.texts
        suffixes = [all_texts[d][a:z] for d, a, z in zip(self.doc.tolist(), self.start.tolist(), (self.start + self.n + WINDOW - 1).tolist())]
        array = sorted(range(len(suffixes)), key=suffixes.__getitem__)
        new = [i for i, (x, y) in enumerate(zip(array, [None, *array])) if y is None or suffixes[x] != suffixes[y]]
        at = np.array(array, np.int64)[new] if new else np.zeros(0, np.int64)  # of equal neighbours, the first in the run
        high, low = digests([suffixes[i] for i in at.tolist()], seed)
        order = np.lexsort((low, high))
        self.high, self.low, self.at, self.count = high[order], low[order], at[order], np.diff(new, append=len(array))[order]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        self.stretch_of = np.zeros(len(array), np.int64)
        self.stretch_of[array] = np.repeat(back, np.diff(new, append=len(array)))

    def windows(self, chosen: np.ndarray) -> tuple[np.ndarray, ...]:
        """Digests, documents and starts of all windows of the chosen stretches."""
        n = self.n[chosen]
        which = np.repeat(chosen, n)
        start = self.start[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        doc, texts = self.doc[which], self.texts
        return *digests((texts[d][s : s + WINDOW] for d, s in zip(doc.tolist(), start.tolist())), self.seed), doc, start

    def judged(self, bits: int, answers) -> tuple[np.ndarray, np.ndarray]:
        """Which stretches are repeated throughout, and of which every window is entered."""
        gram, _ = _told(bits, answers, 0, self.gram)
        total, first = _told(bits, answers, 1, self.high)
        g, t = gram[self.gram_of], total[self.stretch_of]
        shown = np.zeros(len(t), bool)
        shown[self.at] = first  # one copy, in one run
        return t > 1, np.flatnonzero((g > 1) & ((t <= 1) | (t < g) & shown))


def _told(bits: int, answers, kind: int, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The totals of a sorted array's entries (1 if alone) and whether this run held each first."""
    total, first = np.ones(len(high), np.int64), np.zeros(len(high), bool)
    for a in answers or ():
        if a["kind"] == kind:
            low, upto = (int(np.searchsorted(high, np.uint64(x << 64 - bits))) if x >> bits == 0 else len(high) for x in (a["shard"], a["shard"] + 1))
            flags = np.unpackbits(np.frombuffer(a["bits"], np.uint8))[: upto - low].astype(bool)
            total[low:upto][flags] = np.frombuffer(a["totals"], np.uint32)
            first[low:upto][flags] = np.unpackbits(np.frombuffer(a["first"], np.uint8))[: int(flags.sum())].astype(bool)
    return total, first


def _grams_and_stretches(bits: int, seed: int):
    schema = arrow_schema(_SLICE)

    @trimmed
    def enter(batches):
        for batch in batches:
            for run, sizes, texts in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                b = Batch(sizes, texts, seed)
                rows = _cut(run, 0, bits, b.gram, b.gram, b.gram_count) + _cut(run, 1, bits, b.high, b.low, b.count)
                if rows:
                    yield _rows(schema, rows)
                del b, rows
                trim()

    return enter


def _windows(bits: int, seed: int):
    schema = arrow_schema(_SLICE)

    @trimmed
    def enter(batches):
        for batch in batches:
            for run, sizes, texts, answers in zip(*(batch.column(i).to_pylist() for i in range(4))):
                b = Batch(sizes, texts, seed)
                high, low, _, _ = b.windows(b.judged(bits, answers)[1])
                high, low, count, _, _ = _distinct(high, low)
                if len(high):
                    yield _rows(schema, _cut(run, 2, bits, high, low, count))
                del b, high, low, count
                trim()

    return enter


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """Enters the slices of a shard batch by batch; tells each how often its entries stand in all."""
    out = []
    for kind, part in pdf.sort_values("run").groupby("kind"):
        family, slices = Family(), []
        for run, high, low, many, counts in zip(part["run"], part["high"], part["low"], part["many"], part["counts"]):
            high = _unstepped(high)
            low = np.frombuffer(low, np.uint64) if kind else np.zeros(len(high), np.uint64)
            count = np.ones(len(high), np.int64)
            count[np.frombuffer(many, np.uint32)] = np.frombuffer(counts, np.uint32)
            slices.append((run, family.insert(high, low, count, run)))
        for run, number in slices:
            total = family.totals[number]
            again = total > 1
            out.append((run, part["shard"].iloc[0], kind, np.packbits(again).tobytes(), np.minimum(total[again], 2**32 - 1).astype(np.uint32).tobytes(), np.packbits(family.first[number][again] == run).tobytes()))
        del family, slices
    trim()
    return pd.DataFrame(out, columns=[c.split()[0] for c in _ANSWER.split(",")])


_KEPT = "doc_id long, n_bytes long, starts array<int>, ends array<int>, kept binary"
_KEPT_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("kept", pa.binary())])


def _cut_out(bits: int, seed: int):
    @trimmed
    def cut(batches):
        for batch in batches:
            for _, sizes, texts, answers, ids in zip(*(batch.column(i).to_pylist() for i in range(5))):
                b = Batch(sizes, texts, seed)
                throughout, entered = b.judged(bits, answers)
                high, low, doc, start = b.windows(entered)
                high, _, _, _, which = _distinct(high, low)
                again = (_told(bits, answers, 2, high)[0] > 1)[which] if len(which) else np.zeros(0, bool)
                # Runs of repeated window starts as (document, first, number), whole stretches and single windows alike.
                docs = np.concatenate([b.doc[throughout], doc[again]])
                first = np.concatenate([b.start[throughout], start[again]])
                n = np.concatenate([b.n[throughout], np.ones(int(again.sum()), np.int64)])
                order = np.argsort(docs, kind="stable")
                docs, first, n = docs[order], first[order], n[order]
                edges = np.searchsorted(docs, np.arange(len(b.texts) + 1))
                rows = []
                for i, (doc_id, text) in enumerate(zip(ids, b.texts)):
                    x, y = edges[i], edges[i + 1]
                    starts = ends = np.zeros(0, np.int64)
                    if y > x:
                        cover = np.zeros(len(text) + 1, np.int64)
                        np.add.at(cover, first[x:y], 1)
                        np.add.at(cover, first[x:y] + n[x:y] - 1 + WINDOW, -1)
                        gone = np.cumsum(cover)[:-1] > 0
                        edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
                        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
                        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                    else:
                        kept = text
                    rows.append((doc_id, len(text), starts.tolist(), ends.tolist(), kept))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _KEPT_ARROW)], schema=_KEPT_ARROW)
                del b, rows
                trim()

    return cut


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_bytes: int = 4 << 20) -> DataFrame:
    """One row per input row: doc_id, n_bytes, starts, ends, kept.

    Texts are UTF-8 bytes, null is empty. Each byte that lies in a 200-byte string which also starts anywhere else, in this
    row or another, is removed; starts and ends delimit the maximal removed runs, kept is what remains (which may end within
    a character). All is judged on the input: of copies, none stays. Shorter texts stay whole. Repeated rows and rows
    without an id are rows like any other. An empty table gives no rows; other columns are not read. A very long text is a run
    of its own, held whole; fingerprints are made piece by piece. Each run sends a slice to each shard, so on large clusters
    run_bytes should grow with the number of shards (a worker holds some 20 bytes for each of a run's).
    """
    spark = prepare(docs.sparkSession)
    ws = Workspace(spark, "suffix")
    bits = max(1, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    packed, seed = pack_runs(docs, ws, id_col, text_col, run_bytes=run_bytes), secrets.randbits(64)
    answer = lambda slices, name: ws.write(slices.groupBy("shard").applyInPandas(_answer, _ANSWER), name)
    told = lambda answers: packed.join(answers.groupBy("run").agg(F.collect_list(F.struct("shard", "kind", "bits", "totals", "first")).alias("answers")), "run", "left")
    stretches_ = answer(packed.mapInArrow(_grams_and_stretches(bits, seed), _SLICE), "stretches")
    ws.drop()
    windows_ = answer(told(stretches_).select("run", "sizes", "texts", "answers").mapInArrow(_windows(bits, seed), _SLICE), "windows")
    ws.drop()
    return told(stretches_.unionByName(windows_)).select("run", "sizes", "texts", "answers", "doc_ids").mapInArrow(_cut_out(bits, seed), _KEPT)
