"""Benchmark decontamination over a distributed positional inverted index.

Index segments hold, for all words of a block of documents, the ascending positions of each term; they are written as a
table and can serve any number of test sets. A test set is cut into windows of words. In each segment, a window starts
from its rarest term, by counts over the whole index, so windows whose rarest term the segment does not have are not looked
at. The term's positions, less its offset in the window, are candidate starts, which the offset-adjusted lists of the other
terms, rarest first, narrow down, for all windows at once. Proximity queries take the shortest spans that hold all terms.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, arrow_schema, id_and_text, numbered, prepare, record, trimmed

#: A-Z are lower-cased before; then all ASCII but digits and letters ends a word.
_BREAKS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_INDEX = "segment long, doc_ids array<long>, sizes array<int>, terms binary, counts array<int>, positions binary"
_INDEX_ARROW = pa.schema([("segment", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("terms", pa.binary()), ("counts", pa.list_(pa.int32())), ("positions", pa.binary())])
#: Matches: first word and word after the last, of merged runs; items as text.
_FOUND = "segment long, place int, doc_id long, n_words long, starts array<int>, ends array<int>, items array<string>"
_FOUND_ARROW = pa.schema([("segment", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])
#: Bytes of test text that are looked up at once; a larger test set is run in blocks of this size. A window of ten words
#: takes some 60 bytes, and there is about one for each six bytes of text, so a broadcast has at most some 25 MB.
BLOCK_BYTES = 2 << 20
#: Candidate starts that are narrowed down together.
_CANDIDATES = 1 << 21


def words(text: str) -> list[bytes]:
    return text.encode().lower().translate(_BREAKS).split()


def _segments(block_words: int):
    """Index segments of about block_words words."""

    def close(segment, ids, sizes, parts, codes):
        which = np.concatenate([np.zeros(0, np.int32), *parts])
        at = np.argsort(which, kind="stable").astype(np.uint32)
        columns = ([segment], [ids], [sizes], [b" ".join(codes)], [np.bincount(which, minlength=len(codes))], [at.tobytes()])
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(columns, _INDEX_ARROW)], schema=_INDEX_ARROW)

    def fresh():
        codes: defaultdict[bytes, int] = defaultdict()
        codes.default_factory = codes.__len__  # a new word gets the next number
        return [], [], [], codes, 0

    @trimmed
    def build(batches):
        from pyspark import TaskContext

        segment, (ids, sizes, parts, codes, total) = TaskContext.get().partitionId() << 20, fresh()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ws = words(text)
                parts.append(np.fromiter(map(codes.__getitem__, ws), np.int32, len(ws)))
                ids.append(doc_id)
                sizes.append(len(ws))
                total += len(ws)
                if total >= block_words:
                    yield close(segment, ids, sizes, parts, codes)
                    segment, (ids, sizes, parts, codes, total) = segment + 1, fresh()
        if ids:
            yield close(segment, ids, sizes, parts, codes)

    return build


def build_index(docs: DataFrame, ws: Workspace, id_col: str = "doc_id", text_col: str = "text", block_words: int = 500_000) -> DataFrame:
    """The index as a table of segments. A document lies in one segment, so a very long one makes a large segment."""
    prepare(docs.sparkSession)
    return ws.write(id_and_text(docs, id_col, text_col).mapInArrow(_segments(block_words), _INDEX), "postings")


def term_counts(index: DataFrame, terms: set[bytes]) -> dict[bytes, int]:
    """Occurrences in the whole index, of the given terms only."""
    wanted = index.sparkSession.sparkContext.broadcast(terms)

    @trimmed
    def count(batches):
        schema = arrow_schema("term binary, n long")
        for batch in batches:
            found = [(t, n) for names, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for t, n in zip(names.split(b" "), counts) if t in wanted.value]
            yield record(schema, len(found), term=[t for t, _ in found], n=[n for _, n in found])

    rows = index.select("terms", "counts").mapInArrow(count, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    return {bytes(t): int(n) for t, n in zip(rows["term"], rows["n"])}


@dataclass
class Sought:
    """Windows as rows of term numbers, rarest term first, each with its offset; -1 fills up short ones. Windows go by their rarest term."""

    terms: list[bytes]
    width: np.ndarray
    order: np.ndarray
    offset: np.ndarray
    names: list[str]
    item: np.ndarray
    first_item: np.ndarray

    def __post_init__(self):
        self.number = None

    def numbers(self) -> dict[bytes, int]:
        if self.number is None:
            self.number = {t: i for i, t in enumerate(self.terms)}
        return self.number

    def of_terms(self, present: np.ndarray) -> np.ndarray:
        """The windows whose rarest term is among those (sorted numbers)."""
        first = self.order[:, 0]
        low, high = np.searchsorted(first, present), np.searchsorted(first, present, side="right")
        n = high - low
        return np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(present) else np.zeros(0, np.int64)

    def words_of(self, w: int) -> list[bytes]:
        return [self.terms[t] for t in self.order[w, : self.width[w]]]


def sought(items: Iterable[tuple[str, str]], size: int, counts) -> Sought:
    """The windows of `size` words of all items whose terms the index has; an item of fewer words, but not none, is one window.

    counts: from a set of terms to their occurrences in the index.
    """
    split = [(name, words(text or "")) for name, text in items]
    count = counts({w for _, ws in split for w in ws})
    terms = sorted(count, key=lambda t: (count[t], t))
    number = {t: i for i, t in enumerate(terms)}
    names = sorted({name for name, _ in split})
    place = {name: i for i, name in enumerate(names)}
    rows, owners = [np.zeros((0, size), np.int32)], [np.zeros(0, np.int32)]
    for name, ws in split:
        if ws:
            codes = np.array([number.get(w, -2) for w in ws] + [-1] * (size - len(ws)), np.int32)
            rows.append(np.lib.stride_tricks.sliding_window_view(codes, size))
            owners.append(np.full(len(rows[-1]), place[name], np.int32))
    table, owner = np.concatenate(rows), np.concatenate(owners)
    known = (table != -2).all(axis=1)
    table, which = np.unique(table[known], axis=0, return_inverse=True)
    pairs = np.unique(np.stack([which.ravel(), owner[known]], axis=1), axis=0)
    # Terms are numbered from the rarest, so a row's order is that of its numbers, with the fill last.
    rank = np.where(table < 0, np.iinfo(np.int32).max, table)
    offset = np.argsort(rank, axis=1, kind="stable")
    order = np.take_along_axis(table, offset, axis=1)
    by_rarest = np.argsort(order[:, 0], kind="stable") if len(order) else np.zeros(0, np.int64)
    place_of = np.empty(len(by_rarest), np.int64)
    place_of[by_rarest] = np.arange(len(by_rarest))
    owned = place_of[pairs[:, 0]]
    by_window = np.argsort(owned, kind="stable")
    first_item = np.searchsorted(owned[by_window], np.arange(len(by_rarest) + 1))
    return Sought(terms, (table >= 0).sum(axis=1)[by_rarest], order[by_rarest], offset[by_rarest], names, pairs[by_window, 1], first_item)


class Segment:
    """One segment of the index, open for queries."""

    def __init__(self, sizes, terms: bytes, counts, positions: bytes):
        self.bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.counts = np.asarray(counts, np.int64)
        self.ends = np.cumsum(self.counts)
        self.positions = np.frombuffer(positions, np.uint32).astype(np.int64)
        self.terms = terms.split(b" ") if len(self.counts) else []
        self.length = int(self.bounds[-1]) + 1
        # All postings as one sorted list of (term, position).
        self.postings = np.repeat(np.arange(len(self.counts)), self.counts) * self.length + self.positions

    def known(self, q: Sought) -> np.ndarray:
        """For each of the query's terms, its place in this segment, or -1."""
        number, here = q.numbers(), np.full(len(q.terms) + 1, -1, np.int64)  # the last is that of the fill
        for i, t in enumerate(self.terms):
            if (at := number.get(t)) is not None:
                here[at] = i
        return here

    def phrases(self, q: Sought) -> tuple[np.ndarray, np.ndarray]:
        """(window, first position) of all occurrences within one document."""
        here = self.known(q)
        live = q.of_terms(np.flatnonzero(here >= 0))
        live = live[((here[q.order[live]] >= 0) | (q.order[live] < 0)).all(axis=1)]
        rarest = here[q.order[live, 0]]
        upto = np.cumsum(self.counts[rarest])
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        low = 0
        while low < len(live):
            high = max(low + 1, int(np.searchsorted(upto, (upto[low - 1] if low else 0) + _CANDIDATES)))
            w, t = live[low:high], rarest[low:high]
            n = self.counts[t]
            window = np.repeat(w, n)
            at = np.repeat(self.ends[t] - n - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
            start = self.positions[at] - q.offset[window, 0]
            window, start = window[start >= 0], start[start >= 0]
            for j in range(1, q.order.shape[1]):
                term, to = q.order[window, j], start + q.offset[window, j]
                want = here[term] * self.length + to
                place = np.minimum(np.searchsorted(self.postings, want), len(self.postings) - 1)
                ok = (term < 0) | ((self.postings[place] == want) & (to < self.length))
                window, start = window[ok], start[ok]
            inside = self.place(start) == self.place(start + q.width[window] - 1)
            found.append((window[inside], start[inside]))
            low = high
        return tuple(np.concatenate(x) for x in zip(*found))

    def near(self, terms: Iterable[bytes], within: int) -> list[tuple[int, int]]:
        """The shortest spans (first word, after the last) of at most `within` words in one document that hold every term as often as it is given: spans none of whose parts do."""
        need, place, out = Counter(terms), {t: i for i, t in enumerate(self.terms)}, []
        if not need or any(t not in place for t in need):
            return out
        lists = [(self.positions[self.ends[i] - self.counts[i] : self.ends[i]], n) for i, n in ((place[t], n) for t, n in need.items())]
        rarest = min(lists, key=lambda x: len(x[0]))[0]
        for doc in np.unique(self.place(rarest)).tolist():
            at = [x[slice(*np.searchsorted(x, self.bounds[doc : doc + 2]))] for x, _ in lists]
            if any(len(x) < n for x, (_, n) in zip(at, lists)):
                continue
            events = sorted((p, k) for k, x in enumerate(at) for p in x.tolist())
            missing, left = [n for _, n in lists], 0
            for p, k in events:
                missing[k] -= 1
                best = None
                while max(missing) <= 0:
                    first, gone = events[left]
                    best, left = first, left + 1
                    missing[gone] += 1
                if best is not None and p - best < within:
                    out.append((best, p + 1))
        return out

    def place(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bounds, positions, side="right") - 1


def _search(queries, within: int | None):
    """Looks the windows of a block up in each segment."""

    @trimmed
    def look(batches):
        q = queries.value
        for batch in batches:
            for segment, ids, sizes, terms, counts, positions in zip(*(c.to_pylist() for c in batch.columns)):
                s = Segment(sizes, terms, counts, positions)
                if within is None:
                    window, first = s.phrases(q)
                    after = first + q.width[window]
                else:
                    here = s.known(q)
                    spans = [(w, *span) for w in q.of_terms(np.flatnonzero(here >= 0)).tolist() for span in s.near(q.words_of(w), within)]
                    window, first, after = np.array(spans, np.int64).reshape(-1, 3).T
                covered = np.cumsum(np.bincount(first, minlength=s.length) - np.bincount(after, minlength=s.length))[:-1] > 0
                n_items = q.first_item[window + 1] - q.first_item[window]
                doc = np.repeat(s.place(first), n_items)
                item = q.item[np.repeat(q.first_item[window] - np.concatenate([[0], np.cumsum(n_items)[:-1]]).astype(np.int64)[: len(n_items)], n_items) + np.arange(n_items.sum())]
                of: list[list[str]] = [[] for _ in ids]
                for pair in np.unique(doc * max(1, len(q.names)) + item).tolist():
                    of[pair // len(q.names)].append(q.names[pair % len(q.names)])
                starts, ends = [[] for _ in ids], [[] for _ in ids]
                for i in np.unique(s.place(first)).tolist():
                    edge = np.diff(np.concatenate([[0], covered[s.bounds[i] : s.bounds[i + 1]].astype(np.int8), [0]]))
                    starts[i], ends[i] = np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()
                n = len(ids)
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(([segment] * n, range(n), ids, sizes, starts, ends, of), _FOUND_ARROW)], schema=_FOUND_ARROW)

    return look


def _items(tests: DataFrame, item_col: str, text_col: str) -> DataFrame:
    return tests.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def _number_of_blocks(tests: DataFrame, item_col: str, text_col: str, block_bytes: int) -> int:
    """How many blocks it takes to bring no more than about block_bytes of test text to the driver at once."""
    total = _items(tests, item_col, text_col).agg(F.coalesce(F.sum(F.octet_length("text") + F.octet_length("item")), F.lit(0))).first()[0]
    return max(1, -(-int(total) // block_bytes))


def _block(tests: DataFrame, item_col: str, text_col: str, i: int, n: int) -> list[tuple[str, str]]:
    rows = _items(tests, item_col, text_col)
    part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i)
    pdf = part.toPandas()
    return [*zip(pdf["item"].tolist(), pdf["text"].tolist())]


def find_test_text(docs: DataFrame, tests: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 10, within: int | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, starts, ends, items.

    starts and ends delimit the merged runs of words that lie in an occurrence of a window; items are the ids, as text and
    sorted, whose windows occur. With `within`, a window's words may stand in any order inside that many words instead, each as often as the window has it.
    Null texts have no words, a null item id is the empty text. Items with equal windows all count. Documents without
    matches, and all documents if there are no test items, get empty lists. Repeated rows are matched each for itself; other
    columns are not read. Empty tables of documents give no rows. Test sets over block_bytes are run block by block against
    the same stored index.
    """
    spark = prepare(docs.sparkSession)
    ws = Workspace(spark, "postings")
    n_blocks = _number_of_blocks(tests, item_col, item_text_col, block_bytes)
    found, index = [], build_index(docs, ws, id_col, text_col)
    for i in range(n_blocks):  # a block's windows leave the driver before the next one's come
        queries = spark.sparkContext.broadcast(sought(_block(tests, item_col, item_text_col, i, n_blocks), window, lambda terms: term_counts(index, terms)))
        found.append(index.mapInArrow(_search(queries, within), _FOUND))
        if n_blocks > 1:
            found[i] = ws.write(found[i], f"found-{i}")
            queries.unpersist()
    if len(found) == 1:
        out = found[0]
    else:
        every = found[0]
        for f in found[1:]:
            every = every.unionByName(f)
        out = every.groupBy("segment", "place").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))).alias("runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        empty = F.array().cast("array<struct<starts:int,ends:int>>")

        def join(done, run):
            last = F.element_at(done, -1)
            longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["starts"].alias("starts"), F.greatest(last["ends"], run["ends"]).alias("ends"))))
            return F.when((F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["ends"] >= run["starts"]), longer).otherwise(F.concat(done, F.array(run)))

        merged = F.aggregate(F.array_sort("runs"), empty, join)
        out = out.withColumn("runs", merged).select("doc_id", "n_words", F.col("runs.starts").alias("starts"), F.col("runs.ends").alias("ends"), "items")
    n_hit = F.aggregate(F.zip_with("ends", "starts", lambda e, s: (e - s).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    return out.select("doc_id", "n_words", n_hit.alias("n_hit"), "starts", "ends", "items")


def drop_contaminated(docs: DataFrame, tests: DataFrame, **options) -> DataFrame:
    """The rows of docs in which no test window occurs, with their columns.

    Rows are told apart by a number of their own, so rows without an identifier or with a shared one are judged each by its
    text. Null texts stay. An empty table, or one without tests, stays as it is.
    """
    docs, row = numbered(docs, Workspace(prepare(docs.sparkSession), "contaminated"))
    found = find_test_text(docs, tests, id_col=row, **options).where("n_hit > 0").select(F.col("doc_id").alias(row))
    return docs.join(found, row, "left_anti").drop(row)
