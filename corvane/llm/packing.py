"""Packing of documents into sequences of a fixed number of tokens, by bin completion over lengths.

Documents become token ids, whose pieces have lengths from 1 to the size of a sequence. How many pieces there are of each
length is all that a packing depends on, so the plan is made from that table, which is no longer than a sequence: it is a list
of fillings, multisets of lengths, each with the number of sequences filled so. Pieces are numbered within their length,
and a piece's number gives the sequence and the place that the plan has for it. No piece passes through the driver.

The plan is sought by branch and bound. The largest length left is to be put into some sequence; those fillings around it
are tried that no other one dominates (if the members of a filling can be put together to fit into the members of another,
the other one is at least as good), the least waste first. A branch ends when its waste is more than a solution with
one sequence fewer than the best known may have. The first solution known is that of best fit on falling lengths.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import byte_letters, read_definition
from .common import Workspace, prepare, trimmed

#: The letters that follow an apostrophe as one word with it.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
LETTER, NUMBER, OTHER, SPACE = range(4)
#: Characters of texts whose words are held at once (a longer text is held alone), and bytes of words that a worker remembers.
AT_ONCE, REMEMBERED = 2 << 20, 48 << 20
#: Branches that a search for a better plan tries at most, and fillings tried around one length.
BRANCHES, FILLINGS = 20_000, 64

_PIECE = "shard long, number long, doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """The class of each code point, as the tokenizers library's pre-split has it: each class as the regex package knows it is put through that split as one string."""
    from tokenizers import pre_tokenizers

    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    table = np.full(0x110000, OTHER, np.uint8)
    for guess in (r"\p{L}+", r"\p{N}+", r"\s+", r"[^\s\p{L}\p{N}]+"):
        members = "".join(regex.findall(guess, every))
        codes = np.frombuffer(members.encode("utf-32-le"), np.uint32)
        for _, (low, high) in split(members):
            joins = [kind for kind, sign in ((LETTER, "a"), (NUMBER, "1"), (OTHER, "!")) if len(split(sign + members[low])) == 1]
            table[codes[low:high]] = joins[0] if joins else SPACE
    return table


def word_starts(codes: np.ndarray, begins: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Where words of the pre-split begin in the code points of some texts, which begin at `begins`."""
    n = len(codes)
    kind = table[codes]
    first = np.zeros(n + 1, bool)  # of a text; the end counts as one
    first[begins] = True
    first[n] = True
    run = first[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    after = np.append(run[1:], True)  # the next place begins a run
    start = run.copy()
    blank = (codes == 32) & ~first[1:]  # joins what follows, where that is no space
    start[1:] &= ~(blank[:-1] & (kind[1:] != SPACE) & run[1:])
    last = (kind == SPACE) & after & ~first[1:]  # the last space before something else stands alone or joins it
    start |= last
    marks = np.flatnonzero((codes == ord("'")) & run & after & start & ~first[1:])
    for end in CONTRACTIONS:
        at = marks[marks + len(end) < n]
        for i, c in enumerate(end, 1):
            at = at[(codes[at + i] == ord(c)) & ~first[at + i]]
        start[at + 1] = False
        rest = at + 1 + len(end)
        start[rest[rest < n]] = True
    return start


class Encoder:
    """Token ids of texts as the tokenizers library gives them: its model encodes each word once, as words repeat. definition: from read_definition, so byte-level."""

    def __init__(self, definition: str, table: np.ndarray):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        self.library.no_truncation()
        self.library.no_padding()
        self.letters = {b: letter for letter, b in byte_letters().items()}
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.table, self.known, self.held = table, {}, 0

    def ids(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The ids of each text, in order."""
        low = size = 0
        for high, text in enumerate(texts, 1):
            size += len(text)
            if size >= AT_ONCE or high == len(texts):
                yield from self._ids(texts[low:high])
                low, size = high, 0

    def _ids(self, texts: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        plain = []
        for i, text in enumerate(texts):
            if any(s in text for s in self.special):
                out[i] = np.array(self.library.encode(text.decode(), add_special_tokens=False).ids, np.uint32)
            elif text:
                plain.append(i)
        if not plain:
            return out
        data = b"".join(texts[i] for i in plain)
        codes = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
        widths = 1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000)
        place = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(widths, out=place[1:])
        begins = np.searchsorted(place, np.cumsum([0, *(len(texts[i]) for i in plain[:-1])]))
        at = np.flatnonzero(word_starts(codes, begins, self.table))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(np.append(place[at], place[-1])), pa.py_buffer(data)]).dictionary_encode()
        coded = self._words(words.dictionary.to_pylist())
        lengths = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        flat = np.frombuffer(b"".join(coded), np.uint32)
        which = words.indices.to_numpy()
        n = lengths[which]
        ends = np.cumsum(n)
        source = np.repeat((np.cumsum(lengths) - lengths)[which] - (ends - n), n) + np.arange(ends[-1])
        ids = flat[source]
        edges = np.append((ends - n)[np.searchsorted(at, begins)], ends[-1])
        for i, a, b in zip(plain, edges, edges[1:]):
            out[i] = ids[a:b]
        return out

    def _words(self, words: list[bytes]) -> list[bytes]:
        known = self.known
        if self.held > REMEMBERED:
            known.clear()
            self.held = 0
        tokens, letters = self.library.model.tokenize, self.letters
        for w in words:
            if w not in known:
                ids = [t.id for t in tokens(w.decode("latin-1").translate(letters))]
                known[w] = array("I", ids).tobytes()
                self.held += len(w) + 4 * len(ids) + 160
        return [known[w] for w in words]


# --- the plan


def least_sequences(counts: np.ndarray) -> int:
    """A lower bound of the sequences that pieces need; counts: by length, up to the size of a sequence. For each t, pieces over
    size - t stand without any of t or more, those over half stand alone, and the rest from t on fills what these leave."""
    size, most = len(counts) - 1, 0
    number, mass = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * np.arange(size + 1))])
    n, m = lambda a, b: int(number[b] - number[a]), lambda a, b: int(mass[b] - mass[a])  # noqa: E731  lengths a <= x < b
    for t in range(size // 2 + 1):
        alone, large = n(size - t + 1, size + 1), n(size // 2 + 1, size - t + 1)
        room = large * size - m(size // 2 + 1, size - t + 1)
        most = max(most, alone + large + max(0, -(-(m(t, size // 2 + 1) - room) // size)))
    return most


Filling = tuple[int, ...]
Plan = list[tuple[Filling, int]]


def best_fit(counts: np.ndarray) -> Plan:
    """Best fit on falling lengths, equal pieces at once: open sequences are kept by the room they have."""
    size = len(counts) - 1
    open_: dict[int, dict[Filling, int]] = {}
    for length in range(size, 0, -1):
        left = int(counts[length])
        while left:
            room = min((r for r in open_ if r >= length), default=None)
            if room is None:
                fill, take, room = (), left, size
            else:
                fill, there = open_[room].popitem()
                take = min(left, there)
                if there > take:
                    open_[room][fill] = there - take
                if not open_[room]:
                    del open_[room]
            rest, filled = room - length, (*fill, length)
            open_.setdefault(rest, {})
            open_[rest][filled] = open_[rest].get(filled, 0) + take
            left -= take
    return [(fill, n) for held in open_.values() for fill, n in held.items()]


def _all_fillings(room: int, counts: np.ndarray) -> Iterator[Filling]:
    """Every undominated filling of a room with pieces of these counts, the least waste first. For few pieces."""
    lengths = [int(x) for x in np.flatnonzero(counts[: room + 1])[::-1]]
    found: list[tuple[int, Filling]] = []

    def grow(i: int, left: int, held: Filling) -> None:
        more = False
        for j in range(i, len(lengths)):
            x = lengths[j]
            if x <= left and held.count(x) < counts[x]:
                more = True
                grow(j, left - x, (*held, x))
        if not more:
            found.append((left, held))

    def dominated(left: int, held: Filling) -> bool:
        free = [x for x in lengths if held.count(x) < counts[x]]
        sums = [*held, *(held[i] + held[j] for i in range(len(held)) for j in range(i))]
        return any(x < z <= x + left for x in held for z in free) or any(x <= z <= x + left for x in sums[len(held) :] for z in free)

    grow(0, room, ())
    yield from (held for left, held in sorted(found, key=lambda f: (f[0], len(f[1]))) if not dominated(left, held))


def _fillings(room: int, counts: np.ndarray) -> Iterator[Filling]:
    """Undominated fillings of a room, the least waste first: long pieces while three of the longest do not fill it, then up to three pieces that
    come closest to what is left. Among pairs of one sum, those that can be repeated most often come first."""
    taken: list[int] = []
    counts = counts.copy()
    while room:
        there = np.flatnonzero(counts[: room + 1])
        if not len(there):
            break
        longest = int(there[-1])
        if longest == room or 3 * longest >= room:
            break
        n = min(int(counts[longest]), room // longest - 2)
        taken += [longest] * n
        counts[longest] -= n
        room -= n * longest
    if not room or not len(there):
        yield tuple(taken)
        return
    if longest == room:  # one piece that fills a room dominates all else
        yield (*taken, longest)
        return
    one = int.from_bytes(np.packbits(counts[: room + 1] > 0, bitorder="little").tobytes(), "little")
    mask, two, three = (1 << room + 1) - 1, 0, 0
    for x in there.tolist():
        two |= one << x
    two &= mask
    for x in there.tolist():
        three |= two << x
    sums = (two | three) & mask
    made = 0
    for total in range(room, longest, -1):  # a sum up to that of the longest alone is dominated by it
        if not sums >> total & 1:
            continue
        if two >> total & 1:
            a = there[(there * 2 >= total) & (there < total)]
            a = a[counts[total - a] > (a * 2 == total)]
            for x in a[np.argsort(-np.minimum(counts[a], counts[total - a] // (1 + (a * 2 == total))), kind="stable")].tolist():
                yield (*taken, x, total - x)
                if (made := made + 1) >= FILLINGS:
                    return
        if three >> total & 1 and not made:
            for x in there[(there * 3 >= total) & (there < total - 1)][::-1].tolist():
                rest = total - x
                b = there[(there * 2 >= rest) & (there <= x) & (there < rest)]
                need = 1 + (b == x).astype(np.int64) + (b * 2 == rest)
                b = b[(counts[b] >= need) & (counts[rest - b] > 0)]
                if len(b):
                    y = int(b[np.argmax(np.minimum(counts[b], counts[rest - b]))])
                    yield (*taken, x, y, rest - y)
                    if (made := made + 1) >= FILLINGS:
                        return
    yield (*taken, longest)


def plan_sequences(counts: np.ndarray, branches: int = BRANCHES) -> tuple[Plan, int]:
    """Fillings with their numbers for pieces of these counts by length (up to the size of a sequence), and the lower bound.

    The search ends when the bound is met or after so many branches; then the best plan known is taken. Equal sequences
    are filled at once, as often as the counts allow. For a few pieces the search is complete.
    """
    size = len(counts) - 1
    counts = counts.astype(np.int64).copy()
    least, total = least_sequences(counts), int((counts * np.arange(size + 1)).sum())
    best = best_fit(counts)
    used = sum(n for _, n in best)
    made: Plan = []
    stack: list[tuple[Iterator, int, int]] = []

    def step() -> Iterator[tuple[Filling, int]]:
        longest = int(np.flatnonzero(counts)[-1])
        counts[longest] -= 1
        fill = _all_fillings if counts.sum() <= 16 else _fillings
        choices = fill(size - longest, counts)
        while True:
            found = next(choices, None)
            counts[longest] += 1
            if found is None:
                return
            filling = (longest, *found)
            lengths, need = np.unique(filling, return_counts=True)
            yield filling, int((counts[lengths] // need).min()) if fill is _fillings else 1
            counts[longest] -= 1

    if used > least:
        stack.append((step(), 0, 0))
    tried = 0
    while stack and used > least and tried < branches:
        choices, sequences, waste = stack[-1]
        if len(made) == len(stack):  # back from a branch
            filling, n = made.pop()
            np.add.at(counts, list(filling), n)
        choice = next(choices, None)
        if choice is None:
            stack.pop()
            continue
        filling, n = choice
        tried += 1
        wasted = waste + n * (size - sum(filling))
        if wasted > (used - 1) * size - total:
            continue
        np.subtract.at(counts, list(filling), n)
        made.append(choice)
        if counts.any():
            stack.append((step(), sequences + n, wasted))
        elif sequences + n < used:
            best, used = list(made), sequences + n
    return best, least


# --- documents

_encoders: dict[int, Encoder] = {}


def _encoder(shared) -> Encoder:
    """One a worker and definition."""
    definition, table = shared.value
    key = zlib.crc32(definition.encode())
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(definition, table)
    return _encoders[key]


def cut_pieces(docs: DataFrame, tokenizer_path: str, size: int, end_id: int, with_ids: bool, id_col: str, text_col: str) -> DataFrame:
    """The pieces of all documents, each with its number among those of its length in its shard."""
    shared = prepare(docs.sparkSession).sparkContext.broadcast((read_definition(tokenizer_path), char_classes()))
    schema = pa.schema([(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}[c.split()[1]]) for c in _PIECE.split(", ")])

    @trimmed
    def cut(batches):
        from pyspark import TaskContext

        coder, shard, seen = _encoder(shared), TaskContext.get().partitionId(), [0] * (size + 1)
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), coder.ids(batch.column(1).cast(pa.binary()).to_pylist())):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                start, stop = 0, (len(ids) - 1) % size + 1
                for piece in range(-(-len(ids) // size)):
                    held = ids[start:stop].tobytes()
                    rows.append((shard, seen[stop - start], doc_id, piece, start, stop - start, zlib.crc32(held), held if with_ids else None))
                    seen[stop - start] += 1
                    start, stop = stop, stop + size
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)
        coder.known.clear()
        coder.held = 0

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(cut, _PIECE)


def slots_of(plan: Plan) -> pa.Table:
    """Rows (length, low, high, each, sequence, at): pieces low..high of a length go to the sequences from `sequence` on, `each` to one, from place `at` on."""
    rows, used, sequence = [], {}, 0
    for filling, n in plan:
        at = 0
        for length in sorted(set(filling), reverse=True):
            each, low = filling.count(length), used.get(length, 0)
            used[length] = low + n * each
            rows.append((length, low, used[length], each, sequence, at))
            at += each * length
        sequence += n
    names = ("length", "low", "high", "each", "sequence", "at")
    return pa.table({name: pa.array([r[i] for r in rows], pa.int64()) for i, name in enumerate(names)})


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 0, with_ids: bool = False, branches: int = BRANCHES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: where each piece of each document stands in sequences of `size` tokens.

    A document is its ids and end_id. Those longer than a sequence are cut into pieces of its size, the first of which may
    be shorter. start: the document's ids before the piece, offset: the sequence's, gapless from 0; sequence ids count from
    0. with_ids: the piece's ids too (packed little-endian unsigned 32-bit), which `sequences` joins.

    Null text is empty and has the end alone, so every row has a piece; repeated rows and rows without an id are documents of
    their own. An empty table gives no rows. Strings of special tokens are encoded as those. Memory follows the longest text.
    Which of several pieces of one length goes where is decided by their order in the input; other columns play no part.

    Each piece is written once, without its ids unless asked for, and shuffled once, with its length and shard. The driver holds
    the numbers of pieces by length, `size` at most, and the plan, which has some fillings for each length and is broadcast.
    """
    spark = prepare(docs.sparkSession)
    ws = Workspace(spark, "packing")
    pieces = ws.write(cut_pieces(docs, tokenizer_path, size, end_id, with_ids, id_col, text_col), "pieces")
    by_shard = pieces.groupBy("length", "shard").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("length").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = by_shard.select("length", "shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    counts = np.zeros(size + 1, np.int64)
    for r in by_shard.groupBy("length").agg(F.sum("n").alias("n")).collect():  # `size` rows at most
        counts[r["length"]] = r["n"]
    slots = spark.createDataFrame(slots_of(plan_sequences(counts, branches)[0]), "length long, low long, high long, each long, sequence long, at long")
    j = F.col("number") + F.col("before")
    placed = pieces.join(before, ["length", "shard"]).withColumn("j", j).join(F.broadcast(slots), "length").where((F.col("j") >= F.col("low")) & (F.col("j") < F.col("high")))
    nth = F.col("j") - F.col("low")
    out = placed.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("sequence") + F.expr("(j - low) div each")).alias("sequence_id"), (F.col("at") + nth % F.col("each") * F.col("length")).alias("offset"), "ids")
    return out if with_ids else out.drop("ids")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids, doc_ids) of what pack_documents gave with ids: one row a sequence, of bounded size."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids", "length")))
    rows = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return rows.select("sequence_id", F.aggregate("parts", F.lit(0).cast("long"), lambda s, p: s + p["length"]).alias("n_tokens"), F.aggregate("parts", F.lit(b""), lambda s, p: F.concat(s, p["ids"])).alias("ids"), F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"))
