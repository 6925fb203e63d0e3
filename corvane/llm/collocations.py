"""Phrases that belong together, mined from count tries of depth four.

Each shard of documents becomes one trie a language: every place of a text gives a path of up to four words that ends
where its piece ends, and a node counts the paths through it, so the node of a phrase holds the phrase's occurrences. A
trie is kept as its distinct paths, sorted by the bytes of their words, with counts: a node is a run of neighbouring paths,
and the serialised form is that list with the shard's words. The tries are cut at common bounds, full paths taken from
all of them, and each range of prefixes is merged from the parts that the tries have in it. A node that reaches over a
bound is a part in each range; its parts are added afterwards. From the merged nodes, walking up from a phrase gives the
counts of its left parts, and its suffix link, the phrase without its first word, those of its right parts, level by level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace, prepare, trim, trimmed

#: The words of a phrase at most, the bytes that end pieces, those that part words, and the name of no language.
DEPTH, PIECE_ENDS, SPACES, NO_LANG = 4, b".,;:!?\n\x0b\x0c\r", b" \t", "und"
#: Text bytes of a shard; a path in so many is a sample, and so many samples make a range.
SHARD_BYTES, SAMPLED, SAMPLES = 8 << 20, 1 << 17, 4
#: Parts that each language's candidates are ranked in before their best meet.
PARTS = 256

_TRIE = "lang string, n_words long, n_paths long, trie binary, samples array<array<binary>>"
_PART = "part int, lang string, trie binary"
_NODE = "lang string, phrase string, m int, f long"


def _classes() -> np.ndarray:
    """0 for bytes of words, 1 for those between words, 2 for those between pieces."""
    table = np.zeros(256, np.uint8)
    table[np.frombuffer(SPACES, np.uint8)] = 1
    table[np.frombuffer(PIECE_ENDS, np.uint8)] = 2
    return table


def words_of(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All words of some lower-cased texts in order, and the number of the piece that each stands in. No piece spans two texts."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    kind = _classes()[data]
    inside = kind == 0
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    piece = np.cumsum(kind == 2, dtype=np.int32)[begin] if len(begin) else np.zeros(0, np.int32)
    offsets = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside].tobytes())])
    return words, piece


def in_order(columns: list[np.ndarray], size: int) -> np.ndarray:
    """The order of rows of numbers below size, by the first column first."""
    bits = max(1, int(size).bit_length())
    keys, room = [], 0
    for c in columns:  # as few keys as 63 bits a key allow
        if keys and room >= bits:
            keys[-1], room = (keys[-1] << bits) | c.astype(np.int64), room - bits
        else:
            keys.append(c.astype(np.int64))
            room = 63 - bits
    return np.argsort(keys[0], kind="stable") if len(keys) == 1 else np.lexsort(keys[::-1])


class Trie:
    """Distinct paths in order: words sorted by their bytes, paths as DEPTH columns of word numbers from 1 on (0: none), counts."""

    def __init__(self, words: pa.Array, paths: list[np.ndarray], counts: np.ndarray):
        self.words, self.paths, self.counts = words, paths, counts

    @staticmethod
    def collected(words: pa.Array, paths: list[np.ndarray], counts: np.ndarray) -> Trie:
        """From rows in any order, over words in any order that may repeat."""
        coded = words.dictionary_encode()
        names = coded.dictionary
        order = pc.sort_indices(names).to_numpy()
        place = np.empty(len(order) + 1, np.int32)
        place[0], place[order + 1] = 0, np.arange(1, len(order) + 1, dtype=np.int32)
        number = np.concatenate([[0], place[1:][coded.indices.to_numpy()]]).astype(np.int32) if len(words) else np.zeros(1, np.int32)
        paths = [number[p] for p in paths]
        put = in_order(paths, len(order) + 1)
        paths, counts = [p[put] for p in paths], counts[put]
        if len(counts):
            first = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([p[1:] != p[:-1] for p in paths])]))
            paths, counts = [p[first] for p in paths], np.add.reduceat(counts, first)
        return Trie(names.take(pa.array(order)), paths, counts)

    @staticmethod
    def of_texts(texts: list[bytes]) -> tuple[Trie, int]:
        """The trie of all places of some texts, and the number of their words."""
        words, piece = words_of(texts)
        coded = words.dictionary_encode()
        w = coded.indices.to_numpy().astype(np.int32) + 1
        paths = [w]
        for d in range(1, DEPTH):
            follows = np.zeros(len(w), np.int32)
            if len(w) > d:
                follows[:-d] = np.where(piece[d:] == piece[:-d], w[d:], 0)
            paths.append(follows)
        return Trie.collected(coded.dictionary, paths, np.ones(len(w), np.int64)), len(w)

    @staticmethod
    def merged(tries: list[Trie]) -> Trie:
        starts = np.cumsum([0, *(len(t.words) for t in tries)]).astype(np.int32)
        paths = [np.concatenate([np.where(t.paths[d] > 0, t.paths[d] + s, np.int32(0)) for t, s in zip(tries, starts)]) for d in range(DEPTH)]
        return Trie.collected(pa.concat_arrays([t.words for t in tries]), paths, np.concatenate([t.counts for t in tries]))

    def part(self, low: int, high: int) -> Trie:
        """The paths low..high, with the words they hold."""
        paths = [p[low:high] for p in self.paths]
        used = np.unique(np.concatenate(paths))
        number = np.zeros(len(self.words) + 1, np.int32)
        used = used[used > 0]
        number[used] = np.arange(1, len(used) + 1)
        return Trie(self.words.take(pa.array(used - 1)), [number[p] for p in paths], self.counts[low:high])

    def path(self, i: int) -> list[bytes]:
        return [self.words[int(p[i]) - 1].as_py() for p in self.paths if p[i]]

    def place(self, bound: list[bytes]) -> int:
        """How many paths come before a bound."""
        low, high = 0, len(self.counts)
        for d, word in enumerate([*bound, *[b""] * (DEPTH - len(bound))]):
            column = self.paths[d][low:high]
            a, b = 0, len(self.words)
            while a < b:  # the word's number, or that of the next one
                mid = (a + b) // 2
                a, b = (mid + 1, b) if self.words[mid].as_py() < word else (a, mid)
            there = word and a < len(self.words) and self.words[a].as_py() == word
            at = a + 1 if word else 0
            first = int(np.searchsorted(column, at))
            if word and not there:
                return low + first
            low, high = low + first, low + int(np.searchsorted(column, at, "right"))
        return low

    def packed(self) -> bytes:
        """Serialised in order: the first column as steps, which are small, all columns compressed."""
        import zstandard

        small = lambda x: x.astype(np.uint16) if not len(x) or x.max() < 1 << 16 else x
        steps = small(np.diff(self.paths[0], prepend=0).astype(np.uint32))
        columns = [steps, *(small(p.astype(np.uint32)) for p in self.paths[1:]), small(self.counts.astype(np.uint64))]
        head = np.array([len(self.words), len(self.counts), *(c.itemsize for c in columns)], np.int64)
        sizes = np.diff(np.frombuffer(self.words.buffers()[1], np.int64)[self.words.offset : self.words.offset + len(self.words) + 1]) if len(self.words) else np.zeros(0, np.int64)
        body = b"".join([head.tobytes(), sizes.astype(np.int32).tobytes(), *(c.tobytes() for c in columns), b"".join(self.words.to_pylist())])
        return zstandard.ZstdCompressor(level=1).compress(body)

    @staticmethod
    def unpacked(data: bytes) -> Trie:
        import zstandard

        body = zstandard.ZstdDecompressor().decompress(data)
        n_words, n, *widths = np.frombuffer(body, np.int64, 3 + DEPTH).tolist()
        at = 8 * (3 + DEPTH)
        sizes = np.frombuffer(body, np.int32, n_words, at)
        at, columns = at + 4 * n_words, []
        for width in widths:
            columns.append(np.frombuffer(body, f"<u{width}", n, at))
            at += width * n
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n_words, [None, pa.py_buffer(offsets), pa.py_buffer(body[at:])])
        return Trie(words, [np.cumsum(columns[0].astype(np.int64)).astype(np.int32), *(c.astype(np.int32) for c in columns[1:DEPTH])], columns[DEPTH].astype(np.int64))

    def nodes(self, least: int) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
        """(depth, phrases, counts) of nodes with counts of least or more, and of those that hold the first or the last path: they may go on outside."""
        n = len(self.counts)
        if not n:
            return
        differs, columns = np.zeros(n, bool), []
        differs[0] = True
        for d, column in enumerate(self.paths):
            differs[1:] |= column[1:] != column[:-1]
            columns.append(column)
            first = np.flatnonzero(differs)
            counts = np.add.reduceat(self.counts, first)
            keep = counts >= least
            keep[[0, -1]] = True
            keep &= column[first] > 0
            at = first[keep]
            parts = [self.words.take(pa.array(c[at] - 1)) for c in columns]
            yield d + 1, pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.large_binary())) if d else parts[0], counts[keep]


def _tries(docs: DataFrame, ws: Workspace) -> DataFrame:
    """The trie of each shard and language, with samples of its paths at a random start."""

    @trimmed
    def build(batches):
        rng, held, size = np.random.default_rng(7), {}, 0

        def rows():
            for lang, texts in held.items():
                trie, n = Trie.of_texts(texts)
                samples = [trie.path(i) for i in range(int(rng.integers(SAMPLED)), len(trie.counts), SAMPLED)]
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([n], pa.int64()), pa.array([len(trie.counts)], pa.int64()), pa.array([trie.packed()], pa.binary()), pa.array([samples], pa.list_(pa.list_(pa.binary())))], names=[c.split()[0] for c in _TRIE.split(", ")])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), pc.ascii_lower(batch.column(1)).cast(pa.binary()).to_pylist()):
                held.setdefault(lang, []).append(text)
                size += len(text) + 1
                if size >= SHARD_BYTES:
                    yield from rows()
                    held, size = {}, 0
                    trim()
        yield from rows()

    return ws.write(docs.mapInArrow(build, _TRIE), "tries")


def _bounds(tries: DataFrame) -> list[tuple[str, list[bytes]]]:
    """Every SAMPLES-th of all sampled paths in order: bounds of ranges of about SAMPLES * SAMPLED paths."""
    n = int(tries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = tries.select("lang", F.explode("samples").alias("path")).repartitionByRange(n, "lang", "path").sortWithinPartitions("lang", "path")
    chosen = rows.withColumn("__i", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)).where(F.col("__i") % SAMPLES == SAMPLES - 1)
    return sorted((r["lang"], [bytes(w) for w in r["path"]]) for r in chosen.select("lang", "path").collect())


def _merged_nodes(tries: DataFrame, bounds: list[tuple[str, list[bytes]]], least: int) -> DataFrame:
    """(lang, phrase, m, f) of all phrases with f >= least."""
    sent = tries.sparkSession.sparkContext.broadcast(bounds)

    @trimmed
    def cut(batches):
        bounds = sent.value
        for batch in batches:
            for lang, data in zip(batch.column("lang").to_pylist(), batch.column("trie").to_pylist()):
                trie = Trie.unpacked(data)
                own = [i for i, b in enumerate(bounds) if b[0] == lang]
                before = sum(b[0] < lang for b in bounds)
                edges = [0, *(trie.place(bounds[i][1]) for i in own), len(trie.counts)]
                parts = [(before + i, a, b) for i, (a, b) in enumerate(zip(edges, edges[1:])) if a < b]
                for part, a, b in parts:
                    yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([lang]), pa.array([trie.part(a, b).packed()], pa.binary())], names=["part", "lang", "trie"])

    @trimmed
    def merge(batches):
        now, held, size = None, [], 0

        def rows():
            for m, phrases, counts in Trie.merged(held).nodes(least):
                if len(counts):
                    yield pa.RecordBatch.from_arrays([pa.array([now[1]] * len(counts)), phrases.cast(pa.binary()).cast(pa.string()), pa.array([m] * len(counts), pa.int32()), pa.array(counts, pa.int64())], names=["lang", "phrase", "m", "f"])

        for batch in batches:
            for key, data in zip(zip(batch.column("part").to_pylist(), batch.column("lang").to_pylist()), batch.column("trie").to_pylist()):
                if held and key != now:
                    yield from rows()
                    held, size = [], 0
                    trim()
                now = key
                held.append(Trie.unpacked(data))
                size += len(held[-1].counts)
                if len(held) > 1 and size > 3 * SAMPLES * SAMPLED // 2:  # what is held follows the different paths
                    held = [Trie.merged(held)]
                    size = len(held[0].counts) // 2
        if held:
            yield from rows()

    parts = tries.select("lang", "trie").mapInArrow(cut, _PART)
    merged = parts.repartition(len(bounds) + 1, "part").sortWithinPartitions("part", "lang").mapInArrow(merge, _NODE)
    return merged.groupBy("lang", "phrase", "m").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


def mine_collocations(docs: DataFrame, least: int = 30, most: int = 2000, covered: int = 80, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `most` phrases of two to four words with a >= least occurrences, which no longer one covers.

    Texts are lower-cased in A-Z, split into pieces at `.,;:!?` and line ends, and those into words at spaces and tabs. n: the words of
    the language, a: the phrase's occurrences, l and r: those of both sides of its cut, score: floor(2000000 * a / (l + r)). The
    cut with the lowest score counts, of equal ones the first. A phrase goes if it stands inside a longer one that occurs
    `covered` % as often or more; as an inner part of four words is also one of three that occur no less, comparing with phrases of one word more does.
    Order: score and a falling, then the bytes of the phrase. Counts and scores are exact.

    Null text is empty, null lang is "und"; repeated rows count each time. Empty tables and tables without such phrases
    give no rows. A very long text is one shard by itself, whose memory follows its length. Other columns play no part.

    Each shard's trie is written once and shuffled once, cut at bounds; what is shuffled after that are phrases with at least `least`
    occurrences. The driver and a broadcast hold the bounds, one for about half a million distinct paths of a shard (some 60 bytes).
    """
    spark = prepare(docs.sparkSession)
    ws = Workspace(spark, "collocations")
    named = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    tries = _tries(named, ws)
    words = tries.groupBy("lang").agg(F.sum("n_words").alias("n"))
    words = ws.write(words, "words")
    nodes = ws.write(_merged_nodes(tries, _bounds(tries), least), "nodes")
    ws.drop("tries")
    levels = {1: nodes.where("m = 1").select("lang", "phrase", "f", F.array().cast("array<long>").alias("left"), F.array().cast("array<long>").alias("right"))}
    parent, suffix = F.expr("substring_index(phrase, ' ', m - 1)"), F.expr("substring(phrase, instr(phrase, ' ') + 1)")
    linked = nodes.where("m > 1").withColumns({"parent": parent, "suffix": suffix})
    for m in range(2, DEPTH + 1):
        above = levels[m - 1].select("lang", F.col("phrase").alias("key"), F.col("f").alias("g"), "left", "right")
        up = linked.where(F.col("m") == m).withColumnRenamed("parent", "key").join(above.drop("right"), ["lang", "key"]).select("lang", "phrase", "f", "suffix", F.concat("left", F.array("g")).alias("left"))
        level = up.withColumnRenamed("suffix", "key").join(above.drop("left"), ["lang", "key"]).select("lang", "phrase", "f", "left", F.concat(F.array("g"), F.col("right")).alias("right"))
        levels[m] = ws.write(level, f"level_{m}")
    longer = linked.where("m > 2").select("lang", F.explode(F.array("parent", "suffix")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    every = levels[2]
    for m in range(3, DEPTH + 1):
        every = every.unionByName(levels[m])
    score = F.expr("transform(zip_with(left, right, (x, y) -> struct(x, y)), c -> cast(2000000 as decimal(7, 0)) * cast(f as decimal(19, 0)) div (cast(c.x as decimal(19, 0)) + cast(c.y as decimal(19, 0))))")
    scored = every.join(longer, ["lang", "phrase"], "left").where(F.coalesce(F.col("longer").cast("decimal(19, 0)") * 100 < F.col("f").cast("decimal(19, 0)") * covered, F.lit(True)))
    scored = scored.withColumn("scores", score).withColumn("score", F.array_min("scores")).withColumn("cut", F.array_position("scores", F.col("score")).cast("int"))
    best = scored.select("lang", "phrase", F.col("f").alias("a"), F.element_at("left", F.col("cut")).alias("l"), F.element_at("right", F.col("cut")).alias("r"), "score")
    order = (F.desc("score"), F.desc("a"), "phrase")
    near = best.withColumn("__part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).withColumn("__i", F.row_number().over(Window.partitionBy("lang", "__part").orderBy(*order))).where(F.col("__i") <= most)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)
    return ranked.join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
