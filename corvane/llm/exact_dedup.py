"""Exact dedup with a log-structured merge index.

Each task keeps a memtable from text to (best identifier, count), so that texts which meet there are compared byte by
byte. A full memtable is flushed: its digests, sorted, become one run, cut into shards by digest and each slice with a
Bloom filter. In a shard, slices are the runs of the lowest level; whenever a level holds FAN_IN runs, compaction merges
them into one of the next level, with a filter of its own size. An entry that no other run's filter admits takes no part in
the merge. The smallest rank survives (the identifier, or its complement if the largest is to stay). Digests that several
runs share are hits: their texts are read again and compared byte by byte, and texts which only share a digest are told apart.

Copies are counted in the memtable, so a group that holds a third of all rows sends one entry per run, not per row, and
gets its answer back once per run.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, arrow_schema, id_and_text, numbered, prepare, record, trimmed

_FLUSHED = "kind int, row long, doc_id long, digest binary, run long, first boolean, text_sha256 string, shard int, digests binary, ranks binary, nameless binary, counts binary, mixed binary, filter binary"
_MERGED = "run long, digest binary, nameless boolean, rank long, n long, best_run long, runs long, mixed boolean"
#: Runs that one level of a shard holds before they are merged.
FAN_IN = 8
#: Bits of the largest filter of hits that is broadcast (8 MB). The filter follows the number of hits, 16 bits each; when
#: it would be larger, texts meet the hits in a join instead.
HIT_BITS = 1 << 26


def bloom(words: np.ndarray, bits: int) -> np.ndarray:
    """The bits that 64-bit words set in a filter whose size is a power of two."""
    out = np.zeros(bits, bool)
    for at in _places(words, bits):
        out[at] = True
    return out


def admits(bits: np.ndarray, words: np.ndarray) -> np.ndarray:
    out = np.ones(len(words), bool)
    for at in _places(words, len(bits)):
        out &= bits[at]
    return out


def _places(words: np.ndarray, bits: int):
    """Three places in a filter: the word, plus multiples of its high half."""
    for i in range(3):
        yield (words + np.uint64(i) * ((words >> np.uint64(32)) | np.uint64(1))) & np.uint64(bits - 1)


def _filter_bits(n: int) -> int:
    return 1 << max(6, (16 * n - 1).bit_length())


def _words(digests: list[bytes]) -> np.ndarray:
    return np.array([int.from_bytes(d[:8].ljust(8, b"\0"), "little") for d in digests], np.uint64)


class _Entry:
    """What a memtable knows of a text."""

    __slots__ = ("claimed", "digest", "n", "rank", "sha")

    def __init__(self, text: bytes, width: int, rank: tuple[bool, int]):
        sha = hashlib.sha256(text)
        self.digest, self.sha, self.rank, self.n, self.claimed = sha.digest()[:width], sha.hexdigest(), rank, 0, False


def _flush(entries: list[_Entry], rows: list, run: int, shards: int):
    """The document rows of a memtable and its run, one slice a shard."""
    schema, columns = arrow_schema(_FLUSHED), ([], [], [], [], [])
    for row, doc_id, rank, e in rows:
        first = rank == e.rank and not e.claimed
        e.claimed |= first
        for column, value in zip(columns, (row, doc_id, e.digest, first, e.sha)):
            column.append(value)
    yield record(schema, len(rows), kind=[0] * len(rows), row=columns[0], doc_id=columns[1], digest=columns[2], run=[run] * len(rows), first=columns[3], text_sha256=columns[4])
    of_digest: dict[bytes, list] = {}
    for e in entries:
        x = of_digest.setdefault(e.digest, [e.rank, 0, 0])
        x[0], x[1], x[2] = min(x[0], e.rank), x[1] + e.n, x[2] + 1
    ordered = sorted(of_digest.items())
    for shard, slice_ in groupby(ordered, key=lambda x: int.from_bytes(x[0][:4].ljust(4, b"\0"), "big") * shards >> 32):
        slice_ = list(slice_)
        yield record(
            schema, 1, kind=[1], run=[run], shard=[shard], digests=[b"".join(d for d, _ in slice_)],
            ranks=[np.array([x[0][1] for _, x in slice_], np.int64).tobytes()], nameless=[np.array([x[0][0] for _, x in slice_], bool).tobytes()],
            counts=[np.array([x[1] for _, x in slice_], np.int64).tobytes()], mixed=[np.array([x[2] > 1 for _, x in slice_], bool).tobytes()],
            filter=[np.packbits(bloom(_words([d for d, _ in slice_]), _filter_bits(len(slice_)))).tobytes()],
        )


def _runs(keep: str, shards: int, width: int, most_bytes: int, most_rows: int):
    """The map side: memtables of bounded size, flushed as runs. A row holds on to its text's entry, not to its own copy of the text."""

    @trimmed
    def flush_all(batches):
        from pyspark import TaskContext

        run, memtable, rows, held = TaskContext.get().partitionId() << 20, {}, [], 0
        for batch in batches:
            for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast("binary").to_pylist()):
                rank = (True, 0) if doc_id is None else (False, doc_id if keep == "smallest" else ~doc_id)
                e = memtable.get(text)
                if e is None:
                    e = memtable[text] = _Entry(text, width, rank)
                    held += len(text)
                e.rank, e.n = min(e.rank, rank), e.n + 1
                rows.append((row, doc_id, rank, e))
                if held >= most_bytes or len(rows) >= most_rows:
                    yield from _flush([*memtable.values()], rows, run, shards)
                    run, memtable, rows, held = run + 1, {}, [], 0
        if rows:
            yield from _flush([*memtable.values()], rows, run, shards)

    return flush_all


class Run:
    """Sorted digests (as big-endian words, padded) with their values, and a filter."""

    def __init__(self, digests: np.ndarray, values: dict[str, np.ndarray], filter_: np.ndarray | None = None):
        self.digests, self.values = digests, values
        self.words = digests[:, 0].byteswap()
        self.filter = bloom(self.words, _filter_bits(len(digests))) if filter_ is None else filter_

    @classmethod
    def of_slice(cls, row, width: int) -> Run:
        n = len(row.digests) // width
        padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
        padded[:, :width] = np.frombuffer(row.digests, np.uint8).reshape(n, width)
        values = {"nameless": np.frombuffer(row.nameless, bool), "rank": np.frombuffer(row.ranks, np.int64), "n": np.frombuffer(row.counts, np.int64)}
        values |= {"best_run": np.full(n, row.run, np.int64), "runs": np.ones(n, np.int64), "mixed": np.frombuffer(row.mixed, bool)}
        return cls(padded.view(">u8").astype(np.uint64), values, np.unpackbits(np.frombuffer(row.filter, np.uint8)).astype(bool))

    def find(self, digests: np.ndarray) -> np.ndarray:
        """Where digests, all of which are here, stand."""
        at = np.searchsorted(self.digests[:, 0], digests[:, 0])
        while (off := (self.digests[at] != digests).any(axis=1)).any():  # those that share the first word follow each other
            at = at + off
        return at


def merge(runs: list[Run]) -> Run:
    """One run of several; entries that no other run's filter admits are only put in order."""
    shared = []
    for i, x in enumerate(runs):
        seen = np.zeros(len(x.digests), bool)
        for j, y in enumerate(runs):
            if i != j:
                seen |= admits(y.filter, x.words)
        shared.append(seen)
    pick = lambda masks: (np.concatenate([x.digests[m] for x, m in zip(runs, masks)]), {k: np.concatenate([x.values[k][m] for x, m in zip(runs, masks)]) for k in runs[0].values})
    (alone, alone_values), (d, v) = pick([~m for m in shared]), pick(shared)
    order = np.lexsort((v["best_run"], v["rank"], v["nameless"], *d.T[::-1]))
    d, v = d[order], {k: x[order] for k, x in v.items()}
    first = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]).any(axis=1)])) if len(d) else np.zeros(0, int)
    of = lambda add, k: add.reduceat(v[k], first) if len(d) else v[k]
    merged = {k: v[k][first] for k in ("nameless", "rank", "best_run")} | {"n": of(np.add, "n"), "runs": of(np.add, "runs"), "mixed": of(np.logical_or, "mixed")}
    every, values = np.concatenate([alone, d[first]]), {k: np.concatenate([alone_values[k], merged[k]]) for k in merged}
    order = np.lexsort(every.T[::-1])
    return Run(every[order], {k: x[order] for k, x in values.items()})


def compact(runs: list[Run]) -> Run:
    """All runs through the levels to one."""
    levels: list[list[Run]] = [[]]
    for run in runs:
        at = 0
        levels[0].append(run)
        while len(levels[at]) == FAN_IN:
            merged, levels[at] = merge(levels[at]), []
            at += 1
            if at == len(levels):
                levels.append([])
            levels[at].append(merged)
    rest = [run for level in levels for run in level]
    return merge(rest) if len(rest) > 1 else rest[0]


def _compact(width: int):
    """The index of one shard, as an answer for each run and digest."""

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        slices = [Run.of_slice(row, width) for row in pdf.sort_values("run").itertuples()]
        whole, out = compact(slices), []
        for run, s in zip(sorted(pdf["run"]), slices):
            at = whole.find(s.digests)
            raw = s.digests.astype(">u8").view(np.uint8).reshape(len(s.digests), -1)[:, :width]
            out.append(pd.DataFrame({"run": run, "digest": [x.tobytes() for x in raw], **{k: whole.values[k][at] for k in ("nameless", "rank", "n", "best_run", "runs", "mixed")}}))
        return pd.concat(out)

    return answer


def _texts_of_hits(filter_, width: int):
    """The texts whose digests the filter admits (all, without one), each once a batch."""
    schema = arrow_schema("digest binary, text binary")

    @trimmed
    def look(batches):
        for batch in batches:
            texts = list(dict.fromkeys(batch.column(0).cast("binary").to_pylist()))
            digests = [hashlib.sha256(t).digest()[:width] for t in texts]
            found = [i for i, ok in enumerate(admits(filter_.value, _words(digests)) if filter_ else [True] * len(texts)) if ok]
            if found:
                yield record(schema, len(found), digest=[digests[i] for i in found], text=[texts[i] for i in found])

    return look


def _slots(bits: int):
    """The places in a filter that digests set."""
    schema = arrow_schema("slot long")

    @trimmed
    def places(batches):
        for batch in batches:
            slots = np.unique(np.concatenate([*_places(_words(batch.column(0).to_pylist()), bits)])).astype(np.int64)
            yield record(schema, len(slots), slot=slots + 1)  # bitmaps count from 1

    return places


def _filter_of(hits: DataFrame, bits: int) -> np.ndarray:
    """The filter of a column of digests, made in blocks of 4 KB by the executors."""
    parts = hits.mapInArrow(_slots(bits), "slot long").groupBy(F.bitmap_bucket_number("slot").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
    out = np.zeros(max(bits, 1 << 15), bool)
    for block, part in parts.toPandas().itertuples(index=False):  # at most HIT_BITS / 32768 rows
        low = (int(block) - 1) << 15
        out[low : low + (1 << 15)] |= np.unpackbits(np.frombuffer(bytes(part), np.uint8), bitorder="little")[: 1 << 15].astype(bool)[: len(out) - low]
    return out[:bits]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest", memtable_bytes: int = 32 << 20, memtable_rows: int = 1 << 16, digest_bytes: int = 32, shards: int | None = None, row_col: str | None = None, hit_bits: int = HIT_BITS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256 (and row, if row_col names a column that numbers the rows).

    keep is "smallest" or "largest": which identifier stays among equal texts. Null text is the empty text. A row without
    an identifier stays only if no row of its group has one; any 64-bit integer is an identifier. Of rows that repeat
    identifier and text, one is kept. A very long text fills a memtable by itself; texts are whole in memory one memtable
    at a time. Other columns are not read, whatever their names. An empty table gives no rows.
    digest_bytes under 32 shortens the index key (tests use this to force collisions); results do not change.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep: {keep}")
    spark = prepare(docs.sparkSession)
    ws, shards = Workspace(spark, "exact"), shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = (F.col(row_col).cast("long") if row_col else F.lit(None).cast("long")).alias("row")
    source = docs.select(row, F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    flushed = ws.write(source.mapInArrow(_runs(keep, shards, digest_bytes, memtable_bytes, memtable_rows), _FLUSHED), "runs", "kind")
    rows = flushed.where("kind = 0").select("row", "doc_id", "digest", "run", "first", "text_sha256")
    slices = flushed.where("kind = 1").select("run", "shard", "digests", "ranks", "nameless", "counts", "mixed", "filter")
    index = ws.write(slices.groupBy("shard").applyInPandas(_compact(digest_bytes), _MERGED), "index")

    hits = index.where("(runs > 1 and run = best_run) or mixed").select("digest")
    bits = _filter_bits(hits.count())
    texts = source.select("text").mapInArrow(_texts_of_hits(spark.sparkContext.broadcast(_filter_of(hits, bits)) if bits <= hit_bits else None, digest_bytes), "digest binary, text binary")
    if bits > hit_bits:
        texts = texts.join(hits.distinct(), "digest", "left_semi")
    several = ws.write(texts.groupBy("digest", "text").count().groupBy("digest").count().where("count > 1").select("digest"), "collisions")

    id_of = F.when(~F.col("nameless"), F.col("rank") if keep == "smallest" else F.bitwise_not("rank"))
    carried = ["row"] if row_col else []
    joined = rows.join(index, ["run", "digest"], "left")
    out = joined.select("doc_id", id_of.alias("keep_id"), F.col("n").alias("group_size"), (F.col("first") & (F.col("run") == F.col("best_run")) & F.col("doc_id").eqNullSafe(id_of)).alias("kept"), "text_sha256", "digest", *carried)
    if several.isEmpty():
        return out.drop("digest")
    # Texts that share a digest but not their bytes: grouped by the bytes.
    rank = F.coalesce(F.col("doc_id") if keep == "smallest" else F.bitwise_not("doc_id"), F.lit(0))
    ours = source.withColumn("digest", F.substring(F.unhex(F.sha2(F.col("text"), 256)), 1, digest_bytes)).join(several, "digest")
    ours = ws.write(ours.select("*", F.monotonically_increasing_id().alias("number"), F.col("doc_id").isNull().alias("nameless"), rank.alias("rank")), "apart")
    best = ours.groupBy("digest", "text").agg(F.min(F.struct("nameless", "rank", "number")).alias("best"), F.count("*").alias("group_size"))
    rest = ours.select("row", "doc_id", "digest", "text", "number").join(best.select("digest", "text", "group_size", "best.nameless", "best.rank", F.col("best.number").alias("chosen")), ["digest", "text"])
    rest = rest.select("doc_id", id_of.alias("keep_id"), "group_size", (F.col("number") == F.col("chosen")).alias("kept"), F.sha2(F.col("text"), 256).alias("text_sha256"), *carried)
    return out.join(several, "digest", "left_anti").drop("digest").unionByName(rest)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of docs for each distinct text (null is the empty text), with its columns: the one that exact_dedup keeps.

    Rows are told apart by a number of their own, so rows that repeat each other whole, share an identifier or have none
    are copies like any other. An empty table stays empty.
    """
    docs, row = numbered(docs, Workspace(prepare(docs.sparkSession), "copies"))
    kept = exact_dedup(docs, id_col, text_col, row_col=row, **options).where("kept").select(F.col("row").alias(row))
    return docs.join(kept, row, "left_semi").drop(row)
