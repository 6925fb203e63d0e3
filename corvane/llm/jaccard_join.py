"""Jaccard join of word-shingle sets, size-aware: subsets for light sets, inverted lists for heavy ones.

1. Sets. Texts are packed into runs. Every run sends its shingle keys, 40 bits each and sorted, to shards by key; a shard
   answers with one bit a key (does it stand in more than one document?) and, where it does, its frequency level. A set
   can only link if four fifths of it are shared with somebody, so all other documents are done here. Equal sets become
   one class, through a 128-bit digest.
2. Light sets. A pair of sizes (a, b) links exactly if it shares ceil(4 (a + b) / 9) shingles, so both enumerate their
   subsets of that size, and equal subsets are links. Up to which size this is done follows from its cost against that
   of the lists, from the numbers of sets of each size.
3. Heavy sets. Sets post the first shingles of an order by frequency, enough that linked sets share a list. In each list
   all are compared with the most central set; whatever then still stands in different components of one list, and
   passes the bounds on size and position, is compared too. Sets of one component need no more comparing, so finding a
   group of thousands of near copies costs one comparison a set.
4. Links. All links lie inside components. Their classes are cut into blocks of bounded size, by size band and a hash,
   and each two blocks that can link meet in one group, where matrix products give all intersections at once.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_KEYS, Workspace, arrow_schema, attach, mixed, numbered, pack_runs, prepare, record, trim, trimmed, unpack
from .components import components

WORDS = 5
_KEY_BITS = 40
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SETS = "rid long, doc_id long, size int, live boolean, h1 long, h2 long, central int, prefix array<long>, shared binary"
_SETS_ARROW = pa.schema([("rid", pa.int64()), ("doc_id", pa.int64()), ("size", pa.int32()), ("live", pa.bool_()), ("h1", pa.int64()), ("h2", pa.int64()), ("central", pa.int32()), ("prefix", pa.list_(pa.int64())), ("shared", pa.binary())])
#: Entries of one list that are compared as one group; longer lists are cut into blocks.
_LIST_ENTRIES = 2048
#: Classes and shared keys of one block in the counting of links, and the columns of one matrix product.
_BLOCK_SETS, _BLOCK_KEYS, _COLUMNS = 1024, 1 << 19, 1024


def needed(a: int, b: int) -> int:
    """Shingles that sets of a and b must share to link: 100 * shared >= 80 * (a + b - shared)."""
    return -(-4 * (a + b) // 9)


def partners(size: int) -> range:
    """Sizes of sets that can link with a set of this size."""
    return range(-(-4 * size // 5), 5 * size // 4 + 1)


def prefix_length(size: int) -> int:
    return size - -(-4 * size // 5) + 1


def shingle_keys(text: bytes) -> np.ndarray:
    """The distinct 64-bit keys of a text's shingles, sorted. A-Z are lower-cased; fewer than five words are one shingle."""
    ws = text.lower().split()
    n = len(ws)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, ws), np.uint64, n)
    k = min(n, WORDS)
    out = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        out = out * _STEP + h[i : n - k + 1 + i]
    return np.unique(mixed(out))


def _run_keys(sizes, texts) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The sets of a run's documents, the run's distinct keys and in how many of its documents each stands."""
    sets = [shingle_keys(t) for t in unpack(sizes, texts)]
    keys, counts = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    return sets, keys, counts


def _packed_keys(keys: np.ndarray) -> bytes:
    """Sorted integers as differences, byte by byte, so that the near-constant high bytes stand together."""
    steps = np.diff(keys, prepend=np.uint64(0))
    wide = len(steps) and int(steps.max()) >= 1 << 32
    kind = np.uint64 if wide else np.uint32
    return bytes([8 if wide else 4]) + steps.astype(kind).view(np.uint8).reshape(len(steps), -1).T.tobytes()


def _unpacked_keys(blob: bytes) -> np.ndarray:
    width = blob[0]
    planes = np.frombuffer(blob, np.uint8, offset=1).reshape(width, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64 if width == 8 else np.uint32).ravel().astype(np.uint64))


def _slices(bits: int):
    """For each run and shard (the leading bits of a key): the next 40 bits of the run's keys, and the counts over 1."""
    schema = arrow_schema("run long, shard int, keys binary, many binary, counts binary")

    @trimmed
    def cut(batches):
        for batch in batches:
            for run, sizes, texts in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                _, keys, counts = _run_keys(sizes, texts)
                edges = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(0, int)
                rows = []
                for shard, (low, high) in enumerate(zip([0, *edges.tolist()], [*edges.tolist(), len(keys)])):
                    if high > low:
                        short = (keys[low:high] >> np.uint64(64 - bits - _KEY_BITS)) & np.uint64((1 << _KEY_BITS) - 1)
                        many = np.flatnonzero(counts[low:high] > 1).astype(np.uint32)
                        rows.append((shard, _packed_keys(short), many.tobytes(), counts[low:high][many].astype(np.uint32).tobytes()))
                if rows:
                    yield record(schema, len(rows), run=[run] * len(rows), shard=[r[0] for r in rows], keys=[r[1] for r in rows], many=[r[2] for r in rows], counts=[r[3] for r in rows])

    return cut


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """For each slice of a shard: which keys stand in several documents (bits), and the frequency levels of those."""
    keys = [_unpacked_keys(k) for k in pdf["keys"]]
    lengths = [len(k) for k in keys]
    counts = [np.ones(n, np.uint32) for n in lengths]
    for c, many, n in zip(counts, pdf["many"], pdf["counts"]):
        c[np.frombuffer(many, np.uint32)] = np.frombuffer(n, np.uint32)
    flat, counts = np.concatenate(keys), np.concatenate(counts)
    del keys, c
    order = np.argsort(flat, kind="stable")
    flat, counts = flat[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    totals = np.empty(len(flat), np.int64)
    totals[order] = np.repeat(np.add.reduceat(counts, starts, dtype=np.int64), np.diff(starts, append=len(flat)))
    del flat, counts, order, starts
    bits, levels, at = [], [], 0
    for n in lengths:
        t = totals[at : at + n]
        at += n
        bits.append(np.packbits(t > 1).tobytes())
        levels.append(np.minimum(255, np.ceil(8 * np.log2(t[t > 1]))).astype(np.uint8).tobytes())
    del totals, t
    trim()
    return pd.DataFrame({"run": pdf["run"], "shard": pdf["shard"], "bits": bits, "levels": levels})


def _sets(bits: int):
    """The sets of each run, with the answers of the shards: live ones with their prefix and their shared keys."""

    @trimmed
    def digest_order(batches):
        for batch in batches:
            for run, ids, sizes, texts, answers in zip(*(batch.column(i).to_pylist() for i in range(5))):
                sets, keys, _ = _run_keys(sizes, texts)
                shared, level = np.zeros(len(keys), bool), np.zeros(len(keys), np.uint8)
                for a in answers or ():
                    low, high = (int(np.searchsorted(keys, np.uint64(x << 64 - bits))) if x >> bits == 0 else len(keys) for x in (a["shard"], a["shard"] + 1))
                    flags = np.unpackbits(np.frombuffer(a["bits"], np.uint8))[: high - low].astype(bool)
                    shared[low:high] = flags
                    level[low:high][flags] = np.frombuffer(a["levels"], np.uint8)
                rows = []
                for i, (doc_id, s) in enumerate(zip(ids, sets)):
                    at = np.searchsorted(keys, s)
                    known, n = shared[at], len(s)
                    live = bool(n) and 5 * int(known.sum()) >= 4 * n
                    row = [run << 20 | i, doc_id, n, live]
                    if live:
                        lv = level[at]
                        order = np.lexsort((s, lv))[: prefix_length(n)]
                        whole = xxhash.xxh3_128_digest(s.tobytes())
                        row += [*np.frombuffer(whole, np.int64).tolist(), int(8 * lv.mean()), np.where(known[order], s[order], np.uint64(0)).view(np.int64).tolist(), s[known].tobytes()]
                    else:
                        row += [None] * 5
                    rows.append(row)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SETS_ARROW)], schema=_SETS_ARROW)

    return digest_order


def shingle_sets(docs: DataFrame, ws: Workspace, id_col: str, text_col: str) -> DataFrame:
    """One row per document with the size of its set; live sets also with what joining them takes."""
    spark = docs.sparkSession
    bits = max(1, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    packed = pack_runs(docs, ws, id_col, text_col)
    slices = packed.mapInArrow(_slices(bits), "run long, shard int, keys binary, many binary, counts binary")
    answers = ws.write(slices.groupBy("shard").applyInPandas(_answer, "run long, shard int, bits binary, levels binary"), "answers")
    ws.drop()
    answered = answers.groupBy("run").agg(F.collect_list(F.struct("shard", "bits", "levels")).alias("answers"))
    joined = packed.join(answered, "run", "left").select("run", "doc_ids", "sizes", "texts", "answers")
    sets = ws.write(joined.mapInArrow(_sets(bits), _SETS), "sets")
    ws.drop("packed", "answers")
    return sets


def light_cost(m: int) -> int:
    """Subsets that a set of size m enumerates: one row each."""
    return sum(comb(m, needed(m, p)) for p in partners(m) if needed(m, p) <= m)


def heavy_cost(m: int, list_length: float) -> float:
    """A comparison of m shingles with each entry of the lists of its prefix, in rows."""
    return prefix_length(m) * (1 + list_length * m / 8)


def last_size(list_length: float) -> int:
    """The size from which on light sets cost more than heavy ones: subsets grow exponentially with it, lists as its square."""
    m = 1
    while light_cost(m) <= 1000 or light_cost(m) <= heavy_cost(m, list_length):
        m += 1
    return m


def light_boundary(sizes: dict[int, int], list_length: float) -> int:
    """The size up to which enumerating subsets costs least in all, lists included. sizes: number of sets of each size."""
    best, at, total = 0.0, 0, 0.0
    for m in range(1, last_size(list_length) + 1):
        total += sizes.get(m, 0) * (light_cost(m) - heavy_cost(m, list_length))
        if total <= best:
            best, at = total, m
    return at


def _subsets(boundary: int):
    """The subsets of light sets: (smaller size, larger size, digest) of the pair of sizes they are for."""
    schema = arrow_schema("a int, b int, s1 long, s2 long, cls long, size int")

    @trimmed
    def enumerate_(batches):
        for batch in batches:
            rows = []
            for cls, size, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
                keys = np.frombuffer(blob, np.uint64)
                for p in partners(size):
                    if p <= boundary and (o := needed(size, p)) <= min(size, p, len(keys)):
                        for c in combinations(keys, o):
                            rows.append((min(size, p), max(size, p), *np.frombuffer(xxhash.xxh3_128_digest(np.array(c).tobytes()), np.int64).tolist(), cls, size))
                            if len(rows) >= 50_000:
                                yield record(schema, len(rows), **{f.name: [r[i] for r in rows] for i, f in enumerate(schema)})
                                rows = []
            if rows:
                yield record(schema, len(rows), **{f.name: [r[i] for r in rows] for i, f in enumerate(schema)})

    return enumerate_


@trimmed
def _verified(batches):
    """The pairs that link, by exact intersection of their shared keys."""
    schema = arrow_schema("a long, b long")
    for batch in batches:
        found = []
        for a, b, m, n, x, y in zip(*(batch.column(i).to_pylist() for i in range(6))):
            both = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
            if 100 * both >= 80 * (m + n - both):
                found.append((a, b))
        yield record(schema, len(found), a=[f[0] for f in found], b=[f[1] for f in found])


def _links(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The links among pairs (a, b) of classes."""
    side = lambda name: classes.select(F.col("cls").alias(name), F.col("size").alias(f"{name}_size"), F.col("shared").alias(f"{name}_shared"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", "a_size", "b_size", "a_shared", "b_shared").mapInArrow(_verified, "a long, b long")


def _possible(x: str, y: str) -> str:
    """Whether two entries of one list can link: sizes, and what is left of each set from the entry on."""
    return f"least({x}size - {x}at, {y}size - {y}at) >= ceil(4 * ({x}size + {y}size) / 9D) and 5 * least({x}size, {y}size) >= 4 * greatest({x}size, {y}size)"


def _linking(m: np.ndarray, x: list[bytes], n: np.ndarray, y: list[bytes]) -> np.ndarray:
    """Which sets x (of sizes m) link with which sets y (of sizes n), as a table, by exact intersection of their shared keys."""
    lengths = [len(s) // 8 for s in (*x, *y)]
    _, column = np.unique(np.frombuffer(b"".join((*x, *y)), np.uint64), return_inverse=True)
    row = np.repeat(np.arange(len(lengths)), lengths)
    of_y = row >= len(x)
    wide = int(column.max()) + 1 if len(column) else 0
    both = (np.bincount(column[~of_y], minlength=wide) > 0) & (np.bincount(column[of_y], minlength=wide) > 0)
    kept, place = both[column], np.cumsum(both) - 1
    row, column = row[kept], place[column[kept]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((len(x), len(y)), np.float32)  # whole numbers below 2^24
    for low in range(0, int(both.sum()), _COLUMNS):
        at = slice(*np.searchsorted(column, [low, low + _COLUMNS]))
        table = np.zeros((len(lengths), int(column[at][-1]) - low + 1), np.float32)
        table[row[at], column[at] - low] = 1
        shared += table[: len(x)] @ table[len(x) :].T
    return 9 * shared.astype(np.int64) >= 4 * (m[:, None] + n)


@trimmed
def _tallied(batches):
    """For each two blocks (component, x, y), whose rows come one after another, the documents that each class links with."""
    schema = arrow_schema("cls long, linked long")

    def tally(key, rows):
        _, x, y = key
        sides = [rows] if x == y else [[r for r in rows if r[0] == side] for side in (x, y)]
        if all(sides) and len(rows) > 1:
            first, last = sides[0], sides[-1]
            sizes, copies = ([np.array([r[i] for r in side], np.int64) for side in (first, last)] for i in (2, 3))
            links = _linking(sizes[0], [r[4] for r in first], sizes[1], [r[4] for r in last])
            if x == y:
                np.fill_diagonal(links, False)
            found = [(first, links @ copies[1])] + ([(last, copies[0] @ links)] if x != y else [])
            for side, linked in found:
                yield record(schema, len(side), cls=[r[1] for r in side], linked=linked)

    at, held = None, []
    for batch in batches:
        for component, x, y, *row in zip(*(batch.column(i).to_pylist() for i in range(8))):
            if at != (component, x, y):
                yield from tally(at, held) if held else ()
                at, held = (component, x, y), []
            held.append(row)
    yield from tally(at, held) if held else ()
    held.clear()
    trim()


def link_counts(classes: DataFrame, labels: DataFrame, ws: Workspace) -> DataFrame:
    """(cls, linked): how many documents of other classes each class links with, if it links at all.

    A component of at most one block's classes and keys is one group. In others, sets that link are of one band or of two
    neighbouring ones, as a band is wider than a ratio of 5 / 4; bands are dealt by a hash into as many blocks as they need.
    """
    band = F.floor(F.log("size") / F.log(F.lit(1.26))).cast("long").alias("band")
    members = ws.write(classes.join(labels.withColumnRenamed("node", "cls"), "cls").select("component", "cls", "size", "copies", band, "shared"), "members")
    blocks = F.greatest(F.ceil(F.col("n") / _BLOCK_SETS), F.ceil(F.col("keys") / _BLOCK_KEYS))
    bands = ws.write(members.groupBy("component", "band").agg(F.count("*").alias("n"), F.sum(F.expr("length(shared) div 8")).alias("keys")), "bands")  # a few rows a component
    large = bands.groupBy("component").agg(F.sum("n").alias("n"), F.sum("keys").alias("keys")).where(blocks > 1).select("component")
    parts = ws.write(bands.join(large, "component", "left_semi").select("component", "band", blocks.alias("parts")), "parts")
    beside = lambda name, step: parts.select("component", (F.col("band") - step).alias("band"), F.col("parts").alias(name))
    ways = ws.write(parts.join(beside("below", -1), ["component", "band"], "left").join(beside("above", 1), ["component", "band"], "left"), "ways")
    n_classes = bands.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    dealt = attach(members, ways, ["component", "band"], bands.where(F.col("n") * HOT_KEYS > n_classes), "left").withColumn("me", F.expr("if(parts is null, 0L, shiftleft(band, 32) + pmod(xxhash64(cls), parts))"))
    meets = """if(parts is null, array(struct(0L as x, 0L as y)), concat(
        transform(sequence(0L, parts - 1), q -> struct(least(me, shiftleft(band, 32) + q) as x, greatest(me, shiftleft(band, 32) + q) as y)),
        if(below is null, array(), transform(sequence(0L, below - 1), q -> struct(shiftleft(band - 1, 32) + q as x, me as y))),
        if(above is null, array(), transform(sequence(0L, above - 1), q -> struct(me as x, shiftleft(band + 1, 32) + q as y)))))"""
    met = dealt.withColumn("met", F.explode(F.expr(meets))).select("component", "met.x", "met.y", "me", "cls", "size", "copies", "shared")
    grouped = met.repartition("component", "x", "y").sortWithinPartitions("component", "x", "y")
    counts = ws.write(grouped.mapInArrow(_tallied, "cls long, linked long").groupBy("cls").agg(F.sum("linked").alias("linked")), "link-counts")
    ws.drop("members", "parts", "bands", "ways")
    return counts


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", links: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, class_id, n_links, rid.

    Documents link at a Jaccard similarity of 0.8 or more of their sets of five-word shingles; component_id is the
    smallest doc_id that links reach. class_id is the smallest doc_id with an equal set, rid numbers the row. n_links is the exact number of
    other rows that a row links with, those of its class included; without `links` it is not counted, and null. Null and blank texts have empty
    sets, which link with nothing, each other included. A null doc_id is never the smallest unless there is no other.
    Repeated rows are documents of one class. A very long text is held whole, with some 40 bytes a word. An empty table
    gives no rows; other columns are not read.
    """
    spark = prepare(docs.sparkSession)
    ws = Workspace(spark, "jaccard")
    sets = shingle_sets(docs, ws, id_col, text_col)
    live = sets.where("live")
    ids = live.groupBy("h1", "h2").agg(F.min("rid").alias("cls"), F.min("doc_id").alias("least_id"), F.count("*").alias("copies"))
    classes = ws.write(ids.join(live.select(F.col("rid").alias("cls"), "size", "central", "prefix", "shared"), "cls"), "classes")

    entries = classes.selectExpr("cls", "size", "central", "posexplode(prefix) as (at, key)").where("key <> 0")
    lists = entries.agg(F.count("*").alias("n"), F.approx_count_distinct("key").alias("d")).first()
    length = lists["n"] / max(1, lists["d"])
    # At most as many rows as last_size, which follows the logarithm of the lists' length.
    sized = {r["size"]: r["n"] for r in classes.where(F.col("size") <= last_size(length)).groupBy("size").agg(F.count("*").alias("n")).collect()}
    boundary = light_boundary(sized, length)

    # Light: in the sets that enumerated one subset for sizes (a, b), those of size a link with all.
    subsets = classes.where(F.col("size") <= boundary).select("cls", "size", "shared").mapInArrow(_subsets(boundary), "a int, b int, s1 long, s2 long, cls long, size int")
    key = ["a", "b", "s1", "s2"]
    centre = subsets.groupBy(*key).agg(F.min(F.when(F.col("size") == F.col("a"), F.col("cls"))).alias("centre"), F.count("*").alias("n")).where("n > 1 and centre is not null")
    light = ws.write(subsets.join(centre, key).where("cls <> centre").select(F.col("centre").alias("a"), F.col("cls").alias("b")).distinct(), "light")

    # Heavy: every list is first compared with its most central set. Tables of one row a key are written before they are
    # joined, so that the lists meet them straight from a shuffle, whose hot keys Spark can split.
    heavy = entries.where(F.col("size") >= -(-4 * (boundary + 1) // 5))
    heads = heavy.groupBy("key").agg(F.max(F.struct("central", -F.col("cls"), "size", "at")).alias("h"), F.count("*").alias("n")).where("n > 1")
    heads = ws.write(heads.select("key", (-F.col("h.col2")).alias("head"), F.col("h.size").alias("head_size"), F.col("h.at").alias("head_at"), "n"), "heads")
    total = heads.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = heads.where(F.col("n") * HOT_KEYS > total)
    posted = ws.write(attach(heavy, heads, ["key"], hot), "lists")
    first = posted.where("cls <> head").where(_possible("", "head_")).selectExpr("least(cls, head) as a", "greatest(cls, head) as b").distinct()
    tried = ws.write(first, "tried")
    linked = ws.write(_links(tried, classes), "linked")
    every = light.union(linked)
    labels = components(every, ws, "first")

    # What still stands apart in one list: all but the largest component of a list against all others, block by block.
    marked = ws.write(posted.select("key", "cls", "size", "at", "n").join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls")), "marked")
    shares = marked.groupBy("key", "component").agg(F.count("*").alias("m"))
    largest = ws.write(shares.groupBy("key").agg(F.max(F.struct("m", "component")).alias("m"), F.count("*").alias("parts")).where("parts > 1").select("key", F.col("m.component").alias("largest")), "largest")
    split = ws.write(attach(marked, largest, ["key"], hot).withColumn("blocks", F.ceil(F.col("n") / _LIST_ENTRIES)).withColumn("block", F.expr("pmod(xxhash64(cls), blocks)")), "split")
    columns = lambda side: [F.col(c).alias(f"{side}_{c}") for c in ("cls", "size", "at", "component")]
    over = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    x = split.where("component <> largest").select("key", F.col("block").alias("i"), over.alias("j"), *columns("x"))
    y = split.select("key", over.alias("i"), F.col("block").alias("j"), *columns("y"))
    apart = x.join(y, ["key", "i", "j"]).where("x_component <> y_component").where(_possible("x_", "y_")).selectExpr("least(x_cls, y_cls) as a", "greatest(x_cls, y_cls) as b").distinct()
    rest = ws.write(_links(apart.join(tried, ["a", "b"], "left_anti"), classes), "rest")
    if not rest.isEmpty():
        labels = components(every.union(rest), ws, "second")
    ws.drop("lists", "split", "tried", "marked", "heads", "largest")

    counts = link_counts(classes, labels, ws) if links else None

    named = classes.select("h1", "h2", "cls", "least_id", "copies").join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    named = ws.write(named.join(counts, "cls", "left") if links else named.withColumn("linked", F.lit(None).cast("long")), "named")
    n_links = (F.col("copies") - 1 + F.coalesce("linked", F.lit(0)) if links else F.lit(None)).cast("long").alias("n_links")
    smallest = ws.write(named.groupBy("component").agg(F.min("least_id").alias("component_id"), F.count("*").alias("classes")), "smallest")
    n_classes, n_live = named.agg(F.count("*"), F.coalesce(F.sum("copies"), F.lit(0))).first()
    placed = attach(named, smallest.select("component", "component_id"), ["component"], smallest.where(F.col("classes") * HOT_KEYS > n_classes))
    placed = ws.write(placed.select("h1", "h2", "component_id", F.col("least_id").alias("class_id"), n_links, "copies"), "placed")
    out = attach(live.select("rid", "doc_id", "size", "h1", "h2"), placed, ["h1", "h2"], placed.where(F.col("copies") * HOT_KEYS > n_live))
    done = sets.where("not live").select("rid", "doc_id", "size", F.col("doc_id").alias("component_id"), F.col("doc_id").alias("class_id"), F.lit(0 if links else None).cast("long").alias("n_links"))
    both = out.select("rid", "doc_id", "size", "component_id", "class_id", "n_links").unionByName(done)
    return both.select("doc_id", F.col("size").cast("long").alias("n_shingles"), "component_id", "class_id", "n_links", "rid")


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of docs for each component of near duplicates, with its columns: that of the smallest id.

    Rows are told apart by a number of their own: rows with one id, or without any, are documents like any other; rows
    without an id stay only if their component has none with one. Null and blank texts link with nothing, so all stay.
    """
    docs, row = numbered(docs, Workspace(prepare(docs.sparkSession), "near"))
    found = near_duplicates(docs, row, text_col, links=False).select(F.col("doc_id").alias(row), F.col("component_id").alias("__component"))
    ranked = F.struct(F.col("__id").isNull(), "__id", row)
    best = found.join(docs.select(row, F.col(id_col).cast("long").alias("__id")), row).groupBy("__component").agg(F.min(ranked)[row].alias(row))
    return docs.join(best.select(row), row, "left_semi").drop(row)
