"""Hard negatives by norm-bucketed search.

Vectors are turned into whole numbers, sorted by norm and packed into buckets of similar norm. Anchors meet the buckets in
blocks of a bounded size, in two searches: one for the best rows of the anchor's own label, its positives, and one for the
best rows of other labels whose score lies in the window of a positive. An inner product is at most the product of both
norms, so a bucket is passed over for an anchor if its largest norm times the anchor's is below what every window of the
anchor asks for: the window's lower limit, or the kth score found so far where that is higher. Each task walks its buckets
from the largest norm down, so that the kth scores rise early.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Workspace, prepare, trimmed

#: Rows of a bucket, anchors of a block (what the driver and a broadcast hold at once), anchors of a matrix product.
BUCKET_ROWS, BLOCK_ROWS, AT_ONCE = 4096, 16_384, 512
#: Bytes of a bucket's and a block's vectors at most, as doubles; wide vectors make them smaller.
BUCKET_BYTES, BLOCK_BYTES = 8 << 20, 32 << 20
#: Sums of products below this are exact in double precision.
EXACT = 1 << 53
#: Stands for a null id inside: it sorts last.
NO_ID = (1 << 63) - 1

_BUCKET = "bucket long, width int, norm double, ids binary, labels binary, vectors binary"
_ANCHOR = "row long, id long, label long, width int, vector binary"
_FOUND = "anchor_row long, anchor_id long, positive_row long, positive_id long, positive_score long, row long, id long, score long"
_FOUND_ARROW = pa.schema([(c.split()[0], pa.int64()) for c in _FOUND.split(", ")])


def whole(components: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) of doubles, as doubles that are whole numbers."""
    out = np.floor(components.astype(np.float64) * scale)
    if not np.isfinite(out).all():
        raise OverflowError("a component is too large for its scale")
    return out


def packed_buckets(vectors: DataFrame, ws: Workspace, scale: float, bucket_rows: int) -> DataFrame:
    """Buckets of rows (id, label, v) of one width, sorted by norm: their largest norm, ids, labels and whole-numbered vectors."""
    ok = F.col("label").isNotNull() & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    rows = vectors.where(ok).withColumn("id", F.coalesce("id", F.lit(NO_ID))).withColumns({"width": F.size("v"), "about": F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)})
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "width", F.desc("about"), "id").sortWithinPartitions("width", F.desc("about"), "id")

    @trimmed
    def pack(batches):
        from pyspark import TaskContext

        number, held, width = TaskContext.get().partitionId() << 24, [], -1

        def bucket(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
            ids, labels, m = (np.concatenate(x) for x in zip(*rows))
            norm = float(np.sqrt((m * m).sum(axis=1)).max()) * (1 + 1e-9) if m.size else 0.0
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([width], pa.int32()), pa.array([norm]), pa.array([ids.tobytes()]), pa.array([labels.tobytes()]), pa.array([(m.astype(np.int32) if m.size and np.abs(m).max() < 1 << 31 else m).tobytes()])], names=[c.split()[0] for c in _BUCKET.split(", ")])

        for batch in batches:
            ids, labels, widths = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3))
            edges = [0, *(np.flatnonzero(np.diff(widths)) + 1).tolist(), len(ids)] if len(ids) else []
            for low, high in zip(edges, edges[1:]):
                if widths[low] != width and held:
                    yield bucket(held)
                    number, held = number + 1, []
                width = int(widths[low])
                most = min(bucket_rows, max(1, BUCKET_BYTES // (8 * max(1, width))))
                m = whole(batch.column(2).slice(low, high - low).flatten().to_numpy(zero_copy_only=False).reshape(high - low, width), scale)
                while low < high:
                    take = min(high - low, most - sum(len(x[0]) for x in held))
                    held.append((ids[low : low + take], labels[low : low + take], m[len(m) - (high - low) :][:take]))
                    low += take
                    if sum(len(x[0]) for x in held) == most:
                        yield bucket(held)
                        number, held = number + 1, []
        if held:
            yield bucket(held)

    return ws.write(dealt.select("id", "label", "v", "width").mapInArrow(pack, _BUCKET), "buckets")


def unpacked(data: bytes, n: int, width: int) -> np.ndarray:
    kind = np.int32 if len(data) == 4 * n * width else np.float64
    return np.frombuffer(data, kind).reshape(n, width).astype(np.float64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of a with those of b."""
    if not a.size or not b.size or a.shape[1] * np.abs(a).max() * np.abs(b).max() < EXACT:
        return a @ b.T
    exact = np.array([[int(x) for x in r] for r in a], object) @ np.array([[int(x) for x in r] for r in b], object).T
    if max(map(abs, exact.ravel()), default=0) >= 1 << 63:
        raise OverflowError("a score does not fit into 64 bits")
    return exact


def not_above(n: int) -> float:
    """The largest double that is at most n."""
    return float(n) if float(n) <= n else float(np.nextafter(float(n), -np.inf))


@dataclass
class Windows:
    """What is asked of each anchor of a block, sorted by width: rows of its own or of other labels, k for each window of scores low..high."""

    rows: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    widths: np.ndarray
    vectors: list[bytes]
    #: The windows of anchor i are begins[i]..begins[i + 1]; low and high hold whole numbers.
    begins: np.ndarray
    low: np.ndarray
    high: np.ndarray
    #: (row, id, score) of the positive of each window, if it has one.
    positives: list[tuple[int, int, int]] | None
    k: int
    same: bool


def search(asked: Windows, buckets: Iterator[tuple]) -> Iterator[tuple[int, int, int, int]]:
    """(window, row, id, score): the k best of each window over these buckets (number, width, norm, ids, labels, vectors), equal scores by id.

    Buckets may come in any order; with falling norms fewer of them are multiplied.
    """
    k = asked.k
    kth = asked.low.copy()  # what a row has to reach to matter
    best: list[list[tuple]] = [[] for _ in asked.low]
    anchors: dict[int, tuple] = {}
    for number, width, norm, ids, labels, vectors in buckets:
        if width not in anchors:
            at = np.flatnonzero(asked.widths == width)
            m = unpacked(b"".join(asked.vectors[i] for i in at), len(at), width) if len(at) else np.zeros((0, width))
            anchors[width] = at, m, np.sqrt((m * m).sum(axis=1)) * (1 + 1e-9)
        at, m, norms = anchors[width]
        if not len(at):
            continue
        least = np.minimum.reduceat(kth, asked.begins[:-1])[at]
        live = np.flatnonzero(norms * norm >= least)
        if not len(live):
            continue
        b, ids, labels = unpacked(vectors, len(ids) // 8, width), np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        order = np.argsort(ids, kind="stable")
        b, ids, labels, rows = b[order], ids[order], labels[order], (number << 16) + order
        for low in range(0, len(live), AT_ONCE):
            some = live[low : low + AT_ONCE]
            who = at[some]
            s = products(m[some], b)
            allowed = (labels[None, :] == asked.labels[who][:, None]) == asked.same
            if asked.same:
                allowed &= rows[None, :] != asked.rows[who][:, None]
            allowed &= s >= least[some][:, None]
            i, j = np.nonzero(allowed)
            if not len(i):
                continue
            value = s[i, j]
            levels, level = np.unique(value, return_inverse=True)
            # By anchor, falling score and rising id: the columns stand in the order of ids, and nonzero goes row by row.
            key = i.astype(np.int64) * len(levels) + (len(levels) - 1 - level)
            put = np.argsort(key, kind="stable")
            key, i, j, value = key[put], i[put], j[put], value[put]
            for x in np.unique(i):
                for w in range(asked.begins[who[x]], asked.begins[who[x] + 1]):
                    top = np.searchsorted(levels, asked.high[w], "right") if asked.high[w] is not None else len(levels)
                    first = np.searchsorted(key, x * len(levels) + (len(levels) - top))
                    found = []
                    for y in range(first, min(first + k, len(key))):
                        if i[y] != x or value[y] < kth[w]:
                            break
                        found.append((-int(value[y]), int(ids[j[y]]), int(rows[j[y]])))
                    if found:
                        best[w] = sorted(best[w] + found)[:k]
                        if len(best[w]) == k:
                            kth[w] = not_above(-best[w][-1][0])
    for w, found in enumerate(best):
        for score, id_, row in found:
            yield w, row, id_, -score


def _search_task(sent) -> Callable:
    @trimmed
    def run(batches):
        asked: Windows = sent.value
        owner = np.repeat(np.arange(len(asked.rows)), np.diff(asked.begins))
        columns = "bucket width norm ids labels vectors".split()
        buckets = (tuple(batch.column(c)[i].as_py() for c in columns) for batch in batches for i in range(batch.num_rows))
        out = []
        for w, row, id_, score in search(asked, buckets):
            a, p = owner[w], asked.positives[w] if asked.positives else (None, None, None)
            out.append((int(asked.rows[a]), int(asked.ids[a]), *p, row, id_, score))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 8, schema=_FOUND_ARROW)

    return run


def _anchors(buckets: DataFrame, ws: Workspace, wanted) -> DataFrame:
    """The rows of the buckets whose ids are wanted, one vector a row."""

    @trimmed
    def pick(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids, labels = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["labels"], np.int64)
                m = unpacked(r["vectors"], len(ids), r["width"])
                at = np.flatnonzero(wanted(ids) & (ids != NO_ID))
                yield pa.RecordBatch.from_arrays([pa.array((r["bucket"] << 16) + at, pa.int64()), pa.array(ids[at]), pa.array(labels[at]), pa.array([r["width"]] * len(at), pa.int32()), pa.array([m[i].tobytes() for i in at], pa.binary())], names=[c.split()[0] for c in _ANCHOR.split(", ")])

    return ws.write(buckets.mapInArrow(pick, _ANCHOR), "anchors")


def best_of(found: DataFrame, k: int, *window: str) -> DataFrame:
    """The k best of each window over the tasks' own bests, with rank from 1."""
    w = Window.partitionBy(*window).orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mine_hard_negatives(vectors: DataFrame, every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str | Column = "label", bucket_rows: int = BUCKET_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor, a row whose id `every` divides, and each
    of its positives, its first rows of the same label, the first rows of other labels with low % to high % of the positive's score.

    A score is the inner product of the whole-numbered vectors floor(scale * x); higher scores come first, then smaller ids.
    Rows with a null label, a null vector or a component that is null or not finite take no part. A null id comes last and
    is never an anchor. Repeated rows, or rows that share an id, are rows of their own: each is another row to its copies, and
    each copy of an anchor has its own results. Vectors are compared with those of their own width; empty ones score 0. An
    empty table, or one without anchors, gives no rows; so does a positive with a negative score, whose window is empty.
    Other columns play no part. Scores are exact; OverflowError if one does not fit into 64 bits, or a scaled component into a double.

    The rows, packed into buckets, are shuffled once, along their norms; each block of anchors, of which there is one for block_rows,
    reads the buckets twice. The driver and a broadcast hold one block, of BLOCK_BYTES on average. What is shuffled after a search is the k best of each
    window and task.
    """
    spark = prepare(vectors.sparkSession)
    ws = Workspace(spark, "negatives")
    label = label_col if isinstance(label_col, Column) else F.col(label_col)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    buckets = packed_buckets(rows, ws, scale, bucket_rows)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = ws.write(buckets.repartition(n, "bucket").sortWithinPartitions(F.desc("norm")), "dealt")  # each task has buckets of all norms, the largest first
    anchors = _anchors(buckets, ws, lambda ids: ids % every == 0)
    size = anchors.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("vector")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size["n"] // block_rows), -(-size["bytes"] // BLOCK_BYTES))
    parts = []
    for block in range(blocks):
        rows = sorted((anchors if blocks == 1 else anchors.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block)).collect(), key=lambda r: r["row"])
        own = Windows(*(np.array([r[c] for r in rows], np.int64) for c in ("row", "id", "label", "width")), [bytes(r["vector"]) for r in rows], np.arange(len(rows) + 1), np.full(len(rows), -np.inf), np.full(len(rows), None), None, positives, True)
        sent = spark.sparkContext.broadcast(own)
        near = ws.write(best_of(dealt.mapInArrow(_search_task(sent), _FOUND), positives, "anchor_row"), f"positives_{block}")
        sent.unpersist()
        chosen: dict[int, list[tuple[int, int, int]]] = {}
        for r in near.orderBy("rank").select("anchor_row", "row", "id", "score").collect():  # at most `positives` an anchor of the block
            chosen.setdefault(r["anchor_row"], []).append((r["row"], r["id"], r["score"]))
        has = [i for i, r in enumerate(rows) if r["row"] in chosen]
        of = [p for i in has for p in chosen[rows[i]["row"]]]
        begins = np.cumsum([0, *(len(chosen[rows[i]["row"]]) for i in has)])
        asked = Windows(own.rows[has], own.ids[has], own.labels[has], own.widths[has], [own.vectors[i] for i in has], begins, np.array([not_above(-(-low * p[2] // 100)) for p in of]), np.array([high * p[2] // 100 for p in of], object), of, negatives, False)
        sent = spark.sparkContext.broadcast(asked)
        parts.append(ws.write(best_of(dealt.mapInArrow(_search_task(sent), _FOUND), negatives, "anchor_row", "positive_row"), f"negatives_{block}"))
        sent.unpersist()
        ws.drop(f"positives_{block}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    ws.drop("buckets", "dealt", "anchors")
    known = lambda c: F.nullif(F.col(c), F.lit(NO_ID))
    return out.select("anchor_id", known("positive_id").alias("positive_id"), "rank", known("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
