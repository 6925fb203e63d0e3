"""Exact vector search over blocks around pivots: a block is skipped if nothing in it can be among a query's best.

Vectors are dealt to the nearest of some centres and packed in blocks of near ones. An inner product with a vector of a block is
at most that with the block's centre plus the query's length times the block's radius. The blocks with the largest
bounds are searched first, for each query a few; the kth score there is the threshold that all other blocks have to reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import vector_blocks
from ..sources.scratch import stored
from .sampling import hash_order

#: Centres at most (what the driver holds), blocks searched first for each query, and how close scores count as equal.
CENTRES, PROBES, CLOSE = 1024, 4, 1e-8


def blocks_around_centres(vectors: DataFrame, key: str = "chunk_id", vector: str = "embedding", kind: str = "flat", rows: int = vector_blocks.ROWS, centres: int = CENTRES) -> DataFrame:
    """Blocks of vectors that lie near each other. The centres are vectors drawn by hash, one for `rows` vectors and `centres` at most.

    Vectors are dealt along (centre, distance), so a centre that many lie around spreads over tasks.
    """
    spark, n = vectors.sparkSession, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = vectors.where(F.size(vector) > 0)
    wanted = min(centres, -(-some.count() // rows))
    drawn = [np.nan_to_num(np.array(r[0], float)) for r in some.orderBy(hash_order(key)).limit(wanted).select(F.col(vector).cast("array<double>")).collect()] if wanted else []
    by_dim: dict[int, np.ndarray] = {d: np.stack([c for c in drawn if len(c) == d]) for d in {len(c) for c in drawn}}
    sent = spark.sparkContext.broadcast(by_dim)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch.column(1).offsets.to_numpy())
            centre, far = np.zeros(len(sizes), np.int64), np.zeros(len(sizes))
            values = np.nan_to_num(batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(float))
            for d in set(sizes.tolist()) & set(sent.value):
                at = np.flatnonzero(sizes == d)
                starts = (np.cumsum(sizes) - sizes)[at]
                m, c = values[starts[:, None] + np.arange(d)], sent.value[d]
                square = (m * m).sum(axis=1)[:, None] - 2 * m @ c.T + (c * c).sum(axis=1)
                centre[at], far[at] = square.argmin(axis=1), square.min(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(centre), pa.array(far)], names=["k", "v", "width", "centre", "far"])

    dealt = some.select(F.col(key).alias("k"), F.col(vector).cast("array<float>").alias("v")).mapInArrow(deal, f"k {dict(vectors.dtypes)[key]}, v array<float>, width int, centre long, far double")
    order = ("width", "centre", "far", "k")
    return vector_blocks.packed(dealt.repartitionByRange(n, *order).sortWithinPartitions(*order), "k", "v", kind, rows, group="centre")


def _bounds(q: np.ndarray, lengths: np.ndarray, centre: bytes, radius: float) -> np.ndarray:
    return q @ np.frombuffer(centre, np.float64) + lengths * radius


def _best(which: np.ndarray, score: np.ndarray, keys: np.ndarray, k: int) -> np.ndarray:
    """The places of the k best of each query, equal scores by key."""
    order = np.lexsort((keys, -np.round(score, 9), which))
    w = which[order]
    first = np.flatnonzero(np.diff(w, prepend=-1))
    return order[np.arange(len(w)) - np.repeat(first, np.diff([*first, len(w)])) < k]


def _search(sent, k: int, schema: str, only_count: bool = False):
    """A task's k best of each query, from blocks that can reach what is known of its kth score; or the pairs of a query and a block that it would look at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, q, least = sent.value
        least, lengths = least.copy(), np.sqrt((q * q).sum(axis=1)) * (1 + 1e-9)
        which, score, keys, field = np.zeros(0, np.int64), np.zeros(0), None, None
        seen = pairs = 0
        for batch in batches:
            field = batch.schema.field("keys").type.value_type
            for dim, kind, names, centre, radius, data in zip(*(batch.column(c).to_pylist() for c in ("dim", "kind", "keys", "centre", "radius", "vectors"))):
                if dim != q.shape[1]:
                    continue
                live = np.flatnonzero(_bounds(q, lengths, centre, radius) >= least - CLOSE)
                seen, pairs = seen + len(q), pairs + len(live)
                if only_count or not len(live):
                    continue
                s = q[live] @ vector_blocks.matrix(dim, kind, data).T
                i, j = np.nonzero(s >= least[live][:, None] - CLOSE)
                if not len(i):
                    continue
                names = np.array(names)
                keys = names[j] if keys is None else np.concatenate([keys, names[j]])
                which, score = np.concatenate([which, live[i]]), np.concatenate([score, s[i, j]])
                keep = _best(which, score, keys, k)
                which, score, keys = which[keep], score[keep], keys[keep]
                full = np.bincount(which, minlength=len(q)) >= k
                worst = np.full(len(q), np.inf)
                np.minimum.at(worst, which, score)
                least = np.where(full, np.maximum(least, worst), least)
        if only_count:
            yield pa.RecordBatch.from_arrays([pa.array([seen]), pa.array([pairs])], names=["pairs", "pairs_read"])
        elif len(which):
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(which)), pa.array(keys.tolist(), field), pa.array(score)], names=["query_id", "chunk_id", "similarity"])

    return run


def _nearest(sent, probes: int):
    """A task's blocks with the largest bounds for each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, q, _ = sent.value
        lengths = np.sqrt((q * q).sum(axis=1))
        best = np.zeros((len(q), 0))
        names = np.zeros((len(q), 0), np.int64)
        for batch in batches:
            rows = [(n, _bounds(q, lengths, c, r)) for n, d, c, r in zip(*(batch.column(c).to_pylist() for c in ("block", "dim", "centre", "radius"))) if d == q.shape[1]]
            if rows:
                best = np.hstack([best, np.stack([b for _, b in rows], axis=1)])
                names = np.hstack([names, np.tile([n for n, _ in rows], (len(q), 1))])
                top = np.argsort(-best, axis=1, kind="stable")[:, :probes]
                best, names = np.take_along_axis(best, top, 1), np.take_along_axis(names, top, 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(q)), best.shape[1])), pa.array(names.ravel()), pa.array(best.ravel())], names=["q", "block", "bound"])

    return run


def search(queries: DataFrame, blocks: DataFrame, k: int, query_id: str = "query_id", vector: str = "embedding", probes: int = PROBES, block_bytes: int = 32 << 20) -> DataFrame:
    """(query_id, chunk_id, similarity, dense_rank): what ranking.dense_topk gives over the vectors of `blocks`, a stored table.

    Query vectors go in blocks of block_bytes at most, which are all that the driver and a broadcast hold. The width is that of
    most queries; others, and null ones, are left out. Equal scores go by key. Each block of queries reads the centres of
    all blocks, then a few blocks, then those blocks that it needs the vectors of.
    """
    kinds = dict(queries.dtypes)[query_id], dict(blocks.dtypes)["keys"][len("array<") : -1]
    schema = f"query_id {kinds[0]}, chunk_id {kinds[1]}, similarity double"
    by_score = Window.partitionBy("query_id").orderBy(F.desc(F.round("similarity", 9)), "chunk_id")
    out = None
    for sent in _asked(queries, blocks, k, query_id, vector, probes, block_bytes, schema):
        part = blocks.mapInArrow(_search(sent, k, schema), schema).withColumn("dense_rank", F.row_number().over(by_score)).where(F.col("dense_rank") <= k)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else queries.sparkSession.createDataFrame([], f"{schema}, dense_rank int")


def share_read(queries: DataFrame, blocks: DataFrame, k: int, query_id: str = "query_id", vector: str = "embedding", probes: int = PROBES, block_bytes: int = 32 << 20) -> DataFrame:
    """One row: pairs of a query and a block, those that a search multiplies, and their share."""
    key_type = dict(blocks.dtypes)["keys"][len("array<") : -1]
    counted = [blocks.mapInArrow(_search(sent, k, "", only_count=True), "pairs long, pairs_read long") for sent in _asked(queries, blocks, k, query_id, vector, probes, block_bytes, f"query_id {dict(queries.dtypes)[query_id]}, chunk_id {key_type}, similarity double")]
    every = counted[0]
    for c in counted[1:]:
        every = every.unionByName(c)
    return every.agg(F.sum("pairs").alias("pairs"), F.sum("pairs_read").alias("pairs_read")).withColumn("share", F.col("pairs_read") / F.col("pairs"))


def _asked(queries: DataFrame, blocks: DataFrame, k: int, query_id: str, vector: str, probes: int, block_bytes: int, schema: str):
    """Broadcasts of (ids, vectors, threshold) of queries, a block of them at a time; thresholds come from the nearest blocks."""
    spark = queries.sparkSession
    named = stored(queries.select(F.col(query_id).alias("query_id"), F.col(vector).cast("array<double>").alias("v")).where("size(v) > 0"))
    top = named.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if top is None:
        return
    n_blocks = max(1, -(-top["count"] * top["d"] * 8 // block_bytes))
    named = named.where(F.size("v") == top["d"])
    numbered = blocks.withColumn("block", F.xxhash64("centre", "radius", "keys"))  # equal blocks are as good as one another
    for i in range(n_blocks):
        rows = (named if n_blocks == 1 else named.where(F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)) == i)).toArrow()
        if not rows.num_rows:
            continue
        ids = pa.concat_arrays(rows.column("query_id").chunks)
        q = np.nan_to_num(pa.concat_arrays(rows.column("v").chunks).flatten().to_numpy(zero_copy_only=False)).reshape(len(ids), top["d"])
        first = spark.sparkContext.broadcast((ids, q, np.full(len(q), -np.inf)))
        by_bound = Window.partitionBy("q").orderBy(F.desc("bound"), "block")
        near = numbered.select("block", "dim", "centre", "radius").mapInArrow(_nearest(first, probes), "q long, block long, bound double")
        chosen = near.withColumn("i", F.row_number().over(by_bound)).where(F.col("i") <= probes).select("block").distinct()
        found = numbered.join(chosen, "block", "left_semi").drop("block").mapInArrow(_search(first, k, schema), schema)
        kth = found.withColumn("i", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("similarity")))).where(F.col("i") == k)
        known = {r["query_id"]: r["similarity"] for r in kth.select("query_id", "similarity").collect()}  # one row a query of the block
        yield spark.sparkContext.broadcast((ids, q, np.array([known.get(x, -np.inf) for x in ids.to_pylist()])))
